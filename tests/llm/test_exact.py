import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.llm.conftest import EDGE_ROWS, SCHEMA
from tributary.llm.exact import drop_exact_duplicates, exact_duplicates


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        kept_one = False
        for i in ids:
            kept = i == keep and not kept_one
            kept_one |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in exact_duplicates(df, digest_all=True, **kw).collect()), key=repr)


def test_edge_rows_against_brute_force(edge):
    assert got(edge) == brute([r[:2] for r in EDGE_ROWS])


def test_saturated_bit_table_changes_nothing(edge):
    """With few bits every row looks like a candidate; the result is the same."""
    assert got(edge, bits=32) == brute([r[:2] for r in EDGE_ROWS])


def test_without_digests_only_the_hash_column_is_missing(edge):
    plain = sorted((tuple(r) for r in exact_duplicates(edge).collect()), key=repr)
    assert plain == sorted((r[:4] for r in got(edge)), key=repr)


def test_equal_prefix_and_length_but_other_ending(spark):
    a = "same " * 100
    df = spark.createDataFrame([(1, a + "x"), (2, a + "y"), (3, a + "x")], "doc_id bigint, text string")
    assert got(df) == brute([(1, a + "x"), (2, a + "y"), (3, a + "x")])


def test_empty_table(nothing):
    assert exact_duplicates(nothing).collect() == []
    assert drop_exact_duplicates(nothing).collect() == []


def test_drop_keeps_columns_and_one_of_each(edge, clashing):
    for df in (edge, clashing):
        out = drop_exact_duplicates(df)
        assert out.columns == df.columns
        kept = sorted((r.doc_id for r in out.collect()), key=repr)
        assert kept == sorted((r[0] for r in brute([r[:2] for r in EDGE_ROWS]) if r[3]), key=repr)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a b", "a  b", "a\nb", "ab", "", None, " "])), max_size=12))
def test_random_rows(spark, rows):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    assert got(df) == brute(rows)


@pytest.mark.parametrize("n", [1, 300])
def test_hot_group(spark, n):
    df = spark.range(n).selectExpr("id as doc_id", "'copy' as text")
    assert {(r.keep_id, r.group_size) for r in exact_duplicates(df).collect()} == {(0, n)}
