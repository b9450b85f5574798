import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import EDGE_ROWS
from tributary.llm import mixing as M


def words(t):
    return len(re.findall("[^\x20\x09-\x0D]+", t or ""))


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Stops and shares again, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        part = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if part[s] > cap * sizes[s]]
        if not over:
            return {**out, **part}
        for s in over:
            out[s] = cap * sizes[s]
            open_.discard(s)
            left -= cap * sizes[s]
    return out


def check(rows, docs):
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    by_id = {i: (t, s) for i, t, s in docs}
    for r in rows:
        t, s = by_id[r.doc_id]
        assert r.size == words(t) and r.source_size == sizes[s]
        assert math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-6)
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:  # what is left open is less than the smallest documents
        assert abs(taken[s] - want[s]) <= max([words(t) for _, t, x in docs if x == s] + [1])
    return taken, want


def plan(df, **kw):
    return M.mix_plan(df, **kw).collect()


def test_edge_rows(edge, clashing):
    docs = [(r[0], r[1], r[3]) for r in EDGE_ROWS]
    check(plan(edge), docs)
    assert sorted(map(repr, plan(edge))) == sorted(map(repr, plan(clashing)))


def test_many_documents_hit_the_target(spark):
    docs = [(i, " ".join(["w"] * (1 + (i * 7919) % 400)), f"s{i % 5}") for i in range(1000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    taken, want = check(plan(df), docs)
    assert all(abs(taken[s] - want[s]) <= 5 for s in want)
    assert sorted(map(repr, plan(df))) == sorted(map(repr, plan(df.repartition(7))))


def test_rates_are_exponential_tilts(spark):
    """The dual variable gives the target: checked against bisection in Python."""
    cells = [("a", k, 1 + k % 3) for k in range(1, 60)]
    total = sum(k * n for _, k, n in cells)
    df = spark.createDataFrame(cells, "source string, size bigint, n bigint")
    for share in (0.05, 0.7, 1.0, 1.3, 1.97):
        t = spark.createDataFrame([("a", total, total * share)], "source string, words bigint, target double")
        lam = M.dual_variables(df, t).first().lam
        mean = total / sum(n for *_, n in cells)
        got = sum(n * k * min(2.0, math.exp(lam * k / mean)) for _, k, n in cells)
        assert math.isclose(got, total * share, rel_tol=1e-8)


def test_hot_cell_is_dealt_exactly(spark, monkeypatch):
    monkeypatch.setattr(M, "RANKED_TOGETHER", 10)
    docs = [(i, "same size here", "hot") for i in range(300)] + [(i, "other", "cold") for i in range(300, 310)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    rows = plan(df)
    check(rows, docs)
    assert {r.copies for r in rows if r.doc_id < 300} <= {1, 2}


def test_empty_and_wordless_tables(spark, nothing):
    assert plan(nothing) == [] and M.mixed(nothing).collect() == []
    df = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id bigint, text string, source string")
    assert [(r.taken, r.target) for r in plan(df)] == [(0, 0.0)] * 2


def test_mixed_rows_are_the_plan_s_copies(edge, clashing):
    want = {}
    for r in plan(edge):
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    for df in (edge, clashing):
        out = M.mixed(df)
        assert out.columns == df.columns
        got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
        assert got == {i: n for i, n in want.items() if n}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.sampled_from(["a", "b", "é", None])), min_size=1, max_size=15))
def test_random_sources(spark, rows):
    docs = [(i, "w " * n, s) for i, (n, s) in enumerate(rows)]
    check(plan(spark.createDataFrame(docs, "doc_id bigint, text string, source string")), docs)


def test_ranks_by_code_point_with_null_last(spark):
    df = spark.createDataFrame([("b", 1), (None, 1), ("B", 1), ("é", 1), ("\U0001f600", 1), ("￿", 1)], "source string, words bigint")
    ranked = [r.source for r in M._ranked(df).orderBy(F.col("rank")).collect()]
    assert ranked == ["B", "b", "é", "￿", "\U0001f600", None]
