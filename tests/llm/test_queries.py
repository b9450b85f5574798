"""The registered queries against their SQL, or against brute force over the small tables."""

import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from tests.llm.conftest import SCHEMA
from tributary.llm.oracle import ORACLE_SQL
from tributary.llm.queries import PIECE_MODEL, QUERIES, vocabulary


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf, key):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[key](spark, sf)
    want = con.execute(ORACLE_SQL[key])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))


def test_all_operators_and_the_pipeline_are_registered():
    names = [k for k in E.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


def test_native_operators_run_no_python(spark, sf):
    for key in ("op4_exact_dedup", "op5_url_rules", "op7_entropy_mixing", "op9_surrogates"):
        plan = QUERIES[key](spark, sf)._jdf.queryExecution().toString()
        assert not re.search("MapIn|Python|Pandas|ArrowEval", plan), key


def test_pipeline_stages_against_brute_force(spark, sf):
    """Each stage on its own input, by plain Python over all rows."""
    import sentencepiece
    import zstandard

    from tests.llm.test_exact import brute as exact_brute
    from tests.llm.test_simhash import components
    from tributary.llm import quality, simhash
    from tributary.session import scratch_dir

    docs, tables = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in C.STAGES:
        path = scratch_dir(spark, "stage")
        stage(spark, docs, sf).write.parquet(path)
        out = spark.read.parquet(path)
        tables.append(([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], out))
        if name != C.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes
        docs = out
    pack = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    before, out = tables[0]
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, t, _ in before if quality._judged(t.encode(), pack, quality.BANDS)[9])
    before, out = tables[1]
    assert sorted(r.doc_id for r in out.collect()) == sorted(r[0] for r in exact_brute([x[:2] for x in before]) if r[3])
    before, out = tables[2]
    before.sort()
    comp = components([simhash.fingerprint(t, 3) for _, t, _ in before], 2)
    assert sorted(r.doc_id for r in out.collect()) == [i for k, (i, _, _) in enumerate(before) if comp[k] == k]
    before, out = tables[3]
    from tests.llm.test_mixing import targets, words

    sizes, taken = {}, {}
    for _, t, s in before:
        sizes[s] = sizes.get(s, 0) + words(t)
    for r in out.collect():
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
    for s, want in targets(sizes).items():
        assert abs(taken.get(s, 0) - want) <= max(words(t) for _, t, x in before if x == s)
    before, out = tables[4]
    lib = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_MODEL))
    assert sorted((r.doc_id, lib.decode(r.piece_ids)) for r in out.collect()) == sorted((i, t) for i, t, _ in before)


def test_pipeline_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in C.STAGES:
        out = stage(spark, docs, "")
        assert out.collect() == []
        docs = docs.sparkSession.createDataFrame([], out.schema) if "text" in out.columns else docs
