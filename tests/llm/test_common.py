"""Bit tables: exact members, few others, any number of keys."""

import pytest
from pyspark.sql import functions as F

from tributary.llm import common, exact, repeats


def flagged(spark, n, **kw):
    keys = spark.range(n).select(F.xxhash64("id").alias("key"))
    table = common.BitTable(keys.unionByName(keys), "test", **kw)
    df = spark.range(4 * n).withColumn("slot", F.lit("a column of its own"))
    out = table.flag(df, F.xxhash64("id"), "member")
    assert out.columns == ["id", "slot", "member"] and out.count() == 4 * n
    got = {r.member: r.n for r in out.groupBy((F.col("id") < n).alias("own"), "member").count().where("own").select("member", F.col("count").alias("n")).collect()}
    assert got == {True: n}
    return table, out.where(f"id >= {n} and member").count()


def test_the_table_grows_with_its_keys(spark):
    small, _ = flagged(spark, 100)
    assert small.bits == common.TABLE_BITS and small.keys is None
    large, by_chance = flagged(spark, 20_000, bits=1 << 15)
    assert large.bits == 1 << 19 and by_chance < 3 * 20_000 / 10


def test_beyond_the_budget_the_keys_are_joined(spark):
    table, by_chance = flagged(spark, 20_000, bits=1 << 15, most=1 << 16)
    assert table.table is None and by_chance == 0


def test_an_empty_table_has_no_members(spark):
    keys = spark.createDataFrame([], "key bigint")
    assert common.BitTable(keys, "none").flag(spark.range(5), F.col("id"), "m").where("m").count() == 0


@pytest.mark.parametrize("most", [1, 1 << 29])
def test_operators_give_the_same_rows_both_ways(spark, sf, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_BITS", most)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = sorted(r.doc_id for r in exact.drop_exact_duplicates(docs).select("doc_id").collect())
    cut = repeats.cut_repeats(docs, 400).select("doc_id", F.size("removed"), F.sha2("kept", 256)).collect()
    both = (kept, sorted(map(tuple, cut)))
    if not hasattr(test_operators_give_the_same_rows_both_ways, "first"):
        test_operators_give_the_same_rows_both_ways.first = both
    assert test_operators_give_the_same_rows_both_ways.first == both and len(kept) < docs.count()
