"""Plan shapes that the scale design relies on, asserted on the physical plans."""

from pyspark.sql import functions as F

from tributary.operators import normalize
from tributary.operators.payload import response_records
from tributary.plans.runner import AUDIT_SCHEMA, job_summary, run_history


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _bodies(spark, n=200):
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.concat(F.lit('[{"a":'), F.col("id").cast("string"), F.lit(',"b":"x"}]')).alias("body"))


def test_each_body_is_parsed_once(spark):
    plan = _plan(response_records(_bodies(spark)))
    assert plan.count("parseJson") == 1, plan


def test_shaping_has_no_shuffle(spark):
    plan = _plan(response_records(_bodies(spark)))
    assert "Exchange" not in plan


def test_typed_projection_reads_only_needed_variant_fields(spark):
    out = normalize(_bodies(spark)).select("a")
    plan = _plan(out)
    assert "Exchange" not in plan and "parseJson" not in plan  # reads the staged records
    assert "ReadSchema: struct<rec:struct<0:bigint" in out._jdf.queryExecution().toString() or \
        "rec:struct<0:bigint" in plan, plan


def test_history_is_a_top_k_and_summary_aggregates_partially(spark):
    audit = spark.createDataFrame([], AUDIT_SCHEMA)
    assert "TakeOrderedAndProject" in _plan(run_history(audit, 10))
    plan = _plan(job_summary(audit))
    assert plan.count("HashAggregate") >= 2 and "partial_" in plan


def test_no_exchange_before_the_parse_whatever_the_core_count(spark):
    from tributary.queries import _responses

    for parts in (1, spark.sparkContext.defaultParallelism * 2):
        narrow = spark.range(0, 1000, numPartitions=parts).select(F.col("id"), F.lit('{"a":1}').alias("b"))
        plan = _plan(response_records(_responses(narrow, F.col("id"), F.col("b"))))
        assert "Exchange" not in plan
