"""Pipeline configs as a table: many pipeline files validated in one Spark job.

Each file is read whole (``wholetext``), parsed as VARIANT and exploded into one
row per source. Reading with ``spark.read.json(multiLine)`` instead would merge
every ``connection`` object into one struct and lose which keys each had.
"""

from __future__ import annotations

import json
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.functions.text import cron_column
from tributary.operators.payload import text_has_data
from tributary.plans.specs import FIELDS
from tributary.sources import supported_types

CONFIG_COLUMNS = ["pipeline", "idx", "name", "src_type", "connection", "schedule"]


def read_pipeline_files(spark: SparkSession, path: str, *, name_from: str = "file") -> DataFrame:
    """``pipeline`` and ``content`` (whole file text) for every pipeline file under ``path``.

    ``name_from="file"``: ``*.json`` files, named by file stem (the usual layout).
    ``name_from="partition"``: a Spark-written ``pipeline=<name>/part-*`` tree,
    named by the partition value (one file per pipeline).
    """
    reader = spark.read.format("text").option("wholetext", "true")
    if name_from == "file":
        df = reader.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(path)
        stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
        return df.select(stem.alias("pipeline"), F.col("value").alias("content"))
    if name_from == "partition":
        df = reader.schema("value string, pipeline string").load(path)
        return df.select("pipeline", F.col("value").alias("content"))
    raise ValueError("name_from must be 'file' or 'partition'")


def pipeline_sources(files: DataFrame) -> DataFrame:
    """One row per source: ``pipeline, idx, name, src_type, connection`` (JSON text),
    ``schedule`` and the kinds needed for validation.

    An unparsable file gives one row with ``idx`` NULL and ``file_error`` set.
    """
    v = F.try_parse_json(F.col("content"))
    items = (F.when(v.try_cast("map<string,variant>").isNotNull(), F.array(v))
             .otherwise(v.try_cast("array<variant>")))
    df = files.select("pipeline", v.isNull().alias("_bad_json"),
                      F.when(v.isNull(), F.array(F.lit(None).cast("variant"))).otherwise(items).alias("_items"),
                      (v.isNotNull() & items.isNull()).alias("_bad_shape"),
                      F.coalesce(F.size(items) == 0, F.lit(False)).alias("_no_sources"))
    df = df.select("pipeline", "_bad_json", "_bad_shape", "_no_sources",
                   F.posexplode_outer("_items").alias("idx", "src"))
    src = F.col("src")
    conn = F.try_variant_get(src, "$.connection", "variant")
    sched = F.try_variant_get(src, "$.schedule", "variant")
    is_obj = src.try_cast("map<string,variant>").isNotNull()
    file_error = (F.when(F.col("_bad_json"), F.lit("invalid JSON"))
                  .when(F.col("_bad_shape"), F.lit("pipeline must be an object or a list"))
                  .when(F.col("_no_sources"), F.lit("pipeline has no sources"))
                  .when(~is_obj, F.concat(F.lit("source "), F.col("idx").cast("string"),
                                          F.lit(" must be an object"))))
    return df.select(
        "pipeline",
        F.when(F.col("_bad_json") | F.col("_bad_shape") | F.col("_no_sources"), F.lit(None))
        .otherwise(F.col("idx")).alias("idx"),
        F.try_variant_get(src, "$.name", "string").alias("name"),
        F.try_variant_get(src, "$.src_type", "string").alias("src_type"),
        # Python truthiness of the raw values (0, false, [], {} are empty too)
        text_has_data(F.to_json(F.try_variant_get(src, "$.name", "variant"))).alias("_has_name"),
        text_has_data(F.to_json(F.try_variant_get(src, "$.src_type", "variant"))).alias("_has_type"),
        F.when(conn.isNotNull() & ~F.is_variant_null(conn), F.to_json(conn)).alias("connection"),
        F.try_variant_get(src, "$.schedule", "string").alias("schedule"),
        F.coalesce(F.size(conn.try_cast("map<string,variant>")), F.lit(-1)).alias("_conn_size"),
        (sched.isNotNull() & ~F.is_variant_null(sched)).alias("_has_schedule"),
        F.coalesce(F.schema_of_variant(sched) == "STRING", F.lit(False)).alias("_schedule_is_text"),
        file_error.alias("file_error"),
        F.array_sort(F.array_except(F.map_keys(src.try_cast("map<string,variant>")),
                                    F.array(*[F.lit(f) for f in FIELDS]))).alias("_extra"),
    )


def source_checks(name: Column, src_type: Column, conn_size: Column, has_schedule: Column,
                  schedule_is_text: Column, schedule: Column, has_name: Column | None = None,
                  has_type: Column | None = None) -> list[Column]:
    """Each validation check of a source row: its message, or NULL when it passes
    (same checks and order as ``tributary.plans.specs.source_errors``).
    ``conn_size`` is -1 when the connection is not an object; ``has_name`` /
    ``has_type`` give Python truthiness of non-text values where known."""
    types = F.array(*[F.lit(t) for t in supported_types()])
    empty = lambda c: c.isNull() | (c == "")
    no_name = empty(name) if has_name is None else ~has_name
    no_type = empty(src_type) if has_type is None else ~has_type
    return [
        F.when(no_name, F.lit("source name is empty")),
        F.when(no_type, F.lit("source type is empty")),
        F.when(conn_size < 0, F.lit("connection must be an object"))
        .when(conn_size == 0, F.lit("connection is empty")),
        F.when(~no_type & ~F.array_contains(types, F.lower(src_type)),
               F.concat(F.lit("unsupported source type '"), src_type, F.lit("'"))),
        F.when(has_schedule & ~schedule_is_text, F.lit("schedule must be a string"))
        .when(has_schedule & ~cron_column(schedule),
              F.concat(F.lit("invalid cron schedule '"), schedule, F.lit("'"))),
    ]


def source_errors_column(*args: Column) -> Column:
    """``array<string>`` of every failed check (empty when valid)."""
    return F.filter(F.array(*source_checks(*args)), lambda m: m.isNotNull())


def source_error(*args: Column) -> Column:
    """First failed check, NULL when valid."""
    return F.coalesce(*source_checks(*args))


def validate_sources(sources: DataFrame) -> DataFrame:
    """Adds ``errors`` (every failure), ``error`` (the first, or NULL) and ``valid``
    to ``pipeline_sources`` output."""
    args = (F.col("name"), F.col("src_type"), F.col("_conn_size"), F.col("_has_schedule"),
            F.col("_schedule_is_text"), F.col("schedule"), F.col("_has_name"), F.col("_has_type"))
    # a pipeline file is bounded, and so is a group of its sources with one table
    same = Window.partitionBy("pipeline", "_table").orderBy("idx")
    named = F.coalesce(F.col("_has_name"), F.lit(False))
    table = F.when(named, F.lower(F.regexp_replace("name", "[^0-9A-Za-z_]", "_")))
    sources = sources.withColumn("_table", table).withColumn("_first", F.first("name").over(same)) \
        .withColumn("_nth", F.row_number().over(same))
    extra = F.when(F.size("_extra") > 0, F.concat(F.lit("unknown source fields: "), F.array_join("_extra", ", ")))
    twice = F.when(named & (F.col("_nth") > 1), F.when(
        F.col("_first") == F.col("name"), F.concat(F.lit("source '"), F.col("name"), F.lit("' appears twice"))).otherwise(
        F.concat(F.lit("sources '"), F.col("_first"), F.lit("' and '"), F.col("name"), F.lit("' share table '"),
                 F.col("_table"), F.lit("'"))))
    own = F.concat(F.array(extra), F.array(*source_checks(*args)), F.array(twice))
    errors = F.when(F.col("file_error").isNotNull(), F.array(F.col("file_error"))) \
        .otherwise(F.filter(own, lambda m: m.isNotNull()))
    err = F.try_element_at(errors, F.lit(1))
    return sources.select(*CONFIG_COLUMNS, errors.alias("errors"), err.alias("error"),
                          err.isNull().alias("valid"))


def load_configs(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``path`` → validated source rows."""
    return validate_sources(pipeline_sources(read_pipeline_files(spark, path)))


def validate_config_rows(rows: DataFrame) -> DataFrame:
    """Rows with ``name, src_type, connection`` (JSON text) and ``schedule`` (text)
    → the same rows plus ``error`` and ``valid``."""
    conn = F.try_parse_json(F.col("connection"))
    size = F.coalesce(F.size(conn.try_cast("map<string,variant>")), F.lit(-1))
    has_schedule = F.col("schedule").isNotNull()
    args = (F.col("name"), F.col("src_type"), size, has_schedule, F.lit(True), F.col("schedule"))
    err = source_error(*args)
    return rows.select("*", source_errors_column(*args).alias("errors"), err.alias("error"),
                       err.isNull().alias("valid"))


# ---------------------------------------------------------------- changes
def canonical_json(text: str | None) -> str | None:
    """JSON text in one form: keys sorted (the last of a repeated key counts), no spaces, and
    numbers by their value (``1``, ``1.0`` and ``1e0`` are one). Text that is not JSON stays."""
    def number(raw: str):
        d = Decimal(raw).normalize()
        # a whole number has one spelling up to a size that would only be zeros
        return int(d) if d == d.to_integral_value() and abs(d.adjusted()) < 400 else _Raw(str(d))

    if text is None:
        return None
    try:
        value = json.loads(text, parse_int=number, parse_float=number)
    except ValueError:
        return text
    return _text(value)


class _Raw(str):
    """A number's text."""


def _text(value) -> str:
    if isinstance(value, _Raw):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{_text(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_text, value)) + "]"
    return json.dumps(value)


_COMPARED = ("src_type", "connection", "schedule")


def _hashed(configs: DataFrame) -> DataFrame:
    """One row a source: for each compared field the hashes it has, sorted (several, if the source is there twice)."""
    from tributary.session import ship_package

    ship_package(configs.sparkSession)

    @F.pandas_udf("string")
    def canonical(texts: pd.Series) -> pd.Series:
        return texts.map(canonical_json, na_action="ignore")

    values = {"src_type": F.lower("src_type"), "connection": canonical("connection"), "schedule": F.trim(F.col("schedule"))}
    # a null is a value of its own
    one = {n: F.when(v.isNull(), F.lit("null")).otherwise(F.sha2(v, 256)) for n, v in values.items()}
    return configs.groupBy("pipeline", "name").agg(*[F.array_sort(F.collect_list(c)).alias(n) for n, c in one.items()])


def config_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What became of each source: ``pipeline, name, change`` (added, removed, changed, same) and
    ``fields``, the changed ones of src_type, connection and schedule.

    Both tables have rows of ``pipeline, name, src_type, connection`` (JSON text) and
    ``schedule``. Sources meet by pipeline and name, nulls alike. A connection is compared by
    the hash of its canonical form, so another order of keys or spelling of numbers is no
    change. A source that stands twice in a table is compared as both.
    """
    a, b = _hashed(old), _hashed(new)
    a = a.select("pipeline", "name", *[F.col(f).alias(f"old_{f}") for f in _COMPARED])
    b = b.select(F.col("pipeline").alias("p"), F.col("name").alias("n"), *[F.col(f).alias(f"new_{f}") for f in _COMPARED])
    both = a.join(b, a["pipeline"].eqNullSafe(b["p"]) & a["name"].eqNullSafe(b["n"]), "full")
    was, now = F.col("old_src_type").isNotNull(), F.col("new_src_type").isNotNull()
    differ = F.filter(F.array(*[F.when(F.col(f"old_{f}") != F.col(f"new_{f}"), F.lit(f)) for f in _COMPARED]), lambda x: x.isNotNull())
    change = F.when(~was, "added").when(~now, "removed").when(F.size(differ) > 0, "changed").otherwise("same")
    return both.select(F.when(was, F.col("pipeline")).otherwise(F.col("p")).alias("pipeline"),
                       F.when(was, F.col("name")).otherwise(F.col("n")).alias("name"), change.alias("change"),
                       F.when(was & now, differ).otherwise(F.array().cast("array<string>")).alias("fields"))
