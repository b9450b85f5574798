"""``normalize``: response bodies → typed records, the API shaping path end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.json import as_object
from tributary.operators.payload import _check_mode, explode_records, first_keys, response_records, text_has_data
from tributary.operators.schema import (
    FIRST_RECORD,
    _keys,
    first_body_metric,
    project_records,
    record_schema,
    schema_from_metrics,
    schema_metric,
)
from tributary.session import ensure_json_semantics, scratch_dir


def normalize(responses: DataFrame, *, schema: str = FIRST_RECORD, clean: bool = True,
              mode: str = "FAILFAST", body: str = "body", keep: tuple[str, ...] = (),
              staging: str | bool | None = None, stats: dict | None = None,
              columns: T.StructType | None = None) -> DataFrame:
    """Responses (``seq``, ``body`` and optionally ``source``, ``load_id``, ``error``)
    → one typed row per record.

    ``schema="first_record"`` takes the columns and their order from the first
    record (by ``load_id``, ``seq``, position); ``"union"`` takes every key seen.
    ``keep`` names response columns to carry into the output (e.g. ``seq``).

    By default the records are **staged**: one job parses every body once,
    writes the records as VARIANT parquet under the shared folder and, through
    ``observe``, collects the merged schema and the body of the first record;
    the result is a projection over the staged files. The staged copy also cuts
    the lineage: a lost executor re-reads it instead of re-parsing the input.
    ``staging`` may name the folder; ``staging=False`` runs the schema pass as a
    separate aggregate and re-derives the records from the input instead.
    ``columns`` gives names and types outright, whatever the records hold.
    A ``stats`` dict receives ``records`` (the number of rows) when staging.
    """
    mode = _check_mode(mode)
    spark = responses.sparkSession
    ensure_json_semantics(spark)
    base = tuple(dict.fromkeys(("source", "load_id", "seq") + tuple(keep)))
    recs = response_records(responses, body=body, mode=mode, clean=clean,
                            keep=base, keep_body=True)
    if staging is False:
        st = columns or record_schema(explode_records(recs, keep=base), how=schema, mode=mode, clean=clean)
        exploded = explode_records(recs.drop("_body"), keep=base)
        return project_records(exploded, st, mode=mode, keep=tuple(keep))
    path = staging if isinstance(staging, str) else scratch_dir(spark, "staged-records")
    first, obs = Observation(), Observation()
    records = explode_records(recs.observe(first, first_body_metric(recs)).drop("_body"), keep=base)
    (records.observe(obs, schema_metric(mode), F.count(F.lit(1)).alias("records"))
     .drop("wrapped").write.mode("overwrite").parquet(path))
    metrics = {**first.get, **obs.get}
    if stats is not None:
        stats["records"] = int(metrics.get("records") or 0)
    st = columns or schema_from_metrics(metrics.get("schema"), _keys(spark, metrics.get("first"), schema, mode, clean),
                             how=schema, mode=mode)
    return project_records(spark.read.parquet(path), st, mode=mode, keep=tuple(keep))


def normalize_by_source(responses: DataFrame, *, schema: str = FIRST_RECORD, clean: bool = True,
                        mode: str = "FAILFAST", body: str = "body", keep: tuple[str, ...] = (),
                        staging: str | None = None) -> dict[str | None, DataFrame]:
    """``normalize`` for each ``source`` of a table of responses: source name → typed records.

    Every source has its own first record and its own types. Whatever the number of
    sources, every body is parsed once: one job stages the records in a folder for each
    source (rebalanced, so that a large source is many files and a small one few), one
    aggregation over the staged records gives each source's merged schema and where its
    first record stands, and the bodies of those are read for their keys. A source's
    result reads its own folder only. One row per source reaches the driver, as one
    DataFrame per source is returned. A null source is a source of its own.
    """
    mode = _check_mode(mode)
    spark = responses.sparkSession
    ensure_json_semantics(spark)
    base = tuple(dict.fromkeys(("source", "load_id", "seq") + tuple(keep)))
    recs = response_records(responses, body=body, mode=mode, clean=clean, keep=base)
    # folder names cannot tell a null from an empty name
    folder = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source"))).alias(_FOLDER)
    records = explode_records(recs, keep=base).drop("wrapped").select("*", folder)
    path = staging or scratch_dir(spark, "staged-sources")
    records.hint("rebalance", F.col(_FOLDER)).write.partitionBy(_FOLDER).parquet(path)
    staged = spark.read.schema(records.schema).parquet(path)
    rec = F.col("rec") if mode == "FAILFAST" else F.when(as_object(F.col("rec")).isNotNull(), F.col("rec"))
    place = [c for c in ("load_id", "seq") if c in responses.columns]
    found = staged.groupBy(_FOLDER).agg(F.schema_of_variant_agg(rec).alias("schema"), F.min(F.struct(*place)).alias("first")).collect()
    keys = _first_keys_of(responses, found, place, body, mode, clean) if schema == FIRST_RECORD else {}
    out = {}
    for row in found:
        st = schema_from_metrics(row["schema"], keys.get(row[_FOLDER]), how=schema, mode=mode)
        source = None if row[_FOLDER] == "n" else row[_FOLDER][1:]
        out[source] = project_records(staged.where(F.col(_FOLDER) == row[_FOLDER]), st, mode=mode, keep=tuple(keep))
    return out


_FOLDER = "_of"


def _first_keys_of(responses: DataFrame, found: list, place: list[str], body: str, mode: str, clean: bool) -> dict[str, list[str]]:
    """Each source's column names, from the one response that has its first record."""
    if not found:
        return {}
    spark = responses.sparkSession
    kinds = responses.select(*place).schema
    wanted = spark.createDataFrame(
        [(r[_FOLDER], None if r[_FOLDER] == "n" else r[_FOLDER][1:], *r["first"]) for r in found],
        T.StructType([T.StructField(_FOLDER, T.StringType()), T.StructField("_source", T.StringType()),
                      *[T.StructField(f"_{f.name}", f.dataType) for f in kinds.fields]]))
    same = F.col("source").eqNullSafe(F.col("_source"))
    for c in place:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    # a row for each source, as the result has a DataFrame for each
    bodies = responses.where(text_has_data(F.col(body))).join(F.broadcast(wanted), same).groupBy(_FOLDER).agg(F.min(body).alias("body"))
    one = bodies.select(F.col(_FOLDER).alias("source"), F.lit(0).cast("bigint").alias("seq"), "body")
    recs = response_records(one, mode=mode, clean=clean, keep=("source", "seq"), keep_body=True)
    named = recs.select("source", first_keys(F.col("recs")[0], F.col("_body"), F.col("wrapped")).alias("keys"))
    return {r["source"]: list(r["keys"] or []) for r in named.collect()}
