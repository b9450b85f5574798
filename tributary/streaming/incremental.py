"""Incremental load of the raw layer with Structured Streaming (T1).

Whatever landed under a raw folder since the last run is loaded into the
table: ``readStream`` on the JSON files with an explicit schema,
``trigger(availableNow=True)`` (process what is there, then stop) and
``foreachBatch`` into the create/append/replace sink. Each micro-batch is
tagged ``_load_id = <stream tag>-<batch id>`` (the tag comes from the checkpoint
location, so two streams feeding one table never share ids); each batch
overwrites the partition of its id, so a batch that a crash left half written, or that
is replayed, ends up in the table once and whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.names import column
from tributary.sinks.raw import _restore, raw_schema
from tributary.sinks.table import write_table

LOAD_COL = "_load_id"


def incremental_load(spark: SparkSession, raw_folder: str, schema: T.StructType, table: str, *,
                     checkpoint: str, table_path: str | None = None, fmt: str = "parquet",
                     shape: Callable[[DataFrame], DataFrame] | None = None,
                     on_mismatch: str = "fail", max_files_per_trigger: int | None = None,
                     done: Callable[[], None] | None = None,
                     prepare: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """Load new raw files into ``table``; returns counts of batches and rows.

    ``schema`` is the record schema the raw layer was written from (text-held
    types are cast back); ``shape`` may transform each batch before the write.
    The table is partitioned by ``_load_id``, one partition for each batch; a replayed
    batch writes its partition anew. ``prepare`` may transform the stream itself (with state,
    which the checkpoint keeps); ``late`` counts the rows its watermark left out. ``done`` is called after each batch's commit. A
    line that is not JSON, or does not fit the schema, fails the batch.
    """
    stats = {"batches": 0, "rows": 0}
    tag = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:10]

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load_id = f"{tag}-{batch_id:09d}"
        typed = shape(batch) if shape is not None else batch
        res = write_table(typed.withColumn(LOAD_COL, F.lit(load_id)), table, fmt=fmt,
                          path=table_path, on_mismatch=on_mismatch, partition_by=[LOAD_COL],
                          replace_partition={LOAD_COL: load_id})
        if done is not None:
            done()
        stats["batches"] += 1
        stats["rows"] += res.rows

    reader = spark.readStream.schema(raw_schema(schema)).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.json(raw_folder).select(*[_restore(column(f.name), f.dataType).alias(f.name) for f in schema.fields])
    query = ((prepare(rows) if prepare is not None else rows).writeStream
             .foreachBatch(load_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if prepare is not None:
        stats["late"] = sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)
    return stats


def without_repeats(responses: DataFrame, within: str) -> DataFrame:
    """A stream of responses without those that repeat an earlier one: same source, url and body.

    State is a hash for each response and is dropped ``within`` (an interval, by
    ``fetched_at``) behind the newest response seen by an earlier batch. A response older
    than that is late: Spark leaves it out, as it cannot be told from a repeated one (the raw
    layer keeps it, and the load's ``late`` counts it). So ``within`` must cover the time from
    a fetch to the run that loads it. Failed responses have no body and are not compared.
    """
    key = F.when(F.col("body").isNull(), F.expr("uuid()")).otherwise(F.sha2("body", 256))
    marked = responses.withColumn("_content", key).withWatermark("fetched_at", within)
    return marked.dropDuplicatesWithinWatermark(["source", "url", "_content"]).drop("_content")


def incremental_responses_load(spark: SparkSession, raw_folder: str, table: str, *,
                               checkpoint: str, table_path: str | None = None,
                               fmt: str = "parquet", schema: str = "first_record",
                               mode: str = "FAILFAST", on_mismatch: str = "fail",
                               columns: T.StructType | None = None, unique_within: str | None = None) -> dict:
    """Incremental load of a raw layer of API responses: each micro-batch of new
    response files is normalized (its own first-record schema) and appended.

    Type changes between batches: whole numbers go into a DOUBLE column where they are
    exact; any other change of columns fails the batch (``on_mismatch="fail"``) and
    leaves the table as it is. ``columns`` fixes names and types for all batches, so
    that a source whose types vary (a fraction after whole numbers) does not stop.
    ``unique_within`` loads a response that was fetched again once only (``without_repeats``).
    """
    from tributary.operators.normalize import normalize
    from tributary.session import delete_path, scratch_dir
    from tributary.sources.rest import response_struct

    staged: list[str] = []

    def shape(batch: DataFrame) -> DataFrame:
        staged.append(scratch_dir(batch.sparkSession, "staged-records"))
        return normalize(batch, schema=schema, mode=mode, staging=staged[-1], columns=columns)

    def done() -> None:
        while staged:
            delete_path(spark, staged.pop())

    try:
        return incremental_load(
            spark, raw_folder, response_struct(), table, checkpoint=checkpoint,
            table_path=table_path, fmt=fmt, on_mismatch=on_mismatch, shape=shape, done=done,
            prepare=(lambda rows: without_repeats(rows, unique_within)) if unique_within else None)
    finally:
        done()


def incremental_fetch(spark: SparkSession, spec, root: str, table: str, *, checkpoint: str,
                      table_path: str | None = None, fmt: str = "parquet", schema: str = "first_record",
                      mode: str = "FAILFAST", on_mismatch: str = "fail",
                      columns: T.StructType | None = None) -> dict:
    """Fetches the pages that a REST source got since the last run, each once, into raw layer and table.

    Every batch is a load of the raw layer (``load_id`` from the checkpoint and the batch's
    number) and a partition of the table. A batch that is replayed reads its raw load, if
    that was finished, instead of fetching again, and writes its partition anew. Returns
    counts of batches, pages and rows; a run without new pages has none.
    """
    from tributary.operators.normalize import normalize
    from tributary.session import delete_path, scratch_dir
    from tributary.sinks.raw import raw_finished, read_raw, write_raw_responses
    from tributary.sources.rest import RestSource, response_struct

    stats = {"batches": 0, "pages": 0, "rows": 0}
    tag = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:10]

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load_id = f"{tag}-{batch_id:09d}"
        if not raw_finished(spark, root, spec.name, load_id):
            write_raw_responses(batch, root, spec.name, load_id)
        raw = read_raw(spark, root, spec.name, response_struct(), load_id)
        staging, seen = scratch_dir(spark, "staged-records"), {}
        try:
            shaped = normalize(raw, schema=schema, mode=mode, staging=staging, columns=columns, stats=seen)
            res = write_table(shaped.withColumn(LOAD_COL, F.lit(load_id)), table, fmt=fmt, path=table_path,
                              on_mismatch=on_mismatch, partition_by=[LOAD_COL], known_rows=seen["records"],
                              replace_partition={LOAD_COL: load_id}, owner=spec.name)
        finally:
            delete_path(spark, staging)
        stats["batches"] += 1
        stats["pages"] += raw.count()
        stats["rows"] += res.rows

    query = (RestSource(spec).read_stream(spark).writeStream.foreachBatch(load_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return stats
