"""Registered queries: each operator run over the driver's tables.

Every query reads whole tables (or data Spark derives from them), does its real
write/read under a fresh folder of the shared root, and returns a DataFrame
whose columns match the DuckDB oracle of the same key in ``ORACLE_SQL``.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.fixtures import DERBY_DRIVER, ECHO, PAGES_PER_FILE, load_into_derby, write_one_array, write_pages
from tributary.operators import (
    generic_columns,
    named_rows,
    normalize,
    normalize_by_source,
    positional,
    response_outcomes,
    type_variant_columns,
)
from tributary.plans.configs import (
    CONFIG_COLUMNS,
    config_changes,
    pipeline_sources,
    read_pipeline_files,
    validate_config_rows,
    validate_sources,
)
from tributary.plans.runner import Runner, job_summary, run_history
from tributary.plans.schedules import due
from tributary.plans.specs import PipelineSpec, SourceSpec
from tributary.session import local_path, scratch_dir, unique_name
from tributary.sinks.documents import write_documents
from tributary.sinks.lattice import load_widening, open_widening
from tributary.sinks.raw import (
    raw_finished,
    raw_path,
    read_raw,
    read_raw_positional,
    write_raw,
    write_raw_positional,
    write_raw_responses,
)
from tributary.sinks.table import SchemaMismatchError, write_table
from tributary.sources import SOURCE_TYPES, register_type
from tributary.sources.arrays import read_large_arrays
from tributary.sources.documents import read_documents
from tributary.sources.jdbc import JdbcSource
from tributary.sources.ranges import equal_ranges
from tributary.sources.rest import response_struct
from tributary.streaming import LOAD_COL, incremental_fetch, incremental_load, incremental_responses_load

# Page size of the synthetic API responses: every response body holds at most
# this many records, whatever the key distribution.
PAGE = 64
CONFIGS_PER_FILE = 1000  # sources per generated pipeline file (a bounded group)
FIRST = 1_000_000_000_000  # seq offset that orders one kind of response before the other


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _jdbc(spark: SparkSession, df: DataFrame, fixture_table: str, **conn) -> DataFrame:
    url = load_into_derby(df, fixture_table)
    spec = SourceSpec(unique_name(fixture_table.lower()), "jdbc",
                      {"url": url, "driver": DERBY_DRIVER, **conn})
    return JdbcSource(spec).read(spark)


def _responses(df: DataFrame, seq, body) -> DataFrame:
    """Responses built row by row from a table scan (no exchange)."""
    return df.select(seq.cast("bigint").alias("seq"), body.alias("body"))


# ---------------------------------------------------------------- JDBC scans
def jdbc_table_scan(spark, d):
    return _jdbc(spark, _t(spark, d, "nation"), "NATION", table="NATION")


def jdbc_default_table(spark, d):
    return _jdbc(spark, _t(spark, d, "region"), "DATA")


def jdbc_query_scan(spark, d):
    return _jdbc(spark, _t(spark, d, "customer"), "CUSTOMER", table="CUSTOMER",
                 query="SELECT * FROM CUSTOMER WHERE \"c_mktsegment\" = 'BUILDING'")


def jdbc_partitioned_scan(spark, d):
    return _jdbc(spark, _t(spark, d, "orders"), "ORDERS", table="ORDERS",
                 partition_column="o_orderkey", num_partitions=8)


def jdbc_pushdown_filter(spark, d):
    df = _jdbc(spark, _t(spark, d, "orders"), "ORDERS", table="ORDERS")
    return df.filter(F.col("o_totalprice") > 100000).select("o_orderkey", "o_custkey", "o_totalprice")


# ---------------------------------------------------------------- row naming
def named_rows_q(spark, d):
    s = _t(spark, d, "supplier")
    names = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    rows = s.select(positional(s, names).alias("row"))
    return type_variant_columns(named_rows(rows, names), names)


def generic_columns_q(spark, d):
    n = _t(spark, d, "nation")
    rows = n.select("n_nationkey", F.array("n_nationkey", "n_regionkey").alias("row"))
    return generic_columns(rows, order="n_nationkey")


# ---------------------------------------------------------------- payloads
def object_bodies(c: DataFrame) -> DataFrame:
    body = F.to_json(F.struct("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    return _responses(c, F.col("c_custkey"), body)


def payload_object(spark, d):
    return normalize(object_bodies(_t(spark, d, "customer")))


def _order_pages(o: DataFrame) -> DataFrame:
    """Orders as API pages: one array body per (customer, key block of PAGE)."""
    rec = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return (o.groupBy("o_custkey", F.floor(F.col("o_orderkey") / PAGE).alias("page"))
            .agg(F.min("o_orderkey").alias("seq"),
                 F.to_json(F.array_sort(F.collect_list(rec))).alias("body"))
            .select("seq", "body"))


def payload_records(spark, d):
    return normalize(_order_pages(_t(spark, d, "orders")))


def value_pages(li: DataFrame) -> DataFrame:
    """The parts of each order as an array of plain values."""
    return (li.groupBy("l_orderkey", F.floor(F.col("l_linenumber") / PAGE).alias("page"))
             .agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))),
                                       lambda x: x["l_partkey"])).alias("body"))
             .select(F.col("l_orderkey").alias("seq"), "body"))


def payload_values(spark, d):
    return normalize(value_pages(_t(spark, d, "lineitem")))


def payload_scalar(spark, d):
    p = _t(spark, d, "part")
    return normalize(_responses(p, F.col("p_partkey"), F.col("p_size").cast("string")))


# ---------------------------------------------------------------- schema
def first_record_schema(spark, d):
    n, o = _t(spark, d, "nation"), _t(spark, d, "orders")
    nb = _responses(n, F.col("n_nationkey") - FIRST,
                    F.to_json(F.struct(F.col("n_name").alias("rec_name"), F.col("n_nationkey").alias("rec_key"))))
    ob = _responses(o, F.col("o_orderkey"), F.to_json(F.struct(
        F.col("o_orderpriority").alias("rec_name"), F.col("o_orderkey").alias("rec_key"),
        F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))))
    return normalize(nb.unionByName(ob))


def first_record_per_source(spark, d):
    """Two sources in one table of responses: each has the columns of its own first record."""
    n, o = _t(spark, d, "nation"), _t(spark, d, "orders")
    nb = n.select(F.lit("nations").alias("source"), F.col("n_nationkey").cast("bigint").alias("seq"),
                  F.to_json(F.struct("n_name", "n_regionkey")).alias("body"))
    ob = o.select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("seq"),
                  F.to_json(F.struct("o_totalprice", "o_orderstatus")).alias("body"))
    out = None
    for source, df in normalize_by_source(nb.unionByName(ob), keep=("seq",)).items():
        cols = [c for c in df.columns if c != "seq"]
        row = df.select(F.lit(source).alias("source"), "seq", F.lit(",".join(cols)).alias("columns"),
                        F.col(cols[0]).cast("string").alias("first"), F.col(cols[1]).cast("string").alias("second"))
        out = row if out is None else out.unionByName(row)
    return out


def type_bodies(li: DataFrame) -> DataFrame:
    """A response of one record for each line item, its quantity now whole, now a fraction."""
    qty = F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint").cast("string")) \
        .otherwise(F.col("l_quantity").cast("string"))
    body = F.concat(F.lit('{"l_orderkey":'), F.col("l_orderkey").cast("string"),
                    F.lit(',"l_linenumber":'), F.col("l_linenumber").cast("string"),
                    F.lit(',"qty":'), qty, F.lit(',"disc":'), F.col("l_discount").cast("string"), F.lit("}"))
    return _responses(li, F.col("l_orderkey") * 8 + F.col("l_linenumber"), body)


def type_unify(spark, d):
    return normalize(type_bodies(_t(spark, d, "lineitem")))


def nested_union(spark, d):
    o = _t(spark, d, "orders")
    info = F.struct(
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("prio"))
    out = normalize(_responses(o, F.col("o_orderkey"), F.to_json(F.struct("o_orderkey", info.alias("info")))))
    return out.select("o_orderkey", F.col("info.price").alias("price"), F.col("info.prio").alias("prio"))


def clean_record_q(spark, d):
    e = _t(spark, d, "events")
    emptied = F.col("event_type").isin("click", "view")
    props = (F.when(F.col("event_type") == "click", F.lit("{}"))
             .when(F.col("event_type") == "view", F.lit("[]")).otherwise(F.col("props")))
    body = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                    F.lit(',"event_type":"'), F.col("event_type"), F.lit('","props":'), props, F.lit("}"))
    seq = F.col("event_id") + F.when(emptied, F.lit(FIRST)).otherwise(F.lit(0))
    out = normalize(_responses(e, seq, body))
    return out.select("event_id", "event_type", F.to_json("props").alias("props"))


def placeholder_record(spark, d):
    e = _t(spark, d, "events")
    emptied = F.col("event_type") == "signup"
    body = F.when(emptied, F.lit('{"props":{},"tags":[]}')).otherwise(
        F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                 F.lit(',"props":'), F.col("props"), F.lit("}")))
    seq = F.col("event_id") + F.when(emptied, F.lit(0)).otherwise(F.lit(FIRST))
    return normalize(_responses(e, seq, body))


def skip_empty_q(spark, d):
    e = _t(spark, d, "events")
    low = F.col("value") < 5
    real = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                    F.lit(',"value":'), F.col("value").cast("string"), F.lit("}"))
    body = (F.when(F.col("event_type") == "view", F.when(low, F.lit("null")).otherwise(F.lit('""')))
            .when(F.col("event_type") == "click", F.when(low, F.lit("[]")).otherwise(F.lit("{}")))
            .when(F.col("event_type") == "error", F.when(low, F.lit("0")).otherwise(F.lit("false")))
            .otherwise(real))
    return normalize(_responses(e, F.col("event_id"), body))


def response_errors(spark, d):
    e = _t(spark, d, "events")
    t = F.col("event_type")
    responses = e.select(
        F.col("event_id").alias("seq"),
        F.when(t == "signup", F.lit(None).cast("string"))
         .when(t == "error", F.concat(F.col("props"), F.lit(" x")))  # text after the value
         .when(t == "view", F.lit("{}")).otherwise(F.col("props")).alias("body"),
        F.when(t == "signup", F.lit("HTTP 503")).alias("error"))
    return response_outcomes(responses).groupBy("outcome").agg(F.count(F.lit(1)).alias("responses"))


def large_array(spark, d):
    """All line items as one array in one file: cut in the reader, range by range."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    folder = write_one_array(li, f"{scratch_dir(spark, 'large')}/lineitem", "lineitem.json")
    return normalize(read_large_arrays(spark, folder, range_bytes=1 << 20, batch_bytes=1 << 18))


# ---------------------------------------------------------------- raw layer
def raw_roundtrip(spark, d):
    p = _t(spark, d, "part")
    root = scratch_dir(spark, "raw")
    write_raw(p, root, "part", "l1")
    return read_raw(spark, root, "part", p.schema, "l1")


def raw_payload(spark, d):
    e = _t(spark, d, "events")
    root = scratch_dir(spark, "raw")
    write_raw_responses(e.select(F.col("event_id").alias("seq"), F.col("props").alias("body")),
                        root, "events", "l1")
    back = read_raw(spark, root, "events", response_struct(), "l1")
    return back.select(F.col("seq").alias("event_id"), F.col("body").alias("props"))


def raw_stringify(spark, d):
    """Types that JSON lacks as the raw layer's text, and back: the last column is the
    instant that is read again."""
    e = _t(spark, d, "events").select(
        "event_id", "ts", F.col("ts").cast("date").alias("day"), F.col("value").cast("decimal(12,3)").alias("amount"),
        F.timestamp_micros(F.col("event_id") * 1_000_001).alias("instant"))
    root = scratch_dir(spark, "raw")
    path = write_raw(e, root, "events", "l1")
    text = spark.read.schema("event_id bigint, ts string, day string, amount string, instant string").json(path)
    back = read_raw(spark, root, "events", e.schema, "l1").select(
        F.col("event_id").alias("id"), F.unix_micros("instant").alias("micros"))
    return text.join(back, F.col("event_id") == F.col("id")).select(
        "event_id", F.col("ts").alias("ts_text"), F.col("day").alias("day_text"), F.col("amount").alias("amount_text"),
        F.col("instant").alias("instant_text"), "micros")


def raw_positional(spark, d):
    n = _t(spark, d, "nation")
    root = scratch_dir(spark, "raw")
    write_raw_positional(n.select(positional(n).alias("row")), root, "nation", "l1")
    rows = read_raw_positional(spark, root, "nation", "l1")
    cols = generic_columns(rows)
    return type_variant_columns(cols, cols.columns)


def raw_documents(spark, d):
    """Order pages written as one indented document each, and those documents read and shaped again."""
    root = scratch_dir(spark, "raw")
    pages = orders_pages(_t(spark, d, "orders")).select(F.col("page").alias("seq"), "body")
    write_documents(pages, root, "orders", "20240229_235959")
    docs = read_documents(spark, raw_path(root, "orders"))
    orders = normalize(docs, keep=("load_id", "seq"))
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


# ---------------------------------------------------------------- tables
def _table(spark) -> tuple[str, str]:
    name = unique_name("t")
    return name, f"{scratch_dir(spark, 'tables')}/{name}"


def table_create(spark, d):
    name, path = _table(spark)
    write_table(_t(spark, d, "supplier"), name, path=path)
    return spark.table(name)


def table_append(spark, d):
    o = _t(spark, d, "orders")
    first, rest = o.filter(F.col("o_orderstatus") == "F"), o.filter(F.col("o_orderstatus") != "F")
    name, path = _table(spark)
    assert write_table(first, name, path=path).action == "created"
    assert write_table(rest, name, path=path).action == "appended"
    assert write_table(first, name, path=path).action == "appended"
    return spark.table(name)


def table_replace_on_mismatch(spark, d):
    name, path = _table(spark)
    write_table(_t(spark, d, "customer"), name, path=path)
    assert write_table(_t(spark, d, "orders"), name, path=path).action == "replaced"
    return spark.table(name)


def table_neighbours(spark, d):
    """Two tables whose names and folders share a prefix; one is replaced, both are read back whole."""
    name, path = _table(spark)
    write_table(_t(spark, d, "nation"), f"{name}__rest", path=f"{path}__rest")
    write_table(_t(spark, d, "region"), name, path=path)
    assert write_table(_t(spark, d, "customer"), name, path=path).action == "replaced"
    first = spark.table(name).select(F.lit("replaced").alias("which"), F.col("c_custkey").cast("bigint").alias("id"), F.col("c_name").alias("name"))
    return first.unionByName(spark.table(f"{name}__rest").select(
        F.lit("neighbour").alias("which"), F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name")))


def type_lattice(spark, d):
    """Three loads of rising types: whole numbers, then fractions, then more columns; every row is kept."""
    li, name = _t(spark, d, "lineitem"), unique_name("rising")
    path = f"{scratch_dir(spark, 'tables')}/{name}"
    body = [F.col("l_orderkey"), F.col("l_linenumber")]
    by_flag = {
        "A": [F.col("l_quantity").cast("bigint").alias("qty"), F.lit(None).cast("string").alias("disc")],
        "N": [F.col("l_quantity").alias("qty"), F.col("l_discount").alias("disc")],
        "R": [F.col("l_quantity").alias("qty"), F.struct(F.col("l_tax").alias("tax")).alias("info")]}
    for flag, more in by_flag.items():
        rows = li.where(F.col("l_returnflag") == flag)
        seq = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        bodies = _responses(rows, seq, F.to_json(F.struct(*body, *more), {"ignoreNullFields": "false"}))
        load_widening(normalize(bodies), name, f"load-{flag}", path=path)
    return open_widening(spark, name, path).select("l_orderkey", "l_linenumber", "qty", "disc", F.col("info.tax").alias("tax"), "_load_id")


def orders_pages(o: DataFrame) -> DataFrame:
    """Orders as API pages by blocks of keys: ``page``, ``body``."""
    rec = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return (o.groupBy(F.floor(F.col("o_orderkey") / PAGE).alias("page"))
            .agg(F.to_json(F.array_sort(F.collect_list(rec))).alias("body")))


def load_pages(spark: SparkSession, pages: DataFrame, name: str, **conn):
    """Serves ``pages`` as an API and runs a source that fetches them; (runner, result)."""
    connection = write_pages(pages, scratch_dir(spark, "api"))
    runner = Runner(spark, scratch_dir(spark, "out"), table_prefix=unique_name("api") + "_",
                    audit_table=unique_name("runs"))
    return runner, runner.run_source(SourceSpec(name, "api", {**connection, **conn}))


def fetch_fanout(spark, d):
    """One fetch, two sinks: every order's values counted in the raw layer and in the table."""
    runner, res = load_pages(spark, orders_pages(_t(spark, d, "orders")), "orders_src")
    if res.status != "SUCCESS":
        raise RuntimeError(res.error)
    bodies = read_raw(spark, runner.root, "orders_src", response_struct(), res.load_id)
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    raw = bodies.select(F.inline(F.from_json("body", "array<struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>>")))
    both = raw.select(*cols, F.lit(1).alias("r"), F.lit(0).alias("t")).unionByName(
        spark.table(res.table).select(*cols, F.lit(0).alias("r"), F.lit(1).alias("t")))
    return both.groupBy(*cols).agg(F.sum("r").alias("raw_rows"), F.sum("t").alias("table_rows"))


def rest_pages(spark, d):
    """Orders served as pages, fetched by the REST source (path pagination, requests
    spread over twice the default parallelism), then raw → normalize → table."""
    _, res = load_pages(spark, orders_pages(_t(spark, d, "orders")), "orders_api")
    if res.status != "SUCCESS":
        raise RuntimeError(res.error)
    return spark.table(res.table).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def rest_failures(spark, d):
    """Event pages of which every fifth answers 503: what raw layer, table and audit say."""
    e = _t(spark, d, "events")
    page = F.floor(F.col("event_id") / PAGE)
    body = F.to_json(F.array_sort(F.collect_list(F.struct("event_id", "user_id"))))
    pages = e.groupBy(page.alias("page")).agg(body.alias("good")).select(
        "page", F.when(F.col("page") % 5 == 0, "!503").otherwise(F.col("good")).alias("body"))
    runner, res = load_pages(spark, pages, "events_api", mode="PERMISSIVE")
    raw = read_raw(spark, runner.root, "events_api", response_struct(), res.load_id)
    logged = raw.groupBy(F.concat(F.lit("raw: "), F.coalesce("error", F.lit("ok"))).alias("what")).agg(
        F.count(F.lit(1)).alias("n"))
    audit = spark.table(runner.audit_table).select(F.explode(F.array(
        F.struct(F.concat(F.lit("audit: "), F.col("status")).alias("what"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.lit("audit: failed requests").alias("what"), F.col("failed_requests").alias("n")),
        F.struct(F.lit("audit: rows written").alias("what"), F.col("rows_written").alias("n")))).alias("x")).select("x.*")
    table = spark.table(res.table).agg(F.count(F.lit(1)).alias("n")).select(F.lit("table: rows").alias("what"), "n")
    return logged.unionByName(audit).unionByName(table)


def repair_load(spark, d):
    """Event pages of which every fifth fails; a repair sends those again, and the table is whole."""
    e = _t(spark, d, "events")
    good = e.groupBy(F.floor(F.col("event_id") / PAGE).alias("page")).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("event_id", "user_id")))).alias("body"))
    flaky = good.select("page", F.when(F.col("page") % 5 == 0, "!503").otherwise(F.col("body")).alias("body"))
    runner, res = load_pages(spark, flaky, "events_api", mode="PERMISSIVE")
    healed = write_pages(good, scratch_dir(spark, "api"))  # the same API, answering now
    again = runner.repair_source(SourceSpec("events_api", "api", {**healed, "mode": "PERMISSIVE"}))
    idle = runner.repair_source(SourceSpec("events_api", "api", {**healed, "mode": "PERMISSIVE"}))
    return spark.table(res.table).select(
        "event_id", "user_id", F.lit(res.status).alias("first_run"), F.lit(again.status).alias("repair"),
        F.lit(again.rows_read).cast("bigint").alias("sent_again"), F.lit(idle.rows_read).cast("bigint").alias("sent_idle"))


def rest_stream(spark, d):
    """Order pages as a stream: some, then the others, then nothing new; each is fetched once."""
    pages = orders_pages(_t(spark, d, "orders"))
    count = int(pages.agg(F.max("page")).first()[0]) + 1
    early = count // 2 // PAGES_PER_FILE * PAGES_PER_FILE
    folder, root, name = scratch_dir(spark, "api"), scratch_dir(spark, "stream"), unique_name("rest")
    kw = dict(checkpoint=f"{root}/_checkpoint", table_path=f"{root}/tables/{name}")
    runs = []
    for part, since in ((pages.where(F.col("page") < early), 0), (pages.where(F.col("page") >= early), early), (None, None)):
        if part is not None:
            spec = SourceSpec("orders_api", "api", write_pages(part, folder, since=since))
        runs.append(incremental_fetch(spark, spec, root, name, **kw)["pages"])
    fetched = spark.read.schema(response_struct()).json(raw_path(root, "orders_api")).count()
    return spark.table(name).drop(LOAD_COL).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).select(
        "*", F.lit(fetched).cast("bigint").alias("fetched"), F.lit(runs[0]).cast("bigint").alias("first_run"),
        F.lit(runs[2]).cast("bigint").alias("idle_run"))


# ---------------------------------------------------------------- audit
def _audit_from_events(spark, d) -> str:
    e = _t(spark, d, "events")
    failed = F.col("event_type") == "error"
    rows = e.select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.concat(F.col("event_type"), F.lit("_job")).alias("job_name"),
        F.col("event_type").alias("source"),
        F.when(failed, F.lit("FAILURE")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.col("ts").cast("timestamp").alias("started_at"),
        (F.col("ts").cast("timestamp") + F.make_interval(secs=F.col("value"))).alias("finished_at"),
        F.col("user_id").alias("rows_read"),
        F.when(failed, F.lit(0)).otherwise(F.col("user_id")).cast("bigint").alias("rows_written"),
        F.when(failed, F.concat(F.lit("fetch failed: "), F.col("props"))).alias("error"),
    )
    name, path = _table(spark)
    write_table(rows, name, path=path, skip_if_empty=False)
    return name


def run_audit(spark, d):
    summary = job_summary(spark.table(_audit_from_events(spark, d)))
    return summary.drop("last_started_at")


def run_history_topk(spark, d):
    return run_history(spark.table(_audit_from_events(spark, d)), 10).select("run_id", "job_name", "status")


# ---------------------------------------------------------------- configs
def _config_rows(c: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    name = F.when((seg == "HOUSEHOLD") & (F.col("c_acctbal") < 0), F.lit("")).otherwise(F.col("c_name"))
    src_type = (F.when(seg == "AUTOMOBILE", F.lit("odbc")).when(seg == "BUILDING", F.lit("API"))
                .when(seg == "FURNITURE", F.lit("jdbc")).when(seg == "MACHINERY", F.lit("ftp"))
                .otherwise(F.lit("odbc")))
    connection = F.when(F.col("c_acctbal") > 9000, F.lit("{}")).otherwise(F.concat(
        F.lit('{"table":"CUSTOMER_'), F.col("c_custkey").cast("string"), F.lit('","url":"jdbc:derby:memory:c"}')))
    schedule = (F.when(F.col("c_acctbal") < 0, F.lit("@daily"))
                .when(F.col("c_acctbal") < 1000, F.lit(None).cast("string"))
                .otherwise(F.concat(F.col("c_nationkey").cast("string"), F.lit(" */2 * * 1-5"))))
    return c.select("c_custkey", "c_nationkey", name.alias("name"), src_type.alias("src_type"),
                    connection.alias("connection"), schedule.alias("schedule"))


def source_validation(spark, d):
    rows = _config_rows(_t(spark, d, "customer"))
    return validate_config_rows(rows).select("name", "src_type", "schedule", "error", "valid")


def source_configs(spark, d):
    rows = _config_rows(_t(spark, d, "customer"))
    # two of a customer block share a name, and some sources have a field too many
    rows = rows.withColumn("name", F.when((F.col("name") != "") & (F.col("c_custkey") % 50 == 1), F.lit("Shared-Name"))
                           .when((F.col("name") != "") & (F.col("c_custkey") % 50 == 2), F.lit("shared.name"))
                           .otherwise(F.col("name")))
    extra = F.when(F.col("c_custkey") % 20 == 0, F.col("c_custkey"))
    src = F.to_json(F.struct("name", "src_type", F.parse_json("connection").alias("connection"), "schedule",
                             extra.alias("owner")))
    files = (rows.groupBy(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"), F.lit("_"),
                                   F.floor(F.col("c_custkey") / CONFIGS_PER_FILE).cast("string")).alias("pipeline"))
             .agg(F.array_sort(F.collect_list(F.struct("c_custkey", src.alias("src")))).alias("items"))
             .select("pipeline", F.concat(F.lit("[\n"), F.array_join(F.transform("items", lambda x: x["src"]), ",\n"),
                                          F.lit("\n]")).alias("value")))
    folder = scratch_dir(spark, "pipelines")
    files.repartition("pipeline").write.partitionBy("pipeline").text(folder)
    out = validate_sources(pipeline_sources(read_pipeline_files(spark, folder, name_from="partition")))
    return out.select(*CONFIG_COLUMNS, "error", "valid")


def _scheduled(c: DataFrame) -> DataFrame:
    """Customers as sources with schedules of several kinds."""
    kind, key = F.col("c_custkey") % 8, F.col("c_nationkey").cast("string")
    schedule = (F.when(kind == 0, F.concat(key, F.lit(" */2 * * 1-5")))
                .when(kind == 1, F.lit("*/15 8-17 * * *")).when(kind == 2, F.concat(F.lit("0 "), key, F.lit(" 1 * *")))
                .when(kind == 3, F.lit("5,35 3 29 2 *")).when(kind == 4, F.lit("30 6 1-15/7 * 7"))
                .when(kind == 5, F.lit("99 99 * * *")).when(kind == 6, F.lit("10/20 23 * 3-12 0,6")))
    return c.select("c_custkey", schedule.alias("schedule"))


def sources_due(spark, d):
    """Which sources are due between two times, how often, first and last."""
    found = due(_scheduled(_t(spark, d, "customer")), _dt.datetime(2024, 2, 27, 10, 7, 30), _dt.datetime(2024, 3, 4, 6, 30))
    return found.select("c_custkey", "schedule", "valid_schedule", "n_due", "first_due", "last_due")


def config_changes_q(spark, d):
    """Two versions of a table of sources: some added, removed or changed, all others only spelled anew."""
    c = _t(spark, d, "customer")
    key, name = F.col("c_custkey"), F.col("c_name")
    pipeline = F.concat(F.lit("p"), F.col("c_nationkey").cast("string"))
    table = lambda conn, schedule: (pipeline.alias("pipeline"), name.alias("name"), F.lit("jdbc").alias("src_type"),
                                    conn.alias("connection"), schedule.alias("schedule"))
    nightly = F.when(key % 3 == 0, F.lit("0 3 * * *"))
    old = c.where(key % 11 != 1).select(*table(
        F.concat(F.lit('{"url": "jdbc:x", "fetchsize": '), key.cast("string"), F.lit(', "options": {"a": 1, "b": [1.50, null]}}')), nightly))
    moved = F.when(key % 7 == 0, F.lit("jdbc:y")).otherwise(F.lit("jdbc:x"))
    new = c.where(key % 11 != 2).select(*table(
        F.concat(F.lit('{"options":{"b":[1.5,null],"a":1.0},"fetchsize":'), key.cast("string"), F.lit('.0e0,"url":"'), moved, F.lit('"}')),
        F.when(key % 5 == 0, F.lit("0 4 * * *")).otherwise(nightly)))
    return config_changes(old, new).select("pipeline", "name", "change", F.array_join("fields", ",").alias("fields"))


# ---------------------------------------------------------------- streaming
def incremental_load_q(spark, d):
    e = _t(spark, d, "events")
    root = scratch_dir(spark, "stream")
    early = F.col("event_type").isin("view", "click")
    write_raw(e.filter(early), root, "events", "a")
    name = unique_name("inc")
    kw = dict(checkpoint=f"{root}/_checkpoint", table_path=f"{root}/tables/{name}")
    folder = raw_path(root, "events")
    incremental_load(spark, folder, e.schema, name, **kw)
    write_raw(e.filter(~early), root, "events", "b")
    incremental_load(spark, folder, e.schema, name, **kw)
    incremental_load(spark, folder, e.schema, name, **kw)  # nothing new: no duplicates
    return spark.table(name).drop(LOAD_COL)


def incremental_responses(spark, d):
    """API responses (events' ``props`` bodies) landing in the raw layer in two
    loads; each stream run normalizes what is new and appends it."""
    e = _t(spark, d, "events")
    root = scratch_dir(spark, "stream")
    early = F.col("event_type").isin("view", "click")
    responses = e.select(F.col("event_id").alias("seq"), F.col("props").alias("body"))
    write_raw_responses(responses.filter(early), root, "events_api", "a")
    name = unique_name("inc_api")
    kw = dict(checkpoint=f"{root}/_checkpoint", table_path=f"{root}/tables/{name}")
    folder = raw_path(root, "events_api")
    incremental_responses_load(spark, folder, name, **kw)
    write_raw_responses(responses.filter(~early), root, "events_api", "b")
    incremental_responses_load(spark, folder, name, **kw)
    return spark.table(name).drop(LOAD_COL)


def rest_post(spark, d):
    """A POST for every customer, its payload from a table of requests."""
    table = unique_name("requests")
    c = _t(spark, d, "customer")
    c.select(F.col("c_custkey").alias("seq"), F.struct("c_custkey", "c_name", "c_acctbal").alias("body")).write.format("parquet").option(
        "path", scratch_dir(spark, "requests")).saveAsTable(table)
    runner = Runner(spark, scratch_dir(spark, "out"), table_prefix=unique_name("post") + "_", audit_table=unique_name("runs"))
    res = runner.run_source(SourceSpec("customers", "api", {
        "endpoint": "https://api.example/customers", "type": "post", "requests_table": table, "fetcher": ECHO, "partitions": "auto"}))
    if res.status != "SUCCESS":
        raise RuntimeError(res.error)
    return spark.table(res.table)


def run_lookup(spark, d):
    """The runs of one job, by its name."""
    runner = Runner(spark, scratch_dir(spark, "out"), audit_table=_audit_from_events(spark, d))
    runs = spark.table(runner.audit_table).count()
    return runner.run_status(limit=runs, job_name="click_job")


def pipeline_run(spark, d):
    """A pipeline file of four sources: one loads, one fails alone, one has no data, one is scheduled and waits."""
    pages = write_pages(orders_pages(_t(spark, d, "orders")), scratch_dir(spark, "api"))
    none = write_pages(spark.createDataFrame([(0, "[]")], "page bigint, body string"), scratch_dir(spark, "api"))
    sources = [{"name": "orders", "src_type": "API", "connection": pages},
               {"name": "broken", "src_type": "api", "connection": {**pages, "endpoint": pages["endpoint"].replace("api-", "gone-")}},
               {"name": "empty", "src_type": "api", "connection": none},
               {"name": "nightly", "src_type": "odbc", "connection": {"url": "jdbc:none"}, "schedule": "0 3 * * *"}]
    folder = local_path(scratch_dir(spark, "pipelines"))
    os.makedirs(folder)
    with open(f"{folder}/shop.json", "w") as out:
        json.dump(sources, out)
    pipeline = PipelineSpec.from_json(f"{folder}/shop.json")
    root = scratch_dir(spark, "out")
    runner = Runner(spark, root, table_prefix=unique_name("p") + "_", audit_table=unique_name("runs"))
    results = runner.run_pipeline(pipeline)
    rows = [(pipeline.name, r.source, r.status, r.table_action, r.rows_written, raw_finished(spark, root, r.source, r.load_id))
            for r in results]
    rows += [(pipeline.name, name, "SCHEDULED", cron, 0, False) for name, cron in ((s.name, cron) for s, cron in pipeline.scheduled())]
    found = spark.createDataFrame(rows, "pipeline string, source string, status string, action string, rows_written bigint, raw boolean")
    audit = spark.table(runner.audit_table).select(F.col("source").alias("s"), F.col("status").alias("audited"))
    counted = spark.table(results[0].table).agg(F.count(F.lit(1)).alias("table_rows"))
    return (found.join(audit, F.col("source") == F.col("s"), "left").drop("s")
            .join(F.broadcast(counted), F.col("source") == "orders", "left"))


class _Parts:
    """A connector of its own: the parts of a folder."""

    def __init__(self, spec):
        self.folder = spec.connection["folder"]

    def read(self, spark):
        return spark.read.parquet(f"{self.folder}/part.parquet")


def plug_in(spark, d):
    """A new connector class, registered under a name that is looked up without regard to case."""
    name = unique_name("parts")
    register_type(name, _Parts)
    try:
        runner = Runner(spark, scratch_dir(spark, "out"), table_prefix=unique_name("plug") + "_", audit_table=unique_name("runs"))
        res = runner.run_source(SourceSpec("parts", name.upper(), {"folder": d}))
    finally:
        SOURCE_TYPES.pop(name.lower())
    if res.status != "SUCCESS":
        raise RuntimeError(res.error)
    return spark.table(res.table)


def write_failure(spark, d):
    """A load that does not fit raises, and the table is as it was."""
    name, path = _table(spark)
    write_table(_t(spark, d, "supplier"), name, path=path)
    try:
        write_table(_t(spark, d, "nation"), name, path=path, on_mismatch="fail")
        said = "nothing"
    except SchemaMismatchError as e:
        said = type(e).__name__
    return spark.table(name).withColumn("raised", F.lit(said))


def repeated_load(spark, d):
    """A load of order pages that was fetched twice: the stream enters it into the table once."""
    root, name = scratch_dir(spark, "stream"), unique_name("once")
    pages = orders_pages(_t(spark, d, "orders")).select(
        F.lit("orders").alias("source"), F.col("page").alias("seq"), F.concat(F.lit("page "), F.col("page")).alias("url"), "body")
    stats = []
    for load, at in (("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 06:00:00")):
        write_raw_responses(pages.withColumn("fetched_at", F.lit(at).cast("timestamp")), root, "orders", load)
        stats.append(incremental_responses_load(spark, raw_path(root, "orders"), name, checkpoint=f"{root}/_checkpoint",
                                                table_path=f"{root}/tables/{name}", unique_within="1 day"))
    return spark.table(name).drop(LOAD_COL).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).withColumn(
        "late", F.lit(sum(s["late"] for s in stats)).cast("bigint"))


def split_ranges(spark, d):
    """Orders parted by customer into ranges of equal depth: each order's number of ranges, and the balance."""
    o = _t(spark, d, "orders")
    skewed = o.withColumn("o_custkey", F.when(F.col("o_orderstatus") == "F", F.lit(7)).when(
        F.col("o_orderstatus") != "P", F.col("o_custkey")))  # a hot customer, and orders of none
    ranges = equal_ranges(skewed, "o_custkey", 16, second="o_orderkey")
    fits = [F.coalesce(F.expr(p), F.lit(False)) for p in ranges]
    rows = skewed.agg(*[F.count_if(f).alias(f"r{k}") for k, f in enumerate(fits)]).first()
    balanced = max(rows) <= 2 * sum(rows) / len(rows)
    number = sum((f.cast("int") for f in fits), F.lit(0))
    return skewed.select("o_orderkey", number.alias("n_ranges"), F.lit(balanced).alias("balanced"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "jdbc_table_scan": jdbc_table_scan,
    "jdbc_default_table": jdbc_default_table,
    "jdbc_query_scan": jdbc_query_scan,
    "jdbc_partitioned_scan": jdbc_partitioned_scan,
    "jdbc_pushdown_filter": jdbc_pushdown_filter,
    "named_rows": named_rows_q,
    "generic_columns": generic_columns_q,
    "payload_object": payload_object,
    "payload_records": payload_records,
    "payload_values": payload_values,
    "payload_scalar": payload_scalar,
    "first_record_schema": first_record_schema,
    "first_record_per_source": first_record_per_source,
    "type_unify": type_unify,
    "nested_union": nested_union,
    "clean_record": clean_record_q,
    "placeholder_record": placeholder_record,
    "skip_empty": skip_empty_q,
    "response_errors": response_errors,
    "raw_roundtrip": raw_roundtrip,
    "raw_payload": raw_payload,
    "raw_stringify": raw_stringify,
    "raw_positional": raw_positional,
    "table_create": table_create,
    "table_append": table_append,
    "table_replace_on_mismatch": table_replace_on_mismatch,
    "table_neighbours": table_neighbours,
    "fetch_fanout": fetch_fanout,
    "rest_pages": rest_pages,
    "rest_failures": rest_failures,
    "rest_stream": rest_stream,
    "repair_load": repair_load,
    "large_array": large_array,
    "raw_documents": raw_documents,
    "type_lattice": type_lattice,
    "sources_due": sources_due,
    "config_changes": config_changes_q,
    "repeated_load": repeated_load,
    "rest_post": rest_post,
    "run_lookup": run_lookup,
    "pipeline_run": pipeline_run,
    "plug_in": plug_in,
    "write_failure": write_failure,
    "split_ranges": split_ranges,
    "run_audit": run_audit,
    "run_history_topk": run_history_topk,
    "source_validation": source_validation,
    "source_configs": source_configs,
    "incremental_load": incremental_load_q,
    "incremental_responses": incremental_responses,
}
