"""Headline ingestion jobs, timed. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG_DIR (optional: write Spark's event log there, for stage and task times).

Jobs (SURVEY §7.4 plus the heavier shaping queries):
  fetch_to_table       lineitem as API pages of 1,000 rows in the shared folder (written
                       before, untimed) → fetched by the tasks → raw layer + table
  api_pages_to_table   orders as API pages (≤64 records per body) already fetched →
                       raw responses → normalize (first-record schema) → table
  table_append         a second orders load appended to the existing table
  rest_pages           orders as pages fetched by the REST data source → raw → normalize →
                       table, read back (the pages are written before, untimed)
  type_unify / payload_values / payload_object / raw_roundtrip / incremental_load
                       registered queries, forced with a full write to a noop sink; the bodies
                       of the first three are written before, untimed, in many files
Every timed job starts from what a fetch leaves. One untimed warm-up pass over
sf0.001 runs first, so the numbers measure the jobs rather than JVM class loading and
JIT compilation.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from pyspark.sql import functions as F  # noqa: E402

from tributary.fixtures import write_pages  # noqa: E402
from tributary.operators import normalize  # noqa: E402
from tributary.plans.runner import Runner  # noqa: E402
from tributary.plans.specs import SourceSpec  # noqa: E402
from tributary.queries import QUERIES, _order_pages, object_bodies, orders_pages, type_bodies, value_pages  # noqa: E402
from tributary.session import local_session, scratch_dir, unique_name  # noqa: E402
from tributary.sinks import read_raw, write_raw_responses, write_table  # noqa: E402
from tributary.sources.rest import response_struct  # noqa: E402


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return time.perf_counter() - t, out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="tributary-bench",
                          extra=extra)
    t = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    times, rows = {}, {}
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for key in ("payload_values", "payload_records", "raw_roundtrip", "rest_pages"):
            QUERIES[key](spark, warm_dir).write.format("noop").mode("overwrite").save()

    # 1. pages → raw + table (each page is fetched exactly once)
    lineitem, orders = t("lineitem"), t("orders")
    runner = Runner(spark, scratch_dir(spark, "bench"), table_prefix=unique_name("b") + "_",
                    audit_table=unique_name("bench_runs"))

    def load(name, pages):
        conn = write_pages(pages, scratch_dir(spark, "bench_pages"))

        def run():
            res = runner.run_source(SourceSpec(name, "api", conn))
            if res.status != "SUCCESS":
                raise RuntimeError(res.error)
            spark.table(res.table).write.format("noop").mode("overwrite").save()
            return res
        sec, res = timed(run)
        times[name], rows[name] = sec, res.rows_written

    body = F.to_json(F.collect_list(F.struct(*lineitem.columns)))
    load("fetch_to_table", lineitem.groupBy(F.floor(F.col("l_orderkey") / 250).alias("page")).agg(body.alias("body")))
    load("rest_pages", orders_pages(orders))

    # 2. API pages → raw responses → normalize → table
    pages = _order_pages(orders)
    root = scratch_dir(spark, "bench_api")
    pages_path = f"{root}/pages"
    # the "fetched" responses (untimed input), as many files as a parallel fetch leaves
    pages.repartition(int(cpus) * 2).write.parquet(pages_path)
    table = unique_name("orders_api")

    def api():
        responses = spark.read.parquet(pages_path)
        write_raw_responses(responses, root, "orders_api", "l1")
        raw = read_raw(spark, root, "orders_api", response_struct(), "l1")
        stats: dict = {}
        shaped = normalize(raw, stats=stats)
        return write_table(shaped, table, path=f"{root}/tables/{table}", known_rows=stats["records"])
    sec, load = timed(api)
    times["api_pages_to_table"], rows["api_pages_to_table"] = sec, load.rows

    # 3. append a second load of the same shape
    def append():
        raw = read_raw(spark, root, "orders_api", response_struct(), "l1")
        stats: dict = {}
        shaped = normalize(raw, stats=stats)
        return write_table(shaped, table, path=f"{root}/tables/{table}", known_rows=stats["records"])
    sec, load = timed(append)
    assert load.action == "appended"
    times["table_append"], rows["table_append"] = sec, load.rows

    # 4. registered shaping queries, fully computed
    # bodies as a parallel fetch leaves them (untimed): the tables here are one row group, which no scan can split
    fetched = {"type_unify": type_bodies(lineitem), "payload_values": value_pages(lineitem), "payload_object": object_bodies(t("customer"))}
    for key, bodies in fetched.items():
        bodies.repartition(int(cpus) * 2).write.parquet(f"{root}/{key}")
    for key in ("type_unify", "payload_values", "payload_object", "raw_roundtrip", "incremental_load"):
        def run(key=key):
            df = normalize(spark.read.parquet(f"{root}/{key}")) if key in fetched else QUERIES[key](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            return df
        sec, _ = timed(run)
        times[key] = sec

    total = sum(times.values())
    print(json.dumps({
        "metric": "total_wall_sec", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "rows": rows,
        "rows_per_sec": {k: round(rows[k] / times[k]) for k in rows if times[k] > 0},
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
