import json

import pytest
from pyspark.sql import functions as F

from tributary.fixtures import DERBY_DRIVER, drop_derby, load_into_derby
from tributary.plans import PipelineSpec, Runner, SourceSpec, job_summary
from tributary.session import scratch_dir, unique_name
from tributary.sources import JdbcSource, RestSource
from tributary.sources.rest import RequestPlan, RestJsonReader, with_query
from tributary.streaming import LOAD_COL, incremental_load, incremental_responses_load
from tributary.sinks import raw_path, write_raw, write_raw_responses

STUB = "stub_http:fetch"


@pytest.fixture(scope="module")
def derby(spark, sf):
    """Three rows of the driver's region table."""
    df = spark.read.parquet(f"{sf}/region.parquet").where("r_regionkey < 3")
    url = load_into_derby(df, "REGION")
    yield url
    drop_derby(spark, url)


def _src(url, **conn):
    return JdbcSource(SourceSpec("db", "odbc", {"url": url, "driver": DERBY_DRIVER, **conn}))


def test_jdbc_table_query_default(spark, derby):
    assert _src(derby, table="REGION").read(spark).columns == ["r_regionkey", "r_name"]
    q = _src(derby, table="REGION", query='SELECT * FROM REGION WHERE "r_regionkey" = 1').read(spark)
    assert [r.r_regionkey for r in q.collect()] == [1]
    with pytest.raises(Exception):  # no table, no query → table "data", which does not exist
        _src(derby).read(spark).collect()


def test_jdbc_partitioned_and_pushdown(spark, derby):
    df = _src(derby, table="REGION", partition_column="r_regionkey", num_partitions=3).read(spark)
    assert df.rdd.getNumPartitions() == 2 and df.count() == 3  # Spark caps at hi - lo
    q = _src(derby, query="SELECT * FROM REGION", partition_column="r_regionkey", num_partitions=2).read(spark)
    assert q.count() == 3
    plan = df.filter(F.col("r_regionkey") > 1).select("r_name")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(r_regionkey,1)" in plan


def test_jdbc_partitions_sized_by_rows(spark, derby):
    few = _src(derby, table="REGION", partition_column="r_regionkey").read(spark)
    assert few.rdd.getNumPartitions() == 1 and few.count() == 3  # 3 rows: one partition
    capped = _src(derby, table="REGION", partition_column="r_regionkey", rows_per_partition=1,
                  max_connections=2).read(spark)
    assert capped.rdd.getNumPartitions() == 2 and capped.count() == 3


def test_jdbc_predicates_one_partition_each(spark, derby):
    df = _src(derby, table="REGION", predicates=['"r_regionkey" = 1', '"r_regionkey" IN (0, 2)']).read(spark)
    assert df.rdd.getNumPartitions() == 2
    assert sorted(r.r_regionkey for r in df.collect()) == [0, 1, 2]


def test_jdbc_duplicate_column_names_are_refused(spark, derby):
    with pytest.raises(ValueError, match="alias the columns"):
        _src(derby, query='SELECT "r_regionkey", "r_name" AS "r_regionkey" FROM REGION').read(spark)


def test_jdbc_needs_url(spark):
    with pytest.raises(ValueError, match="ODBC"):
        _src(None, odbc_connection_string="DRIVER=x").read(spark)


def test_rest_plan_and_validation():
    paged = RequestPlan({"endpoint": "http://x", "page_param": "page", "pages": "4", "args": '{"k":1}'})
    assert paged.count == 4 and paged.request(3).params == {"k": 1, "page": 4}
    assert RequestPlan({"endpoint": "http://x/{page}", "pages": "2", "page_start": "0"}).request(1).url == "http://x/1"
    for options, message in [({"endpoint": "http://x", "method": "PUT"}, "unsupported method"), ({}, "endpoint"),
                             ({"endpoint": "http://x", "requests": "[1, 2]"}, "array of objects")]:
        with pytest.raises(ValueError, match=message):
            RequestPlan(options)


def test_rest_reader_does_not_grow_with_the_pages():
    import pickle

    few, many = (len(pickle.dumps(RestJsonReader({"endpoint": "http://x", "page_param": "p", "pages": n, "partitions": "8"})))
                 for n in ("10", "9999999"))
    assert many - few < 20
    parts = RestJsonReader({"endpoint": "http://x", "page_param": "p", "pages": "9999999", "partitions": "8"}).partitions()
    assert len(parts) == 8 and parts[0].start == 0 and parts[-1].stop == 9999999 and len(pickle.dumps(parts)) < 2000


def test_query_parameters_repeat_lists_and_leave_out_nulls():
    assert with_query("http://x", {"a": [1, 2], "b": None, "c": "d e"}) == "http://x?a=1&a=2&c=d+e"
    assert with_query("http://x?z=1", {"a": ["q", None]}) == "http://x?z=1&a=q"
    assert with_query("http://x", {"b": None, "a": []}) == "http://x"


def test_partitions_auto_follows_the_cluster(spark):
    src = {"endpoint": "http://h/p", "page_param": "page", "pages": 1000, "partitions": "auto", "fetcher": STUB}
    n = 2 * spark.sparkContext.defaultParallelism
    pages = -(-1000 // n)
    assert RestSource(SourceSpec("a", "api", src)).read(spark).rdd.getNumPartitions() == -(-1000 // pages)
    assert RestSource(SourceSpec("b", "api", {**src, "max_partitions": 3})).read(spark).rdd.getNumPartitions() == 3


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from tributary.session import shared_root

    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(SimpleNamespace(sparkContext=sc))


def test_rest_get_post_pages_errors(spark):
    get = RestSource(SourceSpec("g", "api", {"endpoint": "http://h/ships", "type": "get",
                                             "args": {"berth": 1}, "fetcher": STUB})).read(spark)
    r = get.first()
    assert r.status == 200 and r.url == "http://h/ships?berth=1" and json.loads(r.body)[0]["berth"] == 1
    post = RestSource(SourceSpec("p", "api", {"endpoint": "http://h/post", "type": "POST",
                                              "body": {"flag": "x"}, "fetcher": STUB})).read(spark)
    assert json.loads(post.first().body)["echo"] == {"flag": "x"}
    pages = RestSource(SourceSpec("pg", "api", {"endpoint": "http://h/p", "page_param": "page",
                                                "pages": 5, "fetcher": STUB})).read(spark)
    assert pages.rdd.getNumPartitions() == 5 and pages.count() == 5
    spread = RestSource(SourceSpec("pg2", "api", {"endpoint": "http://h/p", "page_param": "page",
                                                  "pages": 10, "partitions": 3, "fetcher": STUB})).read(spark)
    assert spread.rdd.getNumPartitions() == 3 and spread.select("seq").distinct().count() == 10
    listed = RestSource(SourceSpec("l", "api", {"endpoint": "http://h/x", "type": "POST", "body": {"q": 0},
                                                "requests": [{"body": {"q": 1}}, {}],
                                                "fetcher": STUB})).read(spark)
    assert [json.loads(r.body)["echo"] for r in listed.orderBy("seq").collect()] == [{"q": 1}, {"q": 0}]
    perm = RestSource(SourceSpec("e", "api", {"endpoint": "http://h/status500", "mode": "PERMISSIVE",
                                              "fetcher": STUB})).read(spark).first()
    assert perm.error == "HTTP 500" and perm.body is None
    with pytest.raises(Exception, match="connection refused"):
        RestSource(SourceSpec("f", "api", {"endpoint": "http://h/fail", "fetcher": STUB})).read(spark).collect()


def test_runner_end_to_end(spark, derby):
    root = scratch_dir(spark, "out")
    runner = Runner(spark, root, table_prefix=unique_name("r") + "_", audit_table=unique_name("runs"))
    pipe = PipelineSpec("p", [
        SourceSpec("db_all", "odbc", {"url": derby, "driver": DERBY_DRIVER, "table": "REGION"}),
        SourceSpec("db_one", "odbc", {"url": derby, "driver": DERBY_DRIVER, "table": "REGION",
                                      "query": 'SELECT * FROM REGION WHERE "r_regionkey" = 1'}),
        SourceSpec("ships", "api", {"endpoint": "http://h/ships", "args": {"berth": 1}, "fetcher": STUB}),
        SourceSpec("pages", "api", {"endpoint": "http://h/p", "page_param": "page", "pages": 3,
                                    "fetcher": STUB}),
        SourceSpec("broken", "api", {"endpoint": "http://h/fail", "fetcher": STUB}),
        SourceSpec("later", "odbc", {"url": derby, "table": "REGION"}, schedule="0 1 * * *"),
    ])
    results = {r.source: r for r in runner.run_pipeline(pipe)}
    assert set(results) == {"db_all", "db_one", "ships", "pages", "broken"}
    assert results["db_all"].rows_written == 3 and results["db_one"].rows_written == 1
    t = spark.table(results["ships"].table)
    assert t.columns == ["berth", "imo", "flag"]  # first record decides; "late" is dropped
    assert spark.table(results["pages"].table).count() == 9
    assert results["broken"].status == "FAILURE" and "refused" in results["broken"].error
    raw = spark.read.text(raw_path(root, "db_all")).collect()
    assert {json.loads(r.value)["r_regionkey"] for r in raw} == {0, 1, 2}
    # second run appends (same schema), audit keeps both runs
    again = runner.run_source(pipe.sources[0])
    assert again.table_action == "appended" and spark.table(again.table).count() == 6
    hist = runner.run_history(3).collect()
    assert len(hist) == 3 and hist[0].source == "db_all"
    status = runner.run_status(10, job_name="broken_job").collect()
    assert [(r.job_name, r.status) for r in status] == [("broken_job", "FAILURE")]
    summary = {r.job_name: r for r in job_summary(spark.table(runner.audit_table)).collect()}
    assert summary["db_all_job"].runs == 2 and summary["broken_job"].failures == 1


def test_incremental_load_is_idempotent(spark):
    root = scratch_dir(spark, "stream")
    df = spark.range(100).select(F.col("id"), (F.col("id") * 1.5).alias("v"))
    write_raw(df.filter("id < 50"), root, "s", "a")
    name, kw = unique_name("inc"), {"checkpoint": f"{root}/_ck", "table_path": f"{root}/t"}
    first = incremental_load(spark, raw_path(root, "s"), df.schema, name, **kw)
    assert first["rows"] == 50
    write_raw(df.filter("id >= 50"), root, "s", "b")
    second = incremental_load(spark, raw_path(root, "s"), df.schema, name, **kw)
    third = incremental_load(spark, raw_path(root, "s"), df.schema, name, **kw)
    assert second["rows"] == 50 and third["rows"] == 0
    t = spark.table(name)
    assert t.count() == 100 and t.select(LOAD_COL).distinct().count() == 2
    # a second stream (own checkpoint) into the same table is not mistaken for a replay
    other = scratch_dir(spark, "stream")
    write_raw(df.filter("id < 10"), other, "s", "a")
    more = incremental_load(spark, raw_path(other, "s"), df.schema, name,
                            checkpoint=f"{other}/_ck", table_path=f"{root}/t")
    assert more["rows"] == 10 and spark.table(name).count() == 110


def test_incremental_responses_load(spark):
    root = scratch_dir(spark, "stream")
    first = spark.createDataFrame([(0, '[{"id":1,"v":"a"},{"id":2,"v":"b"}]'), (1, "[]")],
                                  "seq bigint, body string")
    write_raw_responses(first, root, "api", "a")
    name, kw = unique_name("incr"), {"checkpoint": f"{root}/_ck", "table_path": f"{root}/t"}
    assert incremental_responses_load(spark, raw_path(root, "api"), name, **kw)["rows"] == 2
    write_raw_responses(spark.createDataFrame([(2, '{"v":"c","id":3}')], "seq bigint, body string"),
                        root, "api", "b")
    assert incremental_responses_load(spark, raw_path(root, "api"), name, **kw)["rows"] == 1
    t = spark.table(name)
    assert sorted((r.id, r.v) for r in t.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def _stream(spark, df, name, **kw):
    root = scratch_dir(spark, "stream")
    write_raw(df, root, "s", "a")
    args = {"checkpoint": f"{root}/_ck", "table_path": f"{root}/t", **kw}
    incremental_load(spark, raw_path(root, "s"), df.schema, name, **args)
    return root, args


def _replay(spark, root, args, schema, name):
    """The same batch again, as after a crash before its commit: offsets without commits."""
    import glob
    import os

    ck = args["checkpoint"].removeprefix("file:")
    for f in glob.glob(f"{ck}/commits/*") + glob.glob(f"{ck}/commits/.*"):
        os.remove(f)
    incremental_load(spark, raw_path(root, "s"), schema, name, **args)


def test_a_batch_left_half_written_is_written_whole_on_replay(spark):
    import glob
    import os

    df = spark.range(0, 100, numPartitions=4).select(F.col("id"), (F.col("id") * 1.5).alias("v"))
    name = unique_name("inc")
    root, args = _stream(spark, df, name)
    parts = glob.glob(f"{args['table_path'].removeprefix('file:')}/_load_id=*/part-*")
    os.remove(parts[0])  # the crash lost a file of the batch
    spark.catalog.refreshTable(name)
    _replay(spark, root, args, df.schema, name)
    assert spark.table(name).count() == 100


def test_a_replay_after_the_catalog_entry_is_lost_does_not_duplicate(spark):
    df = spark.range(50).select(F.col("id"))
    name = unique_name("inc")
    root, args = _stream(spark, df, name)
    spark.sql(f"DROP TABLE {name}")
    _replay(spark, root, args, df.schema, name)
    assert spark.table(name).count() == 50


def test_a_bad_line_fails_the_stream(spark):
    root = scratch_dir(spark, "stream")
    spark.createDataFrame([('{"id":1}',), ('{"id":2',)], "value string").write.text(f"{root}/raw/s/load_id=a")
    with pytest.raises(Exception):
        incremental_load(spark, raw_path(root, "s"), spark.range(1).schema, unique_name("inc"),
                         checkpoint=f"{root}/_ck", table_path=f"{root}/t")


def test_types_that_change_between_batches(spark):
    """Whole numbers fit a DOUBLE table; the other way round fails unless columns are given."""
    from pyspark.sql.types import StructType

    def load(bodies, name, root, tag, **kw):
        df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "seq bigint, body string")
        write_raw_responses(df, root, "api", tag)
        return incremental_responses_load(spark, raw_path(root, "api"), name, checkpoint=f"{root}/_ck",
                                          table_path=f"{root}/t", **kw)
    root, name = scratch_dir(spark, "stream"), unique_name("inc")
    load(['{"a":1.5}'], name, root, "x")
    load(['{"a":2}'], name, root, "y")
    assert sorted(r.a for r in spark.table(name).collect()) == [1.5, 2.0]
    root, name = scratch_dir(spark, "stream"), unique_name("inc")
    load(['{"a":2}'], name, root, "x")
    with pytest.raises(Exception, match="columns"):
        load(['{"a":1.5}'], name, root, "y")
    root, name = scratch_dir(spark, "stream"), unique_name("inc")
    fixed = StructType.fromDDL("a double")
    load(['{"a":2}'], name, root, "x", columns=fixed)
    load(['{"a":1.5}'], name, root, "y", columns=fixed)
    assert sorted(r.a for r in spark.table(name).collect()) == [1.5, 2.0]


def test_no_staged_copy_is_left_by_a_stream(spark):
    import glob

    from tributary.session import local_path, shared_root

    def staged():
        return set(glob.glob(f"{local_path(shared_root(spark))}/staged-records-*"))
    root, before = scratch_dir(spark, "stream"), staged()
    write_raw_responses(spark.createDataFrame([(0, '{"a":1}')], "seq bigint, body string"), root, "api", "a")
    incremental_responses_load(spark, raw_path(root, "api"), unique_name("inc"), checkpoint=f"{root}/_ck", table_path=f"{root}/t")
    assert staged() == before


def test_cli_runs_a_pipeline_file(spark, derby, tmp_path, capsys):
    from tributary.__main__ import main

    p = tmp_path / "cli.json"
    p.write_text(json.dumps([{"name": "cli_src", "src_type": "jdbc",
                              "connection": {"url": derby, "driver": DERBY_DRIVER, "table": "REGION"}}]))
    assert main(["run", str(p), "--output-root", scratch_dir(spark, "cli")]) == 0
    out = capsys.readouterr().out
    assert "cli/cli_src: SUCCESS" in out and "written=3" in out and "cli_src_job SUCCESS" in out


def test_example_pipelines_validate():
    import os

    from tributary.plans import load_pipelines

    here = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "pipelines")
    names = {s.name for p in load_pipelines(here) for s in p.sources}
    assert {"warehouse_orders", "warehouse_open_orders", "catalog_items", "catalog_search"} <= names


def test_runner_refuses_delta_without_the_package(spark):
    with pytest.raises(RuntimeError, match="Delta"):
        Runner(spark, scratch_dir(spark, "d"), table_format="delta")


def test_runner_parallel_sources(spark, derby):
    runner = Runner(spark, scratch_dir(spark, "par"), table_prefix=unique_name("par") + "_",
                    audit_table=unique_name("runs"), parallel_sources=3)
    specs = [SourceSpec(f"s{i}", "jdbc", {"url": derby, "driver": DERBY_DRIVER, "table": "REGION"})
             for i in range(4)]
    specs.append(SourceSpec("pages", "api", {"endpoint": "http://h/p", "page_param": "page",
                                             "pages": 2, "fetcher": STUB}))
    results = runner.run_pipeline(PipelineSpec("par", specs))
    assert [r.source for r in results] == ["s0", "s1", "s2", "s3", "pages"]
    assert all(r.status == "SUCCESS" for r in results), [r.error for r in results]
    assert spark.table(runner.audit_table).count() == 5
