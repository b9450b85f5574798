"""Requests as tables, repairs of loads, pages as a stream, and body encodings."""

import json

import pytest
from pyspark.sql import functions as F

from tributary.fixtures import write_pages
from tributary.plans import Runner, SourceSpec
from tributary.session import scratch_dir, unique_name
from tributary.sinks.raw import latest_load, read_raw
from tributary.sources.requests import fetch_requests, missing_requests, request_plan, settled
from tributary.sources.rest import RequestPlan, RestJsonStreamReader, decode_body, response_struct
from tributary.streaming import LOAD_COL, incremental_fetch

STUB = "stub_http:fetch"      # as the workers import it
HERE = "tests.stub_http:fetch"  # as this process does


@pytest.mark.parametrize("options", [
    {"endpoint": "http://x/a", "args": '{"k": "v", "page": 9}', "page_param": "page", "pages": "7", "page_start": "3"},
    {"endpoint": "http://x/{page}/{page}", "args": '{"k": 1}', "pages": "4"},
    {"endpoint": "http://x/a", "requests": '[{"args": {"q": [1, 2]}}, {"body": {"z": null}}, {}]', "method": "post", "body": '{"d": 1}'},
    {"endpoint": "http://x/a"},
])
def test_a_plan_has_the_requests_of_the_reader(spark, options):
    """The rows, sent with the options' args and body, are the requests that a read makes."""
    plan, want = request_plan(spark, options), RequestPlan(options)
    got = {r.seq: r for r in plan.collect()}
    assert sorted(got) == list(range(want.count))
    for i, r in got.items():
        w = want.request(i)
        assert (r.method, r.url) == (w.method, w.url)
        assert {**want.args, **json.loads(r.params or "{}")} == w.params
        assert (json.loads(r.body) if r.body is not None else want.body) == w.body


def test_a_plan_of_a_million_pages_is_a_range(spark):
    plan = request_plan(spark, {"endpoint": "http://x/{page}", "pages": "1000000"})
    assert "Range (0, 1000000" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_requests_from_a_table_with_args_of_any_kind(spark):
    base = {"endpoint": "http://x/a", "args": '{"berth": "old", "keep": 1}', "fetcher": STUB}
    rows = spark.createDataFrame([(1, "n1"), (2, "n2")], "seq bigint, b string")
    kinds = {"text": F.to_json(F.struct(F.col("b").alias("berth"))), "struct": F.struct(F.col("b").alias("berth")),
             "map": F.create_map(F.lit("berth"), F.col("b"))}
    for kind, args in kinds.items():
        got = fetch_requests(request_plan(spark, base, rows.select("seq", args.alias("args"))), base).collect()
        assert {(r.seq, json.loads(r.body)[0]["berth"]) for r in got} == {(1, "n1"), (2, "n2")}, kind
        assert all("keep=1" in r.url for r in got)
    with pytest.raises(ValueError, match="seq"):
        request_plan(spark, base, rows.select("b"))
    with pytest.raises(Exception, match="no seq"):
        request_plan(spark, base, spark.createDataFrame([(None,)], "seq bigint")).collect()


def test_a_source_with_a_table_of_requests_runs(spark):
    table = unique_name("plan")
    spark.range(5).select(F.col("id").alias("seq"), F.to_json(F.struct(F.col("id").alias("page"))).alias("args")).write.saveAsTable(table)
    runner = Runner(spark, scratch_dir(spark, "out"), table_prefix=unique_name("p") + "_", audit_table=unique_name("runs"))
    res = runner.run_source(SourceSpec("s", "api", {"endpoint": "http://x/a", "requests_table": table, "fetcher": STUB, "partitions": 2}))
    assert (res.status, res.rows_read, res.rows_written) == ("SUCCESS", 5, 15)


def test_many_responses_leave_the_worker_in_small_batches(spark, monkeypatch):
    plan = request_plan(spark, {"endpoint": "http://x/a", "page_param": "page", "pages": "600", "args": "{}"})
    out = fetch_requests(plan.coalesce(1), {"endpoint": "http://x/a", "fetcher": STUB})
    assert out.count() == 600 and out.select("seq").distinct().count() == 600


# ---------------------------------------------------------------- repairs
def _pages(spark, bad, n=20):
    body = F.to_json(F.array(F.struct(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))))
    return spark.range(n).select(F.col("id").alias("page"), F.when(F.col("id").isin(bad), "!503").otherwise(body).alias("body"))


def _runner(spark):
    return Runner(spark, scratch_dir(spark, "out"), table_prefix=unique_name("p") + "_", audit_table=unique_name("runs"))


def _spec(spark, bad, **conn):
    return SourceSpec("s", "api", {**write_pages(_pages(spark, bad), scratch_dir(spark, "api")), "mode": "PERMISSIVE", **conn})


def test_a_repair_sends_only_what_failed_until_nothing_does(spark):
    runner = _runner(spark)
    first = runner.run_source(_spec(spark, [0, 3, 5, 19]))
    assert (first.status, first.rows_written, first.failed_requests) == ("PARTIAL", 16, 4)
    some = runner.repair_source(_spec(spark, [5]))
    assert (some.status, some.rows_read, some.rows_written, some.failed_requests) == ("PARTIAL", 4, 3, 1)
    rest = runner.repair_source(_spec(spark, []), first.load_id)
    assert (rest.status, rest.rows_read, rest.rows_written) == ("SUCCESS", 1, 1)
    idle = runner.repair_source(_spec(spark, []))
    assert (idle.status, idle.rows_read, idle.table_action) == ("SUCCESS", 0, "skipped")
    assert sorted((r.k, r.v) for r in spark.table(first.table).collect()) == [(i, 2 * i) for i in range(20)]
    raw = read_raw(spark, runner.root, "s", response_struct(), first.load_id)
    assert raw.count() == 25 and settled(raw).count() == 20 and settled(raw).where("error is not null").count() == 0
    assert [r.status for r in runner.run_history().orderBy("started_at").collect()] == ["PARTIAL", "PARTIAL", "SUCCESS", "SUCCESS"]


def test_a_repair_without_a_table_shapes_the_whole_load(spark):
    runner = _runner(spark)
    first = runner.run_source(_spec(spark, list(range(20))))
    assert first.status == "FAILURE" and not spark.catalog.tableExists(first.table)
    res = runner.repair_source(_spec(spark, []))
    assert (res.status, res.rows_read, res.rows_written, res.table_action) == ("SUCCESS", 20, 20, "created")


def test_a_repair_that_does_not_fit_the_table_fails_and_changes_nothing(spark):
    runner = _runner(spark)
    first = runner.run_source(_spec(spark, [4]))
    odd = spark.range(20).select(F.col("id").alias("page"), F.lit('[{"k": "text", "v": 1}]').alias("body"))
    conn = {**write_pages(odd, scratch_dir(spark, "api")), "mode": "FAILFAST"}
    res = runner.repair_source(SourceSpec("s", "api", conn))
    assert res.status == "FAILURE" and spark.table(first.table).count() == 19


def test_repairs_need_requests_and_a_load(spark):
    runner = _runner(spark)
    assert "no load" in runner.repair_source(_spec(spark, [])).error
    jdbc = SourceSpec("d", "jdbc", {"url": "jdbc:derby:memory:none"})
    assert "no requests" in runner.repair_source(jdbc).error


def test_missing_requests_are_the_failed_the_invalid_and_the_unsent(spark):
    plan = request_plan(spark, {"endpoint": "http://x/{page}", "pages": "6"})
    rows = [(0, "[]", None), (1, None, "HTTP 500"), (2, "{oops", None), (3, '{"a": 1}', None), (1, '{"a": 2}', None), (4, None, "x")]
    got = missing_requests(plan, spark.createDataFrame(rows, "seq bigint, body string, error string"))
    assert sorted(r.seq for r in got.collect()) == [2, 4, 5]


# ---------------------------------------------------------------- pages as a stream
def test_stream_fetches_each_page_once(spark):
    folder, root, name = scratch_dir(spark, "api"), scratch_dir(spark, "s"), unique_name("t")
    kw = dict(checkpoint=f"{root}/_c", table_path=f"{root}/tables/{name}")
    pages = _pages(spark, [], 24)
    runs = []
    for part, since in ((pages.where("page < 8"), 0), (pages.where("page >= 8"), 8)):
        spec = SourceSpec("s", "api", write_pages(part, folder, since=since))
        runs += [incremental_fetch(spark, spec, root, name, **kw) for _ in range(2)]
    assert [(r["pages"], r["rows"]) for r in runs] == [(8, 8), (0, 0), (16, 16), (0, 0)]
    assert sorted(r.k for r in spark.table(name).collect()) == list(range(24))
    assert spark.table(name).select(LOAD_COL).distinct().count() == 2


def test_a_replayed_batch_reads_its_raw_load_and_loads_once(spark):
    """The first try dies after the raw write (a column that the table cannot take); the second does not fetch again."""
    root, name = scratch_dir(spark, "s"), unique_name("t")
    conn = write_pages(_pages(spark, [], 8), scratch_dir(spark, "api"))
    kw = dict(checkpoint=f"{root}/_c", table_path=f"{root}/tables/{name}")
    write_other = spark.createDataFrame([("x", "l")], f"other string, {LOAD_COL} string")
    from tributary.sinks import write_table

    write_table(write_other, name, path=kw["table_path"], partition_by=[LOAD_COL])
    with pytest.raises(Exception, match="columns"):
        incremental_fetch(spark, SourceSpec("s", "api", conn), root, name, **kw)
    load = latest_load(spark, root, "s")
    first = read_raw(spark, root, "s", response_struct(), load).agg(F.max("fetched_at")).first()[0]
    second = unique_name("t")
    out = incremental_fetch(spark, SourceSpec("s", "api", conn), root, second, checkpoint=kw["checkpoint"],
                            table_path=f"{root}/tables/{second}")
    assert out["rows"] == 8 and spark.table(second).count() == 8
    assert read_raw(spark, root, "s", response_struct(), load).agg(F.max("fetched_at")).first()[0] == first


def test_a_stream_needs_pages_and_their_number(spark):
    with pytest.raises(ValueError, match="needs pages"):
        RestJsonStreamReader({"endpoint": "http://x/a", "pages_endpoint": "http://x/n"})
    with pytest.raises(ValueError, match="pages_endpoint"):
        RestJsonStreamReader({"endpoint": "http://x/{page}"})
    reader = RestJsonStreamReader({"endpoint": "http://x/{page}", "pages_endpoint": "http://x/bodies/number", "fetcher": HERE,
                                   "partitions": "4"})
    assert reader.latestOffset() == {"pages": 1870}
    assert [(p.start, p.stop) for p in reader.partitions({"pages": 3}, {"pages": 11})] == [(3, 5), (5, 7), (7, 9), (9, 11)]
    with pytest.raises(RuntimeError, match="only 2"):
        reader.partitions({"pages": 3}, {"pages": 2})
    for what, key, text in (("texts", None, "number of pages"), ("flat_object", "harbour", "number of pages")):
        opts = {"endpoint": "http://x/{page}", "pages_endpoint": f"http://x/bodies/{what}", "fetcher": HERE}
        with pytest.raises(ValueError, match=text):
            RestJsonStreamReader({**opts, **({"pages_key": key} if key else {})}).latestOffset()
    keyed = RestJsonStreamReader({"endpoint": "http://x/{page}", "pages_endpoint": "http://x/bodies/flat_object", "pages_key": "berths",
                                  "fetcher": HERE})
    assert keyed.latestOffset() == {"pages": 14}


# ---------------------------------------------------------------- encodings
@pytest.mark.parametrize("codec", ["utf-8", "utf-8-sig", "utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-le", "utf-32-be"])
@pytest.mark.parametrize("text", ['{"a": "é日"}', "[1]", "7", '""'])
def test_json_bodies_of_any_unicode_encoding(codec, text):
    assert decode_body(text.encode(codec)) == text


def test_a_named_charset_is_used_where_the_bytes_allow_it():
    assert decode_body('["é"]'.encode("latin-1"), "iso-8859-1") == '["é"]'
    assert decode_body('["é"]'.encode("utf-16"), "utf-8") == '["é"]'
    assert decode_body(b"") == ""


def test_a_reader_hands_over_few_responses_at_a_time(tmp_path):
    """Rows would be held until there are as many as an Arrow batch takes, whatever their size."""
    from tributary.fixtures import ECHO
    from tributary.sources import rest

    read = lambda n, size: list(rest.RestJsonReader({
        "endpoint": "x", "method": "POST", "page_param": "p", "pages": n, "fetcher": ECHO, "body": '{"t": "%s"}' % ("y" * size)}).read(rest.RequestPartition(0, n)))
    small, large = read(1000, 1), read(20, 1 << 20)
    assert [len(b) for b in small] == [256, 256, 256, 232] and max(len(b) for b in large) <= 4
    assert [s for b in small for s in b.column(2).to_pylist()] == list(range(1000))
    assert rest.RestJsonReader({"endpoint": "x", "page_param": "p", "pages": 0}).partitions() == []
