"""Runs through the runner with a stub transport, checked by the values read back."""

import json

import pytest

from tests.stub_http import BODIES
from tributary.plans import Runner, SourceSpec
from tributary.session import scratch_dir, unique_name
from tributary.sinks import raw_path

STUB = "stub_http:fetch"


@pytest.fixture(scope="module")
def runner(spark):
    return Runner(spark, scratch_dir(spark, "e2e"), table_prefix=unique_name("e2e") + "_",
                  audit_table=unique_name("runs"))


def _run(runner, name, **conn):
    spec = SourceSpec(f"api_{name}", "api", {"endpoint": f"http://h/bodies/{name}", "fetcher": STUB, **conn})
    return runner.run_source(spec)


def _raw(spark, runner, result):
    path = raw_path(runner.root, result.source, result.load_id)
    return [json.loads(r.value) for r in spark.read.text(path).collect()]


#: What each payload becomes: columns and rows of the table.
TABLES = {
    "flat_object": (["harbour", "berths"], [("north", 14)]),
    "object_list": (["imo", "ship", "draught"], [(901, "Kestrel", 6.25), (902, "Heron", 4.5)]),
    "one_object": (["imo", "ship", "draught"], [(903, "Plover", 5.75)]),
    "other_keys_later": (["pilot"], [("yes",), (None,)]),
    "texts": (["value"], [("buoy",), ("quay",), ("lock",)]),
    "number": (["value"], [(1870,)]),
    "text": (["value"], [("closed at low tide",)]),
}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_payload_kinds_in_raw_layer_and_table(spark, runner, name):
    r = _run(runner, name)
    assert r.status == "SUCCESS" and r.table_action == "created" and r.failed_requests == 0
    assert [json.loads(x["body"]) for x in _raw(spark, runner, r)] == [BODIES[name]]
    columns, rows = TABLES[name]
    t = spark.table(r.table)
    assert t.columns == columns
    assert sorted((tuple(x) for x in t.collect()), key=repr) == sorted(rows, key=repr)


@pytest.mark.parametrize("name", ["null", "empty_array"])
def test_empty_payload_is_logged_and_writes_no_table(spark, runner, name):
    r = _run(runner, name)
    assert r.status == "SUCCESS" and r.table_action == "skipped" and (r.rows_read, r.rows_written) == (1, 0)
    assert not spark.catalog.tableExists(r.table)
    assert [json.loads(x["body"]) for x in _raw(spark, runner, r)] == [BODIES[name]]


def test_failed_requests_are_logged_and_counted(spark, runner):
    """One page of five answers 500: the run is PARTIAL, the audit counts it, raw holds its error."""
    r = _run(runner, "x", endpoint="http://h/flaky", page_param="page", pages=5, mode="PERMISSIVE")
    assert (r.status, r.failed_requests, r.rows_read, r.rows_written) == ("PARTIAL", 1, 5, 12)
    assert sorted((x["seq"], x["status"], x["error"]) for x in _raw(spark, runner, r)) == [
        (i, 500, "HTTP 500") if i == 1 else (i, 200, None) for i in range(5)]
    row = spark.table(runner.audit_table).filter("job_name = 'api_x_job'").first()
    assert (row.status, row.failed_requests, row.error) == ("PARTIAL", 1, "1 of 5 requests failed")
    all_bad = _run(runner, "y", endpoint="http://h/status500", mode="PERMISSIVE")
    assert (all_bad.status, all_bad.failed_requests, all_bad.table_action) == ("FAILURE", 1, "skipped")
    strict = _run(runner, "z", endpoint="http://h/flaky", page_param="page", pages=5)
    assert strict.status == "FAILURE" and "HTTP 500" in strict.error


def test_sources_that_would_share_a_table_are_refused(spark, runner):
    first = _run(runner, "number")
    spec = SourceSpec("API.Number", "api", {"endpoint": "http://h/bodies/text", "fetcher": STUB})
    second = runner.run_source(spec)
    assert first.status == "SUCCESS" and second.status == "FAILURE" and "share table" in second.error
    assert spark.table(first.table).first().value == 1870


def test_audit_has_every_run(spark, runner):
    _run(runner, "one_object")
    hist = runner.run_history(100).collect()
    assert any(h.job_name == "api_one_object_job" and h.status == "SUCCESS" for h in hist)


def test_raw_documents_in_the_one_file_per_fetch_layout(spark, tmp_path):
    from tributary.operators import normalize
    from tributary.sources import read_documents

    folder = tmp_path / "raw" / "posts"
    folder.mkdir(parents=True)
    (folder / "posts_20240101_120000.json").write_text(json.dumps(
        [{"id": 1, "title": "a"}, {"id": 2, "title": "b", "late": True}], indent=2))
    (folder / "posts_20240102_120000.json").write_text(json.dumps({"id": 3, "title": "c"}, indent=2))
    docs = read_documents(spark, str(tmp_path / "raw"))
    assert sorted(r.load_id for r in docs.collect()) == ["20240101_120000", "20240102_120000"]
    out = normalize(docs)
    assert out.columns == ["id", "title"]  # the oldest document's first record decides
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_staging_is_dropped_after_the_table_commit(spark, runner):
    import os

    from tributary.session import local_path

    r = _run(runner, "object_list")
    staging = local_path(f"{runner.root}/staging/{r.source}/load_id={r.load_id}")
    assert r.table_action in ("created", "appended") and r.rows_written == 2
    assert not os.path.exists(staging)


def test_documents_without_a_stamp_use_the_file_name(spark, tmp_path):
    from tributary.sources import read_documents

    folder = tmp_path / "docs" / "inventory"
    folder.mkdir(parents=True)
    (folder / "snapshot.json").write_text(json.dumps([{"sku": "a", "qty": 1}]))
    row = read_documents(spark, str(tmp_path / "docs")).first()
    assert (row.source, row.load_id) == ("inventory", "snapshot.json")
