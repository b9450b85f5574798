"""Tables keep to their own folders and owners, and a bad audit table stops no source."""

import pytest
from pyspark.sql import functions as F

from tributary.fixtures import write_pages
from tributary.plans import Runner, SourceSpec
from tributary.session import scratch_dir, unique_name
from tributary.sinks import TableOwnerError, read_raw_positional, table_owner, write_raw_positional, write_table
from tributary.sinks.raw import raw_path

STUB = "stub_http:fetch"


@pytest.fixture
def place(spark):
    return unique_name("t"), f"{scratch_dir(spark, 'tables')}/"


def test_a_replacement_leaves_tables_whose_names_begin_alike(spark, place):
    name, root = place
    rest = f"{name}__rest"
    write_table(spark.range(10), rest, path=root + rest)
    other = spark.createDataFrame([("a",)], "x string")
    assert write_table(other, name, path=root + name).action == "created"
    assert write_table(spark.range(3), name, path=root + name).action == "replaced"
    assert spark.table(rest).count() == 10 and spark.table(name).count() == 3


def test_only_own_replacements_are_adopted(spark, place):
    """A folder with the right kind of name but another table's marker, or none, is passed over."""
    name, root = place
    foreign = f"{name}__r{'9' * 20}"
    write_table(spark.range(10), foreign, path=root + foreign)        # a table that is named so
    spark.range(7).write.parquet(f"{root}{name}__r{'8' * 20}")        # a folder without a marker
    assert write_table(spark.range(2), name, path=root + name).action == "created"
    assert spark.table(name).count() == 2 and spark.table(foreign).count() == 10
    spark.sql(f"DROP TABLE {name}")
    assert write_table(spark.range(1), name, path=root + name).action == "appended"
    assert spark.table(name).count() == 3


def test_a_folder_of_another_table_is_refused(spark, place):
    name, root = place
    write_table(spark.range(4), name, path=root + "shared")
    with pytest.raises(TableOwnerError, match="holds table"):
        write_table(spark.range(1), unique_name("u"), path=root + "shared")
    assert spark.table(name).count() == 4


@pytest.mark.parametrize("external", [True, False])
def test_owners_outlive_the_catalog_entry_and_a_replacement(spark, place, external):
    name, root = place
    path = root + name if external else None
    write_table(spark.range(2), name, path=path, owner="Orders.API")
    write_table(spark.createDataFrame([("a",)], "x string"), name, path=path, owner="Orders.API")  # replaced
    assert table_owner(spark, name, path) == "Orders.API"
    with pytest.raises(TableOwnerError, match="Orders.API"):
        write_table(spark.range(2), name, path=path, owner="orders-api")
    if external:
        spark.sql(f"DROP TABLE {name}")
        assert table_owner(spark, name, path) == "Orders.API"
        with pytest.raises(TableOwnerError):
            write_table(spark.range(2), name, path=path, owner="orders-api")
    assert write_table(spark.createDataFrame([("b",)], "x string"), name, path=path, owner="Orders.API").action == "appended"
    assert spark.table(name).count() == 2


def _api(name, what="object_list"):
    return SourceSpec(name, "api", {"endpoint": f"http://x/bodies/{what}", "fetcher": STUB})


def test_a_new_runner_on_the_same_root_refuses_a_shared_table(spark):
    root, prefix, audit = scratch_dir(spark, "out"), unique_name("p") + "_", unique_name("runs")
    first = Runner(spark, root, table_prefix=prefix, audit_table=audit).run_source(_api("Orders.API"))
    second = Runner(spark, root, table_prefix=prefix, audit_table=audit).run_source(_api("orders-api", "number"))
    assert (first.status, second.status) == ("SUCCESS", "FAILURE") and "share table" in second.error
    assert spark.table(first.table).count() == 2


def test_a_source_named_like_the_audit_table_fails_alone(spark):
    root = scratch_dir(spark, "out")
    runner = Runner(spark, root, table_prefix=unique_name("p") + "_")
    runner.audit_table = runner.table_prefix + "ingest_runs"
    results = [runner.run_source(_api(n)) for n in ("Ingest.Runs", "ships")]
    assert [r.status for r in results] == ["FAILURE", "SUCCESS"] and "audit table" in results[0].error
    assert {r.status for r in runner.run_status().collect()} == {"SUCCESS", "FAILURE"}


def test_an_audit_table_that_cannot_be_written_stops_no_source(spark):
    root, audit = scratch_dir(spark, "out"), unique_name("runs")
    write_table(spark.range(1), audit, path=f"{root}/tables/{audit}")  # somebody's table of other columns
    runner = Runner(spark, root, table_prefix=unique_name("p") + "_", audit_table=audit)
    results = [runner.run_source(_api(n)) for n in ("a", "b")]
    assert [(r.status, r.audited) for r in results] == [("SUCCESS", False)] * 2
    assert spark.table(audit).columns == ["id"]


@pytest.mark.parametrize("line", ['[2,"b"', "{}", "[1] [2]", "5", "", "[1],[2]"])
def test_a_bad_positional_line_raises(spark, line):
    root = scratch_dir(spark, "raw")
    spark.createDataFrame([(line,)], "value string").write.text(raw_path(root, "s", "l"))
    with pytest.raises(Exception, match="not a JSON array"):
        read_raw_positional(spark, root, "s", "l").collect()


def test_a_null_positional_row_comes_back_as_null(spark):
    root = scratch_dir(spark, "raw")
    rows = spark.createDataFrame([(1, [1, 2]), (2, None), (3, [])], "i int, row array<int>")
    write_raw_positional(rows, root, "s", "l")
    got = read_raw_positional(spark, root, "s", "l").select(F.to_json("row").alias("r")).collect()
    assert sorted(r.r or "" for r in got) == ["", "[1,2]", "[]"]


def test_overwriting_a_partition_leaves_the_session_setting(spark, place):
    name, root = place
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    df = spark.range(10).select("id", F.when(F.col("id") < 5, "it's").otherwise("b").alias("p"))
    write_table(df, name, path=root + name, partition_by=["p"])
    write_table(df.where("id = 0"), name, path=root + name, replace_partition={"p": "it's"})
    assert spark.conf.get(key) == before
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 5, 6, 7, 8, 9]


def test_pages_are_packed_into_few_files(spark):
    import os

    from tributary.fixtures import PAGES_PER_FILE, fetch_page
    from tributary.session import local_path

    pages = spark.range(50).select(F.col("id").alias("page"), F.concat(F.lit("["), F.col("id"), F.lit("]")).alias("body"))
    conn = write_pages(pages.where("page <> 7"), scratch_dir(spark, "api"))
    folder = local_path(conn["endpoint"].rsplit("/", 1)[0])
    parts = [f for _, _, names in os.walk(folder) for f in names if f.startswith("part-")]
    assert len(parts) == -(-50 // PAGES_PER_FILE)
    for i in (0, 7, 8, 49):
        assert fetch_page("GET", conn["endpoint"].replace("{page}", str(i)), {}, None, 1) == (200, "[]" if i == 7 else f"[{i}]")
