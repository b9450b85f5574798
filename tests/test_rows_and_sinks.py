import datetime as dt
import decimal
import json
import os

import pytest

from tributary.operators import generic_columns, named_rows, positional, type_variant_columns
from tributary.session import scratch_dir, unique_name
from tributary.sinks import (
    SchemaMismatchError,
    read_raw,
    read_raw_positional,
    stringify,
    write_raw,
    write_raw_positional,
    write_table,
)


def test_named_rows_duplicate_names_keep_first_position_last_value(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "row array<int>")
    out = named_rows(df, ["a", "b", "a"])
    assert out.columns == ["a", "b"]
    assert tuple(out.first()) == (3, 2)


def test_named_rows_width_mismatch_raises(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2, 3],)], "row array<int>")
    with pytest.raises(Exception, match="expected 2"):
        named_rows(df, ["a", "b"]).collect()
    for pruned in (named_rows(df, ["a", "b"]).select("b"), named_rows(df, ["a", "b"]).groupBy().count()):
        with pytest.raises(Exception, match="expected 2"):  # whichever columns are used
            pruned.collect()
    with pytest.raises(Exception, match="row has no values"):
        named_rows(spark.createDataFrame([(None,)], "row array<int>"), ["a"]).collect()


def test_generic_columns_width_from_first_row(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [3, 4])], "k int, row array<int>")
    out = generic_columns(df, order="k")
    assert out.columns == ["column_0", "column_1"]
    bad = spark.createDataFrame([(1, [1, 2]), (2, [3])], "k int, row array<int>")
    with pytest.raises(Exception, match="expected 2"):
        generic_columns(bad, order="k").collect()


def test_positional_rows_typed_like_the_values(spark):
    df = spark.createDataFrame([(7, "gravel", 2.25), (9, "sand", 0.5)], "code int, stuff string, tons double")
    rows = df.select(positional(df).alias("row"))
    out = type_variant_columns(generic_columns(rows), ["column_0", "column_1", "column_2"])
    assert out.schema.simpleString() == "struct<column_0:bigint,column_1:string,column_2:double>"
    assert sorted(tuple(r) for r in out.collect()) == [(7, "gravel", 2.25), (9, "sand", 0.5)]


def test_raw_stringify_rules(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 12, 0, 0), dt.datetime(2024, 1, 1, 12, 0, 0, 500000),
          dt.date(2024, 1, 1), decimal.Decimal("1.10"), bytearray(b"x"))],
        "a timestamp_ntz, b timestamp_ntz, d date, m decimal(5,2), y binary")
    r = stringify(df).first()
    assert (r.a, r.b, r.d, r.m) == ("2024-01-01 12:00:00", "2024-01-01 12:00:00.500000", "2024-01-01", "1.10")


def test_instants_survive_a_repeated_hour(spark):
    """In New York 05:30 and 06:30 UTC of that day are both 01:30 on the wall."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(2).selectExpr("id", "timestamp_seconds(1730611800 + 3600 * id) AS t",
                                       "array(timestamp_micros(1730611800000001)) AS ts")
        root = scratch_dir(spark, "t")
        path = write_raw(df, root, "src", "l1")
        back = read_raw(spark, root, "src", df.schema, "l1").selectExpr("id", "unix_seconds(t) AS s", "unix_micros(ts[0]) AS u")
        assert sorted((r.id, r.s, r.u) for r in back.collect()) == [
            (0, 1730611800, 1730611800000001), (1, 1730615400, 1730611800000001)]
        assert {json.loads(r.value)["t"] for r in spark.read.text(path).collect()} == {
            "2024-11-03 05:30:00+00:00", "2024-11-03 06:30:00+00:00"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("line", ['{"id":2', '{"id":"x"}', "nonsense"])
def test_a_bad_raw_line_raises(spark, line):
    root = scratch_dir(spark, "t")
    spark.createDataFrame([('{"id":1}',), (line,)], "value string").write.text(f"{root}/raw/src/load_id=l1")
    df = read_raw(spark, root, "src", spark.createDataFrame([], "id bigint").schema, "l1")
    with pytest.raises(Exception):
        df.collect()


def test_raw_roundtrip_keeps_types_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, dt.datetime(2024, 1, 1, 0, 0, 1, 5), decimal.Decimal("2.50"), [dt.date(2024, 2, 3)])],
        "id bigint, s string, t timestamp_ntz, m decimal(5,2), ds array<date>")
    root = scratch_dir(spark, "t")
    path = write_raw(df, root, "src", "l1")
    line = json.loads(spark.read.text(path).first().value)
    assert line["s"] is None and "s" in line  # nulls are written, not dropped
    back = read_raw(spark, root, "src", df.schema, "l1")
    assert back.collect() == df.collect()


def test_raw_positional_lines_are_arrays(spark):
    df = spark.createDataFrame([(7, "gravel", 2.25)], "code int, stuff string, tons double")
    root = scratch_dir(spark, "t")
    path = write_raw_positional(df.select(positional(df).alias("row")), root, "src", "l1")
    assert json.loads(spark.read.text(path).first().value) == [7, "gravel", 2.25]
    assert read_raw_positional(spark, root, "src", "l1").count() == 1


def test_table_create_append_replace_skip(spark):
    name = unique_name("t")
    path = os.path.join(scratch_dir(spark, "tables"), name)
    a = spark.createDataFrame([(1, "x")], "id bigint, v string")
    assert write_table(a.limit(0), name, path=path).action == "skipped"
    assert not spark.catalog.tableExists(name)
    assert write_table(a, name, path=path).action == "created"
    reordered = spark.createDataFrame([("y", 2)], "v string, id bigint")
    load = write_table(reordered, name, path=path)
    assert (load.action, load.rows) == ("appended", 1)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "x"), (2, "y")]
    widened = spark.createDataFrame([(3, "z")], "id int, v string")  # type differs: no silent upcast
    with pytest.raises(SchemaMismatchError):
        write_table(widened, name, path=path, on_mismatch="fail")
    assert write_table(widened, name, path=path).action == "replaced"
    assert spark.table(name).schema.simpleString() == "struct<id:int,v:string>"
    assert spark.table(name).count() == 1


def test_table_sink_refuses_unknown_options(spark):
    a = spark.createDataFrame([(1,)], "id bigint")
    with pytest.raises(ValueError):
        write_table(a, unique_name("t"), on_mismatch="merge")
    with pytest.raises(RuntimeError, match="Delta"):
        write_table(a, unique_name("t"), fmt="delta")


def test_replace_with_data_derived_from_the_table(spark):
    name = unique_name("t")
    path = os.path.join(scratch_dir(spark, "tables"), name)
    write_table(spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, v string"), name, path=path)
    derived = spark.table(name).selectExpr("id", "upper(v) AS v", "id * 10 AS w")
    load = write_table(derived, name, path=path)
    assert (load.action, load.rows) == ("replaced", 2)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "X", 10), (2, "Y", 20)]


def _located(spark, name):
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first().data_type


@pytest.mark.parametrize("external", [True, False])
def test_a_replacement_that_fails_leaves_the_old_table(spark, external):
    name = unique_name("t")
    path = os.path.join(scratch_dir(spark, "tables"), name) if external else None
    write_table(spark.createDataFrame([(1, "x")], "id bigint, v string"), name, path=path)
    bad = spark.range(10).selectExpr("id", "if(id = 7, raise_error('boom'), 1) AS w")
    with pytest.raises(Exception, match="boom"):
        write_table(bad, name, path=path, known_rows=10)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "x")]
    assert write_table(spark.range(3).selectExpr("id", "id AS w"), name, path=path).action == "replaced"
    assert spark.table(name).count() == 3


def test_a_replaced_table_is_found_again_and_its_old_files_go(spark):
    name = unique_name("t")
    path = os.path.join(scratch_dir(spark, "tables"), name)
    write_table(spark.createDataFrame([(1, "x")], "id bigint, v string"), name, path=path)
    old = _located(spark, name)
    new = spark.createDataFrame([(1, 2)], "id bigint, w bigint")
    write_table(new, name, path=path)
    assert _located(spark, name) != old and not os.path.exists(old.removeprefix("file:"))
    spark.sql(f"DROP TABLE {name}")  # the catalog is lost
    assert write_table(new, name, path=path).action == "appended"
    assert spark.table(name).count() == 2


def test_whole_numbers_go_into_a_double_column_where_exact(spark):
    name = unique_name("t")
    write_table(spark.createDataFrame([(1.5,)], "v double"), name)
    assert write_table(spark.createDataFrame([(2,)], "v bigint"), name, on_mismatch="fail").action == "appended"
    with pytest.raises(Exception, match="too large"):
        write_table(spark.createDataFrame([(2**53 + 1,)], "v bigint"), name, on_mismatch="fail")
    assert sorted(r.v for r in spark.table(name).collect()) == [1.5, 2.0]


def test_table_folder_from_earlier_session_is_reused(spark):
    name = unique_name("t")
    path = os.path.join(scratch_dir(spark, "tables"), name)
    a = spark.createDataFrame([(1, "x")], "id bigint, v string")
    assert write_table(a, name, path=path).action == "created"
    spark.sql(f"DROP TABLE {name}")  # external: the files stay, as after a new session
    assert write_table(a, name, path=path).action == "appended"
    assert spark.table(name).count() == 2


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_ts = st.datetimes(min_value=dt.datetime(1970, 1, 2), max_value=dt.datetime(2200, 1, 1))
_row = st.tuples(
    st.integers(-2**62, 2**62),
    st.one_of(st.none(), st.text(max_size=8)),
    st.one_of(st.none(), _ts),
    st.one_of(st.none(), st.decimals(min_value=-10**6, max_value=10**6, places=2,
                                     allow_nan=False, allow_infinity=False)),
    st.one_of(st.none(), st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2200, 1, 1))),
    st.one_of(st.none(), st.binary(max_size=6)),
    st.lists(st.one_of(st.none(), _ts), max_size=3),
    st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(_row, min_size=1, max_size=6))
def test_property_raw_roundtrip(spark, rows):
    schema = ("id bigint, s string, t timestamp_ntz, m decimal(12,2), d date, y binary, "
              "ts array<timestamp_ntz>, f double")
    df = spark.createDataFrame([(*r[:5], bytearray(r[5]) if r[5] is not None else None, *r[6:]) for r in rows],
                               schema)
    root = scratch_dir(spark, "prop")
    write_raw(df, root, "p", "l1")
    back = read_raw(spark, root, "p", df.schema, "l1")
    key = lambda r: repr(tuple(r))
    assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)


def test_read_all_raw_loads_with_their_ids(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    root = scratch_dir(spark, "loads")
    write_raw(df.filter("id = 1"), root, "s", "20240101_000000_000001")
    write_raw(df.filter("id = 2"), root, "s", "20240102_000000_000001")
    both = read_raw(spark, root, "s", df.schema, with_load_id=True)
    assert sorted(tuple(r) for r in both.collect()) == [
        (1, "a", "20240101_000000_000001"), (2, "b", "20240102_000000_000001")]
