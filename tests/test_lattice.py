"""Loads of rising types: states that merge, and a view that keeps every row."""

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tributary.plans import Runner, SourceSpec
from tributary.session import scratch_dir, unique_name
from tributary.sinks.lattice import TypeConflictError, join_states, load_widening, open_widening, state_type, type_state

LEAF = st.sampled_from([{"kind": "nothing"}, {"kind": "long", "large": False}, {"kind": "long", "large": True},
                        {"kind": "double", "large": False}, {"kind": "string"}, {"kind": "boolean"}])
STATE = st.recursive(LEAF, lambda c: st.builds(lambda i: {"kind": "array", "item": i}, c) | st.dictionaries(
    st.sampled_from("abc"), c, min_size=1, max_size=3).map(lambda d: {"kind": "struct", "fields": [list(x) for x in d.items()]}), max_leaves=6)


def shape(state):
    """A state without the places of its fields."""
    if state["kind"] == "struct":
        return {"kind": "struct", "fields": {n: shape(s) for n, s in state["fields"]}}
    return {"kind": "array", "item": shape(state["item"])} if state["kind"] == "array" else state


@settings(max_examples=300, deadline=None)
@given(st.lists(STATE, min_size=3, max_size=3))
def test_joins_merge_in_any_order(states):
    def join(a, b):
        return join_states(a, b, "text")

    a, b, c = states
    assert shape(join(a, b)) == shape(join(b, a))
    assert shape(join(join(a, b), c)) == shape(join(a, join(b, c)))
    assert shape(join(a, a)) == shape(a) and shape(join(join(a, b), b)) == shape(join(a, b))


def test_conflicts_are_named():
    long, text = {"kind": "long", "large": False}, {"kind": "string"}
    row = lambda s: {"kind": "struct", "fields": [["a", {"kind": "struct", "fields": [["b", s]]}]]}
    with pytest.raises(TypeConflictError, match="'a.b' holds long and string"):
        join_states(row(long), row(text))
    with pytest.raises(TypeConflictError, match="only by case"):
        join_states({"kind": "struct", "fields": [["a", long]]}, {"kind": "struct", "fields": [["A", long]]})
    with pytest.raises(TypeConflictError):  # a whole number that no double has
        join_states({"kind": "long", "large": True}, {"kind": "double", "large": False})


def test_states_of_types_and_back(spark):
    dt = T.StructType.fromDDL("a bigint, b double, c array<struct<d:bigint,e:string>>, f boolean, g date, h timestamp_ntz, i decimal(5,2)")
    assert state_type(type_state(dt)) == dt
    assert type_state(dt, {".c[].d": True})["fields"][2][1]["item"]["fields"][0][1]["large"]
    assert type_state(T.StructType.fromDDL("a string"), empty=frozenset({".a"}))["fields"] == [["a", {"kind": "nothing"}]]


@pytest.fixture
def place(spark):
    name = unique_name("rising")
    return name, f"{scratch_dir(spark, 'tables')}/{name}"


def loads(spark, place, rows, **kw):
    name, path = place
    return [load_widening(spark.createDataFrame(r, s), name, f"l{k}", path=path, **kw).action for k, (r, s) in enumerate(rows)]


ROWS = [([(1, None)], "a bigint, b string"), ([(2.5, "x")], "a double, b string"), ([(3, True, [1])], "a bigint, c boolean, d array<bigint>"),
        ([(4, [0.5, None])], "a bigint, d array<double>"), ([((7,), )], "e struct<x:bigint>"), ([((None, "y"),)], "e struct<x:double,y:string>")]


def test_every_row_of_every_load_is_kept(spark, place):
    assert loads(spark, place, ROWS) == ["created", "widened", "widened", "widened", "widened", "widened"]
    got = spark.table(place[0])
    assert dict(got.dtypes) == {"a": "double", "b": "string", "c": "boolean", "d": "array<double>", "e": "struct<x:double,y:string>", "_load_id": "string"}
    rows = {r._load_id: r for r in got.collect()}
    assert [rows[f"l{k}"].a for k in range(6)] == [1.0, 2.5, 3.0, 4.0, None, None]
    assert rows["l2"].d == [1.0] and rows["l3"].d == [0.5, None] and rows["l4"].e.x == 7.0 and rows["l5"].e.y == "y" and rows["l1"].c is None


def test_the_order_of_loads_changes_only_the_places_of_columns(spark):
    want = None
    for order in list(itertools.permutations(ROWS[:4]))[::5]:
        name = unique_name("rising")
        place = name, f"{scratch_dir(spark, 'tables')}/{name}"
        loads(spark, place, order)
        got = spark.table(name)
        cols = sorted(got.columns)
        rows = (sorted(got.dtypes), sorted(repr([r[c] for c in cols if c != "_load_id"]) for r in got.collect()))
        want = want or rows
        assert rows == want


def test_a_load_that_comes_again_replaces_itself(spark, place):
    name, path = place
    loads(spark, place, ROWS[:2])
    load_widening(spark.createDataFrame([(9, "z"), (8, "z")], "a bigint, b string"), name, "l0", path=path)
    load_widening(spark.createDataFrame([(6, True)], "a bigint, c boolean"), name, "l1", path=path)  # with other columns
    assert sorted((r._load_id, r.a) for r in spark.table(name).collect()) == [("l0", 8), ("l0", 9), ("l1", 6)]


def test_null_only_columns_take_any_type_later(spark, place):
    assert loads(spark, place, [([(None, 1)], "a string, k bigint"), ([(5, 2)], "a bigint, k bigint"), ([(None, 3)], "a string, k bigint")]) == [
        "created", "widened", "appended"]
    assert sorted((r.k, r.a) for r in spark.table(place[0]).collect()) == [(1, None), (2, 5), (3, None)]


@pytest.mark.parametrize("bad", [([("x",)], "a string"), ([(2**60,)], "a bigint"), ([([1],)], "a array<bigint>")])
def test_a_conflict_leaves_table_and_view_as_they_were(spark, place, bad):
    loads(spark, place, [([(0.5,)], "a double")])
    with pytest.raises(TypeConflictError):
        load_widening(spark.createDataFrame(*bad), place[0], "bad", path=place[1])
    assert [tuple(r) for r in spark.table(place[0]).collect()] == [(0.5, "l0")]
    assert [tuple(r) for r in open_widening(spark, *place).collect()] == [(0.5, "l0")]
    assert load_widening(spark.createDataFrame([(3,)], "a bigint"), place[0], "next", path=place[1]).action == "appended"
    assert sorted(r.a for r in spark.table(place[0]).collect()) == [0.5, 3.0]


def test_conflicts_as_text(spark, place):
    assert loads(spark, place, [([(1,)], "a bigint"), ([("x",)], "a string"), ([((True,),)], "a struct<b:boolean>")], on_conflict="text") == [
        "created", "widened", "appended"]
    assert {r.a for r in spark.table(place[0]).collect()} == {"1", "x", '{"b":true}'}


def test_a_new_session_finds_the_loads_again(spark, place):
    name, path = place
    loads(spark, place, ROWS[:3])
    want = sorted(map(repr, spark.table(name).collect()))
    spark.catalog.dropTempView(name)
    for t in spark.catalog.listTables():
        if t.name.startswith(f"{name}__"):
            spark.sql(f"DROP TABLE {t.name}")
    assert sorted(map(repr, open_widening(spark, name, path).collect())) == want
    with pytest.raises(ValueError, match="no loads"):
        open_widening(spark, name, path + "x")


def test_a_runner_that_widens_keeps_all_loads_and_repairs_them(spark):
    from tributary.fixtures import write_pages

    runner = Runner(spark, scratch_dir(spark, "out"), table_prefix=unique_name("p") + "_", audit_table=unique_name("runs"), on_mismatch="widen")

    def source(bodies):
        pages = spark.createDataFrame(list(enumerate(bodies)), "page bigint, body string")
        return SourceSpec("s", "api", {**write_pages(pages, scratch_dir(spark, "api")), "mode": "PERMISSIVE"})
    first = runner.run_source(source(['[{"v": 1}]', '[{"v": 2}]']))
    second = runner.run_source(source(['[{"v": 0.5, "w": "x"}]', "!503"]))
    assert (first.table_action, second.table_action, second.status) == ("created", "widened", "PARTIAL")
    healed = runner.repair_source(source(['[{"v": 0.5, "w": "x"}]', '[{"v": 7, "w": null}]']))
    assert (healed.status, healed.rows_read) == ("SUCCESS", 1)
    assert sorted((r.v, r.w) for r in spark.table(first.table).collect()) == [(0.5, "x"), (1.0, None), (2.0, None), (7.0, None)]
