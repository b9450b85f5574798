"""Payload shaping: each body's literal result, and properties over generated payloads."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tributary.operators import normalize, normalize_by_source, response_outcomes, skip_empty
from tributary.operators.schema import SchemaConflictError

EMPTY = ([], [])
GONE = (["placeholder"], [("empty_record",)])
#: Body → columns and rows of the table it gives.
SHAPES = {
    "null": EMPTY, '""': EMPTY, "0": EMPTY, "0.0": EMPTY, "-0": EMPTY, "false": EMPTY, "[]": EMPTY, "{}": EMPTY, " [ ] ": EMPTY,
    "[{}]": GONE, '{"deck":{}}': GONE, '{"deck":[]}': GONE, '[{"a":{},"b":[]}]': GONE,
    "[0]": (["value"], [(0,)]), "[null]": (["value"], [(None,)]), "true": (["value"], [(True,)]),
    "7": (["value"], [(7,)]), '"fog"': (["value"], [("fog",)]), "-2.5e3": (["value"], [(-2500.0,)]),
    '["ebb","flood"]': (["value"], [("ebb",), ("flood",)]), "[[1,2],[3]]": (["value"], [([1, 2],), ([3],)]),
    '{"deck":[null]}': (["deck"], [([None],)]), '{"z":1,"a":2}': (["z", "a"], [(1, 2)]), '{"a":1,"a":2}': (["a"], [(2,)]),
    '{"a":100.0}': (["a"], [(100.0,)]), '[{"a":1},{"a":2.5}]': (["a"], [(1.0,), (2.5,)]),
    '[{"mast":1,"sail":{}},{"mast":2,"oar":3}]': (["mast"], [(1,), (2,)]),
    '[{"mast":"tall"},{"oar":"short"}]': (["mast"], [("tall",), (None,)]),
    '{"hull":{"len":1},"crew":[1,2]}': (["hull", "crew"], [({"len": 1}, [1, 2])]),
    '[{},{"a":1}]': (["placeholder"], [("empty_record",), (None,)]),
}


@pytest.mark.parametrize("body", SHAPES)
def test_a_body_and_its_table(responses, body):
    columns, rows = SHAPES[body]
    out = normalize(responses([body]))
    assert out.columns == columns
    assert [tuple(_plain(v) for v in r) for r in out.collect()] == [tuple(_plain(v) for v in r) for r in rows]


def _plain(v):
    """Comparable form: nested objects as key-sorted tuples (nested field order is
    a documented difference), numbers as floats where Arrow gives doubles."""
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    if isinstance(v, float):
        return v + 0.0  # -0.0 reads back as 0.0 (a VARIANT decimal has no negative zero)
    return v


def test_first_record_decides_columns(responses):
    out = normalize(responses(['{"b":1,"a":{}}', '{"a":{"x":1},"b":2,"c":3}']))
    assert out.columns == ["b"]
    assert sorted(r.b for r in out.collect()) == [1, 2]


def test_placeholder_first_hides_everything(responses):
    out = normalize(responses(['[{}]', '{"a":1}']))
    assert out.columns == ["placeholder"]
    assert sorted(r.placeholder or "" for r in out.collect()) == ["", "empty_record"]


def test_union_schema(responses):
    out = normalize(responses(['[{"list":"of"},{"dicts":"here"}]']), schema="union")
    assert out.columns == ["dicts", "list"]


def test_nested_keys_unioned(responses):
    out = normalize(responses(['{"a":{"x":1}}', '{"a":{"y":"s"}}']))
    assert out.schema["a"].dataType.simpleString() == "struct<x:bigint,y:string>"


@pytest.mark.parametrize("bodies", [['[{"a":1},{"a":"x"}]'], ['[5,{"a":1}]'], ['{"a":true}', '{"a":1}']])
def test_conflicting_kinds_raise(responses, bodies):
    with pytest.raises(SchemaConflictError):
        normalize(responses(bodies))


def test_permissive_keeps_conflict_as_text(responses):
    out = normalize(responses(['[{"a":1},{"a":"x"}]']), mode="PERMISSIVE")
    assert [r.a for r in out.collect()] == ["1", "x"]


def test_non_object_after_object_raises(responses):
    with pytest.raises(Exception, match="non-object"):
        normalize(responses(['[{"a":1},5]'])).collect()


@pytest.mark.parametrize("bad", ['{"bad', '{"a":1} x', '{"a":1},', '1 2', '[1] [2]', "{'a':1}"])
def test_invalid_json(responses, bad):
    with pytest.raises(Exception, match="invalid response"):
        normalize(responses([bad])).collect()
    assert normalize(responses([bad, '{"a":1}']), mode="PERMISSIVE").count() == 1


def test_skip_empty_and_outcomes(responses):
    bodies = ['null', '[]', '{}', '""', '0', 'false', '{"a":1}', '[0]', '{bad', None]
    df = responses(bodies, errors={9: "HTTP 500"})
    assert sorted(r.seq for r in skip_empty(df).collect()) == [6, 7]
    outcomes = {r.seq: r.outcome for r in response_outcomes(df).collect()}
    assert outcomes[6] == "ok" and outcomes[0] == "empty" and outcomes[8] == "invalid_json"
    assert outcomes[9] == "failed"


def test_order_by_seq_not_arrival(spark):
    df = spark.createDataFrame([(2, '{"late":1}'), (1, '{"early":1}')], "seq bigint, body string")
    assert normalize(df).columns == ["early"]


# values of one kind for each key, so that any mix of payloads can share a table
record = st.fixed_dictionaries({}, optional={
    "n": st.integers(-10**6, 10**6), "s": st.text(max_size=5), "f": st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: round(x, 3)),
    "o": st.dictionaries(st.sampled_from(["x", "y"]), st.integers(-9, 9), max_size=2), "l": st.lists(st.integers(0, 5), max_size=3)})


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(record, st.lists(record, min_size=1, max_size=4)), min_size=1, max_size=5))
def test_property_records_survive(spark, payloads):
    """Every record of every payload is a row, with the first record's columns and its own values in them."""
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "seq bigint, body string")
    out = normalize(df)
    flat = [r for p in payloads if p for r in (p if isinstance(p, list) else [p])]
    filled = [{k: v for k, v in r.items() if v != {} and v != []} for r in flat]
    assert out.columns == (list(filled[0]) or ["placeholder"] if filled else [])
    want = sorted(repr(tuple(_plain(({**r} if r else {"placeholder": "empty_record"}).get(c)) for c in out.columns)) for r in filled)
    got = sorted(repr(tuple(_plain({k: x for k, x in v.asDict().items() if x is not None}) if hasattr(v, "asDict") else _plain(v) for v in row))
                 for row in out.collect())
    assert [g.replace(".0,", ",").replace(".0)", ")") for g in got] == [w.replace(".0,", ",").replace(".0)", ")") for w in want]


@settings(max_examples=40, deadline=None)
@given(st.sampled_from(['{"a":1}', "[1]", "5", '"x"']), st.text(alphabet='{}[]",:12a ', min_size=1, max_size=12))
def test_property_text_behind_a_value_is_invalid(spark, value, rest):
    body = value + rest
    try:
        json.loads(body)
        valid = True
    except ValueError:
        valid = False
    row = response_outcomes(spark.createDataFrame([(0, body)], "seq bigint, body string")).first()
    assert (row.outcome != "invalid_json") == valid, body


@pytest.mark.parametrize("body", ['{"a":1}] x', '{"a":1}],[{"a":2}', '1},{"b":2', '1,"v":2', '{"a":1}}', "[1]]"])
def test_bodies_that_close_a_wrapper_are_invalid(responses, body):
    with pytest.raises(Exception, match="invalid response"):
        normalize(responses([body])).collect()


@pytest.mark.parametrize("bodies", [['{"a":9223372036854775808}'], ['{"a":1152921504606846977}', '{"a":1.5}'],
                                    ['{"a":[1.5,9007199254740993]}'], ['{"a":{"b":1.5}}', '{"a":{"b":9007199254740993}}'],
                                    ["[1.5,9007199254740993]"]])
def test_whole_numbers_never_change_silently(responses, bodies):
    with pytest.raises(Exception, match="too large to be exact"):
        normalize(responses(bodies)).collect()
    assert normalize(responses(bodies), mode="PERMISSIVE").count() >= 1


def test_large_but_exact_numbers_are_kept(responses):
    out = normalize(responses(['{"a":9007199254740992,"b":9223372036854775807,"c":1e300}', '{"a":1.5,"b":1,"c":12345678901234567890.5}']))
    assert sorted(tuple(r) for r in out.collect()) == [
        (1.5, 1, 1.2345678901234567e19), (9007199254740992.0, 9223372036854775807, 1e300)]


def test_keys_that_differ_by_case_are_refused_early(responses):
    with pytest.raises(SchemaConflictError, match="differ only by case"):
        normalize(responses(['{"id":1,"ID":2}']))


def test_each_source_has_its_own_first_record(spark):
    df = spark.createDataFrame([("a", 0, '{"x":1,"y":"s"}'), ("b", 1, '{"y":2.5}'), ("a", 2, '{"x":2,"z":1}'), ("b", 3, "[]")],
                               "source string, seq bigint, body string")
    got = normalize_by_source(df)
    assert {k: v.columns for k, v in got.items()} == {"a": ["x", "y"], "b": ["y"]}
    assert sorted(tuple(r) for r in got["a"].collect()) == [(1, "s"), (2, None)] and got["b"].first().y == 2.5


@pytest.mark.parametrize("n", [1, 40])
def test_sources_share_one_parse_and_one_scan_of_the_staged_records(spark, monkeypatch, n):
    """Whatever the number of sources: one staging job, and each result reads its own folder only."""
    import importlib

    N = importlib.import_module("tributary.operators.normalize")
    parsed = []
    original = N.response_records
    monkeypatch.setattr(N, "response_records", lambda df, **kw: parsed.append(df) or original(df, **kw))
    df = spark.range(200).select(F.concat(F.lit("s"), F.col("id") % n).alias("source"), F.col("id").alias("seq"),
                                 F.concat(F.lit('{"k":'), F.col("id"), F.lit("}")).alias("body"))
    got = N.normalize_by_source(df)
    # the input once, and the bodies of the first records (one a source) for their keys
    assert len(got) == n and len(parsed) == 2
    for name, out in got.items():
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "parseJson" not in plan and "_of" in plan and "PartitionFilters: [isnotnull(_of" in plan
    assert sorted(r.k for out in got.values() for r in out.collect()) == list(range(200))


def test_sources_of_odd_names_and_none(spark):
    rows = [("", 0, '{"a":1}'), (None, 1, '{"b":1}'), ("x/y=1 %", 2, '{"c":1}'), ("__HIVE_DEFAULT_PARTITION__", 3, '[{"d":1},{"e":2}]'),
            (None, 4, '{"b":2.5}'), ("s", 5, "[]"), ("S", 6, '["v"]')]
    got = normalize_by_source(spark.createDataFrame(rows, "source string, seq bigint, body string"))
    assert {k: (v.columns, v.count()) for k, v in got.items()} == {
        "": (["a"], 1), None: (["b"], 2), "x/y=1 %": (["c"], 1), "__HIVE_DEFAULT_PARTITION__": (["d"], 2), "S": (["value"], 1)}
    assert sorted(r.b for r in got[None].collect()) == [1.0, 2.5]
    assert normalize_by_source(spark.createDataFrame([], "source string, seq bigint, body string")) == {}


def test_staged_and_two_pass_agree(responses):
    bodies = ['[{"b":1,"a":{}},{"a":{"x":1},"b":2.5}]', '{"b":3,"c":[1]}', '[]', '[{}]']
    staged = normalize(responses(bodies))
    direct = normalize(responses(bodies), staging=False)
    assert staged.schema == direct.schema
    assert sorted(map(repr, staged.collect())) == sorted(map(repr, direct.collect()))


@pytest.mark.parametrize("staging", [None, False])
def test_keep_response_columns(spark, staging):
    df = spark.createDataFrame([(5, '[{"a":1},{"a":2}]', "u1"), (7, '{"a":3}', "u2")],
                               "seq bigint, body string, url string")
    out = normalize(df, keep=("seq", "url"), staging=staging)
    assert out.columns == ["seq", "url", "a"]
    assert sorted(tuple(r) for r in out.collect()) == [(5, "u1", 1), (5, "u1", 2), (7, "u2", 3)]
