"""Canonical connections, and what became of sources."""

import pytest

from tributary.plans.configs import canonical_json, config_changes

SCHEMA = "pipeline string, name string, src_type string, connection string, schedule string"


@pytest.mark.parametrize("a,b", [
    ('{"a": 1, "b": [1.0, {"d": 1e2, "c": null}]}', '{"b":[1,{"c":null,"d":100}],"a":1.0}'), ("-0.0", "0"), ('"\\u00e9"', '"é"'),
    ("0.10", "1e-1"), ('{"a":1,"a":2}', '{"a":2}'), ("12345678901234567890123", "1.2345678901234567890123e22"), (" [ ] ", "[]")])
def test_one_form_for_one_value(a, b):
    assert canonical_json(a) == canonical_json(b)


@pytest.mark.parametrize("a,b", [
    ("1", '"1"'), ("1", "1.0000000000000000000001"), ("true", "1"), ("null", '"null"'), ("[1,2]", "[2,1]"), ("{}", "[]"), ("1e999", "1e998")])
def test_other_values_differ(a, b):
    assert canonical_json(a) != canonical_json(b)


def test_text_that_is_not_json_stays():
    assert canonical_json("{oops") == "{oops" and canonical_json(None) is None


def test_changes(spark):
    old = [("p", "same", "jdbc", '{"a": 1}', None), ("p", "gone", "api", "{}", None), ("p", "moved", "api", '{"a": 1}', "0 * * * *"),
           (None, None, "api", None, None), ("p", "twice", "api", "{}", None), ("p", "twice", "api", '{"b": 1}', None), ("q", "same", "api", "{}", None)]
    new = [("p", "same", "JDBC", '{"a": 1.0}', None), ("p", "new", "api", "{}", None), ("p", "moved", "jdbc", '{"a": 2}', "0 * * * *"),
           (None, None, "api", "{}", None), ("p", "twice", "api", '{"b":1}', None), ("p", "twice", "api", "{ }", None), ("q", "same", "api", "{}", "0 0 * * *")]
    got = {(r.pipeline, r.name): (r.change, r.fields) for r in config_changes(*(spark.createDataFrame(x, SCHEMA) for x in (old, new))).collect()}
    assert got == {("p", "same"): ("same", []), ("p", "gone"): ("removed", []), ("p", "new"): ("added", []),
                   ("p", "moved"): ("changed", ["src_type", "connection"]), (None, None): ("changed", ["connection"]),
                   ("p", "twice"): ("same", []), ("q", "same"): ("changed", ["schedule"])}
    nothing = spark.createDataFrame([], SCHEMA)
    assert config_changes(nothing, nothing).collect() == []
