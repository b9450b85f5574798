"""Tables whose types rise over loads: every load is kept, the view is as wide as needed.

Each load's columns form a state of a lattice; states are written beside the loads and
merge in any order. Loads of the same columns share a table; a view over these tables
gives every load the merged columns, by casts alone. Nothing is ever rewritten.

    nothing < BIGINT < DOUBLE (while every whole number is exact in one)
    STRUCT  field by field, fields that are new are added
    ARRAY   by its items
    any other two kinds meet in text (``on_conflict="text"``) or raise
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.names import column
from tributary.session import list_names
from tributary.sinks.table import (
    TableLoad,
    drop_partition,
    read_text,
    schema_key,
    table_known,
    write_table,
    write_text,
)

LOAD_COL = "_load_id"
NOTHING, LONG, DOUBLE, TEXT = "nothing", "long", "double", "text"
_EXACT = 2**53


class TypeConflictError(ValueError):
    """Two loads have values of one column that no type but text can hold."""


# ---------------------------------------------------------------- states
def type_state(dt: T.DataType, large: dict[str, bool] | None = None, empty: frozenset[str] = frozenset(), path: str = "") -> dict:
    """The state of a type. ``large`` tells of which whole numbers some is not exact as a
    double, ``empty`` which columns have no values at all."""
    if path in empty:
        return {"kind": NOTHING}
    if isinstance(dt, T.StructType):
        return {"kind": "struct", "fields": [[f.name, type_state(f.dataType, large, empty, f"{path}.{f.name}")] for f in dt.fields]}
    if isinstance(dt, T.ArrayType):
        return {"kind": "array", "item": type_state(dt.elementType, large, empty, f"{path}[]")}
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return {"kind": LONG, "large": bool((large or {}).get(path))}
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return {"kind": DOUBLE, "large": False}
    if isinstance(dt, T.NullType):
        return {"kind": NOTHING}
    return {"kind": dt.simpleString()}


def join_states(a: dict, b: dict, on_conflict: str = "fail", path: str = "") -> dict:
    """The least state above both; the same in whatever order many are joined (but for new fields' places)."""
    if a["kind"] == NOTHING or a == b:
        return b
    if b["kind"] == NOTHING:
        return a
    if a["kind"] == b["kind"] == "struct":
        fields = dict(map(tuple, a["fields"]))
        lower = {n.lower(): n for n in fields}
        for name, state in b["fields"]:
            if lower.setdefault(name.lower(), name) != name:
                raise TypeConflictError(f"columns {lower[name.lower()]!r} and {name!r} differ only by case")
            fields[name] = join_states(fields[name], state, on_conflict, f"{path}.{name}") if name in fields else state
        return {"kind": "struct", "fields": [list(x) for x in fields.items()]}
    if a["kind"] == b["kind"] == "array":
        return {"kind": "array", "item": join_states(a["item"], b["item"], on_conflict, f"{path}[]")}
    kinds = {a["kind"], b["kind"]}
    if kinds <= {LONG, DOUBLE}:
        large = a["large"] or b["large"]
        if kinds == {LONG}:
            return {"kind": LONG, "large": large}
        if not large:
            return {"kind": DOUBLE, "large": False}
    if on_conflict != "text":
        raise TypeConflictError(f"column {path.lstrip('.')!r} holds {a['kind']} and {b['kind']}")
    return {"kind": TEXT}


def state_type(state: dict) -> T.DataType:
    """The column type of a merged state."""
    kind = state["kind"]
    if kind == "struct":
        return T.StructType([T.StructField(n, state_type(s), True) for n, s in state["fields"]])
    if kind == "array":
        return T.ArrayType(state_type(state["item"]), True)
    if kind in (NOTHING, TEXT):
        return T.StringType()
    return T.LongType() if kind == LONG else T.DoubleType() if kind == DOUBLE else T.DataType.fromDDL(kind)


def _largest(col: Column, dt: T.DataType, path: str) -> list[tuple[str, Column]]:
    """For each whole-number place of a column: whether one of its values is not exact as a double."""
    if isinstance(dt, T.LongType):
        return [(path, (col > _EXACT) | (col < -_EXACT))]
    if isinstance(dt, T.StructType):
        return [x for f in dt.fields for x in _largest(col.getField(f.name), f.dataType, f"{path}.{f.name}")]
    if isinstance(dt, T.ArrayType):
        inside = lambda x: _largest(x, dt.elementType, f"{path}[]")
        any_of = lambda k: F.exists(col, lambda x: F.coalesce(inside(x)[k][1], F.lit(False)))
        return [(p, any_of(k)) for k, (p, _) in enumerate(inside(F.lit(None).cast(dt.elementType)))]
    return []


def widened(col: Column, dt: T.DataType, state: dict) -> Column:
    """A value of type ``dt`` as the merged state wants it."""
    kind = state["kind"]
    if kind == "struct" and isinstance(dt, T.StructType):
        have = {f.name: f.dataType for f in dt.fields}
        parts = [(widened(col.getField(n), have[n], s) if n in have else F.lit(None).cast(state_type(s))).alias(n)
                 for n, s in state["fields"]]
        return F.when(col.isNotNull(), F.struct(*parts))
    if kind == "array" and isinstance(dt, T.ArrayType):
        return F.transform(col, lambda x: widened(x, dt.elementType, state["item"]))
    if kind == TEXT:
        return col.cast("string") if not isinstance(dt, (T.StructType, T.ArrayType, T.MapType)) else F.to_json(col)
    return col.cast(state_type(state))


# ---------------------------------------------------------------- loads
def _states(spark: SparkSession, path: str) -> dict[str, dict]:
    """What is known of the tables of a path: group → the merged state of its loads.

    One small file a group, not a load: a group's loads differ only in which whole numbers
    are large, and that only ever becomes true.
    """
    names = [n for n in list_names(spark, f"{path}/_types") if n.endswith(".json")]
    return {n.removesuffix(".json"): json.loads(read_text(spark, f"{path}/_types/{n}")) for n in sorted(names)}


def _ordered(states: dict[str, dict]) -> list[tuple[str, dict]]:
    return sorted(states.items(), key=lambda x: (x[1]["since"], x[0]))


def merged_state(states: dict[str, dict], on_conflict: str = "fail") -> dict:
    return reduce(lambda a, b: join_states(a, b, on_conflict), [s["state"] for _, s in _ordered(states)])


def load_widening(df: DataFrame, table: str, load_id: str, *, path: str, on_conflict: str = "fail",
                  owner: str | None = None) -> TableLoad:
    """Adds a load to ``table``, a view as wide as its loads need; a load of the same id is replaced.

    ``created`` for the first load, ``appended`` where the view keeps its columns, ``widened``
    where they change. Columns keep the order of the first load, new ones come behind, and
    ``_load_id`` last. A load that conflicts raises :class:`TypeConflictError` and leaves
    table and view as they were. Null-only columns take any type later.
    """
    if on_conflict not in ("fail", "text"):
        raise ValueError("on_conflict must be 'fail' or 'text'")
    spark, path = df.sparkSession, path.rstrip("/")
    if LOAD_COL in df.columns:
        raise ValueError(f"a load has no column {LOAD_COL} of its own")
    df = df.select(*[column(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else column(f.name)
                     for f in df.schema.fields])
    before = _states(spark, path)
    group = "g" + hashlib.sha1(json.dumps(sorted((n, d.json()) for n, d in schema_key(df.schema).items())).encode()).hexdigest()[:12]
    texts = [f".{f.name}" for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    since = before[group]["since"] if group in before else len(before)
    # most conflicts show before anything is written: texts may turn out to have no values
    merged_state({**before, group: {"since": since, "state": type_state(df.schema, empty=frozenset(texts))}}, on_conflict)
    checks = [x for f in df.schema.fields for x in _largest(column(f.name), f.dataType, f".{f.name}")]
    checks = [(p, F.bool_or(c)) for p, c in checks] + [(p, F.count(column(p[1:])) == 0) for p in texts]
    seen = Observation()
    part, where = f"{table}__{group}", f"{path}/{group}"
    if checks:
        df = df.observe(seen, *[F.coalesce(c, F.lit(False)).alias(f"c{k}") for k, (_, c) in enumerate(checks)])
    # a load that comes again with other columns leaves its former table
    res = write_table(df.withColumn(LOAD_COL, F.lit(load_id)), part, path=where, partition_by=[LOAD_COL],
                      on_mismatch="fail", replace_partition={LOAD_COL: load_id}, skip_if_empty=False, owner=owner)
    found = {p for k, (p, _) in enumerate(checks) if seen.get[f"c{k}"]}
    state = type_state(df.schema, dict.fromkeys(found, True), frozenset(found & set(texts)))
    if group in before:
        state = join_states(before[group]["state"], state)
    after = {**before, group: {"since": since, "state": state}}
    try:
        merged = merged_state(after, on_conflict)
    except TypeConflictError:
        drop_partition(spark, part, {LOAD_COL: load_id})
        raise
    for other in before:
        if other != group and table_known(spark, f"{table}__{other}", f"{path}/{other}"):
            drop_partition(spark, f"{table}__{other}", {LOAD_COL: load_id})
    write_text(spark, f"{path}/_types/{group}.json", json.dumps(after[group]))
    _view(spark, table, path, after, merged)
    action = "created" if not before else "appended" if merged == merged_state(before, on_conflict) else "widened"
    return TableLoad(table, action, res.rows)


def _view(spark: SparkSession, table: str, path: str, states: dict[str, dict], merged: dict) -> None:
    """The view over the tables of all groups, a temporary view of the session (see ``open_widening``)."""
    parts = []
    for group, _ in _ordered(states):
        name = f"{table}__{group}"
        table_known(spark, name, f"{path}/{group}")
        own = spark.table(name)
        have = {f.name: f.dataType for f in own.schema.fields}
        cols = [(widened(column(n), have[n], s) if n in have else F.lit(None).cast(state_type(s))).alias(n) for n, s in merged["fields"]]
        parts.append(own.select(*cols, LOAD_COL))
    out = reduce(DataFrame.unionByName, parts)
    out.createOrReplaceTempView(table)


def open_widening(spark: SparkSession, table: str, path: str, on_conflict: str = "fail") -> DataFrame:
    """The view of a table's loads, from what is stored under ``path`` (in a new session too)."""
    states = _states(spark, path.rstrip("/"))
    if not states:
        raise ValueError(f"no loads under {path}")
    _view(spark, table, path.rstrip("/"), states, merged_state(states, on_conflict))
    return spark.table(table)
