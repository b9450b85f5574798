"""Record schema: first-record columns and type unification (N7, N8).

Two steps over the exploded records, both distributed:

1. two aggregates (``schema_metrics``; partial per task, one tiny row out):
   * ``schema_of_variant_agg`` over every record — the union of keys with a
     merged type per key (conflicting kinds merge to VARIANT), and
   * ``min_by`` of the body that holds the first record, ordered by (load id, seq,
     position); its keys in document order are read from that body alone
     (``payload.first_keys``).
   ``normalize`` observes them while staging the records; ``record_schema``
   runs them as a job of their own. Only that body and the schema string
   reach the driver.
2. a projection, one ``variant_get(record, '$[key]', type)`` per column
   (raises on a bad value) or ``try_variant_get`` (NULL instead).

Type mapping, as Python ``json`` + Arrow inference would type the values:
whole numbers → BIGINT, any fraction or a mix of the two → DOUBLE, text →
STRING, true/false → BOOLEAN, objects → STRUCT (inner keys unioned), arrays →
ARRAY, all-null → STRING. Any other mix of kinds is a conflict: FAILFAST raises,
PERMISSIVE keeps that value as its JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.json import as_object
from tributary.functions.names import column

FIRST_RECORD = "first_record"
UNION = "union"


class SchemaConflictError(ValueError):
    """Values of one column have kinds that cannot share a type."""


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ddl(dt: T.DataType) -> str:
    """DDL text of a type, with every field name quoted."""
    if isinstance(dt, T.StructType):
        return "struct<" + ",".join(f"{_quote(f.name)}:{ddl(f.dataType)}" for f in dt.fields) + ">"
    if isinstance(dt, T.ArrayType):
        return f"array<{ddl(dt.elementType)}>"
    if isinstance(dt, T.MapType):
        return f"map<{ddl(dt.keyType)},{ddl(dt.valueType)}>"
    return dt.simpleString()


def variant_schema_to_type(text: str) -> T.DataType:
    """Parse a ``schema_of_variant`` string (OBJECT<…> spelled as STRUCT<…>)."""
    return T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))


def storage_type(dt: T.DataType, path: str, mode: str = "FAILFAST") -> T.DataType:
    """Map a merged variant type to the column type written to the table."""
    if isinstance(dt, T.VariantType):
        if mode == "FAILFAST":
            raise SchemaConflictError(
                f"column {path!r} holds values of different kinds that cannot share a type")
        return T.StringType()
    if isinstance(dt, T.DecimalType):
        return T.DoubleType()
    if isinstance(dt, T.NullType):
        return T.StringType()
    if isinstance(dt, T.StructType):
        if not dt.fields:
            return T.StringType()
        return T.StructType([
            T.StructField(f.name, storage_type(f.dataType, f"{path}.{f.name}", mode), True)
            for f in dt.fields
        ])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(storage_type(dt.elementType, f"{path}[]", mode), True)
    return dt


def _order_key(df: DataFrame) -> Column:
    cols = [c for c in ("load_id", "seq", "pos") if c in df.columns]
    return F.struct(*cols)


def schema_metric(mode: str = "FAILFAST") -> Column:
    """The merged schema of ``explode_records`` output."""
    rec = F.col("rec")
    if mode != "FAILFAST":  # leave non-object items (rows of NULLs) out of the schema
        rec = F.when(as_object(rec).isNotNull(), rec)
    return F.schema_of_variant_agg(rec).alias("schema")


def first_body_metric(recs: DataFrame) -> Column:
    """The body that holds the first record, over ``response_records`` output with ``_body``.

    An aggregate copies the text that it holds with every row it sees: its rows must be
    the responses, as with their records each body would be copied for each of its items.
    """
    order = F.struct(*[F.col(c) for c in ("load_id", "seq") if c in recs.columns], F.lit(0).alias("pos"))
    return F.min_by(F.col("_body"), F.when(F.size("recs") > 0, order)).alias("first")


def schema_metrics(records: DataFrame, mode: str = "FAILFAST") -> list[Column]:
    """The two aggregates pass 1 needs, over ``explode_records`` output (with
    ``_body0``): the merged record schema and the body that holds the first record.
    Both merge idempotently, so they are safe as observed metrics too. The keys of the
    first record are then read from that one body, not from every response's."""
    return [schema_metric(mode),
            F.min_by(F.col("_body0"), _order_key(records)).alias("first")]


def _keys(spark, first: str | None, how: str, mode: str, clean: bool = True) -> list[str]:
    if how != FIRST_RECORD or first is None:
        return []
    from tributary.operators.payload import keys_of_first

    return keys_of_first(spark, first, mode, clean)


def schema_from_metrics(schema_text: str | None, keys: list[str] | None, *,
                        how: str = FIRST_RECORD, mode: str = "FAILFAST") -> T.StructType:
    """Table schema from the pass-1 metrics (empty when there were no records)."""
    if how not in (FIRST_RECORD, UNION):
        raise ValueError(f"schema must be {FIRST_RECORD!r} or {UNION!r}, got {how!r}")
    if schema_text is None:
        return T.StructType([])
    rec_type = variant_schema_to_type(schema_text)
    if isinstance(rec_type, T.NullType):
        return T.StructType([])
    if not isinstance(rec_type, T.StructType):
        raise SchemaConflictError("records mix objects with non-object items")
    by_name = {f.name: f.dataType for f in rec_type.fields}
    names = list(keys or []) if how == FIRST_RECORD else [f.name for f in rec_type.fields]
    by_case: dict[str, str] = {}
    for n in names:
        if by_case.setdefault(n.lower(), n) != n:
            raise SchemaConflictError(f"keys {by_case[n.lower()]!r} and {n!r} differ only by case; "
                                      "a table cannot have both")
    return T.StructType([
        T.StructField(n, storage_type(by_name.get(n, T.NullType()), n, mode), True) for n in names
    ])


def record_schema(records: DataFrame, *, how: str = FIRST_RECORD, mode: str = "FAILFAST",
                  clean: bool = True) -> T.StructType:
    """Pass 1 as its own aggregate job over ``explode_records`` output (with ``_body0``).

    ``normalize`` gets the same metrics while staging the records instead.
    """
    row = records.agg(*schema_metrics(records, mode)).first()
    if row is None:
        return T.StructType([])
    keys = _keys(records.sparkSession, row["first"], how, mode, clean)
    return schema_from_metrics(row["schema"], keys, how=how, mode=mode)


def _key_path(name: str) -> str | None:
    if "'" not in name and "\\" not in name:
        return f"$['{name}']"
    if '"' not in name and "\\" not in name:
        return f'$["{name}"]'
    return None


def project_records(records: DataFrame, schema: T.StructType, *, mode: str = "FAILFAST",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Pass 2: typed columns from the ``rec`` variant column, in ``schema`` order.

    One ``variant_get`` per column (a key lookup in the object), which is
    cheaper than casting the whole record to a struct.
    """
    rec = F.col("rec")
    cols = []
    for f in schema.fields:
        path = _key_path(f.name)
        if path is None:
            one = T.StructType([T.StructField(f.name, f.dataType, True)])
            cols.append(_typed(rec, "$", one, mode).getField(f.name).alias(f.name))
        else:
            cols.append(_typed(rec, path, f.dataType, mode).alias(f.name))
    return records.select(*[F.col(c) for c in keep if c in records.columns], *cols)


#: Whole numbers beyond this do not all have a double of their own.
_EXACT = float(2**53)


def _rounded(v: Column, dt: T.DataType) -> Column | None:
    """Whether a whole number inside ``v`` would change its value in a DOUBLE; None if there is no DOUBLE."""
    if isinstance(dt, T.DoubleType):
        near = F.coalesce(F.abs(F.try_variant_get(v, "$", "double")) >= _EXACT, F.lit(False))
        large = F.abs(F.try_variant_get(v, "$", "decimal(38,0)")) > F.lit(2**53).cast("decimal(38,0)")
        whole = F.schema_of_variant(v).rlike(r"^(BIGINT|DECIMAL\(\d+,\s*0\))$")
        return F.when(near, F.coalesce(whole & large, F.lit(False))).otherwise(F.lit(False))
    if isinstance(dt, T.StructType):
        found = None
        for f in dt.fields:
            path = _key_path(f.name)
            one = _rounded(F.try_variant_get(v, path, "variant"), f.dataType) if path else None
            if one is not None:
                found = one if found is None else found | one
        return found
    if isinstance(dt, T.ArrayType) and _has_double(dt.elementType):
        return F.coalesce(F.exists(v.try_cast("array<variant>"), lambda x: _rounded(x, dt.elementType)), F.lit(False))
    return None


def _has_double(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return any(_has_double(f.dataType) for f in dt.fields)
    return _has_double(dt.elementType) if isinstance(dt, T.ArrayType) else isinstance(dt, T.DoubleType)


def _typed(v: Column, path: str, dt: T.DataType, mode: str) -> Column:
    """The value at ``path`` as ``dt``. FAILFAST raises on a bad value, and on a whole
    number that a DOUBLE cannot hold; PERMISSIVE gives NULL, and the nearest double."""
    if mode != "FAILFAST":
        return F.try_variant_get(v, path, ddl(dt))
    value = F.variant_get(v, path, ddl(dt))
    if not _has_double(dt):
        return value
    if isinstance(dt, T.DoubleType):  # the common case looks at the text type of large values only
        lossy = F.when(F.abs(value) >= _EXACT, _rounded(F.variant_get(v, path, "variant"), dt)).otherwise(F.lit(False))
    else:
        lossy = F.coalesce(_rounded(F.variant_get(v, path, "variant"), dt), F.lit(False))
    message = F.lit(f"column at {path}: a whole number is too large to be exact in a DOUBLE column")
    return F.when(F.coalesce(lossy, F.lit(False)), F.raise_error(message).cast(ddl(dt))).otherwise(value)


def type_variant_columns(df: DataFrame, cols: list[str], *, mode: str = "FAILFAST") -> DataFrame:
    """VARIANT columns → typed columns (same unification rules as records),
    using one global ``schema_of_variant_agg`` per column."""
    if not cols:
        return df
    row = df.agg(*[F.schema_of_variant_agg(column(c)).alias(f"s{i}")
                   for i, c in enumerate(cols)]).first()
    types = {}
    for i, c in enumerate(cols):
        text = row[f"s{i}"] if row is not None else None
        types[c] = storage_type(variant_schema_to_type(text) if text else T.NullType(), c, mode)
    return df.select(*[
        _typed(column(f.name), "$", types[f.name], mode).alias(f.name) if f.name in types
        else column(f.name) for f in df.schema.fields
    ])
