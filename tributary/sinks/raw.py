"""Raw JSON layer (K1–K4).

Layout: ``<root>/raw/<source>/load_id=<stamp>/part-*.json`` — JSON lines, one
record (or one response) per line, written by the executors in parallel. A
rerun of the same ``load_id`` overwrites only that load, so a retried job is
idempotent. Reading back always uses an explicit schema (partition inference
would read a numeric stamp as int).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.json import single_value
from tributary.functions.names import column
from tributary.functions.text import raw_instant_text, raw_timestamp_text
from tributary.session import list_names

LOAD_ID = "load_id"


def raw_path(root: str, source: str, load_id: str | None = None) -> str:
    base = f"{root.rstrip('/')}/raw/{source}"
    return base if load_id is None else f"{base}/{LOAD_ID}={load_id}"


def _stringify(col: Column, dt: T.DataType) -> Column:
    """Values JSON cannot hold as such → text (Python ``json.dump(default=str)``)."""
    if isinstance(dt, T.TimestampType):
        return raw_instant_text(col)
    if isinstance(dt, T.TimestampNTZType):
        return raw_timestamp_text(col)
    if isinstance(dt, (T.DateType, T.DecimalType)):
        return col.cast("string")
    if isinstance(dt, T.BinaryType):
        return F.base64(col)  # Python would print b'…'; base64 round-trips
    if isinstance(dt, T.StructType):
        if not any(_needs_text(f.dataType) for f in dt.fields):
            return col
        return F.when(col.isNull(), F.lit(None)).otherwise(F.struct(*[
            _stringify(col.getField(f.name), f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, T.ArrayType) and _needs_text(dt.elementType):
        return F.transform(col, lambda x: _stringify(x, dt.elementType))
    if isinstance(dt, T.MapType) and _needs_text(dt.valueType):
        return F.transform_values(col, lambda _k, x: _stringify(x, dt.valueType))
    return col


def _needs_text(dt: T.DataType) -> bool:
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType, T.BinaryType)):
        return True
    if isinstance(dt, T.StructType):
        return any(_needs_text(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _needs_text(dt.elementType)
    if isinstance(dt, T.MapType):
        return _needs_text(dt.valueType)
    return False


def stringify(df: DataFrame) -> DataFrame:
    """Project every column to its raw-layer rendering (K3)."""
    return df.select(*[_stringify(column(f.name), f.dataType).alias(f.name)
                       for f in df.schema.fields])


def raw_schema(schema: T.StructType) -> T.StructType:
    """Schema to read a stringified raw layer with (text where ``stringify`` wrote text)."""
    def conv(dt: T.DataType) -> T.DataType:
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType, T.BinaryType)):
            return T.StringType()
        if isinstance(dt, T.StructType):
            return T.StructType([T.StructField(f.name, conv(f.dataType), True) for f in dt.fields])
        if isinstance(dt, T.ArrayType):
            return T.ArrayType(conv(dt.elementType), True)
        if isinstance(dt, T.MapType):
            return T.MapType(dt.keyType, conv(dt.valueType), True)
        return dt
    return T.StructType([T.StructField(f.name, conv(f.dataType), True) for f in schema.fields])


def _restore(col: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.BinaryType):
        return F.unbase64(col)
    if _needs_text(dt):
        if isinstance(dt, T.StructType):
            return F.when(col.isNull(), F.lit(None)).otherwise(F.struct(*[
                _restore(col.getField(f.name), f.dataType).alias(f.name) for f in dt.fields]))
        if isinstance(dt, T.ArrayType):
            return F.transform(col, lambda x: _restore(x, dt.elementType))
        if isinstance(dt, T.MapType):
            return F.transform_values(col, lambda _k, x: _restore(x, dt.valueType))
        return col.cast(dt)
    return col


def write_raw(df: DataFrame, root: str, source: str, load_id: str, *, text_types: bool = True) -> str:
    """Named records → JSON lines under ``raw/<source>/load_id=<id>`` (K1, K3).

    Nulls are written as ``null`` (not dropped), so every record keeps every key.
    """
    out = stringify(df) if text_types else df
    path = raw_path(root, source, load_id)
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_raw_positional(df: DataFrame, root: str, source: str, load_id: str,
                         row: str = "row") -> str:
    """Rows without names → one JSON array per line (K2).

    ``row`` must be an array column; VARIANT items keep mixed kinds. A null row is the line
    ``null``.
    """
    path = raw_path(root, source, load_id)
    df.select(F.coalesce(F.to_json(F.col(row)), F.lit("null")).alias("value")).write.mode("overwrite").text(path)
    return path


def write_raw_responses(responses: DataFrame, root: str, source: str, load_id: str) -> str:
    """Responses as fetched → JSON lines, the body kept as a string field (K4).

    The body is never re-rendered, so its text (key order, number spelling) is
    exactly what the endpoint sent, and a line break inside it cannot split a record.
    """
    return write_raw(responses.drop(LOAD_ID) if LOAD_ID in responses.columns else responses,
                     root, source, load_id)


def add_raw_responses(responses: DataFrame, root: str, source: str, load_id: str) -> None:
    """Adds responses (of a repair) to a load, beside those it has."""
    path = raw_path(root, source, load_id)
    out = stringify(responses.drop(LOAD_ID))
    out.write.mode("append").option("ignoreNullFields", "false").json(path)


def load_ids(spark: SparkSession, root: str, source: str) -> list[str]:
    """The finished loads of a source, oldest first."""
    base = raw_path(root, source)
    names = [n.removeprefix(f"{LOAD_ID}=") for n in list_names(spark, base) if n.startswith(f"{LOAD_ID}=")]
    return sorted(n for n in names if raw_finished(spark, root, source, n))


def latest_load(spark: SparkSession, root: str, source: str) -> str | None:
    return max(load_ids(spark, root, source), default=None)


def raw_finished(spark: SparkSession, root: str, source: str, load_id: str) -> bool:
    """Whether a load was written to its end."""
    return "_SUCCESS" in list_names(spark, raw_path(root, source, load_id))


def read_raw(spark: SparkSession, root: str, source: str, schema: T.StructType,
             load_id: str | None = None, *, with_load_id: bool = False) -> DataFrame:
    """Read a raw layer back with the schema it was written from.

    Types that the raw layer holds as text are read as text and cast back. A line that
    is not JSON, or does not fit the schema, raises.
    """
    path = raw_path(root, source, load_id)
    read_schema = raw_schema(schema)
    if with_load_id and load_id is None:
        read_schema = read_schema.add(LOAD_ID, T.StringType(), True)
    df = spark.read.schema(read_schema).option("mode", "FAILFAST").json(path)
    cols = [_restore(column(f.name), f.dataType).alias(f.name) for f in schema.fields]
    if with_load_id:
        cols.append(F.col(LOAD_ID) if load_id is None else F.lit(load_id).alias(LOAD_ID))
    return df.select(*cols)


def read_raw_positional(spark: SparkSession, root: str, source: str,
                        load_id: str | None = None) -> DataFrame:
    """Positional raw lines → ``row ARRAY<VARIANT>`` (plus ``load_id`` when reading all loads).

    The line ``null`` is a null row; a line that is not one whole JSON array raises.
    """
    path = raw_path(root, source, load_id)
    schema = T.StructType([T.StructField("value", T.StringType())])
    if load_id is None:
        schema = schema.add(LOAD_ID, T.StringType(), True)
    df = spark.read.schema(schema).format("text").load(path)
    text = F.col("value")
    bad = F.raise_error(F.concat(F.lit("raw line is not a JSON array: "), F.substring(text, 1, 200))).cast("array<variant>")
    row = single_value(text).try_cast("array<variant>")
    return df.select(*([F.col(LOAD_ID)] if load_id is None else []),
                     F.when(row.isNotNull() | (F.trim(text) == "null"), row).otherwise(bad).alias("row"))
