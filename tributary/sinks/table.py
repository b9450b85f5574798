"""Typed table sink: create, append, or replace on schema change (K5–K8).

Tables are catalog tables (``saveAsTable``), so Spark itself refuses an append
whose columns do not match; before that, the schemas are compared exactly
(names and types, order-free, nullability ignored) to choose the action. Only a
schema mismatch replaces a table — any other write error surfaces unchanged.
"""

from __future__ import annotations

import json
import logging
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.names import column
from tributary.session import delete_path, list_names

log = logging.getLogger(__name__)

_REPLACED = "__r"  # with 20 digits behind it, marks folders that took another's place
_MARKER = "_table.json"  # in a table's folder: whose data it is (Spark skips names with a leading _)
_OWNER = "tributary.owner"  # table property
CREATED, APPENDED, REPLACED, SKIPPED = "created", "appended", "replaced", "skipped"


class SchemaMismatchError(ValueError):
    """Append refused: the new data's columns differ from the table's."""


class TableOwnerError(ValueError):
    """A table, or the folder named for it, belongs to another table or source."""


@dataclass
class TableLoad:
    table: str
    action: str
    rows: int = 0
    previous_schema: str | None = None


def _strip(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _strip(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_strip(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(_strip(dt.keyType), _strip(dt.valueType), True)
    return dt


def schema_key(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: _strip(f.dataType) for f in schema.fields}


def same_columns(a: T.StructType, b: T.StructType) -> bool:
    """Equal names and types; order and nullability do not matter."""
    return schema_key(a) == schema_key(b)


def delta_available(spark) -> bool:
    """Whether the Delta Lake classes are on the session's classpath (including jars
    added with ``--packages``, which the context class loader sees)."""
    name = "io.delta.tables.DeltaTable"
    jvm = spark._jvm
    for load in (lambda: jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(name),
                 lambda: jvm.java.lang.Class.forName(name)):
        try:
            load()
            return True
        except Exception:  # noqa: BLE001 - not found by this loader
            continue
    return False


def write_text(spark, path: str, text: str) -> None:
    """A small file, on whatever filesystem ``path`` is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark, path: str) -> str | None:
    """A small file's text; None if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_marker(spark, folder: str, table: str, owner: str | None) -> None:
    write_text(spark, f"{folder.rstrip('/')}/{_MARKER}", json.dumps({"table": table.lower(), "owner": owner}))


def _marker(spark, folder: str) -> dict | None:
    """What a folder's marker says; None if it has none."""
    text = read_text(spark, f"{folder.rstrip('/')}/{_MARKER}")
    return None if text is None else json.loads(text)


def _stored_at(spark, table: str, path: str) -> tuple[str, dict | None] | None:
    """Where a table's data is whose first folder was ``path``, and that folder's marker: the
    newest finished folder that replaced it, else ``path`` itself if it has data.

    A folder whose marker names another table is never taken: a replacement is passed
    over, and ``path`` itself raises. Replacements always have a marker.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    replaced = re.compile(re.escape(name + _REPLACED) + "[0-9]{20}")
    for n in sorted(filter(replaced.fullmatch, list_names(spark, parent)), reverse=True):
        said = _marker(spark, f"{parent}/{n}")
        if said and said["table"] == table.lower() and "_SUCCESS" in list_names(spark, f"{parent}/{n}"):
            return f"{parent}/{n}", said
    if not list_names(spark, path):
        return None
    said = _marker(spark, path)
    if said and said["table"] != table.lower():
        raise TableOwnerError(f"folder {path} holds table {said['table']!r}, not {table!r}")
    return path, said


def _register(spark, table: str, path: str, fmt: str) -> None:
    """A catalog entry over finished data, its partitions included."""
    spark.catalog.createTable(table, path=path, source=fmt)
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)


def _set_owner(spark, table: str, owner: str | None) -> None:
    if owner is not None:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_OWNER}' = {_text(owner)})")


def table_owner(spark, table: str, path: str | None = None) -> str | None:
    """The source that a table belongs to: a property of its catalog entry, or the marker of
    its folder where the catalog does not know the table (any more). None: nobody's."""
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).isTemporary:
            return None
        found = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == _OWNER).first()
        return found["value"] if found is not None else None
    stored = _stored_at(spark, table, path) if path else None
    return (stored[1] or {}).get("owner") if stored else None


def table_known(spark, table: str, path: str | None = None, fmt: str = "parquet") -> bool:
    """Whether a table exists, in the catalog or by its folder (then it is registered)."""
    if spark.catalog.tableExists(table):
        return True
    stored = _stored_at(spark, table, path) if path else None
    if stored:
        _register(spark, table, stored[0], fmt)
        _set_owner(spark, table, (stored[1] or {}).get("owner"))
    return stored is not None


def _check_owner(spark, table: str, path: str | None, owner: str | None) -> None:
    """A table keeps its first owner, across sessions and runners; a table of nobody is taken."""
    have = table_owner(spark, table, path)
    if owner is not None and have is not None and have != owner:
        raise TableOwnerError(f"table {table!r} belongs to {have!r}; {owner!r} needs another name")


def _location(spark, table: str) -> str | None:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Location").first()
    return row["data_type"] if row is not None else None


def _replace(df: DataFrame, table: str, path: str | None, fmt: str, partition_by: list[str] | None,
             owner: str | None) -> None:
    """Writes the new data beside the old, then switches the catalog entry over.

    The old table stays readable until its successor is complete, and a write that
    fails leaves it as it was. ``df`` may read the table it replaces. Old files are
    deleted only from a folder that is the table's own.
    """
    spark = df.sparkSession
    writer = df.write.format(fmt).mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        old = _location(spark, table)
        new = f"{path.rstrip('/')}{_REPLACED}{time.time_ns():020d}"
        writer.save(new)
        _write_marker(spark, new, table, owner)
        spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
        _register(spark, table, new, fmt)
        if old is not None:
            said = _marker(spark, old)
            if said is not None and said["table"] == table.lower():
                delete_path(spark, old)
            else:
                log.warning("table %s: the files of its former folder %s stay, they are not marked as its own", table, old)
    else:
        staged = f"{table}_{uuid.uuid4().hex[:10]}"
        writer.saveAsTable(staged)
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    _set_owner(spark, table, owner)


def _widened(df: DataFrame, current: T.StructType) -> DataFrame:
    """``df`` with whole-number columns as doubles where the table has doubles."""
    have = schema_key(current)
    exact = lambda c: F.when(F.abs(c) > 2**53, F.raise_error(F.lit(
        "a whole number is too large to be exact in a DOUBLE column")).cast("double")).otherwise(c.cast("double"))
    return df.select(*[exact(column(f.name)).alias(f.name)
                       if isinstance(f.dataType, T.LongType) and isinstance(have.get(f.name), T.DoubleType)
                       else column(f.name) for f in df.schema.fields])


def write_table(df: DataFrame, table: str, *, fmt: str = "parquet", path: str | None = None,
                on_mismatch: str = "replace", partition_by: list[str] | None = None,
                skip_if_empty: bool = True, known_rows: int | None = None,
                replace_partition: dict[str, str] | None = None, owner: str | None = None) -> TableLoad:
    """Write ``df`` to catalog table ``table``.

    * table missing → create (``created``);
    * same columns → append, matched by name (``appended``; a bag union, no dedupe), or
      with ``replace_partition`` (column → text, the values all rows of ``df`` have there)
      that one partition is overwritten. Whole numbers go into DOUBLE columns where they are exact there;
    * different columns → ``on_mismatch="replace"`` writes the new data beside the old and
      then switches the table over (``replaced``), ``"fail"`` raises
      :class:`SchemaMismatchError`;
    * no rows → nothing is written (``skipped``), no table is created.

    ``known_rows`` (a count the caller already observed) saves the emptiness check.
    ``path`` makes the table external (data under a shared folder); the folder says whose
    it is, and no other table's folder is ever adopted or deleted. ``owner`` names the
    source that the table belongs to; another owner's table raises :class:`TableOwnerError`.
    ``fmt="delta"`` needs the Delta Lake package on the classpath.
    """
    if on_mismatch not in ("replace", "fail"):
        raise ValueError("on_mismatch must be 'replace' or 'fail'")
    spark = df.sparkSession
    if fmt == "delta" and not delta_available(spark):
        raise RuntimeError("format 'delta' requested but Delta Lake is not on the classpath")
    if skip_if_empty and (known_rows == 0 if known_rows is not None else df.isEmpty()):
        return TableLoad(table, SKIPPED, 0)
    obs = Observation(f"rows_{table.replace('.', '_')}")
    _check_owner(spark, table, path, owner)
    # known also by data from an earlier session whose catalog did not keep the table
    exists = table_known(spark, table, path, fmt)
    previous = None
    if not exists:
        action = CREATED
        writer = _counted(df, obs).write.format(fmt).mode("error")
        if path:
            writer = writer.option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(table)
        if path:
            _write_marker(spark, path, table, owner)
        _set_owner(spark, table, owner)
    else:
        current = spark.table(table).schema
        if not same_columns(current, df.schema):
            df = _widened(df, current)
        if same_columns(current, df.schema):
            action = APPENDED
            out = _counted(df, obs).select(*[column(f.name) for f in current.fields])
            if replace_partition:
                _overwrite_partition(out, table, replace_partition)
            else:
                out.write.format(fmt).mode("append").saveAsTable(table)
        elif on_mismatch == "fail":
            raise SchemaMismatchError(
                f"table {table}: columns {current.simpleString()} != {df.schema.simpleString()}")
        else:
            previous = current.simpleString()
            log.warning("table %s: schema changed, replacing (%s -> %s)", table, previous,
                        df.schema.simpleString())
            action = REPLACED
            if fmt == "delta":
                _counted(df, obs).write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
            else:
                _replace(_counted(df, obs), table, path, fmt, partition_by,
                         owner or table_owner(spark, table))
    rows = obs.get.get("rows", 0) if obs.get else 0
    return TableLoad(table, action, int(rows), previous)


def _counted(df: DataFrame, obs: Observation) -> DataFrame:
    return df.observe(obs, F.count(F.lit(1)).alias("rows"))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _overwrite_partition(df: DataFrame, table: str, values: dict[str, str]) -> None:
    """Replaces one partition and leaves the others, whatever the session's overwrite mode is."""
    where = ", ".join(f"`{c}` = {_text(v)}" for c, v in values.items())
    rows = df.select(*[column(c) for c in df.columns if c not in values])
    df.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({where}) SELECT * FROM {{rows}}", rows=rows)


def drop_partition(spark, table: str, values: dict[str, str]) -> None:
    """Drops one partition, its files included, if the table has it."""
    where = ", ".join(f"`{c}` = {_text(v)}" for c, v in values.items())
    place = f"{_location(spark, table)}/" + "/".join(f"{c}={v}" for c, v in values.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({where})")
    delete_path(spark, place)  # an external table: its files would stay
