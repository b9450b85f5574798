"""JDBC source (S1–S6, S12): a table or a query, read in parallel partitions.

Connection options (the ``connection`` dict of a source spec):

``url``            JDBC URL; or ``odbc_connection_string``, of a driver that ``from_odbc`` knows
``driver``         driver class
``table``          table to scan when no ``query`` is given (default ``data``)
``query``          SQL run verbatim by the database; wins over ``table``
``user`` / ``password``
``partition_column``, ``num_partitions``, ``lower_bound``, ``upper_bound``
                   parallel scan; missing bounds come from one MIN/MAX/COUNT
                   query that the database answers (a single row). Without
                   ``num_partitions`` the scan gets one partition per
                   ``rows_per_partition`` rows (default 1,000,000); ``max_connections``,
                   if given, limits that for a database that bears no more
``partition_column_sql``  spelling of the column in the bounds query
``predicates``     list of WHERE clauses, one partition each (for a partition
                   column whose values are skewed, where equal strides would
                   give one task most of the rows); wins over ``partition_column``
``partition_by``   ``"rows"``: ranges of about equal numbers of rows instead of equal strides
                   (``tributary.sources.ranges``); ``second_column`` parts frequent values
``fetchsize``      rows per round trip (default 10000)
``options``        any further Spark JDBC options

Filters and column selections applied to the returned DataFrame are pushed into
the SQL sent to the database by Spark.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tributary.fixed import DEFAULT_TABLE
from tributary.sources.ranges import equal_ranges

DEFAULT_FETCHSIZE = 10000
DEFAULT_ROWS_PER_PARTITION = 1_000_000


# Names of common ODBC drivers (parts of them, in lower case), the URL each
# gives with its default port, and the JDBC driver class.
ODBC_DRIVERS = {
    "postgresql": ("jdbc:postgresql://{server}:{port}/{database}", 5432, "org.postgresql.Driver"),
    "mysql": ("jdbc:mysql://{server}:{port}/{database}", 3306, "com.mysql.cj.jdbc.Driver"),
    "mariadb": ("jdbc:mariadb://{server}:{port}/{database}", 3306, "org.mariadb.jdbc.Driver"),
    "sql server": ("jdbc:sqlserver://{server}:{port};databaseName={database}", 1433, "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    "oracle": ("jdbc:oracle:thin:@//{server}:{port}/{database}", 1521, "oracle.jdbc.OracleDriver"),
    "db2": ("jdbc:db2://{server}:{port}/{database}", 50000, "com.ibm.db2.jcc.DB2Driver"),
    "sqlite": ("jdbc:sqlite:{database}", None, "org.sqlite.JDBC"),
    "duckdb": ("jdbc:duckdb:{database}", None, "org.duckdb.DuckDBDriver"),
}
_ODBC_KEYS = {"server": ("server", "servername", "host", "hostname"), "database": ("database", "db", "dbq", "initial catalog"),
              "user": ("uid", "user", "username", "user id"), "password": ("pwd", "password"), "port": ("port",)}


def odbc_fields(text: str) -> dict[str, str]:
    """``key=value;…`` of an ODBC connection string; keys in lower case, the first of a key counts.
    A value in braces may hold anything, a closing brace doubled."""
    out, rest = {}, text.strip().rstrip("\0")
    while rest.strip(" ;"):
        m = re.match(r"[ ;]*([^=;{}]+?)\s*=\s*(?:\{((?:[^}]|\}\})*)\}\s*|((?!\s*\{)[^;]*))(?:;|$)", rest)
        if m is None:
            raise ValueError(f"the ODBC connection string is not key=value;… at {rest[:30]!r}")
        value = m[2].replace("}}", "}") if m[2] is not None else m[3].strip()
        out.setdefault(m[1].strip().lower(), value)
        rest = rest[m.end():]
    return out


def from_odbc(text: str) -> dict[str, str]:
    """The JDBC options (``url, driver, user, password``) of an ODBC connection string."""
    fields = odbc_fields(text)
    known = {name: next((fields[k] for k in keys if fields.get(k)), None) for name, keys in _ODBC_KEYS.items()}
    said = fields.get("driver", "").lower()
    match = next((v for k, v in ODBC_DRIVERS.items() if k in said), None)
    if match is None:
        raise ValueError(f"the ODBC driver {fields.get('driver') or fields.get('dsn')!r} has no known JDBC counterpart; give a JDBC 'url' instead")
    url, port, driver = match
    server, _, given = (known["server"] or "localhost").removeprefix("tcp:").replace(",", ":").partition(":")
    if "{database}" in url and not known["database"]:
        raise ValueError("the ODBC connection string names no database")
    out = {"url": url.format(server=server, port=known["port"] or given or port, database=known["database"]), "driver": driver}
    return {**out, **{k: known[k] for k in ("user", "password") if known[k]}}


class JdbcSource:
    type_name = "jdbc"

    def __init__(self, spec) -> None:
        self.spec = spec
        self.conn = dict(spec.connection)

    # -- option handling -------------------------------------------------
    def _base_options(self) -> dict[str, str]:
        c = self.conn
        url = c.get("url") or c.get("jdbc_url")
        if not url and c.get("odbc_connection_string"):
            try:
                c = {**from_odbc(c["odbc_connection_string"]), **c}
            except ValueError as e:
                raise ValueError(f"source {self.spec.name!r}: {e}") from e
            url = c["url"]
        if not url:
            raise ValueError(f"source {self.spec.name!r}: connection has no 'url'")
        opts = {"url": url, "fetchsize": str(c.get("fetchsize", DEFAULT_FETCHSIZE))}
        for key in ("driver", "user", "password"):
            if c.get(key):
                opts[key] = str(c[key])
        if c.get("prefer_timestamp_ntz", True):
            opts["preferTimestampNTZ"] = "true"
        opts.update({k: str(v) for k, v in (c.get("options") or {}).items()})
        return opts

    def relation(self) -> tuple[str, str]:
        """``("query", sql)`` or ``("dbtable", table)`` following the precedence rules."""
        query = self.conn.get("query")
        if query:
            return "query", str(query)
        return "dbtable", str(self.conn.get("table") or DEFAULT_TABLE)

    def _bounds(self, spark: SparkSession, opts: dict[str, str], rel: str, col: str) -> tuple:
        sql = f"SELECT MIN({col}) AS lo, MAX({col}) AS hi, COUNT(*) AS n FROM {rel} b"
        row = spark.read.format("jdbc").options(**opts).option("query", sql).load().first()
        return (row[0], row[1], row[2]) if row is not None else (None, None, 0)

    def _partitions(self, spark: SparkSession, rows: int | None) -> int:
        if self.conn.get("num_partitions"):
            return max(1, int(self.conn["num_partitions"]))
        per = int(self.conn.get("rows_per_partition", DEFAULT_ROWS_PER_PARTITION))
        by_rows = -(-int(rows) // per) if rows else spark.sparkContext.defaultParallelism
        most = int(self.conn.get("max_connections") or by_rows)
        return max(1, min(most, by_rows))

    # -- read ----------------------------------------------------------
    def read(self, spark: SparkSession) -> DataFrame:
        """The source as a DataFrame (lazy: rows are fetched by the tasks).

        Column names must be unique (case-insensitively, as Spark resolves them);
        a query returning a repeated name is refused with a hint to alias it.
        """
        try:
            df = self._read(spark)
        except Exception as e:  # noqa: BLE001 - add a hint, keep the cause
            text = str(e)
            if any(k in text for k in ("more than one result column", "uplicate column",
                                       "ambiguous", "already exists")):
                raise ValueError(f"source {self.spec.name!r}: the query returns a column name "
                                 "more than once; alias the columns so every name is unique") from e
            raise
        seen: dict[str, str] = {}
        for name in df.columns:
            if name.lower() in seen:
                raise ValueError(f"source {self.spec.name!r}: columns {seen[name.lower()]!r} and "
                                 f"{name!r} clash; alias the columns so every name is unique")
            seen[name.lower()] = name
        return df

    def _read(self, spark: SparkSession) -> DataFrame:
        opts = self._base_options()
        kind, rel = self.relation()
        preds = self.conn.get("predicates")
        if preds:
            dbtable = rel if kind == "dbtable" else f"({rel}) q"
            props = {k: v for k, v in opts.items() if k != "url"}
            return spark.read.jdbc(opts["url"], dbtable, predicates=[str(p) for p in preds],
                                   properties=props)
        col = self.conn.get("partition_column")
        if not col:
            return spark.read.format("jdbc").options(**opts).option(kind, rel).load()
        # Spark forbids ``query`` with a partition column: wrap it as a subquery.
        dbtable = rel if kind == "dbtable" else f"({rel}) q"
        lo, hi = self.conn.get("lower_bound"), self.conn.get("upper_bound")
        rows = None
        if lo is None or hi is None or not self.conn.get("num_partitions"):
            # ANSI-quoted by default; ``partition_column_sql`` overrides the spelling
            qcol = self.conn.get("partition_column_sql") or f'"{col}"'
            bounded = rel if kind == "dbtable" else f"({rel})"
            blo, bhi, rows = self._bounds(spark, opts, bounded, qcol)
            lo = blo if lo is None else lo
            hi = bhi if hi is None else hi
        if lo is None or hi is None:  # empty relation: a single partition is enough
            return spark.read.format("jdbc").options(**opts).option("dbtable", dbtable).load()
        n = self._partitions(spark, rows)
        if self.conn.get("partition_by") == "rows":
            # the sketch reads the partition columns alone, over equal strides
            narrow = self._strided(spark, opts, dbtable, col, lo, hi, n)
            second = self.conn.get("second_column")
            preds = equal_ranges(narrow.select(*dict.fromkeys(x for x in (col, second) if x)), col, n, second, quote='"')
            props = {k: v for k, v in opts.items() if k != "url"}
            return spark.read.jdbc(opts["url"], dbtable, predicates=preds, properties=props)
        return self._strided(spark, opts, dbtable, col, lo, hi, n)

    @staticmethod
    def _strided(spark: SparkSession, opts: dict, dbtable: str, col: str, lo, hi, n: int) -> DataFrame:
        return (
            spark.read.format("jdbc").options(**opts)
            .option("dbtable", dbtable)
            .option("partitionColumn", col)
            .option("lowerBound", str(lo))
            .option("upperBound", str(hi))
            .option("numPartitions", str(max(1, n)))
            .load()
        )


def jdbc_write(df: DataFrame, url: str, table: str, *, driver: str | None = None,
               mode: str = "overwrite", column_types: str | None = None,
               batchsize: int = 10000) -> None:
    """Write a DataFrame into a JDBC table (fixtures and JDBC sinks)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", str(batchsize)).option("isolationLevel", "NONE").mode(mode)
    if driver:
        w = w.option("driver", driver)
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    w.save()
