"""Expressions and helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import scratch_dir, ship_package

#: White space as the operators count it: space and the control characters 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]"


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def word_count(text: str) -> Column:
    """Number of maximal runs of non-space characters; null and blank texts have none."""
    trimmed = F.regexp_replace(text_or_empty(text), f"^{SPACE}+|{SPACE}+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"{SPACE}+"))).cast("bigint")


#: Documents are large: so many rows go to a Python worker at a time, at most.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """For operators with Python code: the package on the workers, and Arrow batches of few rows.

    Batches live outside the executors' heaps, so the default of 10,000 rows could take
    hundreds of megabytes there.
    """
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: later reads survive lost executors and do not repeat the work.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name = "_" + name
    return name


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    return [free_name(df, w) for w in wanted]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of a few rows, to bound what a Python worker holds at once."""
    for b in batches:
        for i in range(0, len(b), rows):
            yield b.slice(i, rows)


def parts_for(count: int, each: int) -> int:
    return max(1, math.ceil(count / each))


# ---------------------------------------------------------------- bit tables
#: Bits of a bit table: from 1 MB up, BITS_A_KEY for each key, and 64 MB at most.
TABLE_BITS, MOST_BITS, BITS_A_KEY = 1 << 23, 1 << 29, 16
_BUCKET = 32768  # bits in a row of the table, as bitmap_construct_agg builds them


class BitTable:
    """Tells of a key whether it may be among ``keys``, without a shuffle of the asking rows.

    ``keys`` has one bigint column ``key``, a hash. Each key sets one of the table's bits; a
    bit set by another key makes a row look like a member, so what members get must be exact
    for others too. The table grows with its keys (one row in BITS_A_KEY looks like a member
    by chance) up to ``most`` bits and is broadcast. Beyond some ``most`` / 4 keys a table
    could not tell rows apart: then the keys themselves are joined, which shuffles the
    asking rows once but marks members only.
    """

    def __init__(self, keys: DataFrame, purpose: str, bits: int = TABLE_BITS, most: int | None = None):
        most = MOST_BITS if most is None else most
        keys = staged(keys.distinct(), purpose + "-keys")
        count = keys.count()
        self.keys = keys if count > most // 4 else None
        self.bits = min(max(bits, 1 << max(0, count * BITS_A_KEY - 1).bit_length()), max(most, _BUCKET))
        slot = F.pmod(F.col("key"), F.lit(self.bits))
        self.table = None if self.keys is not None else staged(
            keys.groupBy(F.floor(slot / _BUCKET).cast("int").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.pmod(slot, F.lit(_BUCKET))).alias("bits")), purpose)

    def flag(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """``df`` with the boolean column ``name``: ``key`` may be in the table."""
        slot_c, bucket_c, bits_c = free_names(df, "slot", "bucket", "bits")
        if self.keys is not None:
            member = self.keys.select(F.col("key").alias(slot_c), F.lit(True).alias(bits_c))
            asked = df.withColumn(bucket_c, key)
            joined = asked.join(member.hint("shuffle_hash"), F.col(bucket_c) == F.col(slot_c), "left")
            return joined.withColumn(name, F.coalesce(F.col(bits_c), F.lit(False))).drop(slot_c, bucket_c, bits_c)
        table = F.broadcast(self.table.select(F.col("bucket").alias(bucket_c), F.col("bits").alias(bits_c)))
        slotted = df.withColumn(slot_c, F.pmod(key, F.lit(self.bits)))
        joined = slotted.join(table, F.floor(F.col(slot_c) / _BUCKET).cast("int") == F.col(bucket_c), "left")
        at = F.pmod(F.col(slot_c), F.lit(_BUCKET)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(bits_c), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.pmod(at, F.lit(8)))) != 0
        return joined.withColumn(name, F.coalesce(is_set, F.lit(False))).drop(slot_c, bucket_c, bits_c)


def without_rows(df: DataFrame, rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """``df`` without the rows whose id (or null) and hash of the text are in ``rows`` (columns ``id`` and ``th``).

    Only rows that may be among them are shuffled; the rest pass in their partition.
    """
    rows = staged(rows.distinct(), "rows")
    flag, id_r, th_r = free_names(df, "listed", "id_r", "th_r")
    own = F.xxhash64(text)
    flagged = BitTable(rows.select(F.xxhash64("id", "th").alias("key")), "row-bits").flag(df, F.xxhash64(F.col(id_col), own), flag)
    rest = flagged.where(flag).join(rows.toDF(id_r, th_r), F.col(id_col).eqNullSafe(F.col(id_r)) & (own == F.col(th_r)), "left_anti")
    cols = [F.col(f"`{c}`") for c in df.columns]
    return flagged.where(~F.col(flag)).select(*cols).unionByName(rest.select(*cols))
