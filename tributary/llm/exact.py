"""Exact dedup by progressive refinement: length, prefix hash, full hash.

Documents are split by length and by a hash of their first characters; both come
from one narrow scan. A full hash of the content is computed only for documents
whose (length, prefix hash) pair has company. Which pairs have company is told by
a bit table of fixed size, so the text itself is never shuffled to find it out:
a bit set by chance costs one needless hash and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import SPACE, TABLE_BITS, BitTable, free_names, staged, text_or_empty

PREFIX_CHARS = 256


def normal_text(text: str) -> Column:
    """The text with each run of white space replaced by one space; null is empty."""
    return F.regexp_replace(text_or_empty(text), f"{SPACE}+", " ")


def _pair(text: str) -> Column:
    """Hash of length and prefix hash."""
    norm = normal_text(text)
    return F.xxhash64(F.octet_length(norm), F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)))


def _refined(df: DataFrame, text: str, bits: int) -> BitTable:
    """Levels one and two: the (length, prefix hash) pairs that two or more rows of ``df`` have."""
    norm = normal_text(text)
    narrow = df.select(F.octet_length(norm).alias("n"), F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias("prefix"))
    pairs = narrow.groupBy("n", "prefix").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return BitTable(pairs.select(F.xxhash64("n", "prefix").alias("key")), "dedup-pairs", bits)


def _groups(df: DataFrame, refined: BitTable, text: str, id_col: str) -> DataFrame:
    """Level three: (hash, keep, size, lead) of every group of two or more equal texts.

    ``lead`` counts the rows that carry the smallest id; it is over 1 only where a
    row is repeated with its id.
    """
    narrow = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    full = (refined.flag(narrow, _pair("text"), "alike").where("alike")
            .select(F.sha2(normal_text("text"), 256).alias("hash"), "id"))
    by_id = full.groupBy("hash", "id").agg(F.count(F.lit(1)).alias("rows"))
    # null ids come last: any id is preferred to none
    first = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("rows").alias("rows"))
    groups = (by_id.groupBy("hash").agg(F.min(first).alias("first"), F.sum("rows").alias("size"))
              .where("size > 1")
              .select("hash", F.col("first.id").alias("keep"), "size", F.col("first.rows").alias("lead")))
    return staged(groups, "dedup-groups")


def _only_one(df: DataFrame, kept: str, hash_c: str, lead: str) -> DataFrame:
    """Where a kept row is repeated with its id, only one of the copies stays kept."""
    (n,) = free_names(df, "nth")
    spread = df.where(F.coalesce(F.col(lead), F.lit(1)) < 2)
    again = df.where(F.col(lead) > 1)
    nth = F.row_number().over(Window.partitionBy(hash_c, kept).orderBy(F.col(hash_c)))
    again = again.withColumn(n, nth).withColumn(kept, F.col(kept) & (F.col(n) == 1)).drop(n)
    return spread.unionByName(again)


def _matched(df: DataFrame, groups: DataFrame, id_col: str, hash_c: str, names: list[str]) -> DataFrame:
    keep, size, kept, lead = names
    g = groups.select(F.col("hash").alias(f"{hash_c}_g"), F.col("keep").alias(keep), F.col("size").alias(size),
                      F.col("lead").alias(lead))
    out = df.join(g, F.col(hash_c) == F.col(f"{hash_c}_g"), "left")
    own = F.col(f"{hash_c}_g").isNull()
    out = out.withColumn(kept, own | F.col(id_col).eqNullSafe(F.col(keep)))
    out = out.withColumn(keep, F.when(own, F.col(id_col)).otherwise(F.col(keep)))
    out = out.withColumn(size, F.coalesce(F.col(size), F.lit(1)).cast("bigint")).drop(f"{hash_c}_g")
    ties = not groups.where("lead > 1").isEmpty()
    return (_only_one(out, kept, hash_c, lead) if ties else out).drop(lead)


def exact_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id", bits: int = TABLE_BITS,
                     digest_all: bool = False) -> DataFrame:
    """One row per row of ``df``: its id, keep_id, group_size and kept.

    Equal means identical after white-space runs became one space; a null text is
    empty. keep_id is the smallest id of the group (a null id only where the group has
    no other). A row repeated with its id is kept once. An empty table gives none.
    ``digest_all`` adds text_sha256, the full hash of every normalised text, which
    costs a full hash for rows without company too.
    """
    refined = _refined(df, text, bits)
    groups = _groups(df, refined, text, id_col)
    narrow = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    full = F.sha2(normal_text("text"), 256)
    if digest_all:
        rows = narrow.select("id", full.alias("hash"))
    else:  # rows without company get a key of their own, so that they spread over the tasks
        alone = F.concat(F.lit("alone "), F.xxhash64("id", F.length("text")).cast("string"))
        rows = refined.flag(narrow, _pair("text"), "alike").select(
            "id", F.when(F.col("alike"), full).otherwise(alone).alias("hash"))
    out = _matched(rows, groups, "id", "hash", ["keep_id", "group_size", "kept", "lead"])
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept",
                      *[F.col("hash").alias("text_sha256")] * digest_all)


def drop_exact_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id",
                          bits: int = TABLE_BITS) -> DataFrame:
    """``df`` without the rows that ``exact_duplicates`` does not keep, columns unchanged.

    Only rows that may have company are shuffled; the others pass in their partition.
    """
    refined = _refined(df, text, bits)
    groups = _groups(df, refined, text, id_col)
    alike, hash_c, keep, size, kept, lead = free_names(df, "alike", "hash", "keep", "size", "kept", "lead")
    flagged = refined.flag(df, _pair(text), alike)
    cols = [F.col(f"`{c}`") for c in df.columns]
    rest = flagged.where(alike).withColumn(hash_c, F.sha2(normal_text(text), 256))
    rest = _matched(rest, groups, id_col, hash_c, [keep, size, kept, lead])
    return flagged.where(~F.col(alike)).select(*cols).unionByName(rest.where(kept).select(*cols))
