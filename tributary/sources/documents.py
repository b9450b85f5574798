"""Whole-file JSON documents as responses: one row per file.

Reads a folder of JSON documents — for instance raw history kept as one indented
document per fetch, ``raw/<source>/<source>_<YYYYmmdd_HHMMSS>.json`` — into the
response schema that ``normalize`` takes. Files are read whole by the executors
(``wholetext``); the source and load id come from the file path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# <folder>/<source>_<YYYYmmdd>_<HHMMSS>[-<seq>].json — the stamp becomes the load id
_NAME = r"([^/]+)/([^/]+?)_([0-9]{8}_[0-9]{6})(?:-([0-9]{1,18}))?\.json$"


def read_documents(spark: SparkSession, path: str, *, glob: str = "*.json") -> DataFrame:
    """``source, load_id, seq, url, body`` for every document under ``path``.

    ``source`` is the file's folder name; ``load_id`` is the stamp in the file
    name (else the file name), so the oldest load comes first and its first record
    decides the columns; ``seq``, the number behind the stamp or else a hash of the path,
    orders documents of one load.
    """
    df = (spark.read.format("text").option("wholetext", "true")
          .option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path))
    file_path = F.col("_metadata.file_path")
    file_name = F.col("_metadata.file_name")
    stamp = F.regexp_extract(file_path, _NAME, 3)
    load_id = F.when(stamp != "", stamp).otherwise(file_name)
    source = F.regexp_extract(file_path, r"([^/]+)/[^/]+$", 1)
    docs = df.select(source.alias("source"), load_id.alias("load_id"), file_path.alias("url"),
                     F.col("value").alias("body"))
    # seq: a stable order without a global sort — the hash of the path breaks ties
    # between documents of the same load id; load_id itself orders loads
    number = F.nullif(F.regexp_extract("url", _NAME, 4), F.lit("")).cast("bigint")
    return docs.select("source", "load_id", F.coalesce(number, F.xxhash64("url")).alias("seq"), "url", "body")
