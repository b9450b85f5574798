"""A training-corpus pipeline: quality, exact dedup, near dedup, mixing, pieces.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's docs. All but
the last return the columns of ``documents``. ``run`` applies them to ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tributary.llm import exact, mixing, pieces, quality, simhash  # noqa: E402
from tributary.llm.queries import DROPOUT_RATE, DROPOUT_SEED, PIECE_MODEL, vocabulary  # noqa: E402
from tributary.session import scratch_dir  # noqa: E402

#: No SQL: compression, SimHash and the piece model are beyond it.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (8): documents that the rules reject go. An empty table stays empty."""
    return quality.keep_quality(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup (4): of equal texts the smallest doc_id stays."""
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (3): of each group the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs, words=3, bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing (7): each document as often as the mix takes it."""
    return mixing.mixed(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding (6): doc_id, lang, source, piece_ids, n_ids, ids_crc32, lossless."""
    return pieces.encode_pieces(docs, vocabulary(PIECE_MODEL), DROPOUT_SEED, DROPOUT_RATE, keep=("lang", "source"))


STAGES = [
    ("quality rules", keep_good),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("SentencePiece", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is kept in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_dir(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
