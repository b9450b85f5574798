"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (
    counts,
    divergence,
    exact,
    fim,
    mixing,
    pieces,
    planes,
    quality,
    repeats,
    simhash,
    surrogates,
    toxicity,
    urls,
)
from tributary.session import scratch_dir


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def vocabulary(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


WORD_VOCABULARY, END_ID = "word_bpe_49k.json", 2

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_plane_tokens(spark, d):
    files = planes.write_token_files(_t(spark, d, "documents"), scratch_dir(spark, "tokens"),
                                     vocabulary(WORD_VOCABULARY), END_ID)
    return planes.read_token_files(files)


def op2_suffix_repeats(spark, d):
    cut = repeats.cut_repeats(_t(spark, d, "documents"), length=400)
    n = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return cut.select("doc_id", "n_bytes", n.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), (F.size("removed") > 0).alias("repeated"))


def op3_simhash_pivots(spark, d):
    found = simhash.near_duplicates(_t(spark, d, "documents"), words=3, bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op4_exact_dedup(spark, d):
    return exact.exact_duplicates(_t(spark, d, "documents"), digest_all=True)


def op5_url_rules(spark, d):
    rules = spark.createDataFrame(URL_RULES, urls.RULE_COLUMNS)
    return urls.judge_urls(_t(spark, d, "pages"), rules, keep=("page_id",))


PIECE_MODEL, DROPOUT_SEED, DROPOUT_RATE = "piece_bpe_32k.model", 2024, 0.1


def op6_merge_dropout(spark, d):
    return pieces.encode_pieces(_t(spark, d, "documents"), vocabulary(PIECE_MODEL), DROPOUT_SEED, DROPOUT_RATE)


def op7_entropy_mixing(spark, d):
    plan = mixing.mix_plan(_t(spark, d, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_compression_bands(spark, d):
    return quality.quality_report(_t(spark, d, "documents"))


#: In production the key is a secret of the deployment.
SURROGATE_KEY = "a key for tests"


def op9_surrogates(spark, d):
    out = surrogates.replace_personal_data(_t(spark, d, "documents").select("doc_id", "text"), SURROGATE_KEY)
    return out.select("doc_id", "text", "n_entities")


def op10_lexicon_automata(spark, d):
    docs = _t(spark, d, "documents")
    return toxicity.score_documents(docs, toxicity.fit_model(docs, _t(spark, d, "labels")))


TOKEN_LIMIT = 2048


def op11_whole_tokens(spark, d):
    return counts.count_tokens(_t(spark, d, "documents"), vocabulary(WORD_VOCABULARY), TOKEN_LIMIT)


def op12_piece_table(spark, d):
    out = fim.fill_in_middle(_t(spark, d, "documents"), seed=1, plain=10, spm=20, outputs=False)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_chunk_audit(spark, d):
    return divergence.source_divergence(_t(spark, d, "documents"), least_docs=3, top=200)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_plane_tokens": op1_plane_tokens,
    "op2_suffix_repeats": op2_suffix_repeats,
    "op3_simhash_pivots": op3_simhash_pivots,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_url_rules": op5_url_rules,
    "op6_merge_dropout": op6_merge_dropout,
    "op7_entropy_mixing": op7_entropy_mixing,
    "op8_compression_bands": op8_compression_bands,
    "op9_surrogates": op9_surrogates,
    "op10_lexicon_automata": op10_lexicon_automata,
    "op11_whole_tokens": op11_whole_tokens,
    "op12_piece_table": op12_piece_table,
    "op13_chunk_audit": op13_chunk_audit,
}
