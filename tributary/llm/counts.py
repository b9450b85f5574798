"""Token counts without encoding, by a whole-token shortcut.

A tokenizer with byte-pair merges cuts a text into pre-tokens and merges each by itself.
Which vocabulary strings come out of the merges as one token is proved once, before the
job, by running the merges over every string of the vocabulary (a string may be in the
vocabulary and still never come out: other merges can take its parts). A pre-token among
the proved ones counts 1 at sight; the merges run for the rest only, once per form.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import prepare, slices

#: Forms that a Python worker remembers with their counts; then it starts afresh.
REMEMBERED = 500_000
#: Longer words are counted each time, so that what is remembered stays small.
LONG_WORD = 64
#: Long texts are counted in pieces of about so many characters, cut at spaces.
PIECE_CHARS = 1 << 20

# The word-wise tokenizer's normalizer steps, and its pattern of pre-tokens.
# White space parts its pre-tokens and is in none, so a text counts what its words count.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                {"type": "Lowercase"}]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: The same pattern for words of printable ASCII in lower case.
_ASCII_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
_ASCII_WORD = re.compile("[!-~]+").fullmatch


def _load(path: str):
    """The library's tokenizer, its file as JSON, and the strings it takes out of texts first."""
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(path)
    spec = json.loads(lib.to_str())
    model = spec["model"]
    if model["type"] != "BPE" or model["dropout"] or model["byte_fallback"] or model["unk_token"] or model["fuse_unk"]:
        raise ValueError(f"{path}: only plain byte-pair merges can be counted by pre-tokens")
    added = spec["added_tokens"] or []
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or (t["normalized"] and spec["normalizer"]) for t in added):
        raise ValueError(f"{path}: added tokens that look at their surroundings are not supported")
    return lib, spec, [t["content"] for t in added]


def prove_whole(path: str) -> frozenset[str]:
    """The pre-tokens that are one token each, proved by the merges themselves.

    Vocabulary strings with the model's end-of-word suffix (all, if it has none), without
    the suffix. As many entries as the vocabulary has, at most.
    """
    lib, spec, _ = _load(path)
    suffix = spec["model"]["end_of_word_suffix"] or ""
    words = [v[:len(v) - len(suffix)] for v in spec["model"]["vocab"] if v.endswith(suffix) and len(v) > len(suffix)]
    tokenize = lib.model.tokenize
    return frozenset(w for w in words if len(tokenize(w)) == 1)


class Counter:
    """Counts the tokens of texts; ``whole`` are the proved pre-tokens."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.lib, spec, self.special = _load(path)
        self.whole, self.known = whole, {"": 0}
        self.normalizer, self.pre = self.lib.normalizer, self.lib.pre_tokenizer
        self.special_parts = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))).split \
            if self.special else None
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_word = (
            (spec["normalizer"] or {}).get("normalizers") == _NORMALIZERS and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": _PATTERN} and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"])

    def _pre_tokens(self, text: str) -> list[str]:
        if self.by_word and _ASCII_WORD(text):
            return _ASCII_PARTS(text.lower())
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if self.pre is None:
            return [text] if text else []
        return [p for p, _ in self.pre.pre_tokenize_str(text)]

    def _merged(self, pre: str) -> int:
        """Tokens of a pre-token that is not proved to be one."""
        key = " " + pre  # no word has a space, so the two kinds of keys never meet
        if (n := self.known.get(key)) is None:
            n = len(self.lib.model.tokenize(pre))
            if len(pre) <= LONG_WORD:
                self.known[key] = n
        return n

    def _of(self, text: str) -> int:
        whole, merged = self.whole, self._merged
        return sum(1 if p in whole else merged(p) for p in self._pre_tokens(text))

    def _word(self, word: str) -> int:
        if (n := self.known.get(word)) is None:
            n = self._of(word)
            if len(word) <= LONG_WORD:
                self.known[word] = n
        return n

    def _plain(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        if not self.by_word:
            return self._of(text)
        total = 0
        for part in _pieces(text):
            for space in "\n\t\r\v\f":
                part = part.replace(space, " ")
            words = part.split(" ")
            if len(self.known) > REMEMBERED:
                self.known = {"": 0}
            try:
                total += sum(map(self.known.__getitem__, words))
            except KeyError:
                total += sum(map(self._word, words))
        return total

    def count(self, text: str) -> int:
        if not self.special or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.special_parts(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = text.find(" ", start + PIECE_CHARS)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, text: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every document.

    ``vocabulary`` is a tokenizers file with byte-pair merges, at the same path on every
    machine; counts are those of the library without begin or end tokens, strings of added
    tokens inside texts counting one each. A narrow pass: no shuffle, one row out for each
    row in, repeated rows and null ids included. A null or empty text has 0 bytes and 0
    tokens; an empty table gives none. Long texts are counted piece by piece, whole.
    """
    spark = docs.sparkSession
    prepare(spark)
    whole = prove_whole(vocabulary)
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(vocabulary)
        if counter is None:
            counter = _COUNTERS[vocabulary] = Counter(vocabulary, whole)
        for b in slices(batches):
            texts = b.column(1)
            n = [counter.count(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"])

    asked = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return asked.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
