"""Audit of how far the sources of a language differ in their terms, by chunk factorization.

White space never stands inside a term, so a text's terms are those of its chunks (what
lies between white space). Chunks are counted per document, each globally distinct chunk is
cut into terms once, its terms are joined back, and distinct documents and occurrences are
aggregated. What travels for a chunk, and later for a term, is one row a language: its
occurrences by source, and the smallest ``least_docs`` of its documents' keys. Such a set is
all that the threshold needs and merges exactly (whoever has fewer has all of them), so a
chunk of a third of all documents is as short a row as any. Tasks merge their documents
before the first shuffle; a chunk is one row a block, then a term one row a chunk.

The differences need no row for a term that a source lacks. With counts above zero listed,
the sum over all kept terms of f(p, q) of two sources g and h is

    sum over g's terms of f(p, q0) + sum over h's terms of f(p0, q)
    + sum over common terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    + (V - terms of g - terms of h) * f(p0, q0)

where p0 and q0 belong to count zero. The first two sums go over distinct values of p only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import prepare, slices, staged

#: A block of merged documents ends at so many different chunks, or chunks of sources.
BLOCK_CHUNKS = 400_000
BLOCK_ENTRIES = 2_000_000
#: Rows that are merged together in a worker, and that leave it in a batch.
MERGE_ROWS = 20_000

UNIT = 1_000_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Terms: letters A-Z and a-z, and every character beyond ASCII.
TERM = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

#: A chunk or term: ``entries`` are (source id, occurrences) pairs, ``docs`` document keys,
#: both as little-endian 64-bit integers and sorted.
ROWS = "lang string, word string, entries binary, docs binary"
_FIELDS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("entries", pa.binary()), ("docs", pa.binary())])
_KEPT = pa.schema([("lang", pa.string()), ("term", pa.string()), ("n_lang", pa.int64()),
                   ("by_source", pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())])))])
KEPT = "lang string, term string, n_lang bigint, by_source array<struct<id:bigint,n:bigint>>"


def chunk_counts(text: str | bytes) -> Counter:
    """How often each chunk stands in a text, as UTF-8. White space is space and the control characters 9 to 13."""
    # just what bytes.split() splits on, and no byte of another character
    return Counter((text.encode() if isinstance(text, str) else text).split())


def chunk_terms(chunk: str) -> Counter:
    """The terms of a chunk, only A-Z lower-cased, with how often each stands in it."""
    return Counter(_TERM(chunk.lower() if chunk.isascii() else chunk.translate(_LOWER)))


_TERM, _LOWER = re.compile(TERM).findall, str.maketrans(UPPER, LOWER)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of a binary column: ``values`` (a row of 64-bit integers each) cut at ``ends``."""
    width = values.itemsize * (values.shape[1] if values.ndim == 2 else 1)
    offsets = (ends * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The integers of a binary column, and where each row's begin (and the last one's end)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), "<i8"), (offsets - offsets[0]) // 8


def _bounds(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each key of 0 to n - 1 begins in sorted ``keys``, and the end."""
    return np.searchsorted(keys, np.arange(n + 1))


class _Block:
    """Some documents' chunks by language: occurrences by source, and the first documents."""

    def __init__(self, least: int) -> None:
        self.least, self.langs, self.chunks, self.entries = least, {}, 0, 0

    def add(self, lang: str, source: int, key: int, text: str | bytes) -> None:
        chunks, sources = self.langs.setdefault(lang, ({}, {}))
        own, most = sources.setdefault(source, {}), self.least
        before = len(chunks), len(own)
        for chunk, n in chunk_counts(text).items():
            entry = chunks.get(chunk)
            if entry is None:
                entry = chunks[chunk] = [len(chunks), key]
            elif len(entry) <= most:  # keys only grow, so the first are the smallest
                entry.append(key)
            k = entry[0]
            own[k] = own.get(k, 0) + n
        self.chunks += len(chunks) - before[0]
        self.entries += len(own) - before[1]

    def full(self) -> bool:
        return self.chunks >= BLOCK_CHUNKS or self.entries >= BLOCK_ENTRIES

    def batches(self) -> Iterator[pa.RecordBatch]:
        for lang, (chunks, sources) in self.langs.items():
            places = np.concatenate([np.fromiter(own.keys(), np.int64, len(own)) for own in sources.values()])
            counts = np.concatenate([np.fromiter(own.values(), np.int64, len(own)) for own in sources.values()])
            ids = np.repeat(np.array(list(sources), np.int64), [len(own) for own in sources.values()])
            order = np.lexsort((ids, places))
            entries, docs = np.stack([ids, counts], 1)[order], list(chunks.values())
            ends = np.zeros(len(docs) + 1, np.int64)
            np.cumsum([len(d) - 1 for d in docs], out=ends[1:])
            keys = np.fromiter((k for d in docs for k in d[1:]), np.int64, ends[-1])
            rows = pa.RecordBatch.from_arrays([pa.array([lang] * len(docs), pa.string()), pa.array(list(chunks), pa.binary()).cast(pa.string()),
                                               _binary(entries, _bounds(places[order], len(docs))), _binary(keys, ends)], schema=_FIELDS)
            yield from slices([rows], MERGE_ROWS)


def _merge(rows: pa.Table, least: int) -> pa.Table:
    """Rows sorted by word and language → one row each: occurrences added up, document keys united."""
    rows = rows.combine_chunks()
    lang, word = (rows.column(c).combine_chunks() for c in ("lang", "word"))
    n = len(rows)
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = pc.or_(pc.not_equal(word[1:], word[:-1]), pc.not_equal(lang[1:], lang[:-1])).to_numpy(zero_copy_only=False)
    if new.all():
        return rows
    key, firsts = np.cumsum(new) - 1, np.flatnonzero(new)
    flat, ends = _integers(rows.column("entries").combine_chunks())
    pairs, of = flat.reshape(-1, 2), np.repeat(key, np.diff(ends) // 2)
    order = np.lexsort((pairs[:, 0], of))
    pairs, of = pairs[order], of[order]
    begin = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (pairs[1:, 0] != pairs[:-1, 0])])
    entries = np.stack([pairs[begin, 0], np.add.reduceat(pairs[:, 1], begin)], 1)
    docs, ends = _integers(rows.column("docs").combine_chunks())
    own = np.repeat(key, np.diff(ends))
    order = np.lexsort((docs, own))
    docs, own = docs[order], own[order]
    once = np.r_[True, (own[1:] != own[:-1]) | (docs[1:] != docs[:-1])]
    docs, own = docs[once], own[once]
    some = np.arange(len(docs)) - _bounds(own, len(firsts))[own] < least
    docs, own = docs[some], own[some]
    at = pa.array(firsts)
    return pa.Table.from_arrays([lang.take(at), word.take(at), _binary(entries, _bounds(of[begin], len(firsts))),
                                 _binary(docs, _bounds(own, len(firsts)))], schema=_FIELDS)


def _merged(batches: Iterable[pa.RecordBatch], least: int, then: Callable[[pa.Table], pa.Table]) -> Iterator[pa.RecordBatch]:
    """Merges a partition sorted by word and language, and hands whole rows to ``then``."""
    waiting: list[pa.RecordBatch] = []
    tail, have = None, 0

    def merged(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal tail
        table = pa.Table.from_batches(waiting, _FIELDS)
        rows = _merge(table if tail is None else pa.concat_tables([tail, table]), least)
        # the last row may go on in the next batch
        tail = None if last else rows.slice(len(rows) - 1)
        rows = rows if last else rows.slice(0, len(rows) - 1)
        if len(rows):
            yield from then(rows.combine_chunks()).to_batches(MERGE_ROWS)

    for b in batches:
        waiting.append(b)
        have += len(b)
        if have >= MERGE_ROWS:
            yield from merged(last=False)
            waiting, have = [], 0
    if have or tail is not None:
        yield from merged(last=True)


class _Cutter:
    """Merged chunks → their terms. A chunk's rows (one a language) follow each other: it is cut once."""

    def __init__(self) -> None:
        self.last, self.found = None, Counter()

    def __call__(self, rows: pa.Table) -> pa.Table:
        at, times, terms = [], [], []
        for k, chunk in enumerate(rows.column("word").to_pylist()):
            if chunk != self.last:
                self.last, self.found = chunk, chunk_terms(chunk)
            for term, n in self.found.items():
                at.append(k)
                times.append(n)
                terms.append(term)
        taken = rows.take(pa.array(at, pa.int64())).combine_chunks()
        entries = taken.column("entries")
        factors = np.array(times, np.int64)
        if (factors > 1).any():
            flat, ends = _integers(entries.combine_chunks())
            pairs = flat.reshape(-1, 2).copy()
            pairs[:, 1] *= np.repeat(factors, np.diff(ends) // 2)
            entries = _binary(pairs, ends // 2)
        return pa.Table.from_arrays([taken.column("lang"), pa.array(terms, pa.string()), entries, taken.column("docs")], schema=_FIELDS)


def _keep(rows: pa.Table, least: int) -> pa.Table:
    """Merged terms → those of enough documents."""
    rows = rows.filter(pc.greater_equal(pc.binary_length(rows.column("docs")), 8 * least)).combine_chunks()
    if not len(rows):
        return _KEPT.empty_table()
    flat, ends = _integers(rows.column("entries").combine_chunks())
    pairs, ends = flat.reshape(-1, 2), ends // 2
    structs = pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "n"])
    return pa.Table.from_arrays([rows.column("lang"), rows.column("word"), pa.array(np.add.reduceat(pairs[:, 1], ends[:-1])),
                                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)], schema=_KEPT)


def kept_terms(docs: DataFrame, least_docs: int = 3, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """A row for each term in at least ``least_docs`` documents of its language: lang, term,
    ``n_lang`` (occurrences there) and ``by_source``, the occurrences by source id (a hash of
    the name).

    Null texts, langs and sources count as ''. Every row is a document of its own, repeated
    ones too. Blank texts give no rows. Only A-Z are lower-cased. A worker holds one block,
    whose size is bounded, beside the chunks of one document. Documents are told apart by
    their partition and place in it, so recomputed input must come in the same order, as
    files do.
    """
    prepare(docs.sparkSession)
    asked = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.xxhash64(F.coalesce(F.col(source), F.lit(""))).alias("source"),
                        F.monotonically_increasing_id().alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def to_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(least_docs)
        for b in slices(batches):
            for name, own, key, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                block.add(name, own, key, body.as_buffer().to_pybytes())
                if block.full():
                    yield from block.batches()
                    block = _Block(least_docs)
        yield from block.batches()

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.repartition("word").sortWithinPartitions("word", "lang")

    chunks = grouped(asked.mapInArrow(to_chunks, ROWS))
    terms = grouped(chunks.mapInArrow(lambda batches: _merged(batches, least_docs, _Cutter()), ROWS))
    return terms.mapInArrow(lambda batches: _merged(batches, least_docs, lambda rows: _keep(rows, least_docs)), KEPT)


def _share(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / total), exact for any bigint count."""
    over = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", over, total.cast("decimal(19,0)"))


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _wide(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def source_divergence(docs: DataFrame, least_docs: int = 3, top: int = 200, text: str = "text", lang: str = "lang",
                      source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs.

    A language keeps the V terms in at least ``least_docs`` of its documents. Every occurring
    (lang, source) group, and each language, gives a kept term the share
    p = 1 + floor(10**9 * (count + 1) / (N + V)), N its occurrences of kept terms;
    f(p, q) = floor((p - q)**2 / q). Part ``pair``: each other source of the language, value
    the sum of f over all kept terms with the other's shares as q (0 where V = 0). Part
    ``term``: the kept terms with p above the language's q, value f, the ``top`` first.
    Ranks go by value descending, then by item in byte order, from 1 in each group and part.

    Nulls in the three columns count as ''; repeated rows are documents each; an empty table
    gives no rows. A group of many documents is spread over blocks; a language of many
    sources gives a row for each pair of them, as asked. Blocks and kept terms are written
    once to the shared folder.
    """
    kept = staged(kept_terms(docs, least_docs, text, lang, source), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("total_lang"))
    counts = kept.select("lang", F.explode("by_source").alias("s")).select("lang", "s.id", "s.n")
    # how many terms a source has with each count
    profile = staged(counts.groupBy("lang", "id", "n").agg(F.count(F.lit(1)).alias("times")), "profiles")
    sums = profile.groupBy("lang", "id").agg(F.sum(F.col("n") * F.col("times")).alias("total"), F.sum("times").alias("own"))
    names = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    v = F.coalesce("v", F.lit(0)).cast("bigint")
    size = F.coalesce("total", F.lit(0)).cast("bigint") + v
    # one row a group, with its share of a term it lacks
    groups = staged(names.withColumn("id", F.xxhash64("source")).join(langs, "lang", "left").join(sums, ["lang", "id"], "left").select(
        "lang", "id", "source", v.alias("v"), F.coalesce("own", F.lit(0)).cast("bigint").alias("own"), size.alias("size"),
        (F.coalesce("total_lang", F.lit(0)).cast("bigint") + v).alias("size_lang"),
        F.when(size > 0, _share(F.lit(0).cast("bigint"), size)).alias("p0")), "groups")
    if not groups.groupBy("lang", "id").count().where("count > 1").isEmpty():
        raise ValueError("two source names of a language have the same 64-bit hash")

    g = groups.select("lang", "id", "p0", "v", "own")
    h = g.toDF("lang", "item", "q0", "v_item", "own_item")
    pair = ["lang", "id", "item"]
    differ, times = F.col("id") != F.col("item"), _wide(F.col("times"))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    none = g.join(h, "lang").where(differ).select(*pair, F.when(F.col("v") == 0, _wide(F.lit(0))).otherwise(
        _wide(F.col("v") - F.col("own") - F.col("own_item")) * _wide(_f(p0, q0))).alias("value"))
    shares = profile.join(groups, ["lang", "id"]).select("lang", "id", "times", "p0", _share(F.col("n"), F.col("size")).alias("p"))
    left = shares.join(h, "lang").where(differ).select(*pair, (times * _wide(_f(p, q0))).alias("value"))
    right = shares.select("lang", F.col("id").alias("item"), "times", p.alias("q")).join(g, "lang").where(differ).select(
        *pair, (times * _wide(_f(p0, q))).alias("value"))
    # the sources that share a term, counted by their two counts before any arithmetic: each
    # two sources once, and then the other way round
    once = (kept.select("lang", F.col("by_source").alias("others"), F.explode("by_source").alias("a"))
            .select("lang", "a", F.explode(F.filter("others", lambda b: b["id"] > F.col("a.id"))).alias("b"))
            .select("lang", F.col("a.id").alias("id"), F.col("b.id").alias("item"), F.col("a.n").alias("n"), F.col("b.n").alias("m"))
            .groupBy(*pair, "n", "m").agg(F.count(F.lit(1)).alias("times")))
    way = F.explode(F.array(F.struct("id", "item", "n", "m"), F.struct(
        F.col("item").alias("id"), F.col("id").alias("item"), F.col("m").alias("n"), F.col("n").alias("m"))))
    met = once.select("lang", "times", way.alias("w")).select("lang", "w.*", "times")
    sizes = groups.select("lang", "id", "p0", "size")
    both = (met.join(sizes, ["lang", "id"]).join(sizes.toDF("lang", "item", "q0", "size_item"), ["lang", "item"])
            .select(*pair, "times", "p0", "q0", _share(F.col("n"), F.col("size")).alias("p"), _share(F.col("m"), F.col("size_item")).alias("q"))
            .select(*pair, (times * _wide(_f(p, q) - _f(p, q0) - _f(p0, q) + _f(p0, q0))).alias("value")))
    named = groups.select("lang", "id", "source")
    pairs = (none.unionByName(left).unionByName(right).unionByName(both).groupBy(*pair).agg(F.sum("value").cast("bigint").alias("value"))
             .join(named, ["lang", "id"]).join(named.toDF("lang", "item", "name"), ["lang", "item"])
             .select("lang", "source", F.lit("pair").alias("part"), F.col("name").alias("item"), "value"))
    more = (kept.select("lang", "term", "n_lang", F.explode("by_source").alias("s")).select("lang", "term", "n_lang", "s.id", "s.n")
            .join(groups.select("lang", "id", "source", "size", "size_lang"), ["lang", "id"])
            .select("lang", "source", "term", _share(F.col("n"), F.col("size")).alias("p"), _share(F.col("n_lang"), F.col("size_lang")).alias("q"))
            .where(p > q).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f(p, q).alias("value")))

    def ranked(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs).unionByName(ranked(more).where(F.col("rank") <= top))
