"""SimHash near-dedup with pivot distance tables.

Each distinct fingerprint gets its Hamming distances to fixed reference fingerprints,
the pivots. By the triangle inequality two fingerprints within r bits differ by r at
most in every one of these coordinates, so a pair whose coordinates differ by more
is discarded without looking at it; survivors are verified bit by bit.

Pairs are only formed inside buckets. The 64 bits are cut into r + 3 blocks; two
fingerprints within r bits agree on three blocks at least, so each fingerprint enters
one bucket for each choice of three blocks. A bucket that is too large is cut further
along pivot coordinates: a cell takes the coordinates of a stretch, and a fingerprint
enters every cell that a partner within r bits above it could be in. Nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import prepare, staged, without_rows

SEED = 42
PIVOTS = 16
#: Buckets with more members are cut along the first CUTS pivots.
BUCKET_MEMBERS = 4096
CUTS = 4
_STEP = 1 << 16  # shingles whose bits are counted at once


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: str | None, words: int, seed: int = SEED) -> int:
    """64-bit SimHash of the shingles of ``words`` words; no words give zero."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(ws) <= words:
        hashes = np.array([digest(b" ".join(ws), seed)], np.uint64)
    else:
        joined = b" ".join(ws)
        sizes = np.fromiter(map(len, ws), np.int64, len(ws)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends + 1 - sizes).tolist()
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1:].tolist())),
                             np.uint64, len(ws) - words + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _STEP):
        octets = hashes[i:i + _STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, th, fp) of every row; th is the text's hash, fp the fingerprint as a signed long."""
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("th"))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps, pa.int64())], ["id", "th", "fp"])

    return narrow.mapInArrow(compute, f"id {narrow.schema['id'].dataType.simpleString()}, th bigint, fp bigint")


# ---------------------------------------------------------------- pivots and buckets
def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, fixed by their numbers."""
    return [xxhash.xxh64_intdigest(f"pivot {i}".encode(), SEED) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _coordinates(fp: Column) -> Column:
    """The distances to all pivots, one byte each, as an array of longs."""
    distances = [F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("bigint") for p in pivots()]
    packed = []
    for i in range(0, len(distances), 8):
        whole = distances[i]
        for k, c in enumerate(distances[i + 1:i + 8], 1):
            whole = whole.bitwiseOR(F.shiftleft(c, 8 * k))
        packed.append(whole)
    return F.array(*packed)


def _masks(bits: int) -> list[int]:
    """One mask for each choice of three of the bits + 3 blocks."""
    n = bits + 3
    cuts = [round(64 * i / n) for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [a | b | c for a, b, c in combinations(blocks, 3)]


def _cells(fp: Column, bits: int) -> Column:
    """Every cell along the first CUTS pivots in which a partner could look for this fingerprint."""
    width = bits + 1

    def cross(cells: Column, own: Column) -> Column:
        return F.flatten(F.transform(cells, lambda x: F.transform(own, lambda y: x * 128 + y)))

    cells = F.array(F.lit(0))
    for p in pivots()[:CUTS]:
        c = F.bit_count(fp.bitwiseXOR(F.lit(_signed(p))))
        cells = cross(cells, F.array_distinct(F.array(F.floor(c / width).cast("int"),
                                                      F.floor((c + bits) / width).cast("int"))))
    return cells


def _within(frames: Iterable[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    """Links inside buckets, from rows (bucket, fp, coords) that come sorted by bucket."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def links(bucket: np.ndarray, fp: np.ndarray, coords: np.ndarray) -> pd.DataFrame:
        n = len(fp)
        last = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]), n - 1)
        ahead = last[np.searchsorted(last, np.arange(n))] - np.arange(n)  # members behind it in its bucket
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        at, step = np.flatnonzero(ahead), 1
        while len(at):
            near = at[(np.abs(coords[at] - coords[at + step]) <= bits).all(axis=1)]
            near = near[np.bitwise_count(fp[near] ^ fp[near + step]) <= bits]
            for a, b in zip(fp[near].tolist(), fp[near + step].tolist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            step += 1
            at = at[ahead[at] >= step]
        ends = [(x, root(x)) for x in list(parent)]
        out = np.array(ends or np.empty((0, 2)), np.uint64).view(np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": out[:, 0], "v": out[:, 1]})

    for f in frames:
        if not len(f):
            continue
        bucket = f["bucket"].to_numpy()
        fp = f["fp"].to_numpy(np.int64).view(np.uint64)
        coords = np.stack(f["coords"].to_numpy()).astype("<i8").view(np.int8)
        cut = len(bucket) - int(np.searchsorted(bucket[::-1] != bucket[-1], True)) if (bucket != bucket[-1]).any() else 0
        if cut:
            held.append((bucket[:cut], fp[:cut], coords[:cut]))
            yield links(*map(np.concatenate, zip(*held)))
            held = []
        held.append((bucket[cut:], fp[cut:], coords[cut:]))
    if held:
        yield links(*map(np.concatenate, zip(*held)))


def near_links(distinct: DataFrame, bits: int, members: int = BUCKET_MEMBERS) -> DataFrame:
    """Links (u, v) that connect all fingerprints ``fp`` within ``bits`` bits of each other.

    Every pair within the distance is connected by links of pairs within the distance;
    a bucket gives at most one link for each member.
    """
    prepare(distinct.sparkSession)
    masks = _masks(bits)
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for i, m in enumerate(masks)])
    keyed = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    # written before it is joined: then a hot bucket's side of the join can be split
    sizes = staged(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    shared = keyed.join(sizes, ["t", "key"])
    cell = F.when(F.col("size") > members, _cells(F.col("fp"), bits)).otherwise(F.array(F.lit(0)))
    celled = shared.select(F.explode(cell).alias("cell"), "t", "key", "fp")
    rows = celled.select(F.xxhash64("t", "key", "cell").alias("bucket"), "fp", _coordinates(F.col("fp")).alias("coords"))
    ordered = rows.repartition(F.col("bucket")).sortWithinPartitions("bucket", "fp")
    return ordered.mapInPandas(lambda frames: _within(frames, bits), "u bigint, v bigint")


# ---------------------------------------------------------------- components
def star_components(links: DataFrame, purpose: str = "stars") -> DataFrame:
    """(u, root) for every node of ``links`` (u, v) that is not its component's smallest.

    Alternates the large-star and small-star steps until the links no longer change;
    every step is written to the shared folder.
    """
    edges = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u <> v").distinct(), purpose)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
        edges = staged(small.where("u <> v").distinct(), purpose)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select("u", F.col("v").alias("root"))
        state = now


def _components(docs: DataFrame, words: int, bits: int, text: str, id_col: str) -> DataFrame:
    """(id, th, fp, lead) of every row; lead is its component's smallest (no_id, id, th)."""
    fps = staged(fingerprints(docs, words, text, id_col), "fingerprints")
    # null ids come last: any id is preferred to none
    distinct = fps.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "th")).alias("low"))
    stars = star_components(near_links(distinct.select("fp"), bits))
    rooted = distinct.join(stars, F.col("fp") == F.col("u"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("lead"))
    named = staged(rooted.join(lows, "root").select("fp", "lead"), "components")
    return fps.join(named, "fp")


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2, text: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id, fingerprint (16 hex digits) and component_id.

    Rows link where their fingerprints differ in ``bits`` bits or fewer; component_id is
    the smallest id that links reach (null only where no row there has an id). Rows
    without words, null texts included, have fingerprint zero and link like any other.
    Repeated rows are repeated. An empty table gives none.
    """
    return _components(docs, words, bits, text, id_col).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("lead.id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2, text: str = "text",
                         id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; columns unchanged.

    A document is an id with a text: where an id stands on several texts each is kept or
    dropped for itself. A row without an id stays only where its component has no id, and
    there the one with the smallest hash of the text. Repeated rows stay or go together.
    """
    found = _components(docs, words, bits, text, id_col)
    kept = F.col("id").eqNullSafe(F.col("lead.id")) & (F.col("th") == F.col("lead.th"))
    return without_rows(docs, found.where(~kept).select("id", "th"), id_col, text)
