"""Removal of long byte strings that occur more than once, by suffix sorting.

A string of ``length`` bytes is judged by where it starts (a window). Each window is
owned by its anchor: the k-gram inside it with the smallest hash, leftmost if tied. Equal
windows have equal anchors at equal offsets, so only windows of one anchor class (equal
k-gram) need comparing, and a run of windows with one anchor travels as one stretch.

1. Every document is cut into stretches (anchor hash, 128-bit digest, place). Classes
   with one stretch have no repeated window and go.
2. Stretches that are equal as a whole repeat all their windows. One of each stays.
3. The different stretches of a class are suffix-sorted around the anchor, to the right
   and, reversed, to the left: a mergesort whose comparisons find the common extension by
   binary search over prefix polynomial hashes. The neighbours' extensions are then
   verified byte by byte; on a collision the sort is done again with another base. A window
   that begins o bytes before the anchor is repeated if another stretch shares o bytes to
   the left and length - o to the right: both are blocks of the sorted orders.
4. A class of more than CLASS_STRETCHES different stretches is not given to one task: its
   windows are counted by digest in a distributed aggregation instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import BitTable, prepare, slices, staged

GRAM = 100
CLASS_STRETCHES = 2048
#: Bytes of text that are hashed together; places inside fit PLACE_BITS.
BUFFER = 1 << 17
PLACE_BITS = 24
#: Stretches that are sorted together.
SORTED_TOGETHER = 4096
#: Rows and bytes of stretches that are handed on together, up to one stretch more.
READ_ROWS, READ_BYTES = 1 << 15, 1 << 22
#: 2**26 bits are 8 MB.
FILTER_BITS = 1 << 26


# ---------------------------------------------------------------- prefix polynomial hashes
def _base(attempt: int) -> int:
    return xxhash.xxh64_intdigest(f"base {attempt}", 42) | 1  # odd, so that it has an inverse


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, attempt: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    have = _POWERS.get(attempt)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        base, both = _base(attempt), []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.empty(size, np.uint64)
            p[0], done = 1, 1
            while done < size:  # doubling
                step = min(done, size - done)
                p[done:done + step] = p[:step] * np.uint64(pow(b, done, 1 << 64))
                done += step
            both.append(p)
        _POWERS[attempt] = have = (both[0], both[1])
    return have


class Hashed:
    """Bytes with the prefix hashes of a polynomial modulo 2**64."""

    def __init__(self, octets: np.ndarray, attempt: int = 0):
        self.octets = octets
        power, self.inverse = _powers(len(octets) + 1, attempt)
        self.prefix = np.zeros(len(octets) + 1, np.uint64)
        np.cumsum((octets.astype(np.uint64) + np.uint64(1)) * power[:len(octets)], out=self.prefix[1:])

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + size] - self.prefix[start]) * self.inverse[start]

    def grams(self, k: int) -> np.ndarray:
        n = len(self.octets) - k + 1
        x = (self.prefix[k:] - self.prefix[:-k]) * self.inverse[:n]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


# ---------------------------------------------------------------- stretches of a document
def _smallest(keys: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every w neighbours."""
    n = len(keys) - w + 1
    full = np.full(-(-len(keys) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[:len(keys)] = keys
    rows = full.reshape(-1, w)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(rows, axis=1).reshape(-1)
    return np.minimum(ahead[:n], behind[w - 1:w - 1 + n])


def stretches(texts: list[bytes], length: int, k: int) -> tuple[np.ndarray, ...]:
    """(text number, first window, last window, anchor, anchor hash, digest) of every stretch.

    Texts together are at most a buffer; digest is two columns of a 128-bit blake2b over
    the stretch's bytes and its windows' offsets.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    long = sizes >= length
    if not long.any():  # short texts have no window, however many bytes they are together
        return tuple(np.empty((0, 2) if i == 5 else 0, np.int64) for i in range(6))
    begins = np.cumsum(sizes) - sizes
    raw = b"".join(texts)
    grams = Hashed(np.frombuffer(raw, np.uint8)).grams(k)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    places = np.arange(len(grams), dtype=np.uint64)
    anchor = (_smallest((grams & ~mask) | places, length - k + 1) & mask).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, np.int64)  # windows that do not cross into the next text
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, begins[long] + sizes[long] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(inside[:-1]))
    own = anchor[window]
    cut = np.flatnonzero((own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1)) + 1
    first = window[np.append(0, cut)]
    last = window[np.append(cut, len(window)) - 1]
    at = own[np.append(0, cut)]
    view, make = memoryview(raw), hashlib.blake2b
    digests = b"".join([make(view[a:b], digest_size=16, salt=o).digest() for a, b, o in zip(
        first.tolist(), (last + length).tolist(), _salts(at - first, at - last))])
    text = np.searchsorted(begins + sizes, first, side="right")
    shift = begins[text]
    return (text, first - shift, last - shift, at - shift, grams[at].view(np.int64),
            np.frombuffer(digests, "<i8").reshape(-1, 2))


def _salts(a: np.ndarray, b: np.ndarray) -> list[bytes]:
    raw = np.stack([a, b], axis=1).astype("<i8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def _buffers(texts: list[bytes], length: int) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """Texts dealt into buffers: parts, their text numbers and where they begin in the text.

    A text that is longer than a buffer is cut; parts overlap so that each window is in one.
    """
    parts, numbers, offsets, have = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t)), BUFFER):
            part = t[a:a + BUFFER + length - 1] if len(t) > BUFFER else t
            if have and have + len(part) > BUFFER:
                yield parts, numbers, offsets
                parts, numbers, offsets, have = [], [], [], 0
            parts.append(part)
            numbers.append(i)
            offsets.append(a)
            have += len(part)
            if len(t) <= BUFFER:
                break
    if parts:
        yield parts, numbers, offsets


# ---------------------------------------------------------------- suffix sort
def _common(h: Hashed, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common extension of the places a and b, ``most`` at most, by binary search on hashes."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = h.of(a, mid) == h.of(b, mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def _before(h: Hashed, start: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 as suffix a sorts before, like or behind suffix b."""
    least = np.minimum(size[a], size[b])
    n = _common(h, start[a], start[b], least)
    end = len(h.octets) - 1
    x = np.where(n < size[a], h.octets[np.minimum(start[a] + n, end)].astype(np.int64), -1)
    y = np.where(n < size[b], h.octets[np.minimum(start[b] + n, end)].astype(np.int64), -1)
    return np.sign(x - y)


def suffix_order(h: Hashed, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Mergesort of the suffixes [start, start + size) inside each group (groups are contiguous).

    Every level merges neighbouring runs of all groups at once: an element's new place is
    its own place in its run plus its rank in the other run, found by binary search.
    """
    order = np.arange(len(start))
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    tails = np.append(heads[1:], len(start))
    which = np.searchsorted(heads, order, side="right") - 1
    begin, stop = heads[which], tails[which]
    width = 1
    while width < (tails - heads).max(initial=0):
        place = np.flatnonzero(stop - begin > width)
        run = (place - begin[place]) // width
        low = begin[place] + (run ^ 1) * width
        place, run, low = (x[low < stop[place]] for x in (place, run, low))
        other, high = low.copy(), np.minimum(low + width, stop[place])
        me, behind = order[place], (run & 1).astype(bool)
        todo = np.flatnonzero(low < high)
        while len(todo):
            mid = (low[todo] + high[todo]) >> 1
            c = _before(h, start, size, order[mid], me[todo])
            up = np.where(behind[todo], c <= 0, c < 0)  # equal suffixes keep their order
            low[todo], high[todo] = np.where(up, mid + 1, low[todo]), np.where(up, high[todo], mid)
            todo = todo[low[todo] < high[todo]]
        new = begin[place] + (run >> 1) * 2 * width + (place - begin[place] - run * width) + (low - other)
        merged = order.copy()
        merged[new] = me
        order, width = merged, 2 * width
    return order


def _verified(h: Hashed, a: np.ndarray, b: np.ndarray, n: np.ndarray, most: np.ndarray) -> bool:
    """Whether the bytes at a and b agree over n and, below ``most``, differ behind."""
    end = len(h.octets) - 1
    for i in range(0, len(a), 2048):
        s = slice(i, i + 2048)
        width = np.arange(int(n[s].max(initial=0)) + 1)
        x = h.octets[np.minimum(a[s, None] + width, end)] == h.octets[np.minimum(b[s, None] + width, end)]
        if not (x | (width >= n[s, None])).all():
            return False
        if (x[np.arange(len(x)), n[s]] & (n[s] < most[s])).any():
            return False
    return True


def sorted_neighbours(parts: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order of ``parts`` inside their groups, and each one's common extension with the one before.

    The first of a group has -1. Verified byte by byte; a collision is sorted again.
    """
    octets = np.frombuffer(b"".join(parts) or b"\0", np.uint8)
    size = np.array([len(p) for p in parts], np.int64)
    start = np.cumsum(size) - size
    for attempt in range(64):
        h = Hashed(octets, attempt)
        order = suffix_order(h, start, size, group)
        a, b = order[:-1], order[1:]
        most = np.minimum(size[a], size[b])
        n = _common(h, start[a], start[b], most)
        alike = group[a] == group[b]
        if _verified(h, start[a][alike], start[b][alike], n[alike], most[alike]):
            return order, np.append(-1, np.where(alike, n, -1))
    raise RuntimeError("no base of 64 sorts without a collision")


def repeated_windows(parts: list[bytes], left: np.ndarray, last: np.ndarray, group: np.ndarray,
                     length: int) -> np.ndarray:
    """For stretches of the same anchor in a group: which windows another stretch shares.

    ``left`` are the bytes before the anchor, which is the first window's offset, and
    ``last`` the last window's. Returns (stretch, offset) as a boolean matrix.
    """
    right_order, right = sorted_neighbours([p[n:] for p, n in zip(parts, left.tolist())], group)
    left_order, before = sorted_neighbours([p[:n][::-1] for p, n in zip(parts, left.tolist())], group)
    shared = np.zeros((len(parts), int(left.max(initial=0)) + 1), bool)
    block_r, block_l = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for o in range(shared.shape[1]):
        own = np.flatnonzero((last <= o) & (o <= left))
        if len(own) < 2:
            continue
        block_r[right_order] = np.cumsum(right < length - o)
        block_l[left_order] = np.cumsum(before < o)
        key = block_r[own] * (len(parts) + 1) + block_l[own]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        shared[own[by[1:][same]], o] = True
        shared[own[by[:-1][same]], o] = True
    return shared


# ---------------------------------------------------------------- Spark jobs

def _keyed(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """(id, th, text): rows of one id are told apart by the text's hash; null texts are empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("th"), t.alias("text"))


def _unlike(b: pa.RecordBatch) -> pa.RecordBatch:
    """A batch without rows of an id and a text that an earlier one of it has."""
    seen: set = set()
    new = [not (k in seen or seen.add(k)) for k in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    return b if all(new) else b.filter(pa.array(new))


def _octets(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def _lots(texts: list[bytes], row: np.ndarray, kinds: np.ndarray, first: np.ndarray, last: np.ndarray, length: int,
          most: int) -> Iterator[tuple[np.ndarray, list[int], list[int], list[bytes | None], np.ndarray]]:
    """(stretch number, first, last, bytes, digest) of the stretches, in lots of READ_ROWS and READ_BYTES.

    A stretch has its bytes; one of a class of over ``most`` kinds has a row for each window,
    with the window's digest.
    """
    blank = bytes(16)
    take, f, e, octets, digests, held = [], [], [], [], [], 0

    def lot():
        d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        return np.array(take, np.int64), f, e, octets, d

    for i in range(len(row)):
        t, a, z = texts[row[i]], int(first[i]), int(last[i])
        if kinds[i] <= most:
            take.append(i)
            octets.append(t[a:z + length])
            f.append(a)
            e.append(z)
            digests.append(blank)
            held += len(octets[-1])
        else:  # the windows of a very large class, each by itself
            starts = range(a, z + 1)
            take.extend([i] * len(starts))
            octets.extend([None] * len(starts))
            f.extend(starts)
            e.extend(starts)
            digests.extend(hashlib.blake2b(t[p:p + length], digest_size=16).digest() for p in starts)
        if len(take) >= READ_ROWS or held >= READ_BYTES:
            yield lot()
            take, f, e, octets, digests, held = [], [], [], [], [], 0
    if take:
        yield lot()


def _apart(batches: Iterable[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Sorted batches without the rows that agree in ``columns`` with the row ahead of them."""
    ahead = None
    for b in batches:
        place = np.stack([b.column(c).to_numpy() for c in columns])
        if not place.size:
            continue
        new = np.append(ahead is None or bool((place[:, 0] != ahead).any()), (place[:, 1:] != place[:, :-1]).any(axis=0))
        ahead = place[:, -1]
        if new.any():
            yield b if new.all() else b.filter(pa.array(new))


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (id, th), null ids alike; the right side carries no texts and is the one hashed."""
    r = right.withColumnRenamed("id", "id_r").withColumnRenamed("th", "th_r").hint("shuffle_hash")
    on = left["id"].eqNullSafe(F.col("id_r")) & (left["th"] == F.col("th_r"))
    return left.join(r, on, how).drop("id_r", "th_r")


def _one_of_each(keyed: DataFrame) -> DataFrame:
    """``keyed`` without the rows that repeat an id and a text inside of their task.

    No shuffle: what many rows repeat reaches a join once a task instead of once a row.
    """
    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            new = []
            for k in keys:
                new.append(k not in seen)
                seen.add(k)
            yield b if all(new) else b.filter(pa.array(new))

    return keyed.mapInArrow(first, keyed.schema)


def find_repeats(docs: DataFrame, length: int = 400, gram: int = GRAM, text: str = "text", id_col: str = "doc_id",
                 class_stretches: int = CLASS_STRETCHES) -> DataFrame:
    """(id, th, first, last): runs of starts of strings of ``length`` bytes that start elsewhere too.

    th is the xxhash64 of the text; rows that repeat an id and a text repeat each other.
    """
    spark = docs.sparkSession
    prepare(spark)
    gram = min(gram, length)
    keyed = _keyed(docs, text, id_col)
    kind = keyed.schema["id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for parts, numbers, offsets in _buffers(_octets(b.column(2)), length):
                n, first, last, at, g, d = stretches(parts, length, gram)
                if len(n):
                    row, shift = np.array(numbers)[n], np.array(offsets)[n]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(first + shift),
                         pa.array(last + shift), pa.array(at + shift), pa.array(g), pa.array(np.ascontiguousarray(d[:, 0])),
                         pa.array(np.ascontiguousarray(d[:, 1]))], ["id", "th", "first", "last", "at", "g", "d1", "d2"])

    found = staged(keyed.mapInArrow(cut, f"id {kind}, th bigint, first bigint, last bigint, at bigint, "
                                         "g bigint, d1 bigint, d2 bigint"), "stretches")
    # written before it is joined: then a hot class's side of the join can be split
    again = staged(found.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g"), "stretch-classes")
    company = staged(found.join(again, "g"), "stretches-shared")
    one = F.min(F.struct("id", "th", "first", "last", "at"))
    kinds = staged(company.groupBy("g", "d1", "d2").agg(F.count(F.lit(1)).alias("n"), one.alias("one")), "stretch-kinds")
    whole = (company.join(kinds.where("n > 1").select("g", "d1", "d2"), ["g", "d1", "d2"])
             .select("id", "th", "first", "last"))
    classes = staged(kinds.groupBy("g").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "mixed-classes")
    mixed = staged(kinds.join(classes, "g").select("g", "n", "kinds", "one.*"), "stretches-mixed")
    bits = BitTable(mixed.select(F.xxhash64("id", "th").alias("key")), "stretch-docs", FILTER_BITS)
    asked = bits.flag(keyed, F.xxhash64("id", "th"), "asked").where("asked").drop("asked")
    per_doc = mixed.groupBy("id", "th").agg(F.collect_list(F.struct("g", "n", "kinds", "first", "last", "at")).alias("want"))
    # a text may be there in many rows; one of a task is enough to read the bytes from
    rows = _joined(_one_of_each(asked), per_doc, "inner")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "th", "g", "n", "first", "last", "at", "bytes", "d1", "d2"]
        for b in slices(batches):
            # rows of other tasks may repeat one here; they stand in one partition, by the join
            b = _unlike(b)
            texts, want = _octets(b.column(2)), b.column(3)
            flat, ends = want.flatten(), np.asarray(want.offsets)
            g, n, kinds_, first, last, at = (flat.field(i).to_numpy() for i in range(6))
            row = np.repeat(np.arange(len(texts)), np.diff(ends))
            for take, f, e, octets, d in _lots(texts, row, kinds_, first, last, length, class_stretches):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row[take])), b.column(1).take(pa.array(row[take])), pa.array(g[take]),
                     pa.array(n[take]), pa.array(f, pa.int64()), pa.array(e, pa.int64()), pa.array(at[take]),
                     pa.array(octets, pa.binary()), pa.array(np.ascontiguousarray(d[:, 0])),
                     pa.array(np.ascontiguousarray(d[:, 1]))], names)

    with_bytes = staged(rows.mapInArrow(read, f"id {kind}, th bigint, g bigint, n bigint, first bigint, last bigint, "
                                              "at bigint, bytes binary, d1 bigint, d2 bigint"), "stretch-bytes")

    def resolve(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        n, first, last, at, g = (t.column(c).to_numpy() for c in ("n", "first", "last", "at", "g"))
        _, group = np.unique(g, return_inverse=True)
        shared = repeated_windows(t.column("bytes").to_pylist(), at - first, at - last, group, length)
        shared &= (n == 1)[:, None]  # the others are known to be repeated as a whole
        edge = np.diff(np.pad(shared, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, begin = np.nonzero(edge == 1)
        stop = np.nonzero(edge == -1)[1]
        if len(row):
            yield pa.RecordBatch.from_arrays(
                [t.column("id").combine_chunks().take(pa.array(row)), t.column("th").combine_chunks().take(pa.array(row)),
                 pa.array(at[row] - stop + 1), pa.array(at[row] - begin)], ["id", "th", "first", "last"])

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        # a text that several rows have with one id was read several times
        for b in _apart(batches, ("g", "th", "first", "at", "last")):
            g, a = b.column(0).to_numpy(), 0
            for z in np.append(np.flatnonzero(g[1:] != g[:-1]) + 1, len(g)).tolist():
                if sum(map(len, held)) >= SORTED_TOGETHER and held[-1].column(0)[-1].as_py() != g[a]:
                    yield from resolve(held)
                    held = []
                held.append(b.slice(a, z - a))
                a = z
        if held:
            yield from resolve(held)

    by_class = with_bytes.where("bytes is not null").select("g", "n", "first", "last", "at", "bytes", "id", "th")
    sorted_rows = by_class.repartition("g").sortWithinPartitions("g", "th", "first").mapInArrow(
        sort, f"id {kind}, th bigint, first bigint, last bigint")
    windows = with_bytes.where("bytes is null").dropDuplicates(["id", "th", "first"])
    twice = staged(windows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("w")).where("w > 1").select("d1", "d2"),
                   "repeated-windows")
    counted = windows.join(twice, ["d1", "d2"]).select("id", "th", "first", "last")
    return whole.unionByName(sorted_rows).unionByName(counted)


def cut_repeats(docs: DataFrame, length: int = 400, text: str = "text", id_col: str = "doc_id",
                gram: int = GRAM, class_stretches: int = CLASS_STRETCHES) -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes, removed (array of start, end) and kept (bytes).

    Each byte that a ``length``-byte string covers which also starts anywhere else, in this
    document or another, is removed; strings overlap and are judged on the input. Matches
    never cross documents. A null text is empty; texts shorter than ``length`` stay whole.
    Rows that repeat a text remove each other's long strings. ``kept`` may be cut inside
    of a character.
    """
    prepare(docs.sparkSession)
    # rows that repeat each other have the same spans
    spans = staged(find_repeats(docs, length, gram, text, id_col, class_stretches).distinct(), "repeats")
    per_doc = spans.groupBy("id", "th").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    bits = BitTable(spans.select(F.xxhash64("id", "th").alias("key")), "repeat-docs", FILTER_BITS)
    flagged = bits.flag(_keyed(docs, text, id_col), F.xxhash64("id", "th"), "listed")
    rest = flagged.where("not listed").select(
        "id", F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("removed"),
        F.col("text").cast("binary").alias("kept"))
    listed = _joined(flagged.where("listed").drop("listed"), per_doc, "left").select("id", "text", "spans")
    kind = listed.schema["id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            kept, removed, sizes = [], [], []
            for raw, spans_ in zip(_octets(b.column(1)), b.column(2)):
                own = spans_.values if spans_.is_valid else None
                runs = _runs(own.field(0).to_numpy(), own.field(1).to_numpy() + length) if own is not None else []
                sizes.append(len(raw))
                removed.append([{"start": a, "end": z} for a, z in runs])
                out, at = [], 0
                for a, z in runs:
                    out.append(raw[at:a])
                    at = z
                kept.append(b"".join([*out, raw[at:]]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], ["id", "n_bytes", "removed", "kept"])

    out = listed.mapInArrow(cut, f"id {kind}, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary")
    both = rest.unionByName(out)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return both.select(F.col("id").alias(id_col), "n_bytes", F.coalesce("removed", none).alias("removed"), "kept")


def _runs(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the half-open spans cover."""
    by = np.argsort(start)
    start, reach = start[by], np.maximum.accumulate(end[by])
    new = np.append(True, start[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return list(zip(start[new].tolist(), reach[last].tolist()))
