"""Files that hold one large JSON array, read in parallel as batches of their items.

A body is one row and one VARIANT elsewhere; an array of any size is cut here, in the
reader. A file is dealt to tasks in byte ranges, in two passes over the bytes:

1. every range reports, without knowing whether it begins inside a string, how many quotes
   it has and how it changes the depth of brackets in either case; a running sum over a
   file's ranges then tells each its beginning (inside a string or not, depth);
2. every range gives the items that begin in it, as bodies of about ``batch_bytes``: an item
   is whole text between two separators of depth 1, and the last one is read to its end
   behind the range.

A worker holds one read buffer and one batch, so its memory does not depend on the file.
Bodies are arrays that ``normalize`` shapes as it would shape the whole one: of objects as
they stand, of other items as ``{"value": item}``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.fixed import VALUE_KEY
from tributary.sources.requests import response_frame
from tributary.sources.rest import RESPONSE_SCHEMA, request_mode

RANGE_BYTES = 64 << 20
BATCH_BYTES = 1 << 20
READ_BYTES = 4 << 20
BEHIND_BYTES = 1 << 12

_QUOTE, _BACKSLASH, _COMMA, _OPEN, _CLOSE = 34, 92, 44, 91, 93
_DELTA = np.zeros(256, np.int8)
_DELTA[[91, 123]], _DELTA[[93, 125]] = 1, -1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
_BOM = b"\xef\xbb\xbf"


class ArrayError(ValueError):
    """A file is not one JSON array (or one other value)."""


def _quotes(octets: np.ndarray, odd: bool) -> tuple[np.ndarray, bool]:
    """Which bytes are quotes that open or close a string, and whether an odd run of
    backslashes stands at the end. ``odd`` says so of what stands before."""
    found = octets == _QUOTE
    slashes = octets == _BACKSLASH
    if not odd and not slashes.any():
        return found, False
    at = np.arange(len(octets))
    plain = np.maximum.accumulate(np.where(slashes, -1, at))  # the last byte that is no backslash
    run = np.where(plain < 0, at + 1 + odd, at - plain)       # backslashes up to here
    escaped = np.empty(len(octets), bool)
    escaped[0], escaped[1:] = odd, run[:-1] % 2 == 1
    return found & ~escaped, bool(run[-1] % 2)


class Scanner:
    """Follows strings and brackets through the chunks of a byte stream."""

    def __init__(self, in_string: bool = False, depth: int = 0, odd: bool = False):
        self.in_string, self.depth, self.odd = in_string, depth, odd

    def feed(self, octets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each byte: whether it is outside strings, and the depth behind it."""
        quotes, self.odd = _quotes(octets, self.odd)
        behind = (np.cumsum(quotes) + self.in_string) % 2 == 1
        outside = ~behind & ~quotes
        depth = self.depth + np.cumsum(np.where(outside, _DELTA[octets], 0), dtype=np.int64)
        self.in_string, self.depth = bool(behind[-1]), int(depth[-1])
        return outside, depth


def _chunks(stream, start: int, stop: int, own: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """The bytes from ``start`` up to ``stop``; behind ``own`` in small pieces at first, as few are wanted there."""
    stream.seek(start)
    own, behind = stop if own is None else own, BEHIND_BYTES
    while start < stop:
        size = min(READ_BYTES, own - start) if start < own else behind
        raw = stream.read(min(size, stop - start))
        if not raw:
            return
        if start >= own:
            behind = min(2 * behind, READ_BYTES)
        yield start, np.frombuffer(raw, np.uint8)
        start += len(raw)


def _odd_before(stream, start: int) -> bool:
    """Whether an odd run of backslashes ends at ``start``."""
    run = 0
    while start > 0:
        size = min(start, 4096)
        stream.seek(start - size)
        raw = stream.read(size)
        own = size - len(raw.rstrip(b"\\"))
        run, start = run + own, start - size
        if own < size:
            break
    return run % 2 == 1


def summary(stream, start: int, stop: int) -> tuple[int, int, int]:
    """(quotes mod 2, change of depth if the range begins outside a string, if inside one)."""
    scan, both = Scanner(odd=_odd_before(stream, start)), 0
    for _, octets in _chunks(stream, start, stop):
        scan.feed(octets)
        both += int(_DELTA[octets].sum(dtype=np.int64))
    # a bracket is outside strings in exactly one of the two cases
    return int(scan.in_string), scan.depth, both - scan.depth


def head(stream, size: int) -> tuple[str, int]:
    """What a file holds, by its first bytes: ``objects`` or ``values`` (an array, and where it
    opens), ``other`` (another value) or ``nothing``."""
    stream.seek(0)
    first = stream.read(4)
    if not first.startswith(_BOM) and json.detect_encoding(first) != "utf-8":
        raise ArrayError("not UTF-8")
    at = len(_BOM) if first.startswith(_BOM) else 0
    open_at = None
    for start, octets in _chunks(stream, at, size, at):
        for i in np.flatnonzero(~_SPACE[octets])[:2]:
            if open_at is not None:
                return ("objects" if octets[i] == 123 else "values"), open_at
            if octets[i] != _OPEN:
                return "other", at
            open_at = start + int(i)
    return ("nothing", at) if open_at is None else ("values", open_at)


def batches(stream, size: int, start: int, stop: int, in_string: bool, depth: int,
            batch_bytes: int = BATCH_BYTES) -> Iterator[tuple[int, bytes]]:
    """(offset, body) of the items that begin in the range: a ``[`` or a separator of depth 1
    stands before an item, and the range that has it has the item."""
    kind, opened = head(stream, size)
    if kind in ("other", "nothing"):
        if start == 0 and size > opened:
            stream.seek(opened)
            yield opened, stream.read(size - opened)
        return
    scan = Scanner(in_string, depth, _odd_before(stream, start))
    begin, held, held_at = None, bytearray(), start  # the open batch, and the bytes kept for it
    cuts: list[np.ndarray] = []                      # separators inside the open batch
    for at, octets in _chunks(stream, start, size, stop):
        outside, behind = scan.feed(octets)
        before = behind - np.where(outside, _DELTA[octets], 0)
        opens = outside & (before == 0) & (behind == 1)
        closes = outside & (before == 1) & (behind == 0)
        ends = (outside & (behind == 1) & (octets == _COMMA)) | closes
        own = max(0, min(stop - at, len(octets)))
        bad = (behind[:own] == 0) & ~_SPACE[octets[:own]] & ~closes[:own]
        bad[:max(0, opened - at)] = False  # a byte order mark
        if bad.any() or (behind[:own] < 0).any() or (octets[closes] != _CLOSE).any() \
                or (np.flatnonzero(opens[:own]) + at != opened).any():
            raise ArrayError("more than one value, or brackets that do not match")
        if begin is None:
            first = np.flatnonzero((opens | ends) & ~closes)
            first = first[first < own]
            if not len(first):
                if at + len(octets) >= stop:
                    return
                continue
            begin = at + int(first[0]) + 1
            held_at = at
        held += octets.tobytes()
        marks = np.flatnonzero(ends) + at
        marks = marks[marks >= begin]
        while len(marks):
            # the batch ends at its first separator behind batch_bytes, the range at its first behind stop
            k = int(np.searchsorted(marks, begin + batch_bytes))
            k = min(k, int(np.searchsorted(marks, stop)))
            closing = np.flatnonzero(closes)
            if len(closing):
                k = min(k, int(np.searchsorted(marks, at + closing[0])))
            if k >= len(marks):
                break
            end = int(marks[k])
            cuts.append(marks[:k])
            text = bytes(held[begin - held_at:end - held_at])
            done = bool(len(closing)) and end == at + int(closing[0])
            yield begin, _body(text, begin, np.concatenate(cuts), kind, whole=done and begin == opened + 1)
            if done or end >= stop:
                if done and end < stop:  # what stands behind the array belongs to this range too
                    yield from _nothing_behind(stream, end + 1, stop)
                return
            del held[:end + 1 - held_at]
            held_at = begin = end + 1
            cuts, marks = [], marks[k + 1:]
        cuts.append(marks)
        if begin > held_at:
            del held[:begin - held_at]
            held_at = begin
    if begin is not None:
        raise ArrayError("the array is not closed")


def _nothing_behind(stream, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    for _, octets in _chunks(stream, start, stop):
        if not _SPACE[octets].all():
            raise ArrayError("text behind the array")
    return iter(())


def _body(text: bytes, at: int, cuts: np.ndarray, kind: str, whole: bool) -> bytes:
    if not text.strip(b" \t\r\n"):
        if whole:
            return b"[]"
        raise ArrayError(f"an empty item at byte {at}")
    if kind == "objects":
        if not text.lstrip(b" \t\r\n").startswith(b"{"):
            raise ArrayError(f"objects are mixed with other items at byte {at}")
        return b"[" + text + b"]"
    bounds = [-1, *(cuts - at).tolist(), len(text)]
    items = [text[a + 1:b] for a, b in zip(bounds, bounds[1:])]
    wrap = b'{"' + VALUE_KEY.encode() + b'":'
    return b"[" + wrap + (b"}," + wrap).join(items) + b"}]"


# ---------------------------------------------------------------- Spark jobs
#: Ranges of a task, about, once every core has several tasks.
RANGES_PER_TASK = 16


def parts_for_ranges(spark: SparkSession, ranges: int) -> int:
    """Into how many tasks so many ranges go: several a core, and more where there are many ranges."""
    return max(1, min(int(ranges), max(4 * spark.sparkContext.defaultParallelism, -(-int(ranges) // RANGES_PER_TASK))))


def read_large_arrays(spark: SparkSession, path: str, *, glob: str = "*.json", mode: str = "FAILFAST",
                      range_bytes: int = RANGE_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The files under ``path`` as response rows, a row for each batch of items.

    ``source`` is the file's folder name, ``load_id`` and ``url`` its path and ``seq`` the
    byte where the batch begins, so files come in the order of their paths and items in
    theirs. A file with another value than an array is one body, as ``read_documents`` would
    give it; an empty file gives none. Files are UTF-8 (a byte order mark may stand first).
    A file that is not one value raises; with ``mode="PERMISSIVE"`` it gives a row with its
    error beside the batches found before.
    """
    from pyarrow import fs

    from tributary.session import ship_package

    ship_package(spark)
    permissive = request_mode({"mode": mode}) == "PERMISSIVE"
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(path).select("path", "length").where("length > 0"))
    ranges = files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))).alias("start"))
    ranges = ranges.withColumn("stop", F.least(F.col("start") + range_bytes, "length"))

    def opened(url: str):
        where, name = fs.FileSystem.from_uri(url)
        return where.open_input_file(name)

    def sums(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for row in frame.itertuples(index=False):
                with opened(row.path) as stream:
                    found.append(summary(stream, row.start, row.stop))
            quotes, outside, inside = zip(*found) if found else ((), (), ())
            yield frame.assign(quotes=quotes, outside=outside, inside=inside)

    # a range is a short row, so partitions sized by their bytes would give one task all files
    tasks = parts_for_ranges(spark, files.agg(F.sum(F.ceil(F.col("length") / range_bytes))).first()[0] or 0)
    dealt = ranges.repartition(tasks, "path", "start")
    told = dealt.mapInPandas(sums, "path string, length bigint, start bigint, stop bigint, quotes bigint, outside bigint, inside bigint")
    # a file has a row for each range: a running sum over them is far smaller than the file
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    strings = told.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    begun = strings.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))

    def bodies(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                source = row.path.rstrip("/").split("/")[-2]

                def response(at, body, error):
                    return response_frame([(source, row.path, at, row.path, None, None, body, error)])

                with opened(row.path) as stream:
                    try:
                        for at, body in batches(stream, row.length, row.start, row.stop, row.in_string, row.depth, batch_bytes):
                            yield response(at, body.decode(), None)
                    except (ArrayError, UnicodeDecodeError) as e:
                        if not permissive:
                            raise ArrayError(f"{row.path}: {e}") from e
                        yield response(row.start, None, f"{type(e).__name__}: {e}")

    cols = ["path", "length", "start", "stop", "in_string", "depth"]
    return begun.select(*cols).repartition(tasks, "path", "start").mapInPandas(bodies, RESPONSE_SCHEMA)
