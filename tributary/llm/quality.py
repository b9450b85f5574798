"""Quality rules: basic word counts, and compression bands.

Repetitive text compresses too well and random or encoded text hardly at all. The
ratio of zstandard's output to the input is taken for the whole document and for
chunks of a fixed size; the limits depend on the document's length, because a longer
text compresses better.

Ratios are taken over characters, not over UTF-8: each character of an alphabet is one
octet, whatever its script, so that a text and its transliteration get one verdict. Texts
of more characters than an octet tells apart (ideographs) are judged in units of two
octets, for repetition only.

Random letters of any alphabet (hex, base32, digits) compress to what their letters'
frequencies alone allow, and prose, whose words come again, to less: a ratio near the
entropy of the single letters marks encoded text from 16,384 characters. Shorter encoded
text of up to 32 letters, and stretches of it inside of prose, compress like prose of words
that hardly come again, and stay.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import prepare


SYMBOLS = b"#*$%&|<>"
LEVEL = 3
CHUNK_BYTES = 2048
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


class Band(NamedTuple):
    """Limits for documents of ``least`` bytes or more, up to the next band."""

    least: int
    low: float        # a whole document below is repetitive
    high: float       # above it is incompressible
    chunk_low: float  # the same for the lowest and highest chunk
    chunk_high: float
    flat: float = 9.0  # above this share of its letters' entropy it is encoded text


#: Prose of several languages lies well inside these limits, by 0.02 or more; its highest
#: ratios fall with length (0.75 under 512 characters, 0.56 from 2 KB, 0.43 from 32 KB; chunks
#: of 2 KB 0.58), and encoded text is above: base64 has 0.75 or more at any length, base85
#: 0.78. Of its letters' entropy prose has 0.93 at most from 8 KB, random letters have 1.00
#: and more.
BANDS = (
    Band(0, 0.45, 1.10, 0.0, 9.0),
    Band(256, 0.47, 0.85, 0.0, 9.0),
    Band(512, 0.45, 0.80, 0.40, 0.80),
    Band(1024, 0.43, 0.72, 0.42, 0.72),
    Band(2048, 0.42, 0.68, 0.43, 0.68),
    Band(4096, 0.40, 0.64, 0.43, 0.68),
    Band(8192, 0.39, 0.62, 0.43, 0.68),
    Band(16384, 0.38, 0.60, 0.43, 0.68, 0.99),
    Band(32768, 0.36, 0.60, 0.43, 0.68, 0.97),
    Band(131072, 0.33, 0.60, 0.43, 0.68, 0.97),
    Band(1048576, 0.25, 0.60, 0.40, 0.68, 0.97),
)
#: A text is judged in units of two octets if more than this share of it is beyond the
#: ``OWN_OCTETS`` characters that are its most frequent ones outside ASCII.
WIDE_SHARE, OWN_OCTETS = 0.1, 127
#: Of such a text, the share of a band's lower limits that applies.
WIDE_LOW = 0.5

REPORT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "zstd_ratio double, chunk_low double, chunk_high double, base_failed boolean, kept boolean, reason string")


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def octets_of(raw: bytes) -> tuple[bytes, bool]:
    """A UTF-8 text with one octet a character, as far as they go, and whether it is wide.

    ASCII stays; its most frequent other characters follow in their order, rare ones take
    three octets. A wide text (see WIDE_SHARE) is UTF-16.
    """
    if raw.isascii():
        return raw, False
    text = raw.decode("utf-8", "replace")
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    beyond = np.flatnonzero(codes > 127)
    kinds, counts = np.unique(codes[beyond], return_counts=True)
    own = np.sort(kinds[np.argsort(-counts, kind="stable")[:OWN_OCTETS]])
    place = np.minimum(np.searchsorted(own, codes[beyond]), len(own) - 1)
    rare = beyond[own[place] != codes[beyond]]
    if len(rare) > WIDE_SHARE * len(codes):
        return text.encode("utf-16-le"), True
    out = codes.astype(np.uint8)
    out[beyond] = 128 + place
    if not len(rare):
        return out.tobytes(), False
    width = np.ones(len(codes), np.int64)
    width[rare] = 3
    at = np.cumsum(width) - width
    spread = np.repeat(out, width)
    spread[at[rare]] = 255
    spread[at[rare] + 1], spread[at[rare] + 2] = codes[rare] >> 8 & 255, codes[rare] & 255
    return spread.tobytes(), False


def entropy(octets: bytes) -> float:
    """Entropy of single octets, as a share of eight bits."""
    n = np.bincount(np.frombuffer(octets, np.uint8))
    p = n[n > 0] / len(octets)
    return float(-(p * np.log2(p)).sum()) / 8


def _chunks(raw: bytes) -> list[bytes]:
    """Every byte is in a chunk. A tail under half a chunk is seen with what stands before it, a whole chunk again."""
    starts = list(range(0, len(raw), CHUNK_BYTES))
    if len(starts) > 1 and 2 * (len(raw) - starts[-1]) < CHUNK_BYTES:
        starts[-1] = len(raw) - CHUNK_BYTES
    return [raw[i:i + CHUNK_BYTES] for i in starts]


def _judged(raw: bytes, pack, bands: tuple[Band, ...]) -> tuple:
    words = raw.split()
    n = len(words)
    octets = np.frombuffer(b"".join(words), np.uint8)
    chars = int(((octets & 0xC0) != 0x80).sum())
    symbols = sum(map(raw.count, (bytes([c]) for c in SYMBOLS)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    text, wide = octets_of(raw)
    whole = len(pack(text)) / len(text) if text else None
    chunks = [len(pack(c)) / len(c) for c in _chunks(text)]
    low, high = (min(chunks), max(chunks)) if chunks else (None, None)
    band = [b for b in bands if b.least <= len(text)][-1]
    if wide:
        band = band._replace(low=band.low * WIDE_LOW, chunk_low=band.chunk_low * WIDE_LOW, high=9.0, chunk_high=9.0, flat=9.0)
    reason = None
    if failed:
        reason = "short" if n < MIN_WORDS else "repeated words"
    elif whole < band.low or low < band.chunk_low:
        reason = "repetitive"
    elif whole > band.high or high > band.chunk_high:
        reason = "incompressible"
    elif band.flat < 9 and whole > band.flat * entropy(text):
        reason = "encoded"
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, whole, low, high, failed, reason is None, reason


def _texts(column: pa.Array) -> Iterator[bytes]:
    for t in column.cast(pa.large_binary()):
        yield t.as_py() or b""


def quality_report(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                   bands: tuple[Band, ...] = BANDS) -> DataFrame:
    """One row per row of ``docs``: its id, the counts, the ratios and the verdict.

    base_failed: under 50 words, or over half of the words in repeated 3-word windows.
    kept is false where base_failed, or where a ratio is outside the band of the
    document's length. A null or blank text has no words and fails, and has
    null ratios if it is empty. Texts are judged whole, whatever their length. Repeated
    rows are judged alike; an empty table gives none.
    """
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    names = [c.split()[0] for c in REPORT.split(", ")]

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for b in batches:
            rows = list(zip(*(_judged(t, pack, bands) for t in _texts(b.column(1)))))
            if rows:
                kinds = [pa.int64()] * 5 + [pa.float64()] * 3 + [pa.bool_()] * 2 + [pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *(pa.array(r, k) for r, k in zip(rows, kinds))], [id_col, *names])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(judge, f"`{id_col}` {kind}, {REPORT}")


def keep_quality(docs: DataFrame, text: str = "text", bands: tuple[Band, ...] = BANDS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged, in one pass without a shuffle."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for b in batches:
            yield b.filter(pa.array([_judged(t, pack, bands)[9] for t in _texts(b.column(at))], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
