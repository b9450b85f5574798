"""Fill-in-middle documents by a piece table.

A document is a list of descriptors (buffer, start, stop) over two immutable buffers: the
text's UTF-8 bytes and the sentinels. Cutting splits a descriptor, an arrangement permutes
the descriptors and puts sentinels between them, and the inverse permutation restores the
text. Hashes stream the descriptors; bytes are copied only where an output text is wanted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import prepare, slices

TEXT, MARKS = 0, 1  # the buffers of a descriptor

# The sentinels, and the two arrangements of (prefix, middle, suffix).
SENTINELS = b"<P><S><M>"
_MARK = {"P": (MARKS, 0, 3), "S": (MARKS, 3, 6), "M": (MARKS, 6, 9)}
#: For each form: the marks in their order, and which part (0 prefix, 1 middle, 2 suffix) follows each.
FORMS = {"psm": ("PSM", (0, 2, 1)), "spm": ("SPM", (2, 0, 1))}
PLAIN = "plain"

Descriptor = tuple[int, int, int]


class PieceTable:
    """Descriptors over a text and the sentinels; neither buffer is ever changed."""

    def __init__(self, text: bytes | memoryview, pieces: list[Descriptor] | None = None):
        self.buffers = (memoryview(text), memoryview(SENTINELS))
        self.pieces = [(TEXT, 0, len(self.buffers[TEXT]))] if pieces is None else pieces

    def cut(self, at: int) -> None:
        """Splits the descriptor that holds byte ``at`` of the document; a cut at an end leaves an empty piece."""
        for k, (buffer, start, stop) in enumerate(self.pieces):
            if at <= stop - start:
                self.pieces[k:k + 1] = [(buffer, start, start + at), (buffer, start + at, stop)]
                return
            at -= stop - start
        raise IndexError("cut behind the end")

    def arranged(self, form: str) -> "PieceTable":
        """The three pieces in a form's order, a sentinel before each."""
        if form == PLAIN:
            return PieceTable(self.buffers[TEXT], list(self.pieces))
        marks, order = FORMS[form]
        pieces = []
        for mark, part in zip(marks, order):
            pieces += [_MARK[mark], self.pieces[part]]
        return PieceTable(self.buffers[TEXT], pieces)

    def restored(self, form: str) -> "PieceTable":
        """An arranged table's text: sentinels dropped, the other pieces in the inverse order."""
        if form == PLAIN:
            return PieceTable(self.buffers[TEXT], list(self.pieces))
        own, order = [p for p in self.pieces if p[0] == TEXT], FORMS[form][1]
        pieces = [own[0]] * 3
        for piece, part in zip(own, order):
            pieces[part] = piece
        return PieceTable(self.buffers[TEXT], pieces)

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, stop in self.pieces:
            yield self.buffers[buffer][start:stop]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def tobytes(self) -> bytes:
        return b"".join(self.stream())


def parsed(output: bytes, form: str) -> PieceTable:
    """The piece table of an output text: the sentinels found again, what lies between as pieces.

    Texts that hold a sentinel are always plain, and no sentinel's end is another's start,
    so the first of each found from left to right is the one that was put in.
    """
    if form == PLAIN:
        return PieceTable(output)
    pieces, at = [], None
    for mark in FORMS[form][0]:
        _, a, b = _MARK[mark]
        found = output.find(SENTINELS[a:b], at or 0)
        if found < 0 or (at is None and found != 0):
            raise ValueError(f"not a text of the form {form}")
        if at is not None:
            pieces.append((TEXT, at, found))
        pieces.append(_MARK[mark])
        at = found + (b - a)
    pieces.append((TEXT, at, len(output)))
    return PieceTable(output, pieces)


# ---------------------------------------------------------------- units and draws
_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True


def unit_starts(text: bytes | memoryview) -> np.ndarray:
    """Byte offsets of the units: runs of the letters A-Z and a-z, and every other character."""
    octets = np.frombuffer(text, np.uint8)
    letter = _LETTER[octets]
    starts = (octets & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts)


def _chars(part: memoryview) -> int:
    octets = np.frombuffer(part, np.uint8)
    return int(np.count_nonzero((octets & 0xC0) != 0x80))


def draws(key: str, seed: int) -> list[int]:
    """Four numbers below 2**32 from a hash of the seed and the document's key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def transformed(text: bytes | memoryview, key: str, seed: int, plain: int, spm: int) -> tuple[PieceTable, str, int, int | None, int | None]:
    """(arranged table, form, units, characters of the prefix, of the middle) of one document."""
    table, starts = PieceTable(text), unit_starts(text)
    n, (h1, h2, h3, h4) = len(starts), draws(key, seed)
    raw = bytes(text)
    if not n or h3 % 100 >= 100 - plain or any(SENTINELS[a:b] in raw for _, a, b in _MARK.values()):
        return table, PLAIN, n, None, None
    form = "spm" if h4 % 100 < spm else "psm"
    ends = [int(starts[u]) if u < n else len(raw) for u in sorted((h1 % (n + 1), h2 % (n + 1)))]
    table.cut(ends[1])
    table.cut(ends[0])
    parts = list(table.stream())
    return table.arranged(form), form, n, _chars(parts[0]), _chars(parts[1])


# ---------------------------------------------------------------- Spark job
_PIECES = T.ArrayType(T.StructType([T.StructField(f, T.LongType()) for f in ("buffer", "start", "stop")]))


def fill_in_middle(docs: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20, text: str = "text",
                   id_col: str = "doc_id", outputs: bool = True) -> DataFrame:
    """One row for each document: its id, ``n`` units, ``form``, ``prefix_chars``,
    ``middle_chars``, ``pieces`` (the descriptors: buffer 0 is the text, 1 the sentinels, in
    bytes), ``output`` (the text in its form; left out with ``outputs=False``),
    ``output_sha256`` and ``restored_sha256`` (of the text rebuilt from output and form).

    Of a hundred documents ``plain`` stay as they are and ``spm`` of the others put the
    suffix first. Draws depend on the seed and the id alone: reruns and copies of a row
    agree. A null text counts as empty and a null id as the key ''. Empty texts, and texts
    that hold a sentinel, are plain. Texts are cut whole, whatever their length. A narrow
    pass without a shuffle; an empty table gives no rows, other columns are not looked at.
    """
    prepare(docs.sparkSession)
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
              T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
              T.StructField("middle_chars", T.LongType()), T.StructField("pieces", _PIECES),
              T.StructField("output", T.BinaryType()), T.StructField("output_sha256", T.StringType()),
              T.StructField("restored_sha256", T.StringType())]
    if not outputs:
        fields = [f for f in fields if f.name != "output"]
    names = [f.name for f in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            columns: dict[str, list] = {n: [] for n in names[1:]}
            for key, raw in zip(b.column(1).to_pylist(), b.column(2)):
                table, form, n, prefix, middle = transformed(raw.as_buffer(), key, seed, plain, spm)
                output = table.tobytes()
                row = {"n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle,
                       "pieces": [dict(zip(("buffer", "start", "stop"), p)) for p in table.pieces], "output": output,
                       "output_sha256": table.sha256(), "restored_sha256": parsed(output, form).restored(form).sha256()}
                for name, values in columns.items():
                    values.append(row[name])
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(columns[n], _ARROW[n]) for n in names[1:]]], names=names)

    asked = docs.select(F.col(id_col), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"),
                        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    out = asked.mapInArrow(run, T.StructType(fields))
    return out.withColumn("output", F.col("output").cast("string")) if outputs else out


_ARROW = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(),
          "pieces": pa.list_(pa.struct([(f, pa.int64()) for f in ("buffer", "start", "stop")])),
          "output": pa.binary(), "output_sha256": pa.string(), "restored_sha256": pa.string()}


def restore(forms: DataFrame, output: str = "output", form: str = "form", into: str = "text") -> DataFrame:
    """``forms`` with the column ``into``: the text that ``output`` and ``form`` give back.

    A row whose output does not have its form, or whose form is unknown, raises; a null
    output gives null.
    """
    prepare(forms.sparkSession)

    @F.pandas_udf("string")
    def back(outputs, kinds):
        return outputs.combine(kinds, lambda o, k: None if o is None else
                               parsed(o.encode(), k).restored(k).tobytes().decode())

    return forms.withColumn(into, back(F.col(output), F.col(form)))
