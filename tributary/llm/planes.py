"""Token ids in files of shuffled planes.

Ids are cut into blocks of a fixed size. Each block is transposed into byte planes
(the first bytes of all ids, the second bytes, ..) or bit planes, and each plane is
compressed with zstandard by itself. A file ends with a chunk index and the table of
its documents, so any document can be read without the blocks before it.

File: 8 bytes ``PLANES01``, the compressed planes, the footer (compressed JSON
and an Arrow table of documents), then 24 bytes: footer start, two footer lengths.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import prepare, shuffle_partitions, staged

MAGIC = b"PLANES01"
BLOCK_IDS = 1 << 16
LEVEL = 3
#: Forms of words that a Python worker remembers with their ids, in each of two generations.
REMEMBERED = 800_000
#: Long texts are tokenized in pieces of about so many characters, cut at spaces.
PIECE_CHARS = 1 << 20


# ---------------------------------------------------------------- blocks and planes
def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of one block of ids, from the lowest byte or bit to the highest."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [p.tobytes() for p in np.ascontiguousarray(octets.T)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [p.tobytes() for p in np.packbits(np.ascontiguousarray(bits.T), axis=1)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    rows = np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), -1)
    if kind == "byte":
        octets = np.ascontiguousarray(rows.T)
    else:
        bits = np.unpackbits(rows, axis=1)[:, :n]
        octets = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return octets.reshape(-1).view("<u4").copy()


class PlaneWriter:
    """Writes ids to an open binary stream, block by block."""

    def __init__(self, out, kind: str = "byte", block: int = BLOCK_IDS):
        if kind not in ("byte", "bit"):
            raise ValueError(f"planes are of bytes or bits, not {kind!r}")
        self.out, self.kind, self.block = out, kind, block
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.at, self.total, self.waiting, self.have, self.chunks = len(MAGIC), 0, [], 0, []
        out.write(MAGIC)

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.have += len(ids)
        self.total += len(ids)
        if self.have >= self.block:
            self._drain(self.have // self.block)

    def _drain(self, blocks: int) -> None:
        ids = np.concatenate(self.waiting)
        for i in range(blocks):
            self._chunk(ids[i * self.block:(i + 1) * self.block])
        rest = ids[blocks * self.block:].copy()
        self.waiting, self.have = [rest], len(rest)

    def _chunk(self, ids: np.ndarray) -> None:
        packed = [self.pack(p) for p in to_planes(ids, self.kind)]
        self.out.write(b"".join(packed))
        sizes = [len(p) for p in packed]
        self.chunks.append([self.at, len(ids), sizes])
        self.at += sum(sizes)

    def close(self, docs: pa.Table) -> None:
        if self.have:
            self._chunk(np.concatenate(self.waiting))
        head = self.pack(json.dumps({"kind": self.kind, "block": self.block, "chunks": self.chunks}).encode())
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema) as stream:
            stream.write_table(docs)
        table = self.pack(sink.getvalue().to_pybytes())
        self.out.write(head + table + struct.pack("<QQQ", self.at, len(head), len(table)))


class PlaneReader:
    """Reads a file of planes: ``docs`` is its document table, ``ids(a, b)`` a run of ids."""

    def __init__(self, stream, size: int):
        self.stream, self.last = stream, (-1, None)
        self.unpack = zstandard.ZstdDecompressor().decompress
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a file of planes")
        at, n_head, n_table = struct.unpack("<QQQ", self._read(size - 24, 24))
        head = json.loads(self.unpack(self._read(at, n_head)))
        self.kind, self.block, self.chunks = head["kind"], head["block"], head["chunks"]
        with pa.ipc.open_stream(self.unpack(self._read(at + n_head, n_table))) as t:
            self.docs = t.read_all()

    def _read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def _block(self, k: int) -> np.ndarray:
        if self.last[0] != k:
            at, n, sizes = self.chunks[k]
            raw, planes = self._read(at, sum(sizes)), []
            for size in sizes:
                planes.append(self.unpack(raw[:size]))
                raw = raw[size:]
            self.last = (k, from_planes(planes, n, self.kind))
        return self.last[1]

    def ids(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids from start to stop, in parts of a block at most."""
        while start < stop:
            k, off = divmod(start, self.block)
            part = self._block(k)[off:off + stop - start]
            yield part
            start += len(part)


# ---------------------------------------------------------------- tokenizing in tasks
#: What the word-wise way below rests on; another tokenizer is given whole texts.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_PRE = ["Split", "ByteLevel"]
#: Latin letters and closing marks: lower case and byte level are plain for them, and the
#: letters and the marks are one token run each.
_SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)").fullmatch


def _byte_level() -> list[str]:
    """The printable character that byte-level models use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class _Encoder:
    """The tokenizers library, asked once for each form of a word.

    White space parts the words of a word-wise vocabulary and is dropped by it, so a
    text's ids are those of its words in order. Words are cut at spaces, line ends and
    tabs only; other white space stays inside a word and is left to the library. Words of
    plain letters go straight to the library's model, other new words through the whole
    tokenizer, many at a time, parted by a special token that the words themselves lack.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib, self.known, self.older, self.runs = Tokenizer.from_file(path), {"": b""}, {}, {"": b""}
        self.lib.no_padding()
        self.lib.no_truncation()
        names = [t.content for t in self.lib.get_added_tokens_decoder().values() if t.special]
        self.part = names[0] if names else None
        self.part_id = self.lib.token_to_id(self.part) if names else None
        spec = json.loads(self.lib.to_str())
        self.by_word = bool(names) and all(n.startswith("<|") for n in names) and (
            [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])] == _NORMAL
            and [x["type"] for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])] == _PRE
            and not spec["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"]
            and "\\s\\p{L}\\p{N}" in spec["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex", ""))
        self.level = _byte_level()

    def _run(self, run: str) -> bytes:
        """The ids of letters in lower case, or of marks."""
        if (ids := self.runs.get(run)) is None:
            level = run if run.isascii() else "".join(map(self.level.__getitem__, run.encode()))
            ids = self.runs[run] = array("I", [t.id for t in self.lib.model.tokenize(level)]).tobytes()
        return ids

    def _learn(self, words: list[str]) -> None:
        if len(self.runs) > REMEMBERED:
            self.runs = {"": b""}
        known, run, rest = self.known, self._run, []
        for w in words:
            if (m := _SIMPLE(w)) is None:
                rest.append(w)
            else:
                known[w] = run(m[1].lower()) + run(m[2])
        plain = [w for w in rest if "<|" not in w]
        for i in range(0, len(plain), 2000):
            some = plain[i:i + 2000]
            ids = np.array(self.lib.encode_batch_fast([self.part.join(some)], add_special_tokens=False)[0].ids, "<u4")
            raw, cuts = ids.tobytes(), (np.flatnonzero(ids == self.part_id) * 4).tolist()
            for w, a, b in zip(some, [-4, *cuts], [*cuts, len(raw)]):
                known[w] = raw[a + 4:b]
        odd = [w for w in rest if "<|" in w]
        for w, e in zip(odd, self.lib.encode_batch_fast(odd, add_special_tokens=False) if odd else []):
            known[w] = np.array(e.ids, "<u4").tobytes()

    def batch(self, texts: list[str | None]) -> Iterator[list[bytes]]:
        """For each text, its ids as little-endian 32-bit integers, in parts."""
        if not self.by_word:
            for e in self.lib.encode_batch_fast([t or "" for t in texts], add_special_tokens=False):
                yield [np.array(e.ids, "<u4").tobytes()]
            return
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {"": b""}
        get = self.known.get
        split = [[p.replace("\n", " ").replace("\t", " ").split(" ") for p in _pieces(t or "")] for t in texts]
        found, missing = [], set()
        for pieces in split:
            for words in pieces:
                ids = list(map(get, words))
                open_ = [k for k, i in enumerate(ids) if i is None]
                missing.update([words[k] for k in open_])
                found.append((ids, open_, words))
        new = []
        for w in missing:
            if (ids := self.older.get(w)) is None:
                new.append(w)
            else:
                self.known[w] = ids
        self._learn(new)
        rest = iter(found)
        for pieces in split:
            parts = []
            for ids, open_, words in itertools.islice(rest, len(pieces)):
                for k in open_:
                    ids[k] = get(words[k])
                parts.append(b"".join(ids))
            yield parts


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = text.find(" ", start + PIECE_CHARS)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


_ENCODERS: dict[str, _Encoder] = {}


def encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def _grouped(texts: list[str | None], most: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` characters together."""
    a, have = 0, 0
    for i, t in enumerate(texts):
        have += len(t or "")
        if have >= most:
            yield a, i + 1
            a, have = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


# ---------------------------------------------------------------- Spark jobs
def write_token_files(docs: DataFrame, root: str, vocabulary: str, end_id: int, text: str = "text",
                      id_col: str = "doc_id", kind: str = "byte", block: int = BLOCK_IDS) -> DataFrame:
    """Tokenizes ``docs`` and writes them in ascending id order to files under ``root``.

    Returns the written files: shard, path, n_docs, n_tokens. A file holds one range of
    ids; shards are numbered in the order of these ranges. Null ids come first, rows of
    one id are ordered by their text. A null or empty text is the end id alone. Names
    are unique to the task attempt, and only files of finished tasks are listed.
    """
    spark = docs.sparkSession
    prepare(spark)
    ordered = (docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
               .repartitionByRange(F.col("id")).sortWithinPartitions("id", "text"))
    tail = np.array([end_id], "<u4")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out, ids, counts = TaskContext.get().partitionId(), None, [], []
        for b in batches:
            if out is None:
                files, folder = pafs.FileSystem.from_uri(root)
                files.create_dir(folder, recursive=True)
                name = f"part-{part:06d}-{uuid.uuid4().hex}.planes"
                out = files.open_output_stream(f"{folder}/{name}")
                planes, enc = PlaneWriter(out, kind, block), encoder(vocabulary)
            texts = b.column(1).to_pylist()
            for i, j in _grouped(texts):
                for parts in enc.batch(texts[i:j]):
                    n = 1
                    for raw in parts:
                        planes.add(np.frombuffer(raw, "<u4"))
                        n += len(raw) // 4
                    planes.add(tail)
                    counts.append(n)
            ids.append(b.column(0))
        if out is not None:
            planes.close(pa.table({"id": pa.chunked_array(ids), "n": pa.array(counts, pa.int64())}))
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [part], "path": [f"{root}/{name}"], "n_docs": [len(counts)],
                                              "n_tokens": [planes.total]}, schema=MANIFEST_ARROW)

    return staged(ordered.mapInArrow(write, MANIFEST), "token-files")


MANIFEST = "shard int, path string, n_docs bigint, n_tokens bigint"
MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                            ("n_tokens", pa.int64())])


def read_token_files(files: DataFrame, id_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """One row per document of the written files: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it, over all files. With ``with_ids``
    the ids follow as an array.
    """
    spark = files.sparkSession
    prepare(spark)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file; the files are far fewer than the documents
    based = files.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    based = based.repartition(shuffle_partitions(spark))
    schema = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def read(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, base in zip(frame["path"], frame["base"]):
                source, name = pafs.FileSystem.from_uri(path)
                with source.open_input_file(name) as stream:
                    reader = PlaneReader(stream, stream.size())
                    counts = reader.docs.column("n").to_numpy()
                    starts = np.cumsum(counts) - counts
                    for a in range(0, len(counts), 2000):
                        crcs, lists = [], []
                        for at, n in zip(starts[a:a + 2000], counts[a:a + 2000]):
                            crc, own = 0, []
                            for part in reader.ids(int(at), int(at + n)):
                                crc = zlib.crc32(part.tobytes(), crc)
                                if with_ids:
                                    own.append(part.astype(np.int32))
                            crcs.append(crc)
                            if with_ids:
                                lists.append(np.concatenate(own))
                        out = pd.DataFrame({
                            "doc_id": reader.docs.column("id")[a:a + 2000].to_pandas(integer_object_nulls=True),
                            "start": starts[a:a + 2000] + base, "n_tokens": counts[a:a + 2000], "ids_crc32": crcs})
                        yield out.assign(ids=lists) if with_ids else out

    return based.mapInPandas(read, schema)
