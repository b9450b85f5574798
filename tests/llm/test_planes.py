import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import EDGE_ROWS
from tributary.llm import planes
from tributary.llm.queries import END_ID, WORD_VOCABULARY, vocabulary
from tributary.session import scratch_dir


def brute(rows):
    from tokenizers import Tokenizer

    t, out, start = Tokenizer.from_file(vocabulary(WORD_VOCABULARY)), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [END_ID], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def written(spark, df, **kw):
    return planes.write_token_files(df, scratch_dir(spark, "planes"), vocabulary(WORD_VOCABULARY), END_ID, **kw)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_edge_rows_against_the_library(spark, edge, clashing, kind):
    for df in (edge, clashing):
        files = written(spark, df, kind=kind, block=1000)
        back = sorted((tuple(r) for r in planes.read_token_files(files).collect()), key=lambda r: r[1])
        assert back == brute([r[:2] for r in EDGE_ROWS])


def test_ids_come_back(spark, edge):
    rows = planes.read_token_files(written(spark, edge), with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_empty_table(spark, nothing):
    assert planes.read_token_files(written(spark, nothing)).collect() == []


def test_words_that_need_the_whole_tokenizer():
    from tokenizers import Tokenizer

    path = vocabulary(WORD_VOCABULARY)
    texts = ["<|endoftext|> x<|startoftext|>y", "a\x1cb", "Σας İ", "é ́a", "I'll don't 's", "a b", "12 x3,", "!?", None]
    lib = Tokenizer.from_file(path)
    got = [np.frombuffer(b"".join(p), "<u4").tolist() for p in planes.encoder(path).batch(texts)]
    assert got == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_other_vocabulary_is_given_whole_texts():
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    lib, texts = Tokenizer.from_file(path), ["a  b\nc", "", "日本"]
    got = [np.frombuffer(b"".join(p), "<u4").tolist() for p in planes.encoder(path).batch(texts)]
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=30), max_size=8), st.sampled_from(["byte", "bit"]), st.integers(1, 17))
def test_round_trip(docs, kind, block):
    out = io.BytesIO()
    w = planes.PlaneWriter(out, kind, block)
    for d in docs:
        w.add(np.array(d, "<u4"))
    w.close(pa.table({"id": list(range(len(docs)))}))
    size = out.tell()
    out.seek(0)
    r = planes.PlaneReader(out, size)
    flat = [x for d in docs for x in d]
    for a in range(0, len(flat), 5):
        assert [int(x) for part in r.ids(a, len(flat)) for x in part] == flat[a:]
    assert r.docs.num_rows == len(docs)
