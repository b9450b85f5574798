import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import EDGE_ROWS
from tributary.llm import pieces as P
from tributary.llm.queries import PIECE_MODEL, vocabulary

MODEL = vocabulary(PIECE_MODEL)
ODD = ["", None, " ", "  a  b\n\nc\t", "é日本語テキスト 한국어 \U0001f600", "x" * 200, "a" + " " * 100 + "b", "<s> <0x0A> </s> <unk>",
       "\x00\x01 ab", "日本語のながいテキストです" * 20]


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_without_dropout_ids_are_the_library_s(lib):
    texts = ODD + [r[1] for r in EDGE_ROWS if r[1] and "▁" not in r[1]]
    enc = P.Encoder(MODEL, 1, 0.0, 8)
    assert [x.tolist() for x in enc.encode(texts, [5] * len(texts))] == [lib.encode(t or "") for t in texts]


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.0])
def test_every_segmentation_decodes_to_the_text(lib, rate):
    texts = ODD + ["a▁b ▁ c￿▁", "▁"] + [r[1] for r in EDGE_ROWS]
    enc = P.Encoder(MODEL, 7, rate, 8)
    for t, ids in zip(texts, enc.encode(texts, list(range(len(texts))))):
        assert enc.decode(ids) == (t or "")
        if t and "▁" not in t and "\x00" not in t:
            assert lib.decode(ids.tolist()) == t


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdetionsr▁é日", min_size=1, max_size=60), st.integers(0, 7), st.sampled_from([0.0, 0.1, 0.5]))
def test_many_words_at_once_equal_the_agenda(word, variant, rate):
    seg = P.Segmenter(PIECES, 3, rate)
    many = seg.many([word, "▁other", word], [variant, 0, variant])
    assert np.frombuffer(many[0], "<i4").tolist() == seg.one(word, variant)
    assert many[0] == many[2]


PIECES = P.Pieces(MODEL)


def test_segmentations_are_seeded_and_varied():
    words = ["▁international"] * 40
    one = P.Segmenter(PIECES, 1, 0.2).many(words, list(range(40)))
    assert one == P.Segmenter(PIECES, 1, 0.2).many(words, list(range(40)))
    assert one != P.Segmenter(PIECES, 2, 0.2).many(words, list(range(40)))
    assert len(set(one)) > 5
    skipped = P.Segmenter(PIECES, 1, 0.2)._skipped(np.arange(20000, dtype=np.uint64), *[np.arange(20000)] * 3)
    assert abs(skipped.mean() - 0.2) < 0.02


def test_edge_rows_round_trip(edge, clashing, nothing):
    for df in (edge, clashing):
        out = P.encode_pieces(df, MODEL, 9, 0.1, keep=("source",))
        rows = P.decode_pieces(out, MODEL).collect()
        assert all(r.lossless and r.n_ids == len(r.piece_ids) for r in rows)
        assert len(rows) == len(EDGE_ROWS)
        assert {(r.doc_id, r.text) for r in rows} == {(r[0], r[1] or "") for r in EDGE_ROWS}
    assert P.encode_pieces(nothing, MODEL, 9, 0.1).collect() == []


def test_rows_of_one_id_and_text_are_alike(edge):
    rows = [r for r in P.encode_pieces(edge, MODEL, 9, 0.1).collect() if r.doc_id == 8]
    assert len(rows) == 2 and rows[0].ids_crc32 == rows[1].ids_crc32


def test_every_occurrence_draws_for_itself():
    """A frequent word has as many segmentations as the draws give, neighbours too; each is the agenda's."""
    text = " ".join(["international"] * 3000 + ["a", "日本語", "x" * 60, "réseau"] * 5)
    enc = P.Encoder(MODEL, 5, 0.1)
    ids = enc.encode([text, "short", text], [11, 12, 13])
    first, _, other = (x.tolist() for x in ids)
    assert first != other
    words = enc._words(text)
    own = [enc.seg.one(w, int(v)) for w, v in zip(words, enc.draws(11, len(words)))]
    assert first == [i for each in own for i in each]
    kinds = {tuple(x) for x in own[:3000]}
    assert len(kinds) > 20


def test_words_met_once_get_no_node():
    """A tree node costs several merges of its word; who comes by once is merged alone, to the same ids."""
    text = " ".join(["alpha", "bravo", "charlie", "alpha"])
    enc = P.Encoder(MODEL, 5, 0.5)
    first = next(enc.encode([text], [3])).tolist()
    words = enc._words(text)
    assert set(enc.tree.root) == {"▁alpha"} and enc.tree.met == {"▁bravo", "▁charlie"}
    assert first == [i for w, v in zip(words, enc.draws(3, 4)) for i in enc.seg.one(w, int(v))]
    assert next(enc.encode([text], [3])).tolist() == first and len(enc.tree.root) == 3
