"""Token counts against the tokenizers library's own encoding."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm import counts
from tributary.llm.queries import TOKEN_LIMIT, WORD_VOCABULARY, op11_whole_tokens, vocabulary

FILES = [WORD_VOCABULARY, "byte_bpe_50k.json"]


@pytest.fixture(scope="module")
def own():
    return {f: counts.Counter(vocabulary(f), counts.prove_whole(vocabulary(f))) for f in FILES}


@pytest.fixture(scope="module")
def lib():
    return {f: Tokenizer.from_file(vocabulary(f)) for f in FILES}


def want(lib, text):
    return len(lib.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("file", FILES)
def test_proved_strings_are_one_token_and_the_rest_is_not(own, lib, file):
    """Every proved string of plain letters, encoded by the library as a text of its own."""
    words = [w for w in own[file].whole if w.isascii() and w.isalpha() and w.islower()]
    assert len(words) > 10_000
    assert all(len(e.ids) == 1 for e in lib[file].encode_batch(words, add_special_tokens=False))
    assert "qzxvk" not in own[file].whole


def test_a_vocabulary_string_that_never_comes_out_is_not_proved(tmp_path):
    """Being in the vocabulary is no proof: an earlier merge takes a part of ``abc``."""
    from tokenizers import models

    names = ["a", "b", "c</w>", "bc</w>", "ab", "abc</w>", "b</w>", "ab</w>", "c"]
    merges = [("b", "c</w>"), ("a", "b"), ("ab", "c</w>"), ("a", "b</w>")]
    path = str(tmp_path / "small.json")
    Tokenizer(models.BPE({n: i for i, n in enumerate(names)}, merges, end_of_word_suffix="</w>")).save(path)
    whole = counts.prove_whole(path)
    assert whole == {"c", "bc", "b", "ab"}
    own, lib = counts.Counter(path, whole), Tokenizer.from_file(path)
    for text in ("abc", "ab", "bc", "abab", ""):
        assert own.count(text) == want(lib, text)


ODD = ["", " ", "\n\t ", "it's they'RE 'TIS o'clock", "a\x1cb\x85c d e", "<|endoftext|>", "x<|endoftext|>y <|startoftext|>",
       "<|ENDOFTEXT|> <|endoftext", "ΟΔΥΣΣΕΥΣ İstanbul ẞ ﬁ", "é ́x Å", "日本語 テスト 한국어", "😀👍🏽 x", "12,345.67 ½ Ⅳ ٣",
       "antidisestablishmentarianism" * 40, "z" * 5000, "!" * 3000, "a" * 70 + " " + "b" * 70, "\r\n\v\f"]


@pytest.mark.parametrize("file", FILES)
@pytest.mark.parametrize("text", ODD)
def test_odd_texts(own, lib, file, text):
    assert own[file].count(text) == want(lib[file], text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab 'sT\n<|>endoftext")), max_size=60))
def test_any_text(text):
    file = vocabulary(WORD_VOCABULARY)
    if "lib" not in test_any_text.__dict__:
        test_any_text.lib, test_any_text.own = Tokenizer.from_file(file), counts.Counter(file, counts.prove_whole(file))
    assert test_any_text.own.count(text) == want(test_any_text.lib, text)


def test_long_texts_are_counted_piece_by_piece(own, lib, monkeypatch):
    text = "The quick brown fox, it's 12 o'clock <|endoftext|> naïve " * 300
    monkeypatch.setattr(counts, "PIECE_CHARS", 100)
    assert own[WORD_VOCABULARY].count(text) == want(lib[WORD_VOCABULARY], text)


def test_forgetting_changes_nothing(lib, monkeypatch):
    monkeypatch.setattr(counts, "REMEMBERED", 3)
    file = vocabulary(WORD_VOCABULARY)
    c = counts.Counter(file, counts.prove_whole(file))
    for text in ("one two three four five", "six seven eight", "one two qzxvk"):
        assert c.count(text) == want(lib[WORD_VOCABULARY], text)


def test_other_models_are_refused(tmp_path):
    from tokenizers import models

    path = tmp_path / "wordlevel.json"
    Tokenizer(models.WordLevel({"a": 0, "?": 1}, unk_token="?")).save(str(path))
    with pytest.raises(ValueError, match="byte-pair"):
        counts.prove_whole(str(path))


def test_query_equals_the_library_on_all_documents(spark, sf, lib):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op11_whole_tokens(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        n = want(lib[WORD_VOCABULARY], texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > TOKEN_LIMIT)


def test_edges(spark, edge, nothing, clashing, lib):
    file = vocabulary(WORD_VOCABULARY)
    rows = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in counts.count_tokens(edge, file).collect())
    assert rows == sorted((r.doc_id or 0, len((r.text or "").encode()), want(lib[WORD_VOCABULARY], r.text or "")) for r in edge.collect())
    assert counts.count_tokens(clashing, file).count() == edge.count()
    assert counts.count_tokens(nothing, file).collect() == []
