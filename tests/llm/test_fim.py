"""Fill-in-middle by piece tables against plain string work, and exact round trips."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import fim
from tributary.llm.queries import op12_piece_table

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def plain_python(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by lists of strings."""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


TEXT = st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abC <P>SM\n")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 10**6), TEXT)
def test_tables_equal_string_work_and_come_back(doc_id, text):
    raw = text.encode()
    table, form, n, prefix, middle = fim.transformed(raw, str(doc_id), 1, 10, 20)
    want = plain_python(doc_id, text)
    assert (n, form, prefix, middle, table.tobytes().decode()) == want
    assert table.sha256() == sha(want[4])
    assert table.restored(form).tobytes() == raw                      # by the inverse permutation
    assert fim.parsed(table.tobytes(), form).restored(form).tobytes() == raw  # from output and form alone


def test_buffers_are_shared_and_cuts_only_split_descriptors():
    table = fim.PieceTable(b"abcdef")
    table.cut(4)
    table.cut(2)
    assert table.pieces == [(0, 0, 2), (0, 2, 4), (0, 4, 6)] and table.tobytes() == b"abcdef"
    psm, spm = table.arranged("psm"), table.arranged("spm")
    assert psm.tobytes() == b"<P>ab<S>ef<M>cd" and spm.tobytes() == b"<S>ef<P>ab<M>cd"
    assert psm.buffers[0].obj is table.buffers[0].obj
    with pytest.raises(IndexError):
        table.cut(7)


def test_half_sentinels_at_the_seams():
    for pre, mid, suf in (("<P", "<M", "<S"), ("<", "<", "<"), ("", "", ""), ("x<M", "P>", "S>"), ("a<S", "", "<M")):
        raw = (pre + mid + suf).encode()
        if any(s in raw for s in (b"<P>", b"<S>", b"<M>")):
            continue
        for form in fim.FORMS:
            table = fim.PieceTable(raw)
            table.cut(len(pre + mid))
            table.cut(len(pre))
            assert fim.parsed(table.arranged(form).tobytes(), form).restored(form).tobytes() == raw


def test_a_text_without_its_form_raises():
    with pytest.raises(ValueError, match="psm"):
        fim.parsed(b"no sentinels", "psm")


def test_query_on_all_documents(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op12_piece_table(spark, sf).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        want = plain_python(i, text)
        assert tuple(got[i][1:5]) == want[:4]
        assert (got[i].output_sha256, got[i].restored_sha256) == (sha(want[4]), sha(text))


def test_edges_outputs_and_restore(spark, edge, nothing, clashing):
    out = fim.fill_in_middle(edge)
    back = fim.restore(out).collect()
    by_text = sorted((r.doc_id or 0, r.text, r.output, r.restored_sha256) for r in back)
    assert by_text == sorted((r.doc_id or 0, r.text or "", plain_python(r.doc_id, r.text or "")[4], sha(r.text or "")) for r in edge.collect())
    for r in back:
        raw = (r.text.encode(), fim.SENTINELS)
        assert b"".join(raw[p.buffer][p.start:p.stop] for p in r.pieces).decode() == r.output
    assert fim.fill_in_middle(clashing, outputs=False).count() == edge.count()
    assert fim.fill_in_middle(nothing).collect() == []
    assert fim.restore(spark.createDataFrame([(None, "psm")], "output string, form string")).first().text is None
