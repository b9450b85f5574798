import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EDGE_ROWS
from tributary.llm import repeats as R
from tributary.llm.queries import QUERIES


def brute(rows, length):
    octets = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + length] for _, b in octets for p in range(len(b) - length + 1))
    out = []
    for i, b in octets:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df, length, **kw):
    n = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    cut = R.cut_repeats(df, length, **kw)
    return sorted((tuple(r) for r in cut.select("doc_id", "n_bytes", n, F.size("removed"), F.sha2("kept", 256)).collect()), key=repr)


def random_rows():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 120))) for _ in range(12)]
    rows = []
    for i in range(50):
        parts = [rnd.choice(base)[rnd.randint(0, 30):][:rnd.randint(5, 100)] if rnd.random() < 0.6
                 else rnd.choice(["a" * 27, "xyé", "\n", "ab" * 20]) for _ in range(rnd.randint(0, 6))]
        rows.append((i, "".join(parts)))
    return rows + [(100, None), (101, ""), (3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (None, None)]


@pytest.mark.parametrize("length,gram,most", [(20, 5, 2048), (20, 5, 1), (12, 12, 2048), (30, 8, 1)])
def test_random_rows_against_brute_force(spark, length, gram, most):
    """``most`` 1 sends every class through the distributed count of windows."""
    rows = random_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(df, length, gram=gram, class_stretches=most) == brute(rows, length)


def test_edge_rows(edge, clashing, nothing):
    want = brute([r[:2] for r in EDGE_ROWS], 400)
    assert got(edge, 400) == want and got(clashing, 400) == want
    assert got(nothing, 400) == []


def test_text_longer_than_a_buffer(spark, monkeypatch):
    monkeypatch.setattr(R, "BUFFER", 200)
    rnd = random.Random(1)
    a = "".join(rnd.choice("abcdefgh") for _ in range(900))
    parts = [p for texts, _, _ in R._buffers([a.encode(), b"short"], 50) for p in texts]
    windows = {p[i:i + 50] for p in parts for i in range(len(p) - 49)}
    assert windows == {a.encode()[i:i + 50] for i in range(len(a) - 49)}


def test_a_buffer_of_short_texts_alone(spark):
    """Together they have the bytes of a window, none of them has."""
    for texts in ([b"a" * 250, b"b" * 300], [b"x" * 399, b"y"], [b"c" * 399] * 400):
        assert [len(x) for x in R.stretches(texts, 400, R.GRAM)] == [0] * 6
    rows = [(i, c * 399) for i, c in enumerate("aabcde")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert got(df, 400) == brute(rows, 400)
    long = [(9, "z" * 399 + "y" * 30), (8, "z" * 399 + "y" * 30)]
    df = df.unionAll(spark.createDataFrame(long, "doc_id bigint, text string").coalesce(1))
    assert got(df, 400) == brute(rows + long, 400)


def test_suffix_order_is_sorted_and_neighbours_are_exact():
    rnd = random.Random(3)
    parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 30))) for _ in range(200)]
    group = np.sort(np.array([rnd.randint(0, 9) for _ in parts]))
    order, common = R.sorted_neighbours(parts, group)
    for k, (i, n) in enumerate(zip(order, common)):
        if n < 0:
            assert k == 0 or group[order[k - 1]] != group[i]
            continue
        a, b = parts[order[k - 1]], parts[i]
        assert group[order[k - 1]] == group[i] and a <= b
        same = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert same == n


def test_a_hash_collision_is_found_and_sorted_again(monkeypatch):
    real = R.Hashed.of
    monkeypatch.setattr(R, "_powers", lambda n, attempt, f=R._powers: f(n, attempt))
    monkeypatch.setattr(R.Hashed, "__init__", lambda self, o, attempt=0, f=R.Hashed.__init__: (f(self, o, attempt), setattr(self, "attempt", attempt))[0])
    monkeypatch.setattr(R.Hashed, "of", lambda self, s, n: real(self, s, n) * np.uint64(self.attempt > 0))
    order, common = R.sorted_neighbours([b"b", b"ab", b"aa"], np.zeros(3, int))
    assert order.tolist() == [2, 1, 0] and common.tolist() == [-1, 1, 0]


def test_one_row_repeated_a_hundred_thousand_times(spark):
    """Its text is read once a task, and its spans are few."""
    text = "".join(chr(97 + i * i % 23) for i in range(90)) + "tail one"
    many = spark.range(100_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit(text).alias("text")).repartition(8)
    other = spark.createDataFrame([(8, "xx" + text[20:70] + "yy"), (9, "nothing of it, and long enough to be judged")], "doc_id bigint, text string")
    spans = R.find_repeats(many.unionByName(other), 20, gram=5).distinct()
    assert spans.where("id = 7").count() < 200
    n = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    out = R.cut_repeats(many.unionByName(other), 20, gram=5).select("doc_id", n.alias("n"), F.sha2("kept", 256).alias("h"))
    got = {(r.doc_id, r.n, r.h): r["count"] for r in out.groupBy("doc_id", "n", "h").count().collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == {(7, 98, sha(b"")): 100_000, (8, 50, sha(b"xxyy")): 1, (9, 0, sha(b"nothing of it, and long enough to be judged")): 1}


def test_the_query_removes_passages_of_over_50_words_from_400_bytes_on(spark, tmp_path):
    """Told by n_removed and repeated; n_bytes is the size of the input, whatever is removed."""
    rnd = random.Random(9)
    words = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    rows, planted = [], {}
    for size in (399, 400, 450, 399, 400):
        passage = words(70)[:size - 1] + "z"
        assert len(passage.split()) > 50
        for _ in range(2):  # the bytes on both sides differ
            i = len(rows)
            planted[i] = size if size >= 400 else 0
            rows.append((i, f"{words(rnd.randint(5, 120))} {i % 2}{passage}{i % 2} {words(rnd.randint(5, 120))}"))
    rows += [(len(rows) + k, words(rnd.randint(60, 300))) for k in range(10)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op2_suffix_repeats"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.repeated) for r in out} == {
        i: (len(t), planted.get(i, 0), planted.get(i, 0) > 0) for i, t in rows}
    assert sorted((tuple(r)[:5] for r in out), key=repr) == brute(rows, 400)


def task_functions(df, monkeypatch, **kw):
    """The functions that find_repeats hands to mapInArrow, by name."""
    found, real = {}, type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **b: (found.setdefault(f.__name__, f), real(self, f, *a, **b))[1])
    R.find_repeats(df, 20, gram=5, **kw)
    return found


def test_windows_of_large_classes_are_handed_on_in_lots(spark, monkeypatch):
    """One batch of long texts has many windows: they are not gathered before they are handed on."""
    df = spark.createDataFrame(random_rows(), "doc_id bigint, text string")
    read = task_functions(df, monkeypatch, class_stretches=1)["read"]
    texts, size = ["".join(chr(97 + (i * k) % 23) for k in range(4000)) for i in range(50)], 4000 - 19
    want = pa.array([[{"g": 1, "n": 1, "kinds": 9, "first": a, "last": min(a + 14, size - 1), "at": a + 15} for a in range(0, size, 15)]
                     for _ in texts], pa.list_(pa.struct([(c, pa.int64()) for c in ("g", "n", "kinds", "first", "last", "at")])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(range(50)), pa.array(texts), want], ["id", "th", "text", "want"])
    out = list(read([batch]))
    assert max(len(b) for b in out) <= 32768 + 15
    rows = [(r["id"], r["first"], r["last"], r["at"], r["bytes"], r["d1"], r["d2"]) for b in out for r in b.to_pylist()]
    digest = lambda i, p: np.frombuffer(hashlib.blake2b(texts[i][p:p + 20].encode(), digest_size=16).digest(), "<i8").tolist()
    assert rows == [(i, p, p, p // 15 * 15 + 15, None, *digest(i, p)) for i in range(50) for p in range(size)]


def test_repeats_of_a_row_are_dropped_before_a_class_is_held(spark, monkeypatch):
    """A row that many tasks have is read in each of them; what they read of it is held once."""
    df = spark.createDataFrame(random_rows(), "doc_id bigint, text string")
    sort = task_functions(df, monkeypatch)["sort"]
    alive = []

    def batches():
        for th, tail in ((1, b"x"), (2, b"y")):
            for _ in range(100):  # sorted by class, text and place
                alive.append(pa.total_allocated_bytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([7] * 500), pa.array([1] * 500), *(pa.array([v] * 500) for v in (3, 5, 6)),
                     pa.array([b"a" * 21 + tail] * 500), pa.array([9 + th] * 500), pa.array([th] * 500)],
                    ["g", "n", "first", "last", "at", "bytes", "id", "th"])

    got = sorted(tuple(r.values()) for b in sort(batches()) for r in b.to_pylist())
    assert max(alive) - alive[0] < 500_000  # a batch has 40,000 bytes
    assert got == [(10, 1, 3, 4), (11, 2, 3, 4)]
