import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EDGE_ROWS
from tributary.llm import toxicity as T


def distances(a, b):
    """Edit distances of a to every prefix of b."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


@pytest.mark.parametrize("seed", range(4))
def test_automaton_against_edit_distance(seed):
    rnd = random.Random(seed)
    lexicon = list({e.text: e for e in (T.Entry("".join(rnd.choice("ab") for _ in range(rnd.randint(3, 12))), rnd.random() < 0.4, 1.0)
                                        for _ in range(30))}.values())
    auto = T.Automaton(lexicon)
    for _ in range(2000):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 14)))
        near = []
        for k, e in enumerate(lexicon):
            d = distances(e.text, word)
            d = min(d) if e.stem else d[-1]
            if d <= T.edits_allowed(e):
                near.append((d, k))
        got = auto.match(word)
        assert (got and (got[1], got[0])) == min(near, default=None)


def corpus(n=400):
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                insult = rnd.choice(["blockhead", "numbskull", "vermin" + rnd.choice(["ous", "ly", "esque", "ish", "hood"])])
                words.insert(rnd.randrange(60), insult)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    return d, dict(labels), T.fit_model(d, spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_held_out_accuracy(fitted):
    d, labels, model = fitted
    rows = T.score_documents(d, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_misspelled_terms_are_caught(spark, fitted):
    _, _, model = fitted
    filler = "some plain words that say nothing of note here " * 3
    texts = [filler, filler + "you blokhead and numbskul, you blockhead", filler + "verminoid verminous blockhead blockheed"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.predicted for r in sorted(T.score_documents(df, model).collect())] == [0, 1, 1]


def test_misspelled_stem_forms_are_caught(spark, fitted):
    """Forms that no label showed, misspelled inside of the learned stem."""
    _, _, model = fitted
    stems = [e for e in model.lexicon if e.stem]
    assert stems and all(T.edits_allowed(e) == 1 for e in stems if 5 <= len(e.text) <= 7)
    assert [T.edits_allowed(T.Entry("x" * n, True, 1.0)) for n in (4, 5, 7, 11, 12)] == [0, 1, 1, 1, 2]
    filler = "some plain words that say nothing of note here " * 3
    texts = [filler, filler + "vermniesque and vermniesque", filler + "you varminoid, vvermindom", filler + "such vrminage, virminoid"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.predicted for r in sorted(T.score_documents(df, model).collect())] == [0, 1, 1, 1]


def test_quotation_is_told_from_abuse():
    s = T.Scorer([T.Entry("blockhead", False, 5.0)])
    abuse, quote = s.features("you are a blockhead today"), s.features('the word "blockhead" is old')
    assert abuse[0] > 0 and abuse[2] == 0 and abuse[3] > 0
    assert quote[0] == 0 and quote[2] > 0
    assert s.features(None).tolist() == s.features("").tolist() == [0.0] * T.FEATURES


def test_edge_rows_and_tables(spark, edge, clashing, nothing, fitted):
    model = fitted[2]
    rows = T.score_documents(clashing, model).collect()
    assert len(rows) == len(EDGE_ROWS) and {r.doc_id for r in rows} == {r[0] for r in EDGE_ROWS}
    assert T.score_documents(nothing, model).collect() == []
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.predicted for r in T.score_documents(edge, T.fit_model(edge, none)).collect()} == {0}
    odd = spark.createDataFrame([(1, None), (None, 1), (5, 1), (5, 1), (6, 1), (7, 1), (8, 1)], "doc_id bigint, toxic int")
    assert {r.predicted for r in T.score_documents(edge, T.fit_model(edge, odd)).collect()} == {1}


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    lab = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    flipped = lab.withColumn("toxic", F.when(T.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.fit_model(d, lab) == T.fit_model(d, flipped)
