"""Toxicity scores from a lexicon matched with Levenshtein automata.

The lexicon (words and word stems) is learned from labelled documents. It is a trie; the
Levenshtein automaton of all its entries together is run over the trie and made
deterministic as it goes, so that a word is matched, misspelled or not, in one pass over
its letters. Every hit is then seen in its window of neighbouring words: quotation marks
around it and words of reporting speak for a quotation, words of address for abuse. A
logistic model of these window scores gives the document's score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import prepare


#: Labelled documents that the lexicon and the model are fitted on, by a hash of their id.
FIT_ROWS = 8000
MIN_SUPPORT, SUPPORT_SHARE, MIN_ODDS = 3, 0.004, 20.0
STEM_SIZES = (4, 5, 6, 7)
#: Words before and after a hit.
WINDOW = 6
#: Words that a Python worker remembers.
REMEMBERED = 400_000
RIDGE = 1.0

# fixed values: marks and common words of quotation, report and address
_OPEN, _CLOSE = "\"'“‘«„‚", "\"'”’»“‘"
_REPORT = frozenset("said says called word words term quote quoted wrote dit écrit mot sagte schrieb wort dijo escribió palabra".split())
_ADDRESS = frozenset("you your you're yourself du dich dir ihr tu te toi vous tú usted ustedes eres".split())
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”‘’«»„‚…–—¿¡"


class Entry(NamedTuple):
    text: str
    stem: bool
    weight: float


def plain(token: str) -> str:
    return token.strip(_EDGE).lower()


def edits_allowed(entry: Entry) -> int:
    """Short entries must match exactly; a stem leaves its ending free and so allows fewer."""
    n = len(entry.text)
    return 0 if n < 5 else 1 if n < (12 if entry.stem else 9) else 2


# ---------------------------------------------------------------- the automaton
class Automaton:
    """All words within the allowed edits of a lexicon entry; states are made when first met.

    A state is a set of (trie node, edits so far), closed under left-out letters. A stem
    that is reached stays reached, whatever follows.
    """

    def __init__(self, lexicon: list[Entry]):
        self.lexicon = lexicon
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most = [0]  # edits that any entry below the node allows
        for k, e in enumerate(lexicon):
            node, allowed = 0, edits_allowed(e)
            self.most[0] = max(self.most[0], allowed)
            for c in e.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], allowed)
            self.ends[node].append(k)
        self.allowed = [edits_allowed(e) for e in lexicon]
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.hits: list[tuple[int, int] | None] = []
        self.steps: list[dict[str, int]] = []
        self.dead = self._state(frozenset())
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        todo, out = list(states), set()
        while todo:
            node, e = todo.pop()
            if node >= 0 and (e > self.most[node] or (node, e) in out):
                continue
            out.add((node, e))
            if node >= 0:
                out.update((~k, e) for k in self.ends[node] if self.lexicon[k].stem and e <= self.allowed[k])
                todo.extend((child, e + 1) for child in self.children[node].values())
        fewest: dict[int, int] = {}
        for node, e in out:
            fewest[node] = min(e, fewest.get(node, e))
        return frozenset(fewest.items())

    def _state(self, states: frozenset) -> int:
        if (at := self.states.get(states)) is None:
            at = self.states[states] = len(self.sets)
            self.sets.append(states)
            found = [(e, k) for node, e in states if node >= 0 for k in self.ends[node] if e <= self.allowed[k]]
            found += [(e, ~node) for node, e in states if node < 0]
            best = min(found, default=None)
            self.hits.append(None if best is None else (best[1], best[0]))
            self.steps.append({})
        return at

    def _step(self, at: int, c: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, e in self.sets[at]:
            if node < 0:
                after.add((node, e))
                continue
            for letter, child in self.children[node].items():
                after.add((child, e if letter == c else e + 1))
            after.add((node, e + 1))
        to = self.steps[at][c] = self._state(self._closed(after))
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(entry, edits) of the closest entry, or None."""
        at, dead, steps = self.start, self.dead, self.steps
        for c in word:
            to = steps[at].get(c)
            at = self._step(at, c) if to is None else to
            if at == dead:
                return None
        return self.hits[at]


# ---------------------------------------------------------------- window scores
FEATURES = 8


class Scorer:
    """Features of a text under a lexicon; remembers how each token matched."""

    def __init__(self, lexicon: list[Entry]):
        self.automaton, self.known = Automaton(lexicon), {}

    def features(self, text: str | None) -> np.ndarray:
        tokens = (text or "").split()
        out = np.zeros(FEATURES)
        if len(self.known) > REMEMBERED:
            self.known = {}
        get = self.known.get
        found = list(map(get, tokens))
        if None in found:
            match = self.automaton.match
            for t in {t for t, f in zip(tokens, found) if f is None}:
                self.known[t] = match(plain(t)) or 0
            found = list(map(get, tokens))
        if not any(found):
            return out
        best = 0.0
        for i, hit in enumerate(found):
            if not hit:
                continue
            entry, edits = hit
            weight = self.automaton.lexicon[entry].weight / (1 + 2 * edits)
            quoted, address = self._window(tokens, i)
            if quoted:
                out[2] += weight
            elif edits:
                out[1] += weight
            else:
                out[0] += weight
            out[3] += weight * address
            best = max(best, 0.0 if quoted else weight)
        density = sum(map(bool, found)) / len(tokens)
        out[4:] = best, density * 100, best > 0, len({h[0] for h in found if h})
        out[[0, 1, 2, 3, 5, 7]] = np.log1p(out[[0, 1, 2, 3, 5, 7]])
        return out

    @staticmethod
    def _window(tokens: list[str], i: int) -> tuple[bool, int]:
        """Whether the hit is in a quotation, and how many words of address are near it."""
        before, after = tokens[max(0, i - WINDOW):i], tokens[i + 1:i + 1 + WINDOW]
        own = tokens[i]
        opened = own[0] in _OPEN or any(t[0] in _OPEN and t[-1] not in _CLOSE for t in before if t)
        closed = own.rstrip(".,;:!?")[-1:] in tuple(_CLOSE) or any(t.rstrip(".,;:!?")[-1:] in tuple(_CLOSE) for t in after)
        near = [plain(t) for t in (*before, *after)]
        reported = any(w in _REPORT for w in near)
        return (opened and closed) or reported, sum(w in _ADDRESS for w in near)


# ---------------------------------------------------------------- fitting
def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def _fit_rows(docs: DataFrame, labels: DataFrame, text: str, id_col: str, label: str, rows: int) -> DataFrame:
    """(text, y) of at most ``rows`` labelled documents that are not held out."""
    some = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
            .groupBy(F.col(id_col).alias("id_l")).agg(F.max(label).cast("int").alias("y"))
            .orderBy(F.xxhash64("id_l"), "id_l").limit(rows))
    # at most ``rows`` rows of two numbers are broadcast
    return docs.join(F.broadcast(some), F.col(id_col) == F.col("id_l")).select(F.col(text).alias("text"), "y")


def learn_lexicon(fit: DataFrame, entries: int | None = None) -> list[Entry]:
    """Words and stems that toxic documents have far more often than others.

    Support counts the different words that an entry follows in toxic documents, so that
    copies of one document count once. A stem is taken where no single word stands for it.
    ``entries`` keeps the best supported ones only; without it all are kept, which are no
    more than the words of the fitted rows (``FIT_ROWS`` at most).
    """
    prepare(fit.sparkSession)

    def terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            term, stem, of, y, prev = [], [], [], [], []
            for t, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen: dict[tuple[str, bool], tuple[str, str]] = {}
                last = ""
                for w in map(plain, (t or "").split()):
                    if len(w) >= 3:
                        seen.setdefault((w, False), (w, last))
                        for n in STEM_SIZES:
                            if len(w) > n:
                                seen.setdefault((w[:n], True), (w, last))
                    last = w
                for (w, s), (whole, before) in seen.items():
                    term.append(w)
                    stem.append(s)
                    y.append(label)
                    of.append(whole if label else None)
                    prev.append(before if label else None)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.string()), pa.array(stem, pa.bool_()), pa.array(y, pa.int32()),
                                              pa.array(of, pa.string()), pa.array(prev, pa.string())],
                                             ["term", "stem", "y", "of", "prev"])

    docs = fit.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()  # two rows
    pos, neg = (sum(r.n for r in docs if bool(r.y) == v) for v in (True, False))
    if not pos or not neg:
        return []
    odds = ((F.col("p") + 0.5) / (pos + 1)) / ((F.col("q") + 0.5) / (neg + 1))
    counts = (fit.mapInArrow(terms, "term string, stem boolean, y int, of string, prev string").groupBy("term", "stem")
              .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"), F.size(F.collect_set("prev")).alias("support"),
                   F.size(F.collect_set("of")).alias("forms"))
              .withColumn("odds", odds)
              .where((F.col("support") >= max(MIN_SUPPORT, SUPPORT_SHARE * pos)) & (F.col("odds") >= min(MIN_ODDS, neg))))
    top = (counts.orderBy(F.desc(F.col("support") * F.log("odds")), "term", "stem")).collect()
    words = {r.term: r for r in top if not r.stem}
    stems = {r.term: r for r in top if r.stem and r.forms >= 3}
    out = [Entry(w, False, float(np.log(r.odds))) for w, r in words.items()]
    for s, r in stems.items():
        by_word = max((w.support for t, w in words.items() if t.startswith(s)), default=0)
        longer = any(t != s and t.startswith(s) and x.support >= 0.9 * r.support for t, x in stems.items())
        if by_word < 0.5 * r.support and not longer:
            out.append(Entry(s, True, float(np.log(r.odds))))
    support = {**{(w, False): r.support for w, r in words.items()}, **{(s, True): r.support for s, r in stems.items()}}
    out.sort(key=lambda e: (-support[(e.text, e.stem)] * e.weight, e))
    return out[:entries]


class Model(NamedTuple):
    lexicon: list[Entry]
    center: list[float]
    scale: list[float]
    weights: list[float]
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - np.array(self.center)) / np.array(self.scale) @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(a.shape[1]), np.diag([RIDGE] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit_model(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic",
              rows: int = FIT_ROWS) -> Model:
    """Lexicon and weights, from ``rows`` labelled documents at most, none of them held out.

    Only the sample's feature rows come to the driver, ``rows`` times FEATURES numbers.
    Without labels of both kinds every score is the share of the label there is, or 0.
    """
    fit = _fit_rows(docs, labels, text, id_col, label, rows)
    lexicon = learn_lexicon(fit)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for b in batches:
            x = [scorer.features(t).tolist() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], ["x", "y"])

    got = fit.mapInArrow(compute, "x array<double>, y int").collect()
    y = np.array([r.y for r in got], float)
    if not len(got) or y.min() == y.max():
        share = float(y.mean()) if len(got) else 0.0
        return Model([], [0.0] * FEATURES, [1.0] * FEATURES, [0.0] * FEATURES, 40.0 if share else -40.0)
    x = np.array([r.x for r in got])
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    w, bias = _logistic((x - center) / scale, y)
    return Model(lexicon, center.tolist(), scale.tolist(), w.tolist(), bias)


def score_documents(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id, held_out, score and predicted.

    Whole texts are scored, from the text alone. Null and empty texts get the score of a
    text without hits. A null id is not held out.
    """
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.lexicon)
        for b in batches:
            x = np.array([scorer.features(t.as_py()) for t in b.column(1)]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x), pa.float64())], ["id", "score"])

    scored = narrow.mapInArrow(compute, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))
