"""SentencePiece BPE with seeded merge-dropout.

Encoding merges neighbouring symbols, best score first, as the BPE model does. Each
candidate merge is first put to a keyed hash of the seed, the variant, the word and
the candidate's place in it; where the hash falls below the dropout rate the merge is
skipped. So a word has several segmentations, all made of the model's merges, and all
decode to the same text. The same seed gives the same segmentations.

No piece of the model has a word's first mark (U+2581) behind another character, so
merges never cross from one word into the next. Every occurrence of a word draws for
itself: its variant is a keyed hash of the document and of the word's place in it. What
is remembered of a word is the tree of its merges, a branch for each merge that may be
skipped; an occurrence follows its own draws down that tree.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import prepare


MARK = "\u2581"
#: Segmentations that a Python worker remembers before it begins anew.
REMEMBERED = 700_000
#: Words of more symbols are merged one by one; the others many at a time.
LONG_WORD = 48  # below 64: three places fit 18 bits
NO_MERGE = 1 << 30  # a rank behind all
NOBODY, ONE = -1, -2
GONE = -2  # no symbol, and not the -1 of a character without one
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_STAND_INS = "\uFFFE\uFFFF" + "".join(map(chr, range(0xFDD0, 0xFDF0)))  # noncharacters


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def _spread(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All characters of ``words``, each one's place in its word, where the words begin, and whose each is."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    chars = _points("".join(words))
    return chars, np.arange(len(chars)) - first[word], first, word


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, .. (count of them) for each, one behind the other."""
    ends = np.cumsum(count)
    return np.repeat(start - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)


class _Column:
    """An array that grows."""

    def __init__(self, kind):
        self.all, self.n = np.empty(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.all):
            self.all = np.concatenate([self.all[:self.n], np.empty(max(need, len(self.all) * 3 // 2) - self.n, self.all.dtype)])
        self.all[self.n:need] = values
        self.n = need


class Pieces:
    """A SentencePiece BPE model's pieces, merges and byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        if any(MARK in names[i].lstrip(MARK) for i in plain):
            raise ValueError("this model has pieces that reach over a word's end")
        self.bytes_of = {i: bytes([int(names[i][3:5], 16)]) for i in range(n) if lib.is_byte(i)}
        self.byte_id = {b[0]: i for i, b in self.bytes_of.items()}
        self.decoded = [self.bytes_of.get(i, names[i].replace(MARK, " ").encode()) for i in range(n)]
        for i in range(n):
            if lib.is_control(i) or lib.is_unknown(i):
                self.decoded[i] = b""
        # symbols are the pieces, and any character that only occurs inside of pieces
        symbols = {names[i]: i for i in plain}
        for i in plain:
            for c in names[i]:
                symbols.setdefault(c, n + len(symbols))
        self.symbols, self.n = symbols, n
        order = sorted(plain, key=lambda i: -lib.get_score(i))
        self.rank = {}
        last, place = None, -1
        for i in order:  # equal scores have equal ranks
            if lib.get_score(i) != last:
                last, place = lib.get_score(i), place + 1
            self.rank[i] = place
        self.merges = {(symbols[names[i][:k]], symbols[names[i][k:]]): i for i in plain
                       for k in range(1, len(names[i])) if names[i][:k] in symbols and names[i][k:] in symbols}
        self.width = max(symbols.values()) + 2
        pairs = np.array([a * self.width + b for a, b in self.merges], np.int64)
        self._index(pairs, np.array(list(self.merges.values()), np.int64))
        self.of_char = np.full(0x110000, -1, np.int64)
        for name, symbol in symbols.items():
            if len(name) == 1:
                self.of_char[ord(name)] = symbol

    def _index(self, pairs: np.ndarray, made: np.ndarray) -> None:
        """Pairs of symbols in a table with open addressing, so that many are looked up at once."""
        bits = max(8, int(2.5 * len(pairs)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), (1 << bits) - 1
        self.pair, self.made = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        todo, slot = np.arange(len(pairs)), self._slot(pairs)
        while len(todo):
            free = self.pair[slot] < 0
            self.pair[slot[free]] = pairs[todo[free]]  # of several for one slot the last stays
            placed = self.pair[slot] == pairs[todo]
            self.made[slot[placed]] = made[todo[placed]]
            todo, slot = todo[~placed], (slot[~placed] + 1) & self.slots
        ranks = np.array([self.rank.get(i, 0) for i in range(self.n)], np.int64)
        self.ranks = np.append(ranks, NO_MERGE)  # the last stands for -1

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        pairs = left * self.width + right
        slot = self._slot(pairs)
        found = self.pair[slot]
        out = np.where(found == pairs, self.made[slot], -1)
        todo = np.flatnonzero((found != pairs) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.slots
            found = self.pair[slot[todo]]
            hit = found == pairs[todo]
            out[todo[hit]] = self.made[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        out[(left < 0) | (right < 0)] = -1
        return out

    def ids_of(self, symbol: int, char: str) -> list[int]:
        if 0 <= symbol < self.n:
            return [symbol]
        return [self.byte_id[b] for b in char.encode("utf-8", "surrogatepass")]


class Segmenter:
    """Segments words of one model with one seed and dropout rate."""

    def __init__(self, pieces: Pieces, seed: int, rate: float):
        self.p, self.seed, self.rate = pieces, seed, rate
        self.least = np.uint64(min(int(rate * 2.0**64), (1 << 64) - 1))
        self.never = rate <= 0

    def _salts(self, chars: np.ndarray, place: np.ndarray, first: np.ndarray, variants: list[int]) -> np.ndarray:
        """A hash of each word, the variant and the seed; ``chars`` are the words' code points."""
        return self._own(self._forms(chars, place, first), np.array(variants, np.uint64))

    @staticmethod
    def _forms(chars: np.ndarray, place: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.add.reduceat(_mix(chars.astype(np.uint64) << np.uint64(32) ^ place.astype(np.uint64)), first)

    def _own(self, forms: np.ndarray, variants: np.ndarray) -> np.ndarray:
        return _mix(forms ^ _mix(np.uint64((self.seed * 0x9E3779B97F4A7C15) & (2**64 - 1)) ^ variants))

    def _skipped(self, salts: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merge of [a, m) and [m, b) is skipped, for many candidates."""
        return _mix(salts ^ self._candidates(a, m, b)) < self.least

    @staticmethod
    def _candidates(a: np.ndarray, m: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _mix(a.astype(np.uint64) << np.uint64(42) ^ m.astype(np.uint64) << np.uint64(21) ^ b.astype(np.uint64))

    def one(self, word: str, variant: int) -> list[int]:
        """The segments of one word by an agenda; returns the cut offsets."""
        p, n = self.p, len(word)
        sym = [p.symbols.get(c, -1) for c in word]
        end, prev, nxt = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        salt = self._salts(_points(word), np.arange(n), np.array([0]), [variant])
        agenda: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (made := p.merges.get((sym[i], sym[j]))) is not None:
                heapq.heappush(agenda, (p.rank[made], i, end[i], end[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, mid, stop = heapq.heappop(agenda)
            j = nxt[i] if sym[i] is not None else n
            if sym[i] is None or j >= n or end[i] != mid or end[j] != stop:
                continue  # one of the two has been merged meanwhile
            if not self.never and self._skipped(salt, np.array([i]), np.array([mid]), np.array([stop]))[0]:
                continue
            sym[i], end[i], nxt[i] = p.merges[(sym[i], sym[j])], stop, nxt[j]
            sym[j] = None
            if nxt[i] < n:
                prev[nxt[i]] = i
            offer(prev[i], i)
            offer(i, nxt[i])
        out: list[int] = []
        i = 0
        while i < n:
            out += p.ids_of(sym[i], word[i])
            i = nxt[i]
        return out

    def many(self, words: list[str], variants: list[int]) -> list[bytes]:
        """``one`` for many words together: each round makes the best merge of every word."""
        out = [b""] * len(words)
        short = []
        for k, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[k] = np.array(self.one(w, variants[k]), "<i4").tobytes()
            elif w:
                short.append(k)
        if not short:
            return out
        some = [words[k] for k in short]
        chars, start, first, word = _spread(some)
        salts = self._salts(chars, start, first, [variants[k] for k in short])
        skipped = None if self.never else lambda w, a, m, b: self._skipped(salts[w], a, m, b)
        flat, bounds = self._rounds(some, skipped)
        raw, cuts = flat.tobytes(), (bounds * 4).tolist()
        for i, k in enumerate(short):
            out[k] = raw[cuts[i]:cuts[i + 1]]
        return out

    def _rounds(self, words: list[str], skipped: Callable | None, log: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of short words, one behind the other, and where each word's begin and end.

        ``skipped(word, a, m, b)`` tells which candidates are skipped. ``log`` gets the
        merges made, each round's (word, a, m, b).
        """
        p = self.p
        chars, start, first, word = _spread(words)
        whose, places = word, start
        sym, end = p.of_char[chars], start + 1
        made = np.full(len(sym), -1)

        def offer(at: np.ndarray) -> None:
            """Looks up the pairs (at, at + 1) that may be merged next."""
            if len(at):
                new = p.merged(sym[at], sym[at + 1])
                if skipped is not None:
                    new[skipped(word[at], start[at], end[at], end[at + 1])] = -1
                made[at] = new

        offer(np.flatnonzero(word[:-1] == word[1:]))
        ended = np.full(len(sym), GONE)  # the symbols of words that are done, where each begins
        while len(sym):
            # best of each word: lowest rank, then leftmost
            heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            order = np.minimum.reduceat(p.ranks[made] * len(sym) + np.arange(len(sym)), heads)
            live = order < NO_MERGE * len(sym)
            if live.all():
                best, stays = order % len(sym), np.ones(len(sym), bool)
            else:
                stays = np.repeat(live, np.diff(np.append(heads, len(sym))))
                over = np.flatnonzero(~stays)
                ended[first[word[over]] + start[over]] = sym[over]
                best = order[live] % len(sym)
            if log is not None:
                log.append((word[best], start[best], end[best], end[best + 1]))
            sym[best], end[best] = made[best], end[best + 1]
            made[best] = made[best + 1]
            stays[best + 1] = False
            left = np.flatnonzero(stays)
            place = np.searchsorted(left, best)
            sym, word, start, end, made = (x.take(left) for x in (sym, word, start, end, made))
            if not len(sym):
                break
            made[place] = -1
            after = place[(place + 1 < len(sym))]
            after = after[word[after] == word[after + 1]]
            before = place[place > 0] - 1
            offer(np.concatenate([after, before[word[before] == word[before + 1]]]))
        at = np.flatnonzero(ended != GONE)
        word, start, sym = whose[at], places[at], ended[at]
        odd = (sym < 0) | (sym >= p.n)
        if odd.any():  # bytes stand for a character without a piece
            ids = [p.ids_of(y, words[w][c]) if o else [y]
                   for y, w, c, o in zip(sym.tolist(), word.tolist(), start.tolist(), odd.tolist())]
            word = np.repeat(word, list(map(len, ids)))
            sym = np.array([y for each in ids for y in each])
        return sym.astype("<i4"), np.searchsorted(word, np.arange(len(words) + 1))


class Tree:
    """The segmentations of short words, remembered as they are first met.

    A node is a word and the candidates skipped so far. It has the ids that the word gets
    if no more are skipped, and the merges that are still put to the draw on the way
    there, in order. The first of them that is skipped leads to a child.

    Many words, and more so many children, are met once. Who comes first is merged alone,
    with its own draws; a node is made for whoever comes there next.
    """

    def __init__(self, seg: Segmenter):
        self.seg = seg
        self.clear()

    def clear(self) -> None:
        self.root: dict[str, int] = {}
        self.met: set[str] = set()  # words without a node that came by once
        self.words: list[str] = []
        self.skips: list[tuple[int, ...]] = []
        self.passed, self.begin, self.count, self.ids_begin, self.n_ids = (_Column(np.int64) for _ in range(5))
        self.form = _Column(np.uint64)
        # the merges of all nodes; child is NOBODY where nobody went yet, and ONE where one occurrence did
        self.code, self.hash, self.child = _Column(np.int64), _Column(np.uint64), _Column(np.int64)
        self.ids = _Column("<i4")

    def grow(self, words: list[str], skips: list[tuple[int, ...]], passed: np.ndarray) -> np.ndarray:
        """New nodes; the first ``passed`` merges of each are not put to the draw again."""
        new = [self._grow(words[i:i + 4000], skips[i:i + 4000], passed[i:i + 4000])
               for i in range(0, len(words), 4000)]  # so many fit the processor's cache
        return np.concatenate(new)

    def _grow(self, words: list[str], skips: list[tuple[int, ...]], passed: np.ndarray) -> np.ndarray:
        seg, n, at = self.seg, len(words), len(self.words)
        taken = np.array(sorted(w << 18 | c for w, codes in enumerate(skips) for c in codes), np.int64)

        def skipped(w, a, m, b):
            asked = w << 18 | a << 12 | m << 6 | b
            return taken[np.minimum(np.searchsorted(taken, asked), len(taken) - 1)] == asked

        log: list[tuple] = []
        ids, bounds = seg._rounds(words, skipped if len(taken) else None, log)
        chars, place, first, _ = _spread(words)
        self.words += words
        self.skips += skips
        self.passed.add(passed)
        self.form.add(seg._forms(chars, place, first))
        self.ids_begin.add(self.ids.n + bounds[:-1])
        self.n_ids.add(np.diff(bounds))
        self.ids.add(ids)
        begin, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if log and not seg.never:
            w, a, m, b = (np.concatenate(x) for x in zip(*log))
            turn = np.repeat(np.arange(len(log)), [len(x[0]) for x in log])
            left = turn >= passed[w]  # every round makes one merge of a word
            by = np.flatnonzero(left)[np.argsort(w[left], kind="stable")]
            w, a, m, b = w[by], a[by], m[by], b[by]
            count = np.bincount(w, minlength=n)
            begin = self.code.n + np.cumsum(count) - count
            self.code.add(a << 12 | m << 6 | b)
            self.hash.add(seg._candidates(a, m, b))
            self.child.add(np.full(len(w), NOBODY))
        self.begin.add(begin)
        self.count.add(count)
        return np.arange(at, at + n)

    def size(self) -> int:
        return len(self.words) + len(self.met)

    def roots(self, words: list[str]) -> np.ndarray:
        """The nodes of words; NOBODY for a word that is met for the first time, and once."""
        at = np.fromiter(map(self.root.get, words, repeat(NOBODY)), np.int64, len(words))
        todo = np.flatnonzero(at < 0)
        if len(todo):
            asked = [words[k] for k in todo.tolist()]
            times = Counter(asked)
            new = [w for w, n in times.items() if n > 1 or w in self.met]
            self.met.update(times)
            self.met.difference_update(new)
            self.root.update(zip(new, self.grow(new, [()] * len(new), np.zeros(len(new), np.int64)).tolist()) if new else ())
            at[todo] = np.fromiter(map(self.root.get, asked, repeat(NOBODY)), np.int64, len(asked))
        return at

    def segment(self, words: list[str], variants: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one behind the other, and each word's number of ids."""
        at = self.roots(words)
        alone = [np.flatnonzero(at < 0)]
        own = np.flatnonzero(at >= 0)
        salts = np.zeros(len(at), np.uint64)
        salts[own] = self.seg._own(self.form.all[at[own]], variants[own])
        open_ = own[self.count.all[at[own]] > 0]
        while len(open_):
            nodes = at[open_]
            counts = self.count.all[nodes]
            merges = _ranges(self.begin.all[nodes], counts)
            hits = np.flatnonzero(_mix(np.repeat(salts[open_], counts) ^ self.hash.all[merges]) < self.seg.least)
            whose = np.repeat(np.arange(len(open_)), counts)[hits]
            lead = np.append(True, whose[1:] != whose[:-1])[:len(whose)]  # the first one skipped
            slots, open_ = merges[hits[lead]], open_[whose[lead]]
            self._branch(slots, at[open_])
            there = self.child.all[slots]
            alone.append(open_[there < 0])
            open_, there = open_[there >= 0], there[there >= 0]
            at[open_] = there
            open_ = open_[self.count.all[there] > 0]
        alone = np.concatenate(alone)
        at[alone] = 0  # any; their own ids follow
        sizes, begin = self.n_ids.all[at], self.ids_begin.all[at]
        if not len(alone):
            return self.ids.all[_ranges(begin, sizes)], sizes
        ids, bounds = self._alone([words[k] for k in alone.tolist()], variants[alone])
        sizes[alone], begin[alone] = np.diff(bounds), self.ids.n + bounds[:-1]
        return np.concatenate([self.ids.all[:self.ids.n], ids])[_ranges(begin, sizes)], sizes

    def _alone(self, words: list[str], variants: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that are merged with their own draws, and where each word's begin and end."""
        seg, ids, sizes = self.seg, [], []
        for i in range(0, len(words), 4000):
            some = words[i:i + 4000]
            chars, place, first, _ = _spread(some)
            salts = seg._own(seg._forms(chars, place, first), variants[i:i + 4000])
            flat, bounds = seg._rounds(some, None if seg.never else lambda w, a, m, b: seg._skipped(salts[w], a, m, b))
            ids.append(flat)
            sizes.append(np.diff(bounds))
        return np.concatenate(ids), np.append(0, np.cumsum(np.concatenate(sizes)))

    def _branch(self, slots: np.ndarray, nodes: np.ndarray) -> None:
        """Children where two occurrences go, now or with one that went before."""
        new = self.child.all[slots] < 0
        slots, first, times = np.unique(slots[new], return_index=True, return_counts=True)
        nodes = nodes[new][first]
        grown = (times > 1) | (self.child.all[slots] == ONE)
        self.child.all[slots[~grown]] = ONE
        slots, nodes = slots[grown], nodes[grown]
        if len(slots):
            skips = [(*self.skips[k], c) for k, c in zip(nodes.tolist(), self.code.all[slots].tolist())]
            passed = self.passed.all[nodes] + slots - self.begin.all[nodes]
            self.child.all[slots] = self.grow([self.words[k] for k in nodes.tolist()], skips, passed)


class Encoder:
    """Encodes documents. With ``variants`` a word form has so many segmentations at most."""

    def __init__(self, path: str, seed: int, rate: float, variants: int | None = None):
        self.pieces = Pieces(path)
        self.seg, self.variants = Segmenter(self.pieces, seed, rate), variants
        self.tree = Tree(self.seg)

    def _words(self, text: str | None) -> list[str]:
        if not text:
            return []
        if MARK in text:  # a mark of the text itself is no space: bytes stand for it
            text = text.replace(MARK, next(c for c in _STAND_INS if c not in text))
        return _WORDS.findall(MARK + text.replace(" ", MARK))

    def draws(self, key: int, n: int) -> np.ndarray:
        """The variants of a document's first ``n`` words."""
        each = _mix(_mix(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(key))
        return each if self.variants is None else each % np.uint64(self.variants)

    def encode(self, texts: list[str | None], keys: list[int]) -> Iterator[np.ndarray]:
        """The ids of each text; ``keys`` (64-bit hashes of the documents) and the words' places choose the variants."""
        if self.tree.size() > REMEMBERED:
            self.tree.clear()
        parts = [self._words(t) for t in texts]
        sizes = list(map(len, parts))
        words = [w for part in parts for w in part]
        draws = np.concatenate([np.empty(0, np.uint64), *map(self.draws, keys, sizes)])
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        long_ = np.flatnonzero(lengths > LONG_WORD).tolist()
        own = {k: np.array(self.seg.one(words[k], int(draws[k])), "<i4") for k in long_}
        for k in long_:
            words[k] = MARK  # in their place; their own ids are put in below
        ids, n_ids = self.tree.segment(words, draws)
        ends = np.append(0, np.cumsum(n_ids))
        a = 0
        for t, n in zip(texts, sizes):
            row = ids[ends[a]:ends[a + n]]
            if long_ and (here := [k for k in long_ if a <= k < a + n]):
                cuts = [ends[a], *(e for k in here for e in (ends[k], ends[k + 1])), ends[a + n]]
                row = np.concatenate([x for i, k in enumerate(here) for x in (ids[cuts[2 * i]:cuts[2 * i + 1]], own[k])]
                                     + [ids[cuts[-2]:cuts[-1]]])
            a += n
            if t and MARK in t:
                row = self._restore(row, next(c for c in _STAND_INS if c not in t))
            yield row

    def _restore(self, ids: np.ndarray, stand_in: str) -> np.ndarray:
        """The bytes of the stand-in become those of the mark; both take three."""
        old = np.array([self.pieces.byte_id[b] for b in stand_in.encode()], np.int32)
        new = np.array([self.pieces.byte_id[b] for b in MARK.encode()], np.int32)
        ids = ids.copy()
        at = np.flatnonzero((ids[:-2] == old[0]) & (ids[1:-1] == old[1]) & (ids[2:] == old[2]))
        for k in range(3):
            ids[at + k] = new[k]
        return ids

    def decode(self, ids: np.ndarray) -> str:
        table = self.pieces.decoded
        raw = b"".join([table[i] for i in ids.tolist()])
        return raw[1:].decode("utf-8", "replace") if raw else ""  # without the space put before the first word


    def lossless(self, ids: list[np.ndarray], texts: list[str | None]) -> list[bool]:
        """Whether each text's ids decode to it."""
        table = self.pieces.decoded
        out = []
        for own, text in zip(ids, texts):
            text = text or ""
            raw = b"".join(map(table.__getitem__, own.tolist()))
            out.append(raw[1:] == text.encode("utf-8", "surrogatepass") or self.decode(own) == text)
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(*key) -> Encoder:
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def _runs(sizes: list[int], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    a, have = 0, 0
    for i, n in enumerate(sizes):
        have += n
        if have >= most:
            yield a, i + 1
            a, have = i + 1, 0
    if a < len(sizes):
        yield a, len(sizes)


def encode_pieces(docs: DataFrame, model: str, seed: int, rate: float, text: str = "text", id_col: str = "doc_id",
                  variants: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: its id, the ``keep`` columns, piece_ids, n_ids, ids_crc32 and lossless.

    lossless tells whether the ids decode to the text exactly. A null or empty text has
    no ids. With rate 0 the ids are those of the SentencePiece library (but for the
    character U+2581 in a text, which the library turns into a space and this keeps).
    Rows of one id and text get the same ids. ``variants`` limits how many segmentations
    a word form has; without it every occurrence draws for itself.
    """
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"),
                         F.xxhash64(F.lit(seed), F.col(id_col)).alias("key"),
                         *[F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model, seed, rate, variants)
        for whole in batches:
            for a, b in _runs([len(t.as_py() or "") if t.is_valid else 0 for t in whole.column(1)]):
                part = whole.slice(a, b - a)
                texts = part.column(1).to_pylist()
                keys = part.column(2).to_numpy().view(np.uint64).tolist()
                ids = list(enc.encode(texts, keys))
                lens = np.array([0, *map(len, ids)], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(lens), pa.int32()),
                                                 pa.array(np.concatenate(ids) if ids else [], pa.int32()))
                same = enc.lossless(ids, texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *part.columns[3:], lists, pa.array(lens[1:]),
                     pa.array([zlib.crc32(np.ascontiguousarray(i).tobytes()) for i in ids], pa.int64()), pa.array(same)],
                    names)

    names = [id_col, *keep, "piece_ids", "n_ids", "ids_crc32", "lossless"]
    kinds = [f.dataType.simpleString() for f in narrow.schema if f.name not in ("text", "key")]
    kinds += ["array<int>", "bigint", "bigint", "boolean"]
    return narrow.mapInArrow(encode, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def decode_pieces(encoded: DataFrame, model: str, ids: str = "piece_ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in column ``out``; null ids give null."""
    prepare(encoded.sparkSession)
    at = encoded.columns.index(ids)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema] + [f"`{out}` string"])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model, 0, 0.0, 1)
        for b in batches:
            texts = [None if x is None else enc.decode(np.array(x, np.int32)) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, out])

    return encoded.mapInArrow(decode, schema)
