import base64
import random
import re
from collections import Counter

import zstandard

from tests.llm.conftest import EDGE_ROWS
from tributary.llm import quality as Q


def base(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", text)
    windows = list(zip(w, w[1:], w[2:]))
    n, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered), failed


def prose(seed, n=400):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    return " ".join(rnd.choice(vocabulary) for _ in range(n))


def test_counts_against_brute_force(edge, clashing, nothing):
    for df in (edge, clashing):
        rows = sorted((r.doc_id, *r[1:6], r.base_failed) if r.doc_id is not None else (-1, *r[1:6], r.base_failed)
                      for r in Q.quality_report(df).collect())
        assert rows == sorted((r[0] if r[0] is not None else -1, *base(r[1])) for r in EDGE_ROWS)
    assert Q.quality_report(nothing).collect() == []


def test_more_texts_against_brute_force():
    pack = zstandard.ZstdCompressor(level=3).compress
    rnd = random.Random(4)
    for _ in range(200):
        t = "".join(rnd.choice(["a ", "b ", "c\n", "é ", "#", "\n", " \t", "word ", "\x0b"]) for _ in range(rnd.randint(0, 200)))
        got = Q._judged(t.encode(), pack, Q.BANDS)
        assert (*got[:5], got[8]) == base(t)


def verdict(text):
    return Q._judged(text.encode(), zstandard.ZstdCompressor(level=3).compress, Q.BANDS)[9:]


def test_verdicts_by_compression():
    assert verdict(prose(1)) == (True, None) and verdict(prose(2, 5000)) == (True, None)
    rnd = random.Random(0)
    noise = " ".join("".join(map(chr, (rnd.randrange(33, 127) for _ in range(9)))) for _ in range(300))
    assert verdict(noise) == (False, "incompressible")
    # words differ, so no 3-word window repeats, but the text is the same stuff over and over
    stuff = " ".join(f"abcdefghijklmnopqrstuvwxyz{i}" for i in range(300))
    assert base(stuff)[4] == 0 and verdict(stuff) == (False, "repetitive")
    # one repetitive stretch inside good prose is found by its chunk
    assert verdict(prose(3, 1500) + stuff[:6000] + prose(4, 1500)) == (False, "repetitive")


def test_encoded_text_is_rejected():
    rnd = random.Random(6)

    def lines(encode, size, width, by):
        code = encode(rnd.randbytes(size)).decode()[:size]
        return by.join(code[i:i + width] for i in range(0, size, width))

    for size in (5000, 8000, 40000, 300000):
        assert verdict(lines(base64.b64encode, size, 76, "\n")) == (False, "incompressible")
    for size in (600, 1500, 3000, 8000, 40000):
        assert verdict(lines(base64.b64encode, size, 9, " ")) == (False, "incompressible")
        assert verdict(lines(base64.b85encode, size, 9, " ")) == (False, "incompressible")
    # a stretch inside good prose is found by its chunk
    assert verdict(prose(3, 2000) + lines(base64.b64encode, 6000, 76, "\n") + prose(4, 2000)) == (False, "incompressible")


SCRIPTS = {"Cyrillic": 0x430, "Greek": 0x3B1, "Armenian": 0x561, "Arabic": 0x628, "Hebrew": 0x5D0, "Devanagari": 0x905, "Thai": 0xE01}


def _transliterated(text, first):
    return text.translate({ord("a") + i: first + i for i in range(26)} | {ord("A") + i: first + 26 + i for i in range(26)})


def test_prose_is_judged_alike_in_any_script(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    good = [t for t in texts if t and verdict(t)[0]]
    assert len(good) > 800
    for name, first in SCRIPTS.items():
        kept = sum(verdict(_transliterated(t, first))[0] for t in good)
        assert kept >= 0.97 * len(good), (name, kept, len(good))


def test_repetition_is_found_in_any_script():
    stuff = " ".join(f"abcdefghijklmnopqrstuvwxyz{i}" for i in range(300))
    for first in SCRIPTS.values():
        assert verdict(_transliterated(stuff, first)) == (False, "repetitive")


def test_ideographs_are_judged_for_repetition_only():
    rnd = random.Random(3)
    good = " ".join("".join(chr(0x4E00 + int(rnd.paretovariate(0.7)) % 3000) for _ in range(rnd.randint(2, 9))) for _ in range(400))
    assert verdict(good) == (True, None)
    again = " ".join(f"重复的内容一直在这里不断地出现没有任何变化{i}" for i in range(300))
    assert verdict(again) == (False, "repetitive")


def test_octets_of_a_text():
    assert Q.octets_of(b"plain") == (b"plain", False)
    assert Q.octets_of("b\u044fa\u0430\u044f".encode()) == (bytes([98, 129, 97, 128, 129]), False)
    text = "a" * 900 + "".join(chr(0x100 + i) * 2 for i in range(Q.OWN_OCTETS)) + "\u4e01\U0001f600"
    out, wide = Q.octets_of(text.encode())
    assert not wide and len(out) == len(text) + 4 and out.endswith(bytes([255, 0x4E, 1, 255, 0xF6, 0]))
    assert Q.octets_of("".join(chr(0x4E00 + i) for i in range(500)).encode())[1]
    assert Q.octets_of(b"\xff\xfe broken")[0]


def test_letters_of_any_alphabet_are_found():
    rnd = random.Random(5)
    for size in (17000, 33000, 400000):
        for letters in ("0123456789abcdef", "0123456789", "acgt", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
            for width, by in ((60, "\n"), (8, " "), (4, " ")):
                code = "".join(rnd.choice(letters) for _ in range(size))
                kept, reason = verdict(by.join(code[i:i + width] for i in range(0, size, width)))
                assert not kept and reason in ("encoded", "incompressible", "repetitive"), (size, letters, width)
    assert verdict(prose(7, 800)) == verdict(prose(8, 20000)) == (True, None)


def test_every_byte_is_in_a_chunk():
    for n in (1, 600, 1500, 2047, 2048, 2049, 3000, 3072, 5000, 6143):
        raw = random.Random(n).randbytes(n)
        chunks = Q._chunks(raw)
        assert raw.startswith(chunks[0]) and raw.endswith(chunks[-1]) and sum(map(len, chunks)) >= n
        assert n < 2048 or all(1024 <= len(c) <= 2048 for c in chunks)
    assert Q._chunks(b"") == []
    # nearly 1,000 bytes of noise at the end
    rnd = random.Random(8)
    noise = " ".join("".join(map(chr, (rnd.randrange(33, 127) for _ in range(9)))) for _ in range(100))
    good = prose(9, 2000).encode()[:8192].decode()
    assert verdict(good) == (True, None) and verdict(good + noise) == (False, "incompressible")


def test_keep_quality_keeps_columns_and_clean_rows(spark, clashing, nothing):
    assert Q.keep_quality(clashing).columns == clashing.columns
    assert Q.keep_quality(nothing).collect() == []
    df = spark.createDataFrame([(1, prose(5), "a"), (2, "too short", "b"), (3, None, None), (1, prose(5), "a")],
                               "doc_id bigint, text string, kept string")
    assert [r.doc_id for r in Q.keep_quality(df).collect()] == [1, 1]
