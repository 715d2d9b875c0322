import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatrace.llm import periodic
from seatrace.llm.arrays import Powers
from tests.llm.fixtures import collected, documents, texts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def planted(words, doc_id):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_runs(words):
    """(start, length, period) by comparing the words with themselves at every distance."""
    n, index, out = len(words), {}, []
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    for q in range(1, n // 4 + 1):
        same = np.diff(np.concatenate(([0], (ids[: n - q] == ids[q:]).astype(int), [0])))
        for s, t in zip(np.flatnonzero(same == 1).tolist(), np.flatnonzero(same == -1).tolist()):
            e = t + q
            # a stretch with a smaller period too has that one as its smallest
            if e - s >= max(6, 4 * q) and not any(a <= s and e <= a + n_ and q % p == 0 for a, n_, p in out):
                out.append((s, e - s, q))
    return sorted((s, n_, q) for s, n_, q in out)


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def brute_row(doc_id, text):
    words = planted(WORD.findall((text or "").encode()), doc_id)
    runs = brute_runs(words)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (
        doc_id, len(runs), s, n, q, 1000 * n // q if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapsed(words, runs)).hexdigest(),
    )


def made_words(rng):
    n, kinds = rng.choice([0, 1, 5, 6, 7, 20, 60, 200]), rng.choice([1, 2, 2, 3, 5, 30])
    words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.5:
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
        words = words[:a] + [words[a + (i % p) % (n - a)] for i in range(n - a)]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_made_words(seed):
    rng, powers = random.Random(seed), Powers()
    for _ in range(60):
        block = [made_words(rng) for _ in range(rng.randint(1, 6))]
        for words, (runs, kept) in zip(block, periodic.text_runs(block, powers)):
            expected = brute_runs(words)
            assert [tuple(r) for r in runs.tolist()] == expected
            assert kept == brute_collapsed(words, expected)


def test_small_pieces_of_work(monkeypatch):
    monkeypatch.setattr(periodic, "PAIRS", 7)
    rng, powers = random.Random(9), Powers()
    block = [made_words(rng) for _ in range(40)]
    for words, (runs, _) in zip(block, periodic.text_runs(block, powers)):
        assert [tuple(r) for r in runs.tolist()] == brute_runs(words)


def test_hashes_that_meet_change_nothing(monkeypatch):
    """Runs are measured on words: a hash that is always equal only costs time."""
    monkeypatch.setattr(periodic.Hasher, "spans", lambda self, a, b: np.zeros(len(a), np.uint64))
    rng, powers = random.Random(10), Powers()
    for _ in range(20):
        words = made_words(rng)
        assert [tuple(r) for r in periodic.text_runs([words], powers)[0][0].tolist()] == brute_runs(words)


def test_grammar_derives_the_words():
    rng = random.Random(2)
    words = [rng.randrange(4) for _ in range(500)] + [7, 8, 9] * 40
    symbols = np.array([periodic.BREAK, *words, periodic.BREAK], np.int64)
    grammar = periodic.re_pair(symbols, shortest=2)
    for places, length in zip(grammar.derived, grammar.length):
        assert len(places) > 1
        spans = {tuple(symbols[p : p + length]) for p in places}
        assert len(spans) == 1 and periodic.BREAK not in spans.pop()
        assert all(a + length <= b for a, b in zip(places, places[1:]))
    # no pair of what is left comes twice without overlap
    spans = {p: k for k, places in enumerate(grammar.derived) for p in places}
    left = [(spans.get(p, -1 - symbols[p])) for p in grammar.top.tolist()[1:-1]]
    pairs = list(zip(left, left[1:]))
    assert all(abs(i - pairs.index(pair)) < 2 for i, pair in enumerate(pairs))


def test_a_long_constant_text_and_one_long_period():
    powers = Powers()
    period = [b"%d" % i for i in range(5000)]
    found = periodic.text_runs([[b"a"] * 200_000, period * 6 + period[:17]], powers)
    assert found[0][0].tolist() == [[0, 200_000, 1]] and found[0][1] == b"a"
    assert found[1][0].tolist() == [[0, 30_017, 5000]] and found[1][1] == b" ".join(period)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = collected(periodic.runs_digest(periodic.periodic_runs(docs, plant=True)))
    assert got == sorted((brute_row(r.doc_id, r.text) for r in docs.collect()), key=repr)


def test_odd_rows(spark, monkeypatch):
    """Nulls, blanks, repeated rows, ties and clashing columns, in blocks of a few texts."""
    monkeypatch.setattr(periodic, "TEXT_BLOCK", 2000)
    rows = texts() + [(30, "a b " * 9 + "x " + "c d " * 9, "s"), (30, "a b " * 9, "s"), (None, "z " * 50, None)]
    got = collected(periodic.runs_digest(periodic.periodic_runs(documents(spark, rows), plant=True)))
    assert got == sorted((brute_row(i, t) for i, t, _ in rows), key=repr)


def test_without_planting(spark):
    docs = documents(spark, [(i, "one two three " * 4, None) for i in range(30)])
    found = periodic.periodic_runs(docs).select("n_words", "collapsed", F.col("runs")[0].alias("r")).distinct()
    (row,) = found.collect()
    assert (row.n_words, bytes(row.collapsed), tuple(row.r)) == (12, b"one two three", (0, 12, 3))


def test_empty_table(spark):
    empty = documents(spark, texts()).filter("false")
    assert periodic.runs_digest(periodic.periodic_runs(empty)).collect() == []
