import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from seatrace.llm import automaton, repeats, suffix_array
from tests.llm.fixtures import collected, documents, texts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, words, window=50):
    """(doc_id, n, n_removed, n_spans, digest of what stays)."""
    sequences = [WORD.findall((t or "").encode()) if words else list((t or "").encode()) for _, t, _ in rows]
    first = {}
    for (doc_id, _, _), s in zip(rows, sequences):
        if doc_id is not None:
            for p in range(len(s) - window + 1):
                key = tuple(s[p : p + window])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for (doc_id, _, _), s in zip(rows, sequences):
        gone = [False] * len(s)
        for p in range(len(s) - window + 1):
            if doc_id is not None and first[tuple(s[p : p + window])] < doc_id:
                gone[p : p + window] = [True] * window
        kept = [x for x, g in zip(s, gone) if not g]
        data = b" ".join(kept) if words else bytes(kept)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(s), sum(gone), spans, hashlib.sha256(data).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowded", [2000, 1, 0])
def test_bytes_match_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED_FRAGMENTS", crowded)
    assert collected(suffix_array.dedup_bytes_digest(documents(spark))) == brute(texts(), False)


@pytest.mark.parametrize("crowded", [2000, 1, 0])
def test_words_match_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED_FRAGMENTS", crowded)
    got = automaton.dedup_words(documents(spark))
    rows = [(d, n, r, s, hashlib.sha256(k).hexdigest()) for d, n, r, s, k in collected(got)]
    assert sorted(rows, key=repr) == brute(texts(), True)


def test_low_entropy_bytes(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("ab", weights=[9, 1], k=rng.randint(0, 400))), "s") for i in range(60)]
    assert collected(suffix_array.dedup_bytes_digest(documents(spark, rows))) == brute(rows, False)


def test_small_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 500)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 3000)
    assert collected(suffix_array.dedup_bytes_digest(documents(spark))) == brute(texts(), False)


def test_positions_beyond_their_bits():
    """Parts of a long sequence give the same anchors as one part."""
    import numpy as np

    from seatrace.llm.arrays import Powers

    text = bytes(random.Random(5).choices(b"abcd", k=5000))
    task = repeats.Task(False, 50, 20, 8, None)
    whole = repeats.read_block([text], task, Powers())
    bits, mask = repeats.POSITION_BITS, repeats.POSITION
    try:
        # fewer bits for positions: the same windows must be covered, once each
        repeats.POSITION_BITS, repeats.POSITION = 10, np.uint64(1023)
        parted = repeats.read_block([text], task, Powers())
    finally:
        repeats.POSITION_BITS, repeats.POSITION = bits, mask
    covered = [w for a, b in zip(parted.first.tolist(), parted.last.tolist()) for w in range(a, b + 1)]
    assert covered == list(range(len(text) - 49))
    assert whole.first[0] == 0 and whole.last[-1] == len(text) - 50


def test_text_stays_whole_characters(spark):
    docs = documents(spark)
    out = suffix_array.drop_repeated_text(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    rows = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    assert rows[1] is None and rows[21] == "" and rows[18] == "!" and rows[17]
    assert all("�" not in (t or "") for t in rows.values())


def test_empty(spark):
    assert suffix_array.dedup_bytes_digest(documents(spark, [])).count() == 0
    assert automaton.dedup_words_digest(documents(spark, [])).count() == 0


def test_bucket_pointers_order_suffixes():
    import numpy as np

    data = np.frombuffer(b"abracadabra_abracadabra_abracadabra", np.uint8)
    room = len(data) - np.arange(len(data))
    for depth in (8, 11, 16, 20):
        pointer = suffix_array.bucket_pointers(data, room, depth)
        some = [i for i in range(len(data)) if room[i] >= depth]
        for i in some:
            for j in some:
                a, b = bytes(data[i : i + depth]), bytes(data[j : j + depth])
                assert (pointer[i] == pointer[j]) == (a == b)


def test_automaton_matching_statistics():
    rng = random.Random(2)
    for _ in range(50):
        known = ["".join(rng.choices("ab", k=rng.randint(1, 12))) for _ in range(3)]
        asked = "".join(rng.choices("abc", k=15))
        machine = automaton.SuffixAutomaton()
        for k in known:
            machine.add(list(k))
        want = [
            max(n for n in range(i + 2) if n == 0 or any(asked[i + 1 - n : i + 1] in k for k in known))
            for i in range(len(asked))
        ]
        assert machine.matches(list(asked)) == want


def test_columns_of_any_name_and_rows_without_id(spark):
    text = "a text that is long enough to come twice in the table, word by word. " * 3
    rows = [(1, text, 1, 2), (2, text, 3, 4), (None, text, 5, 6), (None, text, 5, 6), (3, None, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _null int, `a.b` int")
    kept = suffix_array.drop_repeated_text(docs)
    assert kept.columns == docs.columns
    expected = [(1, text, 1, 2), (2, "", 3, 4), (None, text, 5, 6), (None, text, 5, 6), (3, None, 7, 8)]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(expected, key=repr)


def test_repeated_and_missing_ids_spread_over_chunks(spark):
    """A third of the rows with one id, a third with none: no chunk takes them all."""
    rows = [(i if i % 3 == 0 else (7 if i % 3 == 1 else None), f"text {i} " * 20) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would put small tasks together
    try:
        tasks = suffix_array.dedup_bytes(docs).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in tasks) == 600 and max(r["count"] for r in tasks) < 300
