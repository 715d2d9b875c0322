import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from seatrace.llm import bpe, token_counts
from tests.llm.fixtures import collected, documents, texts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SEPARATOR = 50256


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_encoder_equals_reference(reference):
    rng = random.Random(1)
    samples = [
        "a" * 5000, "ab" * 3000, " \n\t  x  y\r\n", "日本語テキスト" * 50, "é" * 3001, "", "\x00\x01🙂🙃" * 40,
        "".join(rng.choice("abcdeé 1!\n") for _ in range(20000)),
        "".join(chr(rng.randrange(32, 0xD7FF)) for _ in range(3000)),
        "".join(rng.choice("abcd") for _ in range(100000)),
    ]
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_ranks(RANKS)), PATTERN)
    for text, ids in zip(samples, encoder.encode(samples)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


@pytest.mark.parametrize("many", [1, 3, 10**9])
def test_buckets_as_arrays_or_entry_by_entry(reference, monkeypatch, many):
    monkeypatch.setattr(bpe, "MANY", many)
    rng = random.Random(11)
    samples = ["".join(rng.choices("etaoin shrdlu", k=rng.randint(1, 400))) for _ in range(200)]
    samples += ["a" * n for n in range(1, 40)] + ["ab" * 700, "aaaab" * 300, "the the the"]
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_ranks(RANKS)), PATTERN)
    for text, ids in zip(samples, encoder.encode(samples)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


def test_memory_of_matches_is_bounded(reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 20 * bpe.ENTRY_BYTES)
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_ranks(RANKS)), PATTERN)
    rng = random.Random(12)
    for _ in range(30):
        texts_ = [" ".join(rng.choices(["common", "words", "zqxj" + str(rng.random())], k=12)) for _ in range(2)]
        for text, ids in zip(texts_, encoder.encode(texts_)):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert len(encoder.young) + len(encoder.old) < 200


@pytest.mark.parametrize("many", [1, 10**9])
def test_lower_rank_that_comes_up_goes_first(monkeypatch, many):
    """A vocabulary whose merges make a pair of lower rank than the one just merged."""
    monkeypatch.setattr(bpe, "MANY", many)
    tokens = [b"a", b"b", b"c", b"abc", b"ab", b"bc", b"abcab", b"ca"]
    ranks = {t: i for i, t in enumerate(tokens)}
    own = tiktoken.Encoding("t", pat_str="[abc]+", mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.Encoder(bpe.Vocabulary(ranks), "[abc]+")
    rng = random.Random(9)
    samples = ["".join(rng.choices("abc", k=rng.randint(1, 30))) for _ in range(300)]
    for text, ids in zip(samples, encoder.encode(samples)):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)


def test_digest(spark, reference):
    expected = []
    for doc_id, text, _ in texts():
        ids = reference.encode_ordinary(text or "")
        data = np.array(ids, "<u4").tobytes()
        expected.append(
            (doc_id, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert collected(bpe.round_trip_digest(documents(spark), RANKS, PATTERN)) == sorted(expected, key=repr)


def test_encode_then_decode(spark):
    rows = bpe.decode(bpe.encode(documents(spark), RANKS, PATTERN), RANKS).collect()
    assert sorted(bytes(r.decoded).decode() for r in rows) == sorted(t or "" for _, t, _ in texts())


def test_document_tokens(spark, reference, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_TOKENS", 64)
    monkeypatch.setattr(token_counts, "SPAN_BLOCKS", 4)
    got = token_counts.document_tokens(documents(spark), RANKS, PATTERN, SEPARATOR)
    expected = [(d, len(reference.encode_ordinary(t or ""))) for d, t, _ in texts()]
    assert collected(got) == sorted(expected, key=repr)


def test_separator_scan(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SPAN_BLOCKS", 3)
    rng = random.Random(6)
    rows, expected = [], []
    for file in range(6):
        tokens = [rng.choice([7, 8, 9, 9, 9]) for _ in range(rng.choice([0, 1, 57, 200]))]
        if file == 3:
            tokens = [7] * 90
        documents_ = [0]
        for t in tokens:
            if t == 9:
                documents_.append(0)
            else:
                documents_[-1] += 1
        if documents_[-1] == 0:
            documents_.pop()
        expected += [(file, i, n) for i, n in enumerate(documents_)]
        number = 0
        while tokens:
            n = rng.randint(1, 9)
            rows.append((file, number, np.array(tokens[:n], "<u2").tobytes()))
            tokens, number = tokens[n:], number + 1
    rows += [(9, 0, b""), (10, 0, None), (None, 0, b"\x09\x00"), (4, None, b"\x09\x00")]
    blocks = spark.createDataFrame([(*r, 1) for r in rows], "file int, number long, data binary, size int").repartition(4)
    assert collected(token_counts.count_tokens(blocks, 9)) == sorted(expected, key=repr)


def test_empty(spark):
    empty = documents(spark, [])
    assert bpe.round_trip_digest(empty, RANKS, PATTERN).count() == 0
    assert token_counts.document_tokens(empty, RANKS, PATTERN, SEPARATOR).count() == 0
