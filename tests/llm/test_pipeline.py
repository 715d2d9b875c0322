"""The pipeline's stages against brute force, each on what the one before it kept."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from seatrace.llm import bpe, mixing, quality, registry
from tests.llm.test_near_copies import brute_kept

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_rejected_documents_go(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    report = quality.quality_report(stages[0], labels)
    assert stages[1].count() == report.filter("predicted = 1").count() > 0
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    there = {r.doc_id for r in stages[0].collect()}
    assert len(good & kept) >= 0.99 * len(good & there)


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert brute_kept(rows) == sorted(r.doc_id for r in stages[2].collect())


def test_repeated_strings_go(stages, window=50):
    rows = {r.doc_id: r.text or "" for r in stages[2].collect()}
    first = {}
    for doc_id, text in rows.items():
        data = text.encode()
        for p in range(len(data) - window + 1):
            key = data[p : p + window]
            first[key] = min(first.get(key, doc_id), doc_id)
    expected = {}
    for doc_id, text in rows.items():
        data, gone = text.encode(), np.zeros(len(text.encode()), bool)
        for p in range(len(data) - window + 1):
            if first[data[p : p + window]] < doc_id:
                gone[p : p + window] = True
        kept, at = [], 0
        for c in text:
            n = len(c.encode())
            if not gone[at : at + n].any():
                kept.append(c)
            at += n
        expected[doc_id] = "".join(kept)
    assert {r.doc_id: r.text or "" for r in stages[3].collect()} == expected


def test_copies_of_the_mix(stages):
    copies = {r.doc_id: r.copies for r in mixing.mix_report(stages[3]).collect()}
    found = Counter(r.doc_id for r in stages[4].collect())
    assert found == Counter({d: n for d, n in copies.items() if n})


def test_tokens(stages):
    ranks = bpe.read_ranks(public_tokenizers.path(registry.RANKS))
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for r in stages[4].collect():
        ids = own.encode_ordinary(r.text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(tuple(r) for r in stages[5].collect()) == sorted(expected)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in stages[5].collect())
