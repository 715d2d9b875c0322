import zlib

import numpy as np

from seatrace.llm import quality
from tests.llm.fixtures import documents, texts

FOLDER = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    report = quality.quality_report(docs, labels)
    rows = report.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    score, label = np.array([r.score for r in held]), np.array([r.quality for r in held])
    predicted = np.array([r.predicted for r in held])
    assert auc(score, label) > 0.97
    assert (predicted == label).mean() > 0.97
    assert predicted[label == 1].mean() > 0.99


def test_marginals_match_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    emission, moves = rng.normal(size=(3, 5)), rng.normal(size=(2, 2))
    lengths = np.array([5, 1, 3])
    there = np.arange(5)[None] < lengths[:, None]
    got = quality.marginals(emission * there, there, moves)
    for d, n in enumerate(lengths):
        total, good = 0.0, np.zeros(n)
        for path in product((0, 1), repeat=int(n)):
            weight = np.exp(
                sum(emission[d, t] * y for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            )
            total += weight
            good += weight * np.array(path)
        assert np.allclose(got[d, :n], good / total)


def test_odd_rows_and_columns(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(i, int(i >= 30), 0) for i in range(1, 70)] + [(None, 1, 0), (3, None, 0), (21, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    report = quality.quality_report(docs, labels).collect()
    assert len(report) == len(texts()) and all(0 <= r.score <= 1 for r in report)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in report)
    again = quality.quality_report(docs, labels).collect()
    assert sorted(report, key=repr) == sorted(again, key=repr)


def test_no_labels_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_report(documents(spark), none).collect()} == {0.5}
    assert quality.quality_report(documents(spark, []), none).count() == 0


def test_a_repeated_labelled_id_and_labels_without_document(spark, monkeypatch):
    """The bounds hold for rows and lines, and labels of absent documents use up nothing."""
    monkeypatch.setattr(quality, "FIT_LINES", 5)
    seen = []
    fit_lines = quality.fit_lines
    monkeypatch.setattr(quality, "fit_lines", lambda *a: seen.append(a) or fit_lines(*a))
    texts = {i: ("fine words here.\n" * 20 if i % 2 else "#### $$$ ||| !!!\n" * 20) for i in range(60)}
    rows = [(i, t) for i, t in texts.items()] + [(1, "fine words here.\n" * 20)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(-2000, 60)], "doc_id long, quality int")
    model = quality.fit(docs, labels, documents=30)
    features, n_lines, good = seen[0]
    assert len(n_lines) == 30 and n_lines.max() == 5 and len(features) == n_lines.sum()
    assert 0 < good.sum() < 30 and model is not None


def test_keep_good_passes_columns_through(spark):
    docs = spark.createDataFrame([(1, "fine words here.", 2, 3, 4)], "doc_id long, text string, score int, c1 int, `a.b` int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "fine words here.", 2, 3, 4)]
    assert quality.keep_good(docs.filter("false"), labels).collect() == []
