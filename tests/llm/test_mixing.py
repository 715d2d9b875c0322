import pytest

from pyspark.sql import functions as F

from seatrace.llm import mixing
from tests.llm.fixtures import collected, documents, texts

BLANKS = " \t\n\x0b\x0c\r"


def n_words(text):
    return len("".join(" " if c in BLANKS else c for c in text or "").split(" ")) - (
        "".join(" " if c in BLANKS else c for c in text or "").split(" ").count("")
    )


def brute_targets(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + n_words(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    open_, full, left = set(order), {}, 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]] if open_ else []
        if not over:
            break
        for s in over:
            full[s] = 2.0 * sizes[s]
            open_.discard(s)
        left = 1.5 * sum(sizes.values()) - sum(full.values())
    return sizes, full | {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}


def test_report_matches_resharing(spark):
    rows = texts()
    sizes, targets = brute_targets(rows)
    report = mixing.mix_report(documents(spark))
    source = {d: s for d, _, s in rows}
    text = {d: t for d, t, _ in rows}
    got = [r for r in report.collect() if r.doc_id is not None]
    assert len(got) == sum(d is not None for d, _, _ in rows)
    for r in got:
        assert r["size"] == n_words(text[r.doc_id]) and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(targets[source[r.doc_id]])
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(rate), int(rate) + 1) and r.taken == r["size"] * r.copies <= 2 * r["size"]
    assert collected(report) == collected(mixing.mix_report(documents(spark)))


def test_mix_near_targets_and_keeps_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("copies", F.lit(9))
    report = mixing.mix_report(docs).join(docs.select("doc_id", "source"), "doc_id")
    total = report.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"))
    for r in total.collect():
        assert abs(r.t - r.g) <= 0.35 * r.g
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert out.count() == report.agg(F.sum("copies")).first()[0]


def test_no_source_above_its_cap_and_total_is_share(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 500), ("e", 3)], "source string, source_size long")
    got = {r.source: r for r in mixing.source_targets(sizes).collect()}
    assert all(r.target <= 2 * r.source_size + 1e-9 for r in got.values())
    assert sum(r.target for r in got.values()) == pytest.approx(1.5 * 1513)


def test_empty_and_wordless(spark):
    assert mixing.mix_report(documents(spark, [])).count() == 0
    rows = mixing.mix_report(documents(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert [(r["size"], r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2
