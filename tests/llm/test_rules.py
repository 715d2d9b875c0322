import re

from pyspark.sql import functions as F

from seatrace.llm import rules
from tests.llm.fixtures import collected, documents, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeated = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for starts in seen.values():
        if len(starts) > 1:
            repeated |= {i + k for i in starts for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measurements(spark):
    expected = sorted(((d, *brute(t)) for d, t, _ in texts()), key=repr)
    assert collected(rules.measured(documents(spark)).select("doc_id", *COLUMNS)) == expected


def test_measurements_of_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    assert collected(rules.measured(docs).select("doc_id", *COLUMNS)) == expected


def test_policies_and_ablations_agree(spark):
    ledger = rules.ledger(documents(spark)).cache()
    rows = ledger.collect()
    for policy, names in rules.POLICIES.items():
        chosen = rules.mask(names)
        kept = rules.with_policy(ledger, policy).filter("kept").count()
        assert kept == sum(not r.failed & chosen for r in rows)
        got = {r.rule: (r.n_failed, r.n_failed_alone, r.n_kept) for r in rules.ablations(ledger, policy).collect()}
        for name in names:
            bit = 1 << rules.BITS[name]
            assert got[name] == (
                sum(bool(r.failed & bit) for r in rows), sum(r.failed & chosen == bit for r in rows), kept
            )


def test_bits_follow_their_conditions(spark):
    ledger = rules.ledger(documents(spark))
    for bit, _, condition in rules.RULES:
        wrong = ledger.filter(F.expr(condition) != (F.col("failed").bitwiseAND(F.lit(1 << bit)) != 0))
        assert wrong.count() == 0


def test_good_documents_of_normal_size_stay(spark):
    folder = "/root/testdata/sf0.1"
    good = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").select("doc_id")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(good, "doc_id")
    lost = rules.with_policy(rules.ledger(docs)).filter("not kept and failed & 3 = 0")
    assert lost.count() == 0


def test_empty(spark):
    assert rules.with_policy(rules.ledger(documents(spark, []))).count() == 0
