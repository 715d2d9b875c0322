import contextlib
import io
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from seatrace.llm import components, simhash
from tests.llm.fixtures import collected, documents, texts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered.encode())
    if not words:
        return 0
    n = min(3, len(words))
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows, radius=2):
    prints = [brute_fingerprint(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(doc_id, smallest.get(find(i), doc_id))
    return [(d, f"{p:016x}", smallest.get(find(i))) for i, ((d, _, _), p) in enumerate(zip(rows, prints))]


def test_classes_match_all_pairs(spark):
    rows = texts()
    assert collected(simhash.simhash_classes(documents(spark))) == sorted(brute_classes(rows), key=repr)


def test_whole_table_matches_all_pairs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source")
    brute = brute_classes([tuple(r) for r in rows.collect()])
    assert collected(simhash.simhash_classes(rows)) == sorted(brute, key=repr)


def test_links_keep_chains(spark):
    low = -(1 << 63)
    prints = [0, 3, 15, low, -1, -4, 7, 0x0F0F0F]
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    got = dict(collected(components.components(edges)))
    assert got == {p: low for p in (0, 3, 15, 7, low)} | {-1: -4, -4: -4}


def test_radius_must_be_even(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_empty(spark):
    docs = documents(spark, [])
    assert simhash.simhash_classes(docs).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(0, 200).selectExpr("id as u", "id + 1 as v")
    assert set(components.components(edges).select("root").distinct().collect()) == {(0,)}


def test_estimates_of_components_do_not_grow_with_the_rounds(spark):
    """Spark guesses a join at the product of its sides, and a checkpoint keeps the guess: after
    nine rounds that was a number of thousands of digits."""
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    roots = components.components(edges)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        roots.explain(mode="cost")
    sizes = re.findall(r"sizeInBytes=([^,)]+)", plan.getvalue())
    assert sizes and all(re.fullmatch(r"[\d.]+ (B|KiB)", size) for size in sizes)
    assert [tuple(r) for r in roots.orderBy("node").collect()] == [(i, 0) for i in range(201)]


def test_components_of_several_calls_keep_their_own_rows(spark):
    """Each call stores its rounds apart, and rows are read when they are asked for."""
    graphs = [[(1, 2), (2, 3)], [(4, 5), (None, 6), (5, 4), (4, 5)], []]
    roots = [components.components(spark.createDataFrame(g, "u long, v long")) for g in graphs]
    assert [collected(r) for r in roots] == [[(1, 1), (2, 1), (3, 1)], [(4, 4), (5, 4)], []]
