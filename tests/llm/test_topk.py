import math
import random

from seatrace.llm import topk
from tests.llm.fixtures import collected

SCHEMA = "vec_id long, embedding array<float>, label int, v int, lo int, block int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)


def brute(rows, k=5, every=50):
    import numpy as np

    known = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    asked = {}
    for i, v in known:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in known if i != q and len(w) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def random_rows(n=260, dim=6):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(i, [0.5] * dim) for i in range(n, 2 * n)]
    rows += [
        (None, [1.0] * dim), (1001, None), (1002, []), (1003, [float("nan")] * dim), (1004, [None] * dim),
        (1005, [float("inf")] * dim), (1050, [1.0, 2.0]), (1051, [0.25, -0.5]), (1100, [1.0, 1.0, 1.0]),
        (100, [0.1] * dim), (7, [0.9] * dim), (7, [0.9] * dim), (1150, [3e4] * dim), (1151, [-3e4] * dim),
    ]
    return rows


def test_matches_brute_force(spark):
    rows = random_rows()
    assert collected(topk.top_k(vectors(spark, rows).repartition(5))) == brute(rows)


def test_by_shuffle_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rows = random_rows(90)
    assert collected(topk.top_k(vectors(spark, rows).repartition(5))) == brute(rows)


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [-1.0, 0.0])]
    assert collected(topk.top_k(vectors(spark, rows))) == brute(rows)


def test_empty(spark):
    assert topk.top_k(vectors(spark, [])).count() == 0
    assert topk.top_k(vectors(spark, [(1, [1.0])])).count() == 0
