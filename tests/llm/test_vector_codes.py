import hashlib
import math
import random

import numpy as np
import pytest

from seatrace.llm import vector_codes as codes
from tests.llm.fixtures import collected

SCHEMA = "vec_id long, embedding array<float>, label int, v int, x int, dim int, part int, entry int, n int, at int"


def vectors(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, 4, 5, 6, 7) for row in rows], SCHEMA).repartition(3)


def brute(rows, parts=8, entries=16, rounds=6):
    """Plain Lloyd rounds over all rows, for each dimension on its own."""
    kept = [
        (i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
        if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for dim in {len(v) for _, v, _ in kept}:
        chosen = sorted((r for r in kept if len(r[1]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        x = np.array([v for _, v, _ in chosen]).reshape(len(chosen), parts, -1)
        book = x[:entries].transpose(1, 0, 2).copy()

        def nearest():
            return ((x[:, :, None, :] - book[None]) ** 2).sum(axis=3)

        for _ in range(rounds):
            to = nearest().argmin(axis=2)
            for k in range(parts):
                for e in set(to[:, k].tolist()):
                    book[k, e] = x[to[:, k] == e, k].sum(axis=0) // int((to[:, k] == e).sum())
        distances = nearest()
        digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
        for (i, _, label), d in zip(chosen, distances):
            out.append((i, "".join(f"{e:02x}" for e in d.argmin(axis=1)), int(d.min(axis=1).sum()), label, digest))
    per_label = {}
    for _, _, error, label, _ in out:
        per_label[label] = per_label.get(label, 0) + error
    return sorted(((i, c, e, per_label[label], h) for i, c, e, label, h in out), key=repr)


def found(spark, rows):
    return collected(codes.codes_digest(*codes.vector_codes(vectors(spark, rows))))


def odd_rows(n=150):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [(1000 + i, [0.25] * 16, 3) for i in range(60)]
    rows += [(2000 + i, [rng.choice([-0.5, 0.5]) for _ in range(16)], 4) for i in range(60)]
    rows += [(3, [0.1] * 16, 1), (3, [0.1] * 16, 1), (None, [0.3] * 16, None), (None, None, 1)]
    rows += [(-1, None, 1), (-2, [], 1), (-3, [math.nan] * 16, 1), (-4, [None] * 16, 2), (-5, [math.inf] * 16, 2)]
    rows += [(-6, [0.5] * 7, 1), (-7, [1.0] * 8, 5), (-8, [-1.0] * 8, 5), (-9, [0.0] * 16, 1)]
    return rows


def test_matches_plain_rounds(spark):
    assert found(spark, odd_rows()) == brute(odd_rows())


def test_small_blocks_and_leaves(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK_ROWS", 7)
    monkeypatch.setattr(codes, "PAIRS", 5)
    assert found(spark, odd_rows(60)) == brute(odd_rows(60))


def test_few_rows(spark):
    rows = [(i, [float(i), 0.0] * 4, None) for i in range(3)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1), (2, [0.5] * 3, 1)]) == []


def test_too_large_components_are_refused():
    batch = codes.pa.RecordBatch.from_pylist([{"vec_id": 1, "label": 1, "v": [1 << 40] * 8}])
    with pytest.raises(ValueError):
        list(codes._pack_batches(iter([batch]), 8))


@pytest.mark.parametrize("seed", range(8))
def test_trees_choose_the_nearest(seed):
    """Every part's entry, counts and sums, also where groups are far apart and ties abound."""
    rng = np.random.default_rng(seed)
    n, width, size = int(rng.integers(1, 500)), int(rng.integers(1, 5)), int(rng.integers(1, 20))
    spread = int(rng.choice([2, 5, 1000]))
    points = rng.integers(-spread, spread, (n, width)) + rng.integers(0, 3, (n, 1)) * 100_000
    entries = np.concatenate([points[rng.integers(0, n, size)], points[:1]])
    tree = codes.Tree(points, 4)
    chosen, counts, sums = codes.assign(tree, entries)
    expected = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (chosen == expected[tree.order]).all()
    assert (counts == np.bincount(expected, minlength=len(entries))).all()
    assert (sums == np.stack([points[expected == e].sum(axis=0) for e in range(len(entries))])).all()


def test_whole_nodes_are_assigned(monkeypatch):
    """Parts in separate clouds never reach the leaves' distances."""
    rng = np.random.default_rng(1)
    centres = np.array([[0, 0], [10_000, 0], [0, 10_000], [10_000, 10_000]])
    points = (centres[:, None, :] + rng.integers(-50, 50, (4, 64, 2))).reshape(-1, 2)
    monkeypatch.setattr(codes, "_decide", lambda *a: pytest.fail("a leaf was decided part by part"))
    _, counts, sums = codes.assign(codes.Tree(points, 4), centres)
    assert counts.tolist() == [64] * 4
    assert (sums == points.reshape(4, 64, 2).sum(axis=1)).all()
