import math
import random

import numpy as np
import pytest

from seatrace.llm import near_vectors as near
from seatrace.llm.components import Groups
from tests.llm.fixtures import collected

SCHEMA = (
    "vec_id long, embedding array<float>, label int, x int, _x int, tile int, node int, dim int, "
    "copies int, first int, links int, _links int, component int, root int"
)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, *range(11)) for i, v in rows], SCHEMA).repartition(4)


def brute(rows, threshold=0.9):
    unit = []
    for _, v in rows:
        good = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float32).astype(float) if good else None
        unit.append(x / np.sqrt((x / np.abs(x).max() * (x / np.abs(x).max())).sum()) / np.abs(x).max() if good else None)
    n = len(rows)
    links = [
        {j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None
         and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold}
        for i in range(n)
    ]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((vec_id, len(links[i]), component, vec_id == component))
    return sorted(out, key=repr)


def near_row(rng, centre, spread):
    return [x + rng.gauss(0, spread) for x in centre]


def odd_rows(n=120, dim=12):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(1000 + i, near_row(rng, centres[i % 5], 0.25)) for i in range(n)]
    rows += [(2000 + i, centres[0]) for i in range(40)]
    rows += [
        (None, centres[1]), (None, centres[1]), (None, [5.0] * 3), (7, centres[2]), (7, centres[2]), (7, centres[3]),
        (-1, None), (-2, []), (-3, [0.0] * dim), (-4, [math.nan] * dim), (-5, [None] * dim), (-6, [math.inf] * dim),
        (-7, [1.0, 0.0]), (-8, [1.0, 0.1]), (-9, [-1.0, 0.0]), (-10, [1e-30, 0.0]), (-11, [3e38, 3e37]), (-12, [2.0]),
    ]
    return rows


def test_matches_brute_force(spark):
    got = collected(near.near_vectors(vectors(spark, odd_rows())))
    assert got == brute(odd_rows())


def test_many_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(near, "TILE_BYTES", 300)
    monkeypatch.setattr(near, "BLOCK", 8)
    rows = odd_rows(60)
    assert collected(near.near_vectors(vectors(spark, rows))) == brute(rows)


@pytest.mark.parametrize("threshold", [0.5, 0.99])
def test_other_thresholds(spark, threshold):
    rows = odd_rows(40)
    assert collected(near.near_vectors(vectors(spark, rows), threshold)) == brute(rows, threshold)


def test_empty_and_nothing_usable(spark):
    assert near.near_vectors(vectors(spark, [])).collect() == []
    got = collected(near.near_vectors(vectors(spark, [(1, None), (2, [0.0]), (None, None)])))
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)], key=repr)


def test_bounds_hold():
    """No cosine lies further from the product of the codes than the bound; open pairs are few."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 64)) * rng.choice([1e-20, 1.0, 1e6], (300, 1))
    x[:20] *= rng.random((20, 64)) < 0.1
    x = x[np.abs(x).max(axis=1) > 0]
    unit, codes, scale, loss = near.quantise(x)
    product = codes.astype(int) @ codes.astype(int).T * scale[:, None] * scale
    off = loss[:, None] + loss + loss[:, None] * loss
    assert (np.abs(unit @ unit.T - product) <= off).all()
    side = near.Side(np.arange(len(x)), codes, scale, loss, np.ones(len(x), int))
    pairs = [(i, j, s) for a, b, c in near.near_pairs(side, side, True, 0.3) for i, j, s in zip(a, b, c)]
    found = {(i, j) for i, j, _ in pairs}
    reached = {(i, j) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.3, 1)))}
    assert reached <= found and {(i, j) for i, j, s in pairs if s} <= reached
    assert sum(not s for *_, s in pairs) < 0.1 * len(x) ** 2


def test_only_open_pairs_are_recomputed(monkeypatch):
    """Pairs that the codes decide never reach the full-precision products."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(1, 32))
    x = np.concatenate([base + rng.normal(size=(50, 32)) * 1e-3, rng.normal(size=(200, 32))])
    _, codes, scale, loss = near.quantise(x)
    side = near.Side(np.arange(len(x)), codes, scale, loss, np.ones(len(x), int))
    sure = [s for _, _, c in near.near_pairs(side, side, True, 0.9) for s in c]
    assert sum(sure) == len(sure) == 50 * 49 // 2


def test_groups_join_as_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = int(rng.integers(1, 60))
        u, v = rng.integers(0, n, (2, int(rng.integers(0, 60))))
        groups = Groups(n)
        groups.join(u[::2], v[::2])
        groups.join(u[1::2], v[1::2])
        label = np.arange(n)
        for _ in range(n):
            for a, b in zip(u, v):
                label[a] = label[b] = min(label[a], label[b])
        assert (groups.label == label).all()
        a, b = groups.edges()
        again = Groups(n)
        again.join(a, b)
        assert (again.label == label).all()
        assert len(a) == n - len(set(label.tolist()))
        assert np.bincount(np.concatenate([a, b]), minlength=n).max(initial=0) <= 3
