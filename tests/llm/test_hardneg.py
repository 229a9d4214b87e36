"""Hard negatives against all pairs, the curve's order and the zone maps' bounds."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import hardneg as H

VECTORS = "vec_id long, embedding array<float>, label int, score string, block int"


def test_curve_visits_neighbours():
    """Consecutive places of a full grid differ by one step in one dimension."""
    for dims, bits in ((1, 4), (2, 4), (3, 3), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = H.hilbert_keys(grid, bits)
        assert len(set(keys)) == len(grid)
        walk = grid[sorted(range(len(grid)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_bounds_hold_all_products():
    rng = np.random.default_rng(1)
    for size in (1, 1 << 40):
        block, anchors = rng.integers(-9, 10, (50, 8)) * size, rng.integers(-9, 10, (20, 8)) * size
        low, high = H.bounds(anchors.astype(float), block.min(0)[None].astype(float), block.max(0)[None].astype(float))
        products = block.astype(object) @ anchors.astype(object).T
        assert (low[:, 0] <= products.min(0)).all() and (products.max(0) <= high[:, 0]).all()


def expected(rows, positives=5, negatives=5):
    kept = set()
    for vec_id, v, label, *_ in rows:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        long = [int(np.clip(np.floor(float(np.float32(x)) * 256), -(2**63), 2**63 - 1)) for x in v]
        kept.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(long)))
    out = []
    for a in (r for r in kept if r[0] % 100 == 0):
        scored = [
            (-max(min(sum(x * y for x, y in zip(a[2], b[2], strict=True)), 2**63 - 1), 1 - 2**63), b[0], b[1] == a[1])
            for b in kept
            if b != a and len(b[2]) == len(a[2])
        ]
        scored.sort()
        for ps, positive, _ in [s for s in scored if s[2]][:positives]:
            fit = [s for s in scored if not s[2] and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:negatives]
            out += [(a[0], positive, i, n, -ps, -s) for i, (s, n, _) in enumerate(fit, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def mine(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return H.mine(df, F.col("vec_id") % 100 == 0, label)


def rows():
    """A third of the rows in one place, ties, copies, NULLs, odd lengths, ids that repeat."""
    rng = random.Random(3)
    cloud = [(i, [rng.gauss(0, 0.4) + (i % 3 == 0) for _ in range(6)], rng.randrange(4), "x", 1) for i in range(0, 900, 3)]
    hot = [(i, [0.5, 0.25, 0.5, -0.25, 0.0, 1.0], i % 3, "x", 1) for i in range(1, 500, 3)]
    odd = [
        (100, [0.1] * 6, 1, None, None), (100, [0.1] * 6, 1, None, None), (100, [0.1] * 6, 2, None, None), (100, [0.9] * 6, 1, None, None),
        (None, [0.5] * 6, 1, "x", 1), (2000, None, 1, "x", 1), (2001, [0.5] * 6, None, "x", 1), (2100, [0.5, None] * 3, 1, "x", 1),
        (2200, [float("nan")] * 6, 1, "x", 1), (2300, [float("inf")] * 6, 1, "x", 1), (2400, [0.5, 0.5], 1, "x", 1),
        (2401, [0.5, 0.4], 1, "x", 1), (2402, [0.5, 0.4], 2, "x", 1), (2500, [], 1, "x", 1), (2501, [], 1, "x", 1), (2502, [], 2, "x", 1),
        (2600, [1e12, -1e12], 1, "x", 1), (2601, [1e12, 1e12], 1, "x", 1), (2602, [1e11, -1e12], 2, "x", 1), (2603, [3e18, 1.0], 2, "x", 1),
    ]
    return cloud + hot + odd


@pytest.mark.parametrize("block_rows, zones, anchors, partitions", [(1_024, 2_048, 2_048, 4), (16, 3, 2, 5), (1, 8, 3, 3)])
def test_equals_all_pairs(spark, conf, monkeypatch, block_rows, zones, anchors, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    for name, value in (("BLOCK_ROWS", block_rows), ("PAGE_ZONES", zones), ("SLICE_ANCHORS", anchors)):
        monkeypatch.setattr(H, name, value)
    want = expected(rows())
    assert len(want) > 100
    assert got(mine(spark.createDataFrame(rows(), VECTORS))) == want


def test_blocks_out_of_reach_are_not_read(spark, monkeypatch):
    """Four clusters far apart: an anchor reads its own cluster's blocks and few of mixed ones."""
    monkeypatch.setattr(H, "BLOCK_ROWS", 20)
    rng = random.Random(4)
    near = [(i, [(i % 4 == d) * 4 + rng.random() / 8 for d in range(4)], i % 8 // 4, "x", 1) for i in range(800)]
    df = spark.createDataFrame(near, VECTORS)
    asked = []
    choose = H._Blocks.choose
    monkeypatch.setattr(H._Blocks, "choose", lambda self, a: asked.append((self.table.count(), a.count(), choose(self, a))) or asked[-1][2])
    assert got(mine(df)) == expected(near)
    for blocks, anchors, chosen in asked:
        assert chosen.count() < 0.4 * blocks * anchors


def test_empty(spark):
    df = spark.createDataFrame(rows(), VECTORS)
    assert mine(df.where("false")).count() == 0
    assert mine(df.where("vec_id % 100 > 0")).count() == 0
    assert mine(df.where("vec_id = 300")).count() == 0
