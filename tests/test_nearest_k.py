"""The k nearest against a full sort, with shared coordinates, ties, limits and crowded places."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import towerlens.operators.nearest as module
from towerlens.operators.nearest import Boxes, nearest


def brute(left, right, k, limit=None, metric="sphere"):
    out = []
    for pid, x, y in left:
        if x is None or y is None or x != x or y != y:
            out.append((pid, None, None))
            continue
        d = []
        for tid, rx, ry in right:
            if rx is not None and ry is not None:
                m = float(module._distances(metric, np.asarray([x]), np.asarray([y]), np.asarray([rx]), np.asarray([ry]))[0])
                d.append((int(m * 1e6 // 1), tid, m))
        some = [(t, n + 1) for n, (_, t, m) in enumerate(sorted(d)[:k]) if limit is None or m <= limit]
        out += [(pid, t, n) for t, n in some] or [(pid, None, None)]
    return sorted(out, key=repr)


def scene(seed=6):
    rng = random.Random(seed)
    spots = [(rng.uniform(-122.5, -122.1), rng.uniform(47.5, 47.8)) for _ in range(60)]
    right = [(i, *rng.choice(spots)) for i in range(150)] + [(1000 + i, *spots[0]) for i in range(40)]      # a crowded place
    right += [(3000, 179.99, 10.0), (3001, -179.99, 10.0), (3002, 0.0, 89.9), (3003, None, 1.0)]
    rng.shuffle(right)
    left = [(i, rng.uniform(-122.6, -122.0), rng.uniform(47.4, 47.9)) for i in range(120)] + [(500, *spots[0]), (501, 180.0, 10.0), (502, 90.0, 90.0),
                                                                                           (503, None, 3.0), (504, float("nan"), 3.0)]
    return left, right


def answers(spark, left, right, **kw):
    a = spark.createDataFrame(left, "pid long, x double, y double")
    b = spark.createDataFrame(right, "tid long, tx double, ty double").withColumn("note", F.concat(F.lit("t"), "tid"))
    got = nearest(a, b, left_xy=("x", "y"), right_xy=("tx", "ty"), right_id="tid", right_cols=["note"], rank_col="place", **kw).collect()
    assert all(r["note"] == (None if r["tid"] is None else f"t{r['tid']}") for r in got)
    return sorted(((r["pid"], r["tid"], r["place"]) for r in got), key=repr)


@pytest.mark.parametrize("block_points", [200_000, 20])
@pytest.mark.parametrize("k,limit", [(1, None), (3, None), (3, 2500.0), (25, None), (500, None)])
def test_k_nearest_against_a_full_sort(spark, monkeypatch, block_points, k, limit):
    monkeypatch.setattr(module, "LEFT_PER_TASK", 60)
    left, right = scene()
    want = brute(left, right, k, limit)
    assert answers(spark, left, right, k=k, max_distance=limit, how="left", block_points=block_points) == want
    inner = answers(spark, left, right, k=k, max_distance=limit, block_points=block_points)
    assert inner == [w for w in want if w[1] is not None]


@pytest.mark.parametrize("block_points", [200_000, 20])
def test_k_nearest_planar_and_shuffled_columns(spark, monkeypatch, block_points):
    monkeypatch.setattr("towerlens.operators.skew.BROADCAST_BYTES", 0)
    left, right = scene(9)
    assert answers(spark, left, right, k=4, how="left", metric="planar", block_points=block_points) == brute(left, right, 4, metric="planar")


def test_no_right_rows_and_bad_k(spark):
    left, _ = scene()
    assert answers(spark, left, [], k=3) == []
    assert len(answers(spark, left, [], k=3, how="left")) == len(left)
    with pytest.raises(ValueError):
        answers(spark, left, [], k=0)


def test_a_tree_over_blocks_opens_few_of_them():
    """Boxes tested for a point grow with the logarithm of their number, not with the number."""
    rng = np.random.default_rng(3)
    x, y = rng.uniform(-125, -115, 60_000), rng.uniform(40, 48, 60_000)
    order = np.argsort(module._z_order(x, y))
    v, cut = module._vectors("sphere", x[order], y[order]), np.arange(0, 60_000, 12)
    tree = Boxes(np.minimum.reduceat(v, cut), np.maximum.reduceat(v, cut), np.full(len(cut), 12))
    tested = []
    real = module._bounds
    module._bounds = lambda q, low, high: tested.append(len(q)) or real(q, low, high)
    try:
        q = module._vectors("sphere", rng.uniform(-125, -115, 500), rng.uniform(40, 48, 500))
        who, box = tree.open(q, np.inf, 3)
    finally:
        module._bounds = real
    assert len(tree.levels[0][0]) == 5000 and sum(tested) / 500 < 800 and len(who) / 500 < 20
