import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from towerlens.llm import bit_planes, queries

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=40, rounds=5):
    """Plain integers, one vector after the other."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest()))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, g in groups.items():
            centroids[n] = [sum(col) // len(g) for col in zip(*g)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    per = {}
    for _, d, n in found:
        per[n] = per.get(n, 0) + d
    return sorted(((i, n, d, per[n], total, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in found), key=repr)


def test_planes_are_exact():
    rng = np.random.default_rng(1)
    for low, high in ((-5, 4), (0, 0), (-256, 255), (-257, 256), (0, 1), (-1, 0), (-(1 << 27), 1 << 27)):
        x = rng.integers(low, high + 1, (50, 64))
        c = rng.integers(min(low, -3), max(high, 3) + 1, (7, 64))
        x[0], x[1] = low, high
        px, pc = (bit_planes.to_planes(v, bit_planes.plane_count(int(v.min()), int(v.max()))) for v in (x, c))
        assert (bit_planes.from_planes(px) == x).all()
        assert (bit_planes.dots(px, pc) == x @ c.T).all()
        assert (bit_planes.squares(px) == (x * x).sum(axis=1)).all()
        near, distance = bit_planes.nearest(px, pc)
        full = ((x[:, None] - c) ** 2).sum(axis=2)
        assert (near == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
        sums = bit_planes.cluster_sums(px, near, 7)
        assert (sums == np.stack([x[near == n].sum(axis=0) for n in range(7)])).all()


def test_clusters_against_plain_integers(spark, tmp_path):
    rng = random.Random(4)
    middles = [[rng.gauss(0, 0.2) for _ in range(64)] for _ in range(9)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.1))) for x in rng.choice(middles)]) for i in range(260)]
    rows += [(1000 + i, middles[0]) for i in range(150)]           # a hot vector
    rows += [(2000, None), (2001, []), (2002, [0.5] * 63), (2003, [0.5] * 65), (2004, [0.5] * 63 + [None]), (2005, [math.nan] + [0.0] * 63),
             (2006, [math.inf] + [0.0] * 63), (None, [0.25] * 64), (2007, [-0.0] * 64), (2008, [-1.0] * 64), (2009, [31.7] * 64), (5, rows[5][1])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("x")).withColumn("planes", F.lit(1)).repartition(5)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_bit_planes(spark, str(tmp_path))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_few_vectors_and_none(spark, tmp_path):
    few = [(i, [i / 10] * 64) for i in range(3)]
    spark.createDataFrame(few, SCHEMA).write.parquet(f"{tmp_path}/few/embeddings.parquet")
    assert sorted((tuple(r) for r in queries.op12_bit_planes(spark, f"{tmp_path}/few").collect()), key=repr) == brute(few)
    spark.createDataFrame([(1, [0.0] * 3)], SCHEMA).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert queries.op12_bit_planes(spark, f"{tmp_path}/none").collect() == []
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/empty/embeddings.parquet")
    assert queries.op12_bit_planes(spark, f"{tmp_path}/empty").collect() == []


def test_components_without_room_are_an_error(spark):
    with pytest.raises(ValueError, match="64 bits"):
        bit_planes.cluster(spark.createDataFrame([(1, [1e9] * 64)], SCHEMA))
