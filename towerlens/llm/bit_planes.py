"""Clusters around centroids by exact integer distances from bit planes.

A vector of 64 components becomes 64 integers, ``floor(scale * x)``, and is
stored as bit planes: plane ``i`` holds bit ``i`` of every component in one
unsigned 64-bit word, the last plane the sign (two's complement).  With plane
weights ``w = 1, 2, 4, ..., -2**(B-1)``, the dot product of two vectors is

    sum over i, j of  w[i] * w[j] * popcount(x[i] & c[j])

and squared distances follow as ``|x|**2 - 2 x.c + |c|**2``: all exact, no
float arithmetic.  The planes are written once; each round is one pass over
them with the centroids in the task (k times 64 integers), after which every
task gives at most k rows of sums.  Only those sums come to the driver, added
up by Spark, so nothing there grows with the table.

Defined cases: vectors that are null, of other than 64 components, or hold a
null or non-finite component are left out; repeated rows are vectors like any
others; ids may be null or repeat (the start takes null as an empty text, equal
ids in the order of their planes); fewer vectors than ``k`` give as many
centroids; no vector gives no row.  Components whose integer exceeds ``LIMIT``
would not leave room for a distance in 64 bits and are an error.  Further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stored

COMPONENTS = 64
SCALE = 256.0
LIMIT = 1 << 27
_ROWS = 1024                 # vectors compared with all centroids at a time
_SUM = "decimal(38,0)"


def plane_count(least: int, most: int) -> int:
    """Planes that hold every integer from ``least`` to ``most`` in two's complement."""
    return max(1, int(most).bit_length(), int(~least).bit_length() if least < 0 else 0) + 1


def to_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """``(n, 64)`` integers as ``(n, bits)`` words; bit ``p`` of a word belongs to component ``p``."""
    out = np.empty((len(values), bits), np.uint64)
    for i in range(bits):
        out[:, i] = np.packbits(((values >> i) & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def _bits_of(words: np.ndarray) -> np.ndarray:
    """The 64 bits of each word, one component a column."""
    return np.unpackbits(np.ascontiguousarray(words, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def weights(bits: int) -> np.ndarray:
    w = np.int64(1) << np.arange(bits, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def from_planes(planes: np.ndarray) -> np.ndarray:
    w = weights(planes.shape[1])
    return sum(_bits_of(planes[:, i]).astype(np.int64) * w[i] for i in range(planes.shape[1]))


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Dot products of every vector with every centroid, both as planes."""
    wx, wc = weights(x.shape[1]), weights(c.shape[1])
    total = np.zeros((len(x), len(c)), np.int64)
    both, ones, part = np.empty(total.shape, np.uint64), np.empty(total.shape, np.uint8), np.empty(total.shape, np.int64)
    for i in range(x.shape[1]):
        for j in range(c.shape[1]):
            np.bitwise_and(x[:, i, None], c[None, :, j], out=both)
            np.bitwise_count(both, out=ones)
            np.multiply(ones, wx[i] * wc[j], out=part)
            total += part
    return total


def squares(x: np.ndarray) -> np.ndarray:
    """Squared length of each vector, from its planes."""
    w = weights(x.shape[1])
    total = np.zeros(len(x), np.int64)
    for i in range(x.shape[1]):
        for j in range(i, x.shape[1]):
            total += np.bitwise_count(x[:, i] & x[:, j]).astype(np.int64) * (w[i] * w[j] * (1 if i == j else 2))
    return total


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector (the smaller number on ties) and the squared distance."""
    cluster, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    own = squares(c)
    for at in range(0, len(x), _ROWS):
        some = x[at:at + _ROWS]
        d = squares(some)[:, None] - 2 * dots(some, c) + own
        best = d.argmin(axis=1)
        cluster[at:at + _ROWS] = best
        distance[at:at + _ROWS] = d[np.arange(len(some)), best]
    return cluster, distance


def cluster_sums(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Componentwise sums of the vectors of each cluster, counted plane by plane."""
    sums = np.zeros((k, COMPONENTS), np.int64)
    order = np.argsort(cluster, kind="stable")
    present, start = np.unique(cluster[order], return_index=True)
    for i, w in enumerate(weights(x.shape[1])):
        sums[present] += np.add.reduceat(_bits_of(x[order, i]), start, axis=0, dtype=np.int64) * w
    return sums


def _words(batch: pa.RecordBatch, bits: int) -> np.ndarray:
    return batch.column("planes").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, bits)


def plane_table(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``vec_id, planes`` of every vector that counts, stored, and the number of planes."""
    vector = F.col("vector")
    usable = (F.size("vector") == COMPONENTS) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
            .where(vector.isNotNull()).where(F.coalesce(usable, F.lit(False))))
    low, high = kept.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    least, most = (0, 0) if low is None else (int(np.floor(SCALE * low)), int(np.floor(SCALE * high)))
    if max(-least, most) > LIMIT:
        raise ValueError(f"components between {low} and {high}: beyond {LIMIT} after scaling, a distance has no room in 64 bits")
    bits = plane_count(least, most)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)
                words = to_planes(np.floor(SCALE * x).astype(np.int64), bits).view(np.int64).ravel()
                offsets = pa.array(np.arange(0, len(words) + 1, bits, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.ListArray.from_arrays(offsets, pa.array(words))],
                                                 ["vec_id", "planes"])

    return stored(kept.mapInArrow(pack, "vec_id long, planes array<long>"), "planes"), bits


@dataclass
class Clusters:
    """``assigned`` has ``vec_id, cluster, distance``; ``centroids`` are the final ones; ``inertia`` is theirs, one each."""

    assigned: DataFrame
    centroids: list[list[int]]
    inertia: list[int]


def cluster(df: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2", id_col: str = "vec_id",
            vector_col: str = "embedding") -> Clusters:
    """Lloyd rounds on integer vectors, started from the ``k`` vectors whose ``seed:id`` has the least SHA-256."""
    table, bits = plane_table(df, id_col, vector_col)
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = table.orderBy(place, "planes").limit(k).select("planes").collect()      # k rows
    if not first:
        return Clusters(table.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [], [])
    centroids = from_planes(np.asarray([r[0] for r in first], np.int64).view(np.uint64)).tolist()
    for _ in range(rounds):
        planes = _centroid_planes(centroids)

        def add_up(batches: Iterator[pa.RecordBatch], planes: np.ndarray = planes) -> Iterator[pa.RecordBatch]:
            count, sums = np.zeros(len(planes), np.int64), np.zeros((len(planes), COMPONENTS), np.int64)
            for batch in batches:
                if batch.num_rows:
                    x = _words(batch, bits)
                    near, _ = nearest(x, planes)
                    count += np.bincount(near, minlength=len(planes))
                    sums += cluster_sums(x, near, len(planes))
            some = np.flatnonzero(count)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(sums[some]))],
                                                 ["cluster", "n", "sums"])

        total = [F.sum(F.col("sums")[p].cast(_SUM)).alias(f"s{p}") for p in range(COMPONENTS)]
        rows = (table.mapInArrow(add_up, "cluster int, n long, sums array<long>").groupBy("cluster")
                .agg(F.sum("n").alias("n"), *total).collect())                    # at most k rows
        for r in rows:
            centroids[r["cluster"]] = [int(r[f"s{p}"]) // r["n"] for p in range(COMPONENTS)]
    planes = _centroid_planes(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near, distance = nearest(_words(batch, bits), planes)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(near, pa.int32()), pa.array(distance)],
                                                 ["vec_id", "cluster", "distance"])

    assigned = stored(table.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters")
    inertia = [0] * len(centroids)
    for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast(_SUM)).alias("d")).collect():     # at most k rows
        inertia[r["cluster"]] = int(r["d"])
    return Clusters(assigned, centroids, inertia)


def _centroid_planes(centroids: list[list[int]]) -> np.ndarray:
    values = np.asarray(centroids, np.int64)
    return to_planes(values, plane_count(int(values.min()), int(values.max())))


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
