"""Exact k nearest neighbours by great-circle (or planar) distance.

Right rows on one coordinate are first reduced to those of the k lowest ids,
as ids decide ties.  What is left is put into a tree of boxes: points in
Z-order, sixteen to a leaf, sixteen boxes to the next larger one, each with the
number of points below it.  For a batch of left points the tree is opened from
the top, a level at a time, with numpy: a box gives a lower bound on the
distance of its points, and the nearest-ending boxes that hold k points
together give an upper bound on the k-th distance; only boxes whose lower bound
is not above the best upper bound so far are opened.  Bounds are straight-line
distances between unit vectors, so poles and the date line need no care.
``max_distance`` is the first upper bound; a point with nothing near is done at
the top of the tree.

Up to ``BLOCK_POINTS`` right points (a proven count) make one tree of numbers,
which is broadcast; the left side is then never shuffled.  More are cut into
blocks along the Z-order; a tree over the blocks' boxes (one row a block) tells
which blocks a left point may have a neighbour in, mostly one, and left points
meet blocks in co-grouped tasks, the points of a crowded block in several; the
lists of the blocks are merged.  Both ways use the same search, need no key on
the left side and give the same rows.  The other right columns are joined by
the right row's number, as a broadcast only if their files are small.

Ties: the order is (distance floored to 1 micrometre, right id), so two
candidates closer than 1e-6 m are decided by the lower id.  This makes the
answer independent of last-bit floating-point noise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.functions.geo import EARTH_RADIUS_M, haversine_m, planar_deg
from towerlens.operators.skew import broadcast_if_proven, spread, written

BLOCK_POINTS = 200_000
LEFT_PER_TASK = 100_000
_FAN = 16
_BATCH = 2048
_TIE_SCALE = 1.0e6          # distance ranking resolution: 1 micrometre (or 1e-6 degree)
_SLACK = 1.0e-10            # on straight-line distances, far above their rounding errors


def distance(metric: str, lx, ly, rx, ry) -> Column:
    if metric == "planar":
        return planar_deg(lx, ly, rx, ry)
    return haversine_m(lx, ly, rx, ry)


def _distances(metric: str, lx, ly, rx, ry) -> np.ndarray:
    if metric == "planar":
        return np.sqrt((rx - lx) ** 2 + (ry - ly) ** 2)
    p, q = np.radians(ly), np.radians(ry)
    a = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(rx - lx) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(1.0, a)))


def _vectors(metric: str, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Points in space whose straight-line distances order like the metric."""
    if metric == "planar":
        return np.stack((x, y, np.zeros(len(x))), axis=1)
    lon, lat = np.radians(x), np.radians(y)
    return np.stack((np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)), axis=1)


def _reach(metric: str, limit: float | None) -> float:
    """A distance limit as a straight-line one."""
    if limit is None:
        return np.inf
    if metric == "planar":
        return limit * (1 + 1e-9) + _SLACK
    return 2 * np.sin(min(limit / (2 * EARTH_RADIUS_M) * (1 + 1e-9), np.pi / 2)) + _SLACK


def _z_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Position on a Z curve over longitude and latitude, 31 bits each."""
    out = np.zeros(len(x), np.uint64)
    for k, v in enumerate((np.clip((x + 180.0) / 360.0, 0, 1), np.clip((y + 90.0) / 180.0, 0, 1))):
        b = (v * (2.0 ** 31 - 1)).astype(np.uint64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                            (2, 0x3333333333333333), (1, 0x5555555555555555)):
            b = (b | (b << np.uint64(shift))) & np.uint64(mask)
        out |= b << np.uint64(k)
    return (out >> np.uint64(1)).astype(np.int64)


def _bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Straight-line distances to the nearest and to the farthest place of boxes, pair by pair."""
    near = np.maximum(np.maximum(low - q, q - high), 0.0)
    far = np.maximum(np.abs(q - low), np.abs(q - high))
    return np.sqrt((near ** 2).sum(axis=1)), np.sqrt((far ** 2).sum(axis=1))


def _spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which span, and which number in it, for all numbers of all spans."""
    size = last - first
    owner = np.repeat(np.arange(len(first)), size)
    return owner, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)


class Boxes:
    """Boxes under larger boxes, sixteen to one, each with the number of points below it."""

    def __init__(self, low: np.ndarray, high: np.ndarray, count: np.ndarray):
        self.levels = [(low, high, count)]
        while len(low) > _FAN:
            cut = np.arange(0, len(low), _FAN)
            low, high, count = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.add.reduceat(count, cut)
            self.levels.append((low, high, count))

    def open(self, q: np.ndarray, reach: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (point, lowest box) that may hold one of the point's ``k`` nearest.

        At every level the boxes still open for a point hold different points: in the order of their farthest places,
        the first ones that hold ``k`` points together bound the distance of the ``k``-th nearest."""
        best = np.full(len(q), reach)
        top = len(self.levels[-1][0])
        who, box = np.divmod(np.arange(len(q) * top), top)
        for depth in range(len(self.levels) - 1, -1, -1):
            low, high, count = self.levels[depth]
            near, far = _bounds(q[who], low[box], high[box])
            if k == 1:
                np.minimum.at(best, who, far + _SLACK)
            else:
                np.minimum.at(best, *_kth(who, far + _SLACK, count[box], k))
            ok = near <= best[who]
            who, box = who[ok], box[ok]
            if depth:
                owner, box = _spans(box * _FAN, np.minimum((box + 1) * _FAN, len(self.levels[depth - 1][0])))
                who = who[owner]
        return who, box


def _kth(who: np.ndarray, far: np.ndarray, count: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each point whose boxes hold ``k`` points, the bound within which they lie."""
    order = np.lexsort((far, who))
    w, total = who[order], np.cumsum(count[order])
    new = np.concatenate(([True], w[1:] != w[:-1])) if len(w) else np.zeros(0, bool)
    before = np.maximum.accumulate(np.where(new, total - count[order], 0)) if len(w) else total
    enough = np.flatnonzero(total - before >= k)
    first = enough[np.concatenate(([True], w[enough][1:] != w[enough][:-1]))] if len(enough) else enough
    return w[first], far[order][first]


class BoxTree:
    """Right points (with a rank that decides ties) below boxes."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rank: np.ndarray, metric: str):
        order = np.argsort(_z_order(x, y), kind="stable")
        self.metric, self.row = metric, order
        self.x, self.y, self.rank = x[order], y[order], rank[order]
        v, cut = _vectors(metric, self.x, self.y), np.arange(0, len(x), _FAN)
        self.boxes = Boxes(np.minimum.reduceat(v, cut), np.maximum.reduceat(v, cut), np.diff(np.append(cut, len(x))))

    def nearest(self, x: np.ndarray, y: np.ndarray, limit: float | None, k: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each point, in order, its ``k`` nearest right points: point, row of the right point, distance."""
        found = [self._batch(x[at:at + _BATCH], y[at:at + _BATCH], at, limit, k) for at in range(0, len(x), _BATCH)]
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    def _batch(self, x, y, at, limit, k):
        who, box = self.boxes.open(_vectors(self.metric, x, y), _reach(self.metric, limit), k)
        owner, point = _spans(box * _FAN, np.minimum((box + 1) * _FAN, len(self.x)))
        who = who[owner]
        d = _distances(self.metric, x[who], y[who], self.x[point], self.y[point])
        order = np.lexsort((self.rank[point], np.floor(d * _TIE_SCALE), who))
        order = order[_place(who[order]) < k]
        return at + who[order], self.row[point[order]], d[order]


def _place(who: np.ndarray) -> np.ndarray:
    """Place of each entry among the entries of its point, from 0."""
    if not len(who):
        return who
    new = np.concatenate(([True], who[1:] != who[:-1]))
    return np.arange(len(who)) - np.maximum.accumulate(np.where(new, np.arange(len(who)), 0))


def _coordinates(right: DataFrame, right_xy: tuple[str, str], rcols: list[str], k: int) -> DataFrame:
    """The rows of the ``k`` lowest ids on each coordinate; no others can be among the ``k`` nearest."""
    x, y = (F.col(c).cast("double") for c in right_xy)
    rows = right.select(x.alias("_rx"), y.alias("_ry"), F.struct(*[F.col(c) for c in rcols]).alias("_r")).filter(
        F.col("_rx").isNotNull() & F.col("_ry").isNotNull() & ~F.isnan("_rx") & ~F.isnan("_ry"))
    if k == 1:
        rows = rows.groupBy("_rx", "_ry").agg(F.min("_r").alias("_r"))
    else:       # the limit on the row number is applied before the shuffle as well, so a crowded place stays small
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_rx", "_ry").orderBy("_r"))).filter(F.col("_n") <= k).drop("_n")
    return rows.withColumn("_rk", F.monotonically_increasing_id())


def _tree_of(table: pa.Table, metric: str) -> tuple[BoxTree, np.ndarray, list]:
    ids, keys = table.column("_id").to_pylist(), table.column("_rk").to_numpy()
    rank = np.empty(len(ids), np.int64)
    rank[sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k]))] = np.arange(len(ids))
    x, y = (table.column(c).to_numpy().astype(float) for c in ("_rx", "_ry"))
    return BoxTree(x, y, rank, metric), keys, ids


def _finite(batch, names=("_lx", "_ly")) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, y = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names)
    return x, y, np.flatnonzero(np.isfinite(x) & np.isfinite(y))


def _with_tree(rows: DataFrame, pts: DataFrame, metric: str, limit: float | None, k: int) -> DataFrame:
    """Left rows with the key of each of their nearest right rows and its place (from 1); the tree goes to every task."""
    tree, keys, _ = _tree_of(pts.select("_rx", "_ry", F.col("_r._id").alias("_id"), "_rk").toArrow(), metric)
    shared = rows.sparkSession.sparkContext.broadcast((tree, keys))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys = shared.value
        for batch in batches:
            x, y, known = _finite(batch)
            who, row, _ = tree.nearest(x[known], y[known], limit, k)
            who = known[who]
            none = np.setdiff1d(np.arange(len(x)), who)              # rows without an answer stay, once
            out = batch if k == 1 and not len(none) else batch.take(pa.array(np.concatenate((who, none))))
            absent = pa.nulls(len(none), pa.int64())
            rk = pa.concat_arrays([pa.array(keys[row], pa.int64()), absent])
            nth = pa.concat_arrays([pa.array(_place(who) + 1, pa.int64()), absent])
            yield pa.RecordBatch.from_arrays([*out.columns, rk, nth], [*out.schema.names, "_rk", "_nth"])

    return rows.mapInArrow(search, T.StructType([*rows.schema.fields, T.StructField("_rk", T.LongType()), T.StructField("_nth", T.LongType())]))


def _blocks(pts: DataFrame, n: int, block_points: int, metric: str) -> DataFrame:
    """Right points in blocks along the Z curve, written."""
    def z(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, _ = _finite(batch, ("_rx", "_ry"))
            v = _vectors(metric, x, y)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_z_order(x, y)), *[pa.array(v[:, i]) for i in range(3)]],
                                             [*batch.schema.names, "_z", "_v0", "_v1", "_v2"])

    slim = pts.select("_rx", "_ry", F.col("_r._id").alias("_id"), "_rk")
    more = [T.StructField("_z", T.LongType()), *[T.StructField(f"_v{i}", T.DoubleType()) for i in range(3)]]
    return written(slim.mapInArrow(z, T.StructType([*slim.schema.fields, *more]))
                   .repartitionByRange(-(-n // block_points), "_z").withColumn("_block", F.spark_partition_id()), "blocks")


def _with_blocks(rows: DataFrame, pts: DataFrame, n: int, block_points: int, metric: str, limit: float | None, k: int) -> DataFrame:
    """The same with right points in blocks: a tree over the blocks' boxes tells which blocks a left point may have
    one of its ``k`` nearest in, and the best ``k`` of what those blocks answer are its answer."""
    blocks = _blocks(pts, n, block_points, metric)
    box = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("n"), *[f(f"_v{i}").alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(3)]).collect()
    box.sort(key=lambda r: r["_block"])                          # one row for each block, in the order of the curve
    names, count = np.asarray([r["_block"] for r in box]), np.asarray([r["n"] for r in box])
    tree = Boxes(*(np.asarray([[r[f"{f}{i}"] for i in range(3)] for r in box]) for f in ("min", "max")), count)
    shared = rows.sparkSession.sparkContext.broadcast((tree, names))
    rows = written(rows.withColumn("_lid", F.monotonically_increasing_id()), "left")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, names = shared.value
        for batch in batches:
            x, y, known = _finite(batch)
            for at in range(0, len(known), _BATCH):
                mine = known[at:at + _BATCH]
                who, b = tree.open(_vectors(metric, x[mine], y[mine]), _reach(metric, limit), k)
                at_row = mine[who]
                yield pa.RecordBatch.from_arrays([batch.column("_lid").take(pa.array(at_row)), pa.array(x[at_row]), pa.array(y[at_row]),
                                                  pa.array(names[b], pa.int32())], ["_lid", "_lx", "_ly", "_block"])

    asked = rows.select("_lid", "_lx", "_ly").mapInArrow(assign, "_lid long, _lx double, _ly double, _block int")
    cuts = asked.groupBy("_block").agg(F.ceil(F.count(F.lit(1)) / LEFT_PER_TASK).cast("int").alias("_cuts")).collect()     # one row for each block
    cuts = F.broadcast(rows.sparkSession.createDataFrame(cuts, "_block int, _cuts int"))
    asked = asked.join(cuts, "_block").withColumn("_cut", F.pmod(F.xxhash64("_lid"), F.col("_cuts")).cast("int"))
    offered = blocks.select("_block", "_rx", "_ry", "_id", "_rk").join(cuts, "_block").withColumn(
        "_cut", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
    id_type = blocks.schema["_id"].dataType

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        tree, keys, ids = _tree_of(right, metric)
        x, y = (left.column(c).to_numpy().astype(float) for c in ("_lx", "_ly"))
        who, row, d = tree.nearest(x, y, limit, k)
        return pa.table({"_lid": left.column("_lid").take(pa.array(who)), "_dk": pa.array(np.floor(d * _TIE_SCALE).astype(np.int64)),
                         "_id": pa.array([ids[i] for i in row], right.schema.field("_id").type), "_rk": pa.array(keys[row], pa.int64())})

    found = asked.drop("_cuts").groupBy("_block", "_cut").cogroup(offered.drop("_cuts").groupBy("_block", "_cut")).applyInArrow(
        search, T.StructType([T.StructField("_lid", T.LongType()), T.StructField("_dk", T.LongType()), T.StructField("_id", id_type),
                              T.StructField("_rk", T.LongType())]))
    answer = F.struct("_dk", "_id", "_rk")
    if k == 1:
        best = found.groupBy("_lid").agg(F.min(answer)["_rk"].alias("_rk")).withColumn("_nth", F.lit(1).cast("long"))
    else:       # at most k answers from each of the few blocks of a point
        best = found.groupBy("_lid").agg(F.slice(F.sort_array(F.collect_list(answer)), 1, k).alias("_all")).select(
            "_lid", F.posexplode("_all").alias("_at", "_one")).select("_lid", F.col("_one._rk").alias("_rk"), (F.col("_at") + 1).cast("long").alias("_nth"))
    return rows.join(best, "_lid", "left").drop("_lid")


def nearest(left: DataFrame, right: DataFrame, *, left_xy: tuple[str, str], right_xy: tuple[str, str],
            right_id: str, right_cols: Sequence[str] = (), dist_col: str = "distance_m", how: str = "inner",
            metric: str = "sphere", max_distance: float | None = None, k: int = 1, rank_col: str | None = None,
            block_points: int = BLOCK_POINTS) -> DataFrame:
    """For every left row, the ``k`` nearest right rows.

    Returns the left columns, ``right_cols`` (``right_id`` first), ``dist_col`` (unrounded metres, or degrees for
    ``metric='planar'``) and, if named, ``rank_col`` (1 for the nearest).  A left row comes once for each answer.
    ``how='inner'`` drops left rows without an answer (no right rows, NULL coordinates, or nothing within
    ``max_distance``); ``how='left'`` keeps them once with NULLs.  Left rows may repeat; right rows that share a
    coordinate or an id are rows of their own.
    """
    if k < 1:
        raise ValueError(f"nearest: k is {k}")
    rcols = [right_id] + [c for c in right_cols if c != right_id]
    clash = [c for c in rcols + [dist_col] + [rank_col] * (rank_col is not None) if c in left.columns]
    if clash:
        raise ValueError(f"nearest: output columns already on the left side: {clash}")
    named = right.select(*[F.col(f"`{c}`").alias(f"_{'x' if c == right_xy[0] else 'y'}") for c in right_xy],
                         *[F.col(f"`{c}`").alias("_id" if c == right_id else f"_c{i}") for i, c in enumerate(rcols)])
    pts = written(_coordinates(named, ("_x", "_y"), ["_id", *[f"_c{i}" for i in range(1, len(rcols))]], k), "points")
    n = pts.count()
    rows = spread(left).select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"),
                               F.col(left_xy[0]).cast("double").alias("_lx"), F.col(left_xy[1]).cast("double").alias("_ly"))
    if not n:
        found = rows.withColumns({"_rk": F.lit(None).cast("long"), "_nth": F.lit(None).cast("long")})
    elif n <= block_points:
        found = _with_tree(rows, pts, metric, max_distance, k)
    else:
        found = _with_blocks(rows, pts, n, block_points, metric, max_distance, k)
    side = pts.select("_rk", "_rx", "_ry", "_r")
    joined = found.join(broadcast_if_proven(side), "_rk", "left").withColumn(
        "_d", F.when(F.col("_rk").isNotNull(), distance(metric, F.col("_lx"), F.col("_ly"), F.col("_rx"), F.col("_ry"))))
    if max_distance is not None:
        near = F.col("_d") <= F.lit(float(max_distance))
        if k > 1:       # answers are in order of distance, so a row without any has none at its first place
            joined = joined.filter(F.coalesce(near, F.lit(False)) | (F.coalesce(F.col("_nth"), F.lit(1)) == 1))
        joined = joined.withColumns({c: F.when(near, F.col(c)) for c in ("_r", "_nth", "_d")})
    if how == "inner":
        joined = joined.filter(F.col("_d").isNotNull())
    out = [F.col("_r")["_id" if i == 0 else f"_c{i}"].alias(c) for i, c in enumerate(rcols)]
    return joined.select("_row.*", *out, F.col("_d").alias(dist_col), *[F.col("_nth").cast("int").alias(c) for c in [rank_col] if c])
