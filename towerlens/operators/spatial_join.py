"""Point-in-polygon join (``JOIN ... ON ST_Contains(polygon, point)``).

A theta join on ``ST_Contains`` is a nested loop over all (point, polygon)
pairs.  Here it becomes an equi-join on a tile key:

1. each polygon (or multipolygon) is parsed once and stored; its tile size is
   the power of two above its own extent, so its bounding box touches at most
   four tiles, whatever the other polygons look like;
2. each point gets the key of its tile at every size that occurs (at most one
   for each power of two between the smallest and the largest polygon);
3. points and polygons join on size and tile, a bounding-box test drops most
   candidates cheaply, and the exact ray-casting test over all parts decides.

A polygon is found from every tile its box touches, and a point lies in
exactly one tile of each size, so each (point, polygon) pair is tested once: no
duplicates, no misses.  The polygons are broadcast when they are proven to take
few bytes; otherwise the join shuffles with hot tiles salted.

A polygon of more than ``COVER_VERTICES`` vertices is covered by finer tiles
instead (``polygon_cover``): those inside as a whole need no test, and in those
that edges touch a point meets only the edges of its row of tiles.

Text that is no geometry is an error here, as in ``ST_GeomFromText``; rules can
reject it before.  NULL and geometries without an inside contain nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.functions.exprcache import cached_expr
from towerlens.functions.geo import contains_any, geometry_type, multipolygon_parts, parts_bbox
from towerlens.operators.polygon_cover import inside_by_edges, polygon_cover
from towerlens.operators.skew import proven_small, salted_join, written

BROADCAST_BYTES = 64 << 20
COVER_VERTICES = 512
_LARGEST = 9          # tiles of 512 degrees hold everything


@cached_expr
def _polygon_exprs(wkt_col: str, px: str, py: str):
    wkt = F.col(wkt_col)
    readable = F.when(wkt.isNotNull() & geometry_type(wkt).isNull(), F.raise_error(F.concat(F.lit("not a geometry: "), F.substring(wkt, 1, 80))))
    return (F.coalesce(readable.cast("string"), F.lit("")), multipolygon_parts(wkt), parts_bbox(F.col("_parts")),
            contains_any(F.col("_parts"), F.col(px), F.col(py)))


def _tile(value, size):
    return F.floor(value / size)


def polygon_tiles(polys: DataFrame) -> DataFrame:
    """Rows with ``_parts`` and ``_bb`` -> one row per tile (at most four) of the polygon's own size ``_lv``."""
    bb = F.col("_bb")
    extent = F.greatest(bb["maxx"] - bb["minx"], bb["maxy"] - bb["miny"], F.lit(1e-9))
    size = F.pow(F.lit(2.0), F.col("_lv").cast("double"))
    return (polys.withColumn("_lv", F.least(F.ceil(F.log2(extent)), F.lit(_LARGEST)).cast("int"))
            .withColumn("_tx", F.explode(F.sequence(_tile(bb["minx"], size), _tile(bb["maxx"], size))))
            .withColumn("_ty", F.explode(F.sequence(_tile(bb["miny"], size), _tile(bb["maxy"], size)))))


def contains_join(points: DataFrame, polys: DataFrame, *, point_xy: tuple[str, str], wkt_col: str,
                  poly_id: str, point_keys: Sequence[str] | None = None, keep_wkt: bool = False,
                  broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int | None = None,
                  cover_vertices: int = COVER_VERTICES) -> DataFrame:
    """INNER join of points with the polygons that contain them (fan-out kept)."""
    px, py = point_xy
    pcols = [c for c in polys.columns if c != wkt_col or keep_wkt]
    checked, parts, box, inside = _polygon_exprs(wkt_col, px, py)
    vertices = F.aggregate("_parts", F.lit(0), lambda n, p: F.aggregate(p, n, lambda m, ring: m + F.size(ring)))
    parsed = written(polys.withColumn("_text", checked).filter(F.col("_text") == "").withColumn("_parts", parts)
                     .filter(F.col("_parts").isNotNull()).withColumn("_bb", box).withColumn("_vertices", vertices)
                     .select(F.monotonically_increasing_id().alias("_pid"), "_bb", "_parts", "_vertices", *pcols), "polygons")
    most = parsed.agg(F.max("_vertices")).first()[0] or 0
    pts = points.filter(F.col(px).isNotNull() & F.col(py).isNotNull())
    join = _TileJoin(pts, px, py, list(point_keys or points.columns), broadcast_bytes, hot_rows)
    few = join.whole(parsed.filter(F.col("_vertices") <= cover_vertices), pcols, inside)
    return few if most <= cover_vertices else few.unionByName(join.covered(parsed.filter(F.col("_vertices") > cover_vertices), pcols))


class _TileJoin:
    """Points that meet polygons on tiles."""

    def __init__(self, pts: DataFrame, px: str, py: str, salt_cols: list[str], broadcast_bytes: int, hot_rows: int | None):
        self.pts, self.px, self.py, self.bytes = pts, px, py, broadcast_bytes
        self.salted = {"salt_cols": salt_cols} | ({"hot_rows": hot_rows} if hot_rows else {})

    def _at(self, tiles: DataFrame) -> DataFrame:
        """Points with their tile at every size that occurs (a few)."""
        levels = sorted(r[0] for r in tiles.select("_lv").distinct().collect()) or [0]
        keys = F.array(*[F.struct(F.lit(lv).cast("int").alias("_lv"), _tile(F.col(self.px), F.lit(2.0 ** lv)).alias("_tx"),
                                  _tile(F.col(self.py), F.lit(2.0 ** lv)).alias("_ty")) for lv in levels])
        return self.pts.select("*", F.inline(keys))

    def _join(self, left: DataFrame, right: DataFrame, on: list[str], source: DataFrame, copies: int = 1) -> DataFrame:
        """``right``, read from ``source`` in at most so many copies, is broadcast if that is proven small."""
        if proven_small(source, self.bytes // copies):
            return left.join(F.broadcast(right), on, "inner")
        return salted_join(left, right, on, "inner", **self.salted)

    def whole(self, polys: DataFrame, pcols: list[str], inside) -> DataFrame:
        """Polygons of few vertices, each in at most four tiles, with all their vertices."""
        tiles = polygon_tiles(polys).select("_lv", "_tx", "_ty", "_bb", "_parts", *pcols)
        j = self._join(self._at(tiles), tiles, ["_lv", "_tx", "_ty"], polys, 4)
        bb, x, y = F.col("_bb"), F.col(self.px), F.col(self.py)
        in_box = (x >= bb["minx"]) & (x <= bb["maxx"]) & (y >= bb["miny"]) & (y <= bb["maxy"])
        return j.filter(in_box).filter(inside).drop("_lv", "_tx", "_ty", "_bb", "_parts")

    def covered(self, polys: DataFrame, pcols: list[str]) -> DataFrame:
        """Polygons of many vertices: a cover tells for most points where they are, the others are tested against the
        edges of their row of tiles."""
        tiles, slabs = (written(t, name) for t, name in zip(polygon_cover(polys, "_pid"), ("cover", "rows")))
        met = self._join(self._at(tiles), tiles, ["_lv", "_tx", "_ty"], tiles).drop("_tx")
        tested = self._join(met.filter(~F.col("_whole")), slabs, ["_pid", "_lv", "_ty"], slabs)
        tested = tested.filter(inside_by_edges("_edges", F.col(self.px), F.col(self.py))).drop("_edges")
        about = written(polys.select("_pid", *pcols), "attributes")
        found = met.filter("_whole").unionByName(tested).drop("_lv", "_ty", "_whole")
        return self._join(found, about, ["_pid"], about).drop("_pid")


def contains_counts(polys: DataFrame, points: DataFrame, *, point_xy, wkt_col: str, poly_id: str,
                    point_id: str, out_col: str = "n_points", **kw) -> DataFrame:
    """Every polygon with the number of distinct points inside it (0 when none)."""
    j = contains_join(points.select(point_id, *point_xy), polys.select(poly_id, wkt_col), point_xy=point_xy,
                      wkt_col=wkt_col, poly_id=poly_id, point_keys=[point_id], **kw)
    counts = j.groupBy(poly_id).agg(F.count_distinct(point_id).alias(out_col))
    return (polys.join(counts, poly_id, "left")
            .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(0).cast("bigint"))))
