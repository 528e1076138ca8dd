"""Polygons as edges: rows of a grid are cut by edges, and what lies between cuts is inside.

A horizontal line meets a polygon's edges at some places; sorted, every other
stretch between two of them is inside.  ``inside_stretches`` does that for many
lines of many polygons at once, with one row an edge and line, so a polygon of
any number of vertices is spread over tasks and no point of a grid is tested
against a polygon.  Two things are made of it:

* ``cells_in_polygon``: the hexagonal cells whose centre lies in a polygon;
* ``polygon_cover``: a grid of tiles over a polygon of many vertices.  Tiles
  that no edge touches lie inside or outside as a whole; for the others a point
  is tested against the edges of its own row of tiles.

A ray meets an edge from its lower end, included, to its upper end, left out,
as in ``functions.geo.contains``; all rings of all parts count together, which
is the same as a test of each part as long as parts do not overlap.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.functions.cells import DEFAULT_REF_LAT, center_degrees, plane_constants
from towerlens.functions.geo import multipolygon_parts

GRID_BITS = 10               # tiles across a cover: at most 2 ** GRID_BITS


def polygon_edges(polys: DataFrame, keys: Sequence[str], parts: str = "_parts") -> DataFrame:
    """``keys`` and ``ax, ay, bx, by`` of each edge of each ring of each part."""
    rings = polys.select(*keys, F.explode(F.flatten(parts)).alias("_ring"))
    n = F.size("_ring")
    pairs = F.zip_with(F.slice("_ring", 1, n - 1), F.slice("_ring", 2, n - 1), lambda a, b: F.struct(
        a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    return rings.filter(n > 1).select(*keys, F.inline(pairs)).dropna(subset=["ax", "ay", "bx", "by"])


def crossing(y: Column, e=F.col) -> Column:
    """Where an edge meets the line at height ``y``; NULL if it does not."""
    return F.when((e("ay") > y) != (e("by") > y), (e("bx") - e("ax")) * (y - e("ay")) / (e("by") - e("ay")) + e("ax"))


def inside_stretches(edges: DataFrame, keys: Sequence[str], first: Column, last: Column, height) -> DataFrame:
    """``keys, _row, x_from, x_to``: the stretches of line ``_row`` inside the polygon, from ``x_from``, included, to
    ``x_to``.  Lines ``first`` to ``last`` are tried for an edge; ``height(_row)`` is a line's place."""
    met = (edges.withColumn("_row", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
           .select(*keys, "_row", crossing(height(F.col("_row"))).alias("_x")).filter(F.col("_x").isNotNull()))
    cuts = met.groupBy(*keys, "_row").agg(F.sort_array(F.collect_list("_x")).alias("_cuts"))
    pairs = F.transform(F.sequence(F.lit(1), F.floor(F.size("_cuts") / 2).cast("int")), lambda i: F.struct(
        F.element_at("_cuts", 2 * i - 1).alias("x_from"), F.element_at("_cuts", 2 * i).alias("x_to")))
    return cuts.filter(F.size("_cuts") > 1).select(*keys, "_row", F.inline(pairs))


def cells_in_polygon(polys: DataFrame, keys: Sequence[str], wkt_col: str, res: int = 9, ref_lat: float = DEFAULT_REF_LAT,
                     out_col: str = "cell") -> DataFrame:
    """``keys`` and one row for each cell whose centre lies in the (multi)polygon.  Rows of cells are lines."""
    k = plane_constants(res, ref_lat)
    parsed = polys.select(*keys, multipolygon_parts(wkt_col).alias("_parts")).filter(F.col("_parts").isNotNull())
    pitch = 1.5 * k["s"] / k["ky"]          # between rows of cells, in degrees
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    rows = inside_stretches(polygon_edges(parsed, keys), keys, F.floor(low / pitch), F.ceil(high / pitch),
                            lambda r: center_degrees(F.lit(0.0), r.cast("double"), res, ref_lat)[1])
    across = math.sqrt(3.0) * k["s"] / k["kx"]

    def column(x: str) -> Column:
        return F.col(x) / across - F.col("_row") / 2

    asked = rows.withColumn("_q", F.explode(F.sequence((F.floor(column("x_from")) - 1).cast("long"), (F.ceil(column("x_to")) + 1).cast("long"))))
    centre = center_degrees(F.col("_q").cast("double"), F.col("_row").cast("double"), res, ref_lat)[0]
    return asked.filter((centre >= F.col("x_from")) & (centre < F.col("x_to"))).select(
        *keys, F.concat_ws(":", F.lit(str(res)), F.col("_q").cast("string"), F.col("_row").cast("string")).alias(out_col))


def polygon_cover(polys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Tiles and edge lists of polygons with ``_parts``, ``_bb`` and ``_vertices``.

    The first frame has ``key, _lv, _tx, _ty, _whole``: tiles of size ``2 ** _lv`` that lie inside as a whole, and those
    that edges touch.  The second has ``key, _lv, _ty, _edges``: the edges that reach into a row of tiles.  A row has about
    the square root of a polygon's edges."""
    bb = F.col("_bb")
    extent = F.greatest(bb["maxx"] - bb["minx"], bb["maxy"] - bb["miny"], F.lit(1e-9))
    fine = F.least(F.greatest(F.ceil(F.log2(F.sqrt("_vertices")) - 1), F.lit(1)), F.lit(GRID_BITS))
    level = (F.ceil(F.log2(extent)) - fine).cast("int").alias("_lv")
    keys = [key, "_lv"]
    edges = polygon_edges(polys.select(key, level, "_parts"), keys)
    size = F.pow(F.lit(2.0), F.col("_lv").cast("double"))
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    in_rows = edges.withColumn("_ty", F.explode(F.sequence(F.floor(low / size), F.floor(high / size))))
    slabs = in_rows.groupBy(*keys, "_ty").agg(F.collect_list(F.struct("ax", "ay", "bx", "by")).alias("_edges"))
    # where an edge enters and leaves the row, a little widened
    at = [F.greatest(low, F.col("_ty") * size), F.least(high, (F.col("_ty") + 1) * size)]
    x = [F.when(F.col("ay") == F.col("by"), end).otherwise((F.col("bx") - F.col("ax")) * (y - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax"))
         for y, end in zip(at, (F.least("ax", "bx"), F.greatest("ax", "bx")))]
    margin = size * 1e-6
    touched = (in_rows.withColumn("_tx", F.explode(F.sequence(F.floor((F.least(*x) - margin) / size), F.floor((F.greatest(*x) + margin) / size))))
               .select(*keys, "_tx", "_ty").distinct())
    lines = inside_stretches(edges, keys, F.floor(low / size) - 1, F.floor(high / size), lambda r: (r + 0.5) * size)
    first, last = F.ceil(F.col("x_from") / size - 0.5), F.ceil(F.col("x_to") / size - 0.5) - 1
    whole = (lines.filter(last >= first).select(*keys, F.explode(F.sequence(first, last)).alias("_tx"), F.col("_row").alias("_ty"))
             .join(touched, [*keys, "_tx", "_ty"], "left_anti"))
    return whole.withColumn("_whole", F.lit(True)).unionByName(touched.withColumn("_whole", F.lit(False))), slabs


def inside_by_edges(edges: str, px: Column, py: Column) -> Column:
    """Parity of the edges to the right of a point."""
    return F.size(F.filter(F.col(edges), lambda e: F.coalesce(px < crossing(py, lambda f: e[f]), F.lit(False)))) % 2 == 1
