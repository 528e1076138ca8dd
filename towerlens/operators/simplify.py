"""Polygon simplification (Douglas-Peucker per ring).

Text is parsed and printed in the JVM.  Only the rings' coordinates go to
Python, as Arrow arrays whose buffers numpy reads in place, because the
algorithm is recursive per ring and Spark has no such function; what comes back
are the points that stay.  Rings stay closed with their end points fixed; a ring
that would fall below 4 points is kept as it was, and a polygon with nothing
removed (or with a coordinate that is no number) keeps its original text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.functions.geo import POLYGON_TYPE, materialize, multipolygon_parts, ring_points_kept, to_wkt


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


def _lists(lengths: np.ndarray, values: pa.Array, mask: pa.Array | None = None) -> pa.Array:
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=mask)


def thinned(tol: float):
    """A function of a column of (multi)polygon parts: the same with the points that stay."""
    @F.arrow_udf(T.ArrayType(POLYGON_TYPE))
    def thin(parts: pa.Array) -> pa.Array:
        polygons = parts.flatten()
        rings = polygons.flatten()
        points = rings.flatten()
        x, y = (pc.fill_null(points.field(c).cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False) for c in ("x", "y"))
        xy, sizes = np.stack((x, y), axis=1), _lengths(rings)
        end = np.cumsum(sizes)
        keep = np.ones(len(xy), bool)
        for a, b in zip(end - sizes, end):
            if np.isfinite(xy[a:b]).all():
                keep[a:b] = ring_points_kept(xy[a:b], tol)
        left = np.add.reduceat(keep, end - sizes, dtype=np.int64) * (sizes > 0) if len(keep) and (sizes > 0).all() else np.asarray(
            [keep[a:b].sum() for a, b in zip(end - sizes, end)], np.int64)
        stay = pa.StructArray.from_arrays([pa.array(x[keep], pa.float64()), pa.array(y[keep], pa.float64())], ["x", "y"])
        return _lists(_lengths(parts), _lists(_lengths(polygons), _lists(left, stay)), parts.is_null())

    return thin


def _count(parts: Column) -> Column:
    return F.aggregate(F.flatten(parts), F.lit(0), lambda n, ring: n + F.size(ring))


def parts_wkt(parts: Column, multi: Column) -> Column:
    """``ST_AsText`` of one polygon, or of several."""
    bodies = F.transform(parts, lambda p: F.substring(to_wkt(p), len("POLYGON ") + 1, 1 << 30))
    return F.when(multi, F.concat(F.lit("MULTIPOLYGON ("), F.array_join(bodies, ", "), F.lit(")"))).otherwise(to_wkt(parts.getItem(0)))


def simplify(df: DataFrame, wkt_col: str, tol: float = 0.001, out_col: str | None = None) -> DataFrame:
    """Add (or replace) a simplified WKT column; all other columns pass through.  Geometries without rings stay."""
    out_col = out_col or wkt_col
    own = [f.name for f in df.schema.fields]
    parsed = materialize(df, _parts=multipolygon_parts(F.col(f"`{wkt_col}`"))).withColumn("_thin", thinned(tol)("_parts"))
    changed = F.coalesce(_count(F.col("_thin")) != _count(F.col("_parts")), F.lit(False))
    text = F.col(f"`{wkt_col}`")
    out = F.when(changed, parts_wkt(F.col("_thin"), F.lower(text).rlike(r"^\s*multi"))).otherwise(text)
    return parsed.select(*[F.col(f"`{c}`") for c in own if c != out_col], out.alias(out_col))
