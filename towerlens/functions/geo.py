"""Spatial functions as plain Column expressions (no UDF).

Representation
--------------
* point   -- two DOUBLE columns (lon, lat); coordinate order is always (x, y).
* polygon -- ``ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>``: ring 0 is the
  outer ring, the others are holes.  Rings are closed (first == last).
* storage -- WKT text.  SRID is always 4326 and carried as metadata only.

Everything here compiles to built-in SQL expressions and higher-order
functions, evaluated on the executors inside the JVM (the higher-order
functions are interpreted within the generated stage code; no Python worker).
Compute a polygon once in a projection and refer to the column afterwards;
the nested ``aggregate``/``transform`` trees are cheap to duplicate by
mistake.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Mean Earth radius in metres used by the great-circle distance.
EARTH_RADIUS_M = 6371000.0
DEG2RAD = math.pi / 180.0

POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING_TYPE = T.ArrayType(POINT_TYPE)
POLYGON_TYPE = T.ArrayType(RING_TYPE)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (which may use it many times).

    Spark has no public let-binding; an ``aggregate`` over a one-element
    array binds its start value to a lambda variable, so nested geometry
    expressions do not copy (and re-evaluate) their argument at every use.
    """
    return F.aggregate(F.array(F.lit(0)), value, lambda acc, _x: acc, fn)


def materialize(df, **cols: Column):
    """Add columns computed exactly once per row.

    The values go through a generator (``inline`` of a one-element array),
    which the optimizer neither collapses into later projections nor
    duplicates into filters pushed below it.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


# ---------------------------------------------------------------- distances
def haversine_m(lon1, lat1, lon2, lat2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres (``ST_DistanceSphere``).

    The argument of the square root is clamped to 1 so that antipodal points
    give pi*R instead of NaN.
    """
    lon1, lat1, lon2, lat2 = map(_c, (lon1, lat1, lon2, lat2))
    p1 = lat1 * F.lit(DEG2RAD)
    p2 = lat2 * F.lit(DEG2RAD)
    dp = (lat2 - lat1) * F.lit(DEG2RAD)
    dl = (lon2 - lon1) * F.lit(DEG2RAD)
    sp, sl = F.sin(dp / 2), F.sin(dl / 2)
    a = sp * sp + F.cos(p1) * F.cos(p2) * (sl * sl)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def planar_deg(x1, y1, x2, y2) -> Column:
    """Planar distance in degrees (``ST_Distance`` on lon/lat)."""
    x1, y1, x2, y2 = map(_c, (x1, y1, x2, y2))
    return F.sqrt(F.pow(x2 - x1, 2) + F.pow(y2 - y1, 2))


def deg_to_m(deg, at_lat: float = 47.6) -> Column:
    """Degrees to metres at a latitude: ``deg * 111000 * cos(radians(lat))``."""
    return _c(deg) * F.lit(111000.0 * math.cos(math.radians(at_lat)))


# ---------------------------------------------------------------- points
def point_wkt(lon, lat) -> Column:
    """``ST_AsText(ST_Point(lon, lat))``."""
    return F.concat(F.lit("POINT ("), _c(lon).cast("string"), F.lit(" "), _c(lat).cast("string"), F.lit(")"))


def point_from_wkt(wkt) -> Column:
    """``POINT (x y)`` text -> struct<x, y>; anything else -> NULL."""
    pattern = r"(?i)^\s*POINT\s*\(\s*(\S+)\s+(\S+)\s*\)\s*$"
    x = F.regexp_extract(_c(wkt), pattern, 1)
    y = F.regexp_extract(_c(wkt), pattern, 2)
    return F.when(x != "", F.struct(x.try_cast("double").alias("x"), y.try_cast("double").alias("y")))


# ---------------------------------------------------------------- polygons
_POLY_RE = r"(?i)^\s*POLYGON\s*\(\s*\((.*)\)\s*\)\s*$"
_MULTI_RE = r"(?i)^\s*MULTIPOLYGON\s*\(\s*\(\s*\((.*)\)\s*\)\s*\)\s*$"


def _rings_from_body(body: Column) -> Column:
    rings_txt = F.split(body, r"\)\s*,\s*\(")
    return F.transform(
        rings_txt,
        lambda r: F.transform(
            F.split(F.trim(r), r"\s*,\s*"),
            lambda p: let(F.split(F.trim(p), r"\s+"), lambda xy: F.struct(
                xy.getItem(0).try_cast("double").alias("x"),
                xy.getItem(1).try_cast("double").alias("y"),
            )),
        ),
    )


def poly_from_wkt(wkt) -> Column:
    """``ST_GeomFromText(wkt)`` for POLYGON text -> rings; other text -> NULL."""
    body = F.regexp_extract(_c(wkt), _POLY_RE, 1)
    return let(body, lambda b: F.when(b != "", _rings_from_body(b)).cast(POLYGON_TYPE))


def multipolygon_parts(wkt) -> Column:
    """MULTIPOLYGON (or POLYGON) text -> array of polygons (explode for one row per part)."""
    w = _c(wkt)
    mbody = F.regexp_extract(w, _MULTI_RE, 1)
    parts = F.split(mbody, r"\)\s*\)\s*,\s*\(\s*\(")
    multi = F.transform(parts, _rings_from_body)
    return (F.when(mbody != "", multi)
            .when(F.regexp_extract(w, _POLY_RE, 1) != "", F.array(poly_from_wkt(w)))
            .cast(T.ArrayType(POLYGON_TYPE)))


def materialize_ring_midpoints(wkt) -> Column:
    """A one-ring polygon's text with the midpoint of every edge added."""
    ring = poly_from_wkt(wkt).getItem(0)
    each = let(ring, lambda r: F.flatten(F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.array(
        F.element_at(r, i), F.struct(((F.element_at(r, i)["x"] + F.element_at(r, i + 1)["x"]) / 2).alias("x"),
                                     ((F.element_at(r, i)["y"] + F.element_at(r, i + 1)["y"]) / 2).alias("y"))))))
    return to_wkt(F.array(let(each, lambda p: F.concat(p, F.slice(p, 1, 1)))))


def _num_text(v: Column) -> Column:
    return v.cast("string")


def to_wkt(rings) -> Column:
    """``ST_AsText`` of a polygon."""
    r = _c(rings)
    body = F.array_join(
        F.transform(r, lambda ring: F.array_join(
            F.transform(ring, lambda p: F.concat(_num_text(p["x"]), F.lit(" "), _num_text(p["y"]))), ", ")),
        "), (")
    return F.when(r.isNotNull(), F.concat(F.lit("POLYGON (("), body, F.lit("))")))


def geometry_type(wkt) -> Column:
    """``ST_GeometryType`` from the WKT tag: 'ST_Point', 'ST_Polygon', ..."""
    tag = F.upper(F.regexp_extract(_c(wkt), r"^\s*([A-Za-z]+)", 1))
    # WKT tag -> ST type name.
    names = {
        "POINT": "ST_Point", "LINESTRING": "ST_LineString", "POLYGON": "ST_Polygon",
        "MULTIPOINT": "ST_MultiPoint", "MULTILINESTRING": "ST_MultiLineString",
        "MULTIPOLYGON": "ST_MultiPolygon", "GEOMETRYCOLLECTION": "ST_GeometryCollection",
    }
    m = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return m[tag]


def _edges(ring: Column, fn) -> Column:
    """Apply ``fn(a, b)`` to each edge (consecutive vertex pair) of a closed ring."""
    n = F.size(ring)
    return F.zip_with(F.slice(ring, 1, n - 1), F.slice(ring, 2, n - 1), fn)


def _ring_moments(ring: Column) -> Column:
    """struct(a2, mx, my, x0, y0) with coordinates shifted to the first vertex.

    a2 is twice the signed area; the ring centroid is (mx/(3 a2) + x0, my/(3 a2) + y0).
    """
    x0 = ring.getItem(0)["x"]
    y0 = ring.getItem(0)["y"]
    terms = _edges(ring, lambda a, b: F.struct(
        ((a["x"] - x0) * (b["y"] - y0) - (b["x"] - x0) * (a["y"] - y0)).alias("c"),
        ((a["x"] - x0) + (b["x"] - x0)).alias("sx"),
        ((a["y"] - y0) + (b["y"] - y0)).alias("sy"),
    ))
    zero = F.lit(0.0)
    acc = F.aggregate(
        terms,
        F.struct(zero.alias("a2"), zero.alias("mx"), zero.alias("my")),
        lambda acc, t: F.struct(
            (acc["a2"] + t["c"]).alias("a2"),
            (acc["mx"] + t["sx"] * t["c"]).alias("mx"),
            (acc["my"] + t["sy"] * t["c"]).alias("my"),
        ),
    )
    return F.struct(acc["a2"].alias("a2"), acc["mx"].alias("mx"), acc["my"].alias("my"),
                    x0.alias("x0"), y0.alias("y0"))


def _poly_moments(rings: Column) -> Column:
    """struct(area, cx, cy): outer ring counted positive, holes negative."""
    per_ring = F.transform(rings, lambda r, i: F.struct(
        _ring_moments(r).alias("m"), F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("s")))
    zero = F.lit(0.0)
    tot = F.aggregate(
        per_ring,
        F.struct(zero.alias("a"), zero.alias("sx"), zero.alias("sy")),
        lambda acc, r: F.struct(
            (acc["a"] + r["s"] * F.abs(r["m"]["a2"]) / 2).alias("a"),
            (acc["sx"] + F.when(r["m"]["a2"] != 0, r["s"] * F.abs(r["m"]["a2"]) / 2
                                * (r["m"]["mx"] / (r["m"]["a2"] * 3) + r["m"]["x0"])).otherwise(zero)).alias("sx"),
            (acc["sy"] + F.when(r["m"]["a2"] != 0, r["s"] * F.abs(r["m"]["a2"]) / 2
                                * (r["m"]["my"] / (r["m"]["a2"] * 3) + r["m"]["y0"])).otherwise(zero)).alias("sy"),
        ),
    )
    return tot


def area(rings) -> Column:
    """``ST_Area`` in square degrees (planar shoelace, holes subtracted)."""
    return let(_c(rings), lambda r: F.when(F.size(r) > 0, _poly_moments(r)["a"]))


def centroid(rings) -> Column:
    """``ST_Centroid`` -> struct<x, y>.

    Area-weighted centroid; for a zero-area polygon the mean of the outer
    ring's distinct vertices is returned.
    """
    def body(r):
        outer = r.getItem(0)
        k = F.size(outer) - 1
        mean_x = F.aggregate(F.slice(outer, 1, k), F.lit(0.0), lambda acc, p: acc + p["x"]) / k
        mean_y = F.aggregate(F.slice(outer, 1, k), F.lit(0.0), lambda acc, p: acc + p["y"]) / k
        return F.when(F.size(r) > 0, let(_poly_moments(r), lambda m: F.when(
            m["a"] != 0, F.struct((m["sx"] / m["a"]).alias("x"), (m["sy"] / m["a"]).alias("y")))
            .otherwise(F.struct(mean_x.alias("x"), mean_y.alias("y")))))

    return let(_c(rings), body)


def area_m2(rings, lat0: float = 47.6) -> Column:
    """Approximate area in square metres: local equal-area scaling at ``lat0``.

    ``R^2 * cos(lat0) * shoelace(radians)``; differs from a UTM projected area
    by the projection's grid scale factor (about 0.04 % in the reference's zone).
    """
    return area(rings) * F.lit(EARTH_RADIUS_M ** 2 * DEG2RAD ** 2 * math.cos(math.radians(lat0)))


def bbox(rings) -> Column:
    """Bounding box of the outer ring -> struct(minx, miny, maxx, maxy)."""
    def body(outer):
        xs = F.transform(outer, lambda p: p["x"])
        ys = F.transform(outer, lambda p: p["y"])
        return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
                        F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))

    return let(_c(rings).getItem(0), body)


def contains(rings, px, py) -> Column:
    """``ST_Contains(polygon, point)`` by even-odd ray casting over all rings.

    Holes are handled by the same parity.  Boundary rule (half-open): a point
    on a left or bottom edge counts as inside, on a right or top edge as
    outside, so two polygons sharing an edge never both own a point on it.
    """
    px, py = _c(px), _c(py)

    def ring_parity(ring):
        crossings = _edges(ring, lambda a, b: ((a["y"] > py) != (b["y"] > py)) & (
            px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"]))
        return F.aggregate(crossings, F.lit(False), lambda acc, e: acc != e)

    return F.aggregate(_c(rings), F.lit(False), lambda acc, r: acc != ring_parity(r))


def contains_any(parts, px, py) -> Column:
    """Whether any part of a (multi)polygon contains the point."""
    return F.exists(_c(parts), lambda p: contains(p, px, py))


def parts_bbox(parts) -> Column:
    """Bounding box over all parts."""
    boxes = F.transform(_c(parts), bbox)
    return let(boxes, lambda b: F.struct(
        F.array_min(F.transform(b, lambda x: x["minx"])).alias("minx"), F.array_min(F.transform(b, lambda x: x["miny"])).alias("miny"),
        F.array_max(F.transform(b, lambda x: x["maxx"])).alias("maxx"), F.array_max(F.transform(b, lambda x: x["maxy"])).alias("maxy")))


def parts_area(parts) -> Column:
    """Square degrees of all parts together."""
    return F.when(F.size(_c(parts)) > 0, F.aggregate(F.transform(_c(parts), area), F.lit(0.0), lambda acc, a: acc + a))


def parts_centroid(parts) -> Column:
    """Centroid of all parts, weighted by their areas; of one part its own, of parts without area their mean."""
    def body(r):
        each = F.transform(r, lambda p: F.struct(area(p).alias("a"), centroid(p).alias("c")))

        def mean(e):
            def total(f):
                return F.aggregate(e, F.lit(0.0), lambda acc, x: acc + f(x))

            return let(total(lambda x: x["a"]), lambda a: F.struct(*[
                F.when(a != 0, total(lambda x, k=k: x["a"] * x["c"][k]) / a).otherwise(total(lambda x, k=k: x["c"][k]) / F.size(e)).alias(k)
                for k in ("x", "y")]))

        return F.when(F.size(r) == 1, centroid(r.getItem(0))).when(F.size(r) > 1, let(each, mean))

    return let(_c(parts), body)


def is_valid(rings, check_self_intersection: bool = False) -> Column:
    """``ST_IsValid`` (structural form).

    Valid when: not NULL, at least one ring, every ring closed with >= 4
    points, every coordinate finite, and the outer ring has non-zero area.
    ``check_self_intersection`` adds a test that no two edges cross, neither of
    one ring nor of two (a hole through the shell).
    """
    def body(r):
        ring_ok = F.forall(r, lambda ring: (F.size(ring) >= 4)
                           & (ring.getItem(0)["x"] == F.element_at(ring, -1)["x"])
                           & (ring.getItem(0)["y"] == F.element_at(ring, -1)["y"])
                           & F.forall(ring, lambda p: p["x"].isNotNull() & p["y"].isNotNull()
                                      & ~F.isnan(p["x"]) & ~F.isnan(p["y"])
                                      & (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf"))))
        ok = r.isNotNull() & (F.size(r) > 0) & ring_ok
        ok = ok & F.coalesce(_ring_moments(r.getItem(0))["a2"] != 0, F.lit(False))
        if check_self_intersection:
            ok = ok & ~_edges_cross(r)
        return F.coalesce(ok, F.lit(False))

    return let(_c(rings), body)


def _edges_cross(rings: Column) -> Column:
    """Whether any two edges cross properly, of one ring or of two.

    Edges go to as many columns as the square root of their number, by the longer side of the polygon's box, and are
    compared within columns only: about n times the square root of n steps for n edges of like length, where comparing
    all pairs takes n times n."""
    def side(e, i, j):
        """On which side of edge e the point (i, j) lies."""
        return (e["bx"] - e["ax"]) * (j - e["ay"]) - (e["by"] - e["ay"]) * (i - e["ax"])

    def crosses(e, f):
        near = (e["ring"] == f["ring"]) & ((f["at"] == e["at"] + 1) | ((e["at"] == 1) & (f["at"] == e["n"])))
        return (~near) & (side(f, e["ax"], e["ay"]) * side(f, e["bx"], e["by"]) < 0) & (side(e, f["ax"], f["ay"]) * side(e, f["bx"], f["by"]) < 0)

    def after(e, f):
        return (f["ring"] > e["ring"]) | ((f["ring"] == e["ring"]) & (f["at"] > e["at"]))

    def overlap(e, f):
        return (e["low"] <= f["high"]) & (f["low"] <= e["high"])

    def of_ring(ring, k):
        n = F.size(ring) - 1
        return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: let(
            F.struct(F.element_at(ring, i).alias("a"), F.element_at(ring, i + 1).alias("b")), lambda p: F.struct(
                k.alias("ring"), i.alias("at"), n.alias("n"), p["a"]["x"].alias("ax"), p["a"]["y"].alias("ay"), p["b"]["x"].alias("bx"), p["b"]["y"].alias("by")))))

    def placed(edges):
        """Edges with their extent along the longer side."""
        def extent(axis):
            return F.array_max(F.transform(edges, lambda e: e[f"a{axis}"])) - F.array_min(F.transform(edges, lambda e: e[f"a{axis}"]))

        return let(extent("x") >= extent("y"), lambda wide: F.transform(edges, lambda e: F.struct(
            *[e[c].alias(c) for c in ("ring", "at", "n", "ax", "ay", "bx", "by")],
            F.when(wide, F.least(e["ax"], e["bx"])).otherwise(F.least(e["ay"], e["by"])).alias("low"),
            F.when(wide, F.greatest(e["ax"], e["bx"])).otherwise(F.greatest(e["ay"], e["by"])).alias("high"))))

    def in_columns(edges):
        low, high = F.array_min(F.transform(edges, lambda e: e["low"])), F.array_max(F.transform(edges, lambda e: e["high"]))
        columns = F.ceil(F.sqrt(F.size(edges))).cast("int")
        return let(F.struct(low.alias("low"), ((high - low) / columns).alias("width"), columns.alias("columns")), lambda g: F.exists(
            F.sequence(F.lit(0), g["columns"] - 1), lambda c: let(F.filter(edges, lambda e: (
                (e["low"] <= g["low"] + (c + 1) * g["width"]) | (c == g["columns"] - 1)) & (e["high"] >= g["low"] + c * g["width"])),
                lambda here: F.exists(here, lambda e: F.exists(here, lambda f: after(e, f) & overlap(e, f) & crosses(e, f))))))

    return let(F.flatten(F.transform(rings, of_ring)), lambda edges: F.when(F.size(edges) > 3, let(placed(edges), in_columns)).otherwise(F.lit(False)))


def bbox_overlaps(rings, minx: float, miny: float, maxx: float, maxy: float) -> Column:
    """Polygon bounding box overlaps a query box (inclusive)."""
    b = bbox(rings)
    return (b["maxx"] >= minx) & (b["minx"] <= maxx) & (b["maxy"] >= miny) & (b["miny"] <= maxy)


def ring_points_kept(pts, tol: float):
    """Which points of one closed ring (an array of two columns) Douglas-Peucker keeps; the ends are fixed, and all are
    kept if fewer than 4 would be."""
    import numpy as np

    keep = np.zeros(len(pts), dtype=bool)
    if len(pts) < 5:
        return ~keep
    keep[0] = keep[-1] = True
    stack = [(0, len(pts) - 1)]
    while stack:
        i, j = stack.pop()
        if j <= i + 1:
            continue
        a, b = pts[i], pts[j]
        seg = b - a
        rel = pts[i + 1:j] - a
        length = float(np.hypot(*seg))
        if length == 0:
            d = np.hypot(rel[:, 0], rel[:, 1])
        else:
            d = np.abs(seg[0] * rel[:, 1] - seg[1] * rel[:, 0]) / length
        k = int(np.argmax(d))
        if d[k] > tol:
            m = i + 1 + k
            keep[m] = True
            stack.append((i, m))
            stack.append((m, j))
    return keep if keep.sum() >= 4 else np.ones(len(pts), dtype=bool)


def simplify_ring_dp(points, tol: float):
    """``ring_points_kept`` on a list of (x, y)."""
    import numpy as np

    if points is None or len(points) < 5:
        return points
    return [p for p, kept in zip(points, ring_points_kept(np.asarray(points, dtype=float), tol)) if kept]


# ---------------------------------------------------------------- WKB points
def _le_hex_to_double(hex16: Column) -> Column:
    """Little-endian 8-byte hex text -> DOUBLE, decoded from the IEEE-754 bits in SQL arithmetic."""
    # reverse the byte order: 8 bytes = 8 two-character groups
    be = F.concat(*[F.substring(hex16, 15 - 2 * i, 2) for i in range(8)])
    hi = F.conv(F.substring(be, 1, 3), 16, 10).cast("bigint")          # sign (1 bit) + exponent (11 bits)
    mant = F.conv(F.substring(be, 4, 13), 16, 10).cast("double")       # 52-bit fraction, exact in a double
    sign = F.when(F.shiftright(hi, 11) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    exp = hi.bitwiseAND(F.lit(0x7FF))
    normal = (F.lit(1.0) + mant / F.lit(float(2 ** 52))) * F.pow(F.lit(2.0), exp - F.lit(1023))
    subnormal = (mant / F.lit(float(2 ** 52))) * F.pow(F.lit(2.0), F.lit(-1022))
    return sign * F.when(exp == 0, subnormal).when(exp == 0x7FF, F.lit(float("nan"))).otherwise(normal)


def point_from_wkb_hex(wkb_hex) -> Column:
    """``ST_GeomFromWKB`` for a little-endian WKB point given as hex text -> struct<x, y>.

    Byte 0 is the order flag (01 = little endian), bytes 1-4 the type (1 =
    point), then x and y as 8-byte doubles.  Anything else gives NULL.
    """
    h = F.lower(_c(wkb_hex))
    ok = (F.length(h) == 42) & (F.substring(h, 1, 2) == "01") & (F.substring(h, 3, 8) == "01000000")
    return F.when(ok, F.struct(_le_hex_to_double(F.substring(h, 11, 16)).alias("x"),
                               _le_hex_to_double(F.substring(h, 27, 16)).alias("y")))


def point_from_wkb(wkb) -> Column:
    """``ST_GeomFromWKB`` for a BINARY little-endian WKB point -> struct<x, y>; anything else gives NULL."""
    return point_from_wkb_hex(F.hex(_c(wkb)))
