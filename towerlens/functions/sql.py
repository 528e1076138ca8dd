"""The spatial and cell functions as SQL functions (``ST_*``, ``h3_*``).

``register_sql_functions(spark)`` defines them as temporary SQL functions
whose bodies are plain SQL expressions.  The analyzer inlines the bodies, so
queries that call them stay on the JVM (no Python worker, no UDF).  This lets
SQL text written against a platform that has these built-ins -- dataflow SQL
nodes, transform expressions, expectation predicates -- run unchanged.

In SQL a geometry is its WKT text (``'POINT (x y)'``, ``'POLYGON ((...))'``);
doubles are rendered with Spark's shortest round-trip text, so a value
survives the text form exactly.  ``h3_*`` functions address the hexagonal
grid of ``towerlens.functions.cells`` (keys ``'<res>:<q>:<r>'``); the id
checks also accept real H3 hex ids.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

from towerlens.functions.cells import APERTURE, DEFAULT_REF_LAT, RES9_EDGE_M, sql_double
from towerlens.functions.geo import DEG2RAD, EARTH_RADIUS_M

_D = sql_double
_PT = r"'(?i)^\\s*POINT\\s*\\(\\s*(\\S+)\\s+(\\S+)\\s*\\)\\s*$'"
_POLY = r"'(?i)^\\s*POLYGON\\s*\\(\\s*\\((.*)\\)\\s*\\)\\s*$'"
_TAG = r"'^\\s*([A-Za-z]+)'"
_RINGSEP = r"'\\)\\s*,\\s*\\('"
_PTSEP = r"'\\s*,\\s*'"
_WS = r"'\\s+'"

POLY_T = "ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>"


def _defs() -> list[str]:
    kx = EARTH_RADIUS_M * DEG2RAD * math.cos(math.radians(DEFAULT_REF_LAT))
    ky = EARTH_RADIUS_M * DEG2RAD
    r9 = _D(RES9_EDGE_M)
    sq7 = _D(math.sqrt(APERTURE))
    s = f"({r9} * pow({sq7}, 9 - res))"
    hav = (f"{_D(2 * EARTH_RADIUS_M)} * asin(sqrt(least(1e0, "
           f"sin((y2 - y1) * {_D(DEG2RAD)} / 2e0) * sin((y2 - y1) * {_D(DEG2RAD)} / 2e0) + "
           f"cos(y1 * {_D(DEG2RAD)}) * cos(y2 * {_D(DEG2RAD)}) * "
           f"(sin((x2 - x1) * {_D(DEG2RAD)} / 2e0) * sin((x2 - x1) * {_D(DEG2RAD)} / 2e0)))))")
    ring_terms = ("zip_with(slice(r, 1, size(r) - 1), slice(r, 2, size(r) - 1), (a, b) -> named_struct("
                  "'c', (a.x - r[0].x) * (b.y - r[0].y) - (b.x - r[0].x) * (a.y - r[0].y), "
                  "'sx', (a.x - r[0].x) + (b.x - r[0].x), 'sy', (a.y - r[0].y) + (b.y - r[0].y)))")
    ring_mom = (f"aggregate({ring_terms}, named_struct('a2', 0e0, 'mx', 0e0, 'my', 0e0), (acc, t) -> named_struct("
                "'a2', acc.a2 + t.c, 'mx', acc.mx + t.sx * t.c, 'my', acc.my + t.sy * t.c))")
    poly_mom = (f"aggregate(transform(p, (r, i) -> named_struct('m', {ring_mom}, 'x0', r[0].x, 'y0', r[0].y, "
                "'s', CASE WHEN i = 0 THEN 1e0 ELSE -1e0 END)), named_struct('a', 0e0, 'sx', 0e0, 'sy', 0e0), "
                "(acc, q) -> named_struct('a', acc.a + q.s * abs(q.m.a2) / 2, "
                "'sx', acc.sx + CASE WHEN q.m.a2 <> 0 THEN q.s * abs(q.m.a2) / 2 * (q.m.mx / (q.m.a2 * 3) + q.x0) ELSE 0e0 END, "
                "'sy', acc.sy + CASE WHEN q.m.a2 <> 0 THEN q.s * abs(q.m.a2) / 2 * (q.m.my / (q.m.a2 * 3) + q.y0) ELSE 0e0 END))")
    parity = ("aggregate(p, false, (acc, r) -> acc != aggregate(zip_with(slice(r, 1, size(r) - 1), "
              "slice(r, 2, size(r) - 1), (a, b) -> ((a.y > py) != (b.y > py)) AND "
              "(px < (b.x - a.x) * (py - a.y) / (b.y - a.y) + a.x)), false, (c, e) -> c != e))")
    axial = (f"named_struct('q', (lon * {_D(kx)}) * ({_D(math.sqrt(3.0) / 3.0)} / {s}) - (lat * {_D(ky)}) * "
             f"({_D(1.0 / 3.0)} / {s}), 'r', (lat * {_D(ky)}) * ({_D(2.0 / 3.0)} / {s}))")
    return [
        # geometry constructors and accessors
        "tl_poly(w STRING) RETURNS " + POLY_T + f" RETURN CASE WHEN regexp_extract(w, {_POLY}, 1) <> '' THEN "
        f"transform(split(regexp_extract(w, {_POLY}, 1), {_RINGSEP}), r -> transform(split(trim(r), {_PTSEP}), "
        f"p -> named_struct('x', try_cast(split(trim(p), {_WS})[0] AS DOUBLE), "
        f"'y', try_cast(split(trim(p), {_WS})[1] AS DOUBLE)))) END",
        "st_point(x DOUBLE, y DOUBLE, srid INT DEFAULT 4326) RETURNS STRING RETURN "
        "concat('POINT (', CAST(x AS STRING), ' ', CAST(y AS STRING), ')')",
        "st_geomfromtext(w STRING, srid INT DEFAULT 4326) RETURNS STRING RETURN w",
        "st_geomfromwkt(w STRING, srid INT DEFAULT 4326) RETURNS STRING RETURN w",
        "st_astext(g STRING) RETURNS STRING RETURN g",
        f"st_x(g STRING) RETURNS DOUBLE RETURN try_cast(regexp_extract(g, {_PT}, 1) AS DOUBLE)",
        f"st_y(g STRING) RETURNS DOUBLE RETURN try_cast(regexp_extract(g, {_PT}, 2) AS DOUBLE)",
        "st_geometrytype(g STRING) RETURNS STRING RETURN map('POINT', 'ST_Point', 'LINESTRING', 'ST_LineString', "
        "'POLYGON', 'ST_Polygon', 'MULTIPOINT', 'ST_MultiPoint', 'MULTILINESTRING', 'ST_MultiLineString', "
        f"'MULTIPOLYGON', 'ST_MultiPolygon', 'GEOMETRYCOLLECTION', 'ST_GeometryCollection')[upper(regexp_extract(g, {_TAG}, 1))]",
        # polygon measures
        f"tl_poly_moments(p {POLY_T}) RETURNS STRUCT<a: DOUBLE, sx: DOUBLE, sy: DOUBLE> RETURN {poly_mom}",
        "st_area(g STRING) RETURNS DOUBLE RETURN CASE WHEN st_geometrytype(g) = 'ST_Polygon' "
        "THEN tl_poly_moments(tl_poly(g)).a ELSE 0e0 END",
        "tl_point_text(c STRUCT<x: DOUBLE, y: DOUBLE>) RETURNS STRING RETURN "
        "concat('POINT (', CAST(c.x AS STRING), ' ', CAST(c.y AS STRING), ')')",
        "tl_centroid_of(m STRUCT<a: DOUBLE, sx: DOUBLE, sy: DOUBLE>, p " + POLY_T + ") RETURNS STRUCT<x: DOUBLE, y: DOUBLE> "
        "RETURN CASE WHEN m.a <> 0 THEN named_struct('x', m.sx / m.a, 'y', m.sy / m.a) "
        "ELSE named_struct('x', aggregate(slice(p[0], 1, size(p[0]) - 1), 0e0, (c, v) -> c + v.x) / (size(p[0]) - 1), "
        "'y', aggregate(slice(p[0], 1, size(p[0]) - 1), 0e0, (c, v) -> c + v.y) / (size(p[0]) - 1)) END",
        "tl_centroid_xy(p " + POLY_T + ") RETURNS STRUCT<x: DOUBLE, y: DOUBLE> RETURN "
        "tl_centroid_of(tl_poly_moments(p), p)",
        "st_centroid(g STRING) RETURNS STRING RETURN CASE st_geometrytype(g) WHEN 'ST_Point' THEN g "
        "WHEN 'ST_Polygon' THEN tl_point_text(tl_centroid_xy(tl_poly(g))) END",
        # distances and predicates
        f"tl_hav(x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE) RETURNS DOUBLE RETURN {hav}",
        "st_distancesphere(a STRING, b STRING) RETURNS DOUBLE RETURN tl_hav(st_x(a), st_y(a), st_x(b), st_y(b))",
        "st_distance(a STRING, b STRING) RETURNS DOUBLE RETURN "
        "sqrt(pow(st_x(b) - st_x(a), 2) + pow(st_y(b) - st_y(a), 2))",
        f"tl_contains(p {POLY_T}, px DOUBLE, py DOUBLE) RETURNS BOOLEAN RETURN {parity}",
        "st_contains(poly STRING, pt STRING) RETURNS BOOLEAN RETURN tl_contains(tl_poly(poly), st_x(pt), st_y(pt))",
        "tl_valid(p " + POLY_T + ") RETURNS BOOLEAN RETURN p IS NOT NULL AND size(p) > 0 AND "
        "forall(p, r -> size(r) >= 4 AND r[0].x = element_at(r, -1).x AND r[0].y = element_at(r, -1).y AND "
        "forall(r, v -> v.x IS NOT NULL AND v.y IS NOT NULL AND NOT isnan(v.x) AND NOT isnan(v.y) "
        "AND abs(v.x) < double('inf') AND abs(v.y) < double('inf'))) AND tl_poly_moments(p).a <> 0",
        "st_isvalid(g STRING) RETURNS BOOLEAN RETURN coalesce(tl_valid(tl_poly(g)), false)",
        # hexagonal cells
        f"h3_longlatash3string(lon DOUBLE, lat DOUBLE, res INT) RETURNS STRING RETURN aggregate(array(0), {axial}, "
        "(acc, z) -> acc, a -> aggregate(array(0), named_struct('q', a.q, 'r', a.r, 'rq', floor(a.q + 0.5e0), "
        "'rr', floor(a.r + 0.5e0), 'rt', floor(-a.q - a.r + 0.5e0)), (acc2, z2) -> acc2, "
        "h -> concat_ws(':', CAST(res AS STRING), CAST(CAST(CASE WHEN abs(h.rq - h.q) > abs(h.rr - h.r) AND "
        "abs(h.rq - h.q) > abs(h.rt - (-h.q - h.r)) THEN -h.rr - h.rt ELSE h.rq END AS BIGINT) AS STRING), "
        "CAST(CAST(CASE WHEN abs(h.rq - h.q) > abs(h.rr - h.r) AND abs(h.rq - h.q) > abs(h.rt - (-h.q - h.r)) "
        "THEN h.rr WHEN abs(h.rr - h.r) > abs(h.rt - (-h.q - h.r)) THEN -h.rq - h.rt ELSE h.rr END AS BIGINT) AS STRING))))",
        "h3_longlatash3(lon DOUBLE, lat DOUBLE, res INT) RETURNS STRING RETURN h3_longlatash3string(lon, lat, res)",
        "h3_pointash3(g STRING, res INT) RETURNS STRING RETURN h3_longlatash3string(st_x(g), st_y(g), res)",
        "h3_pointash3string(g STRING, res INT) RETURNS STRING RETURN h3_longlatash3string(st_x(g), st_y(g), res)",
        "h3_h3tostring(h STRING) RETURNS STRING RETURN CASE WHEN h RLIKE '^[0-9]+$' "
        "THEN lower(hex(CAST(h AS BIGINT))) ELSE h END",
        "h3_stringtoh3(s STRING) RETURNS BIGINT RETURN CASE WHEN s RLIKE '^[0-9a-fA-F]{1,16}$' "
        "THEN try_cast(conv(s, 16, 10) AS BIGINT) END",
        "h3_resolution(h STRING) RETURNS INT RETURN CASE WHEN h RLIKE '^[0-9]{1,2}:' "
        "THEN CAST(split(h, ':')[0] AS INT) ELSE CAST(shiftright(h3_stringtoh3(h), 52) & 15 AS INT) END",
        f"tl_cell_center(h STRING) RETURNS STRUCT<x: DOUBLE, y: DOUBLE> RETURN aggregate(array(0), named_struct("
        f"'res', CAST(split(h, ':')[0] AS INT), 'q', CAST(split(h, ':')[1] AS DOUBLE), "
        f"'r', CAST(split(h, ':')[2] AS DOUBLE)), (acc, z) -> acc, c -> named_struct("
        f"'x', ({r9} * pow({sq7}, 9 - c.res)) * ({_D(math.sqrt(3.0))} * c.q + {_D(math.sqrt(3.0) / 2)} * c.r) / {_D(kx)}, "
        f"'y', ({r9} * pow({sq7}, 9 - c.res)) * 1.5e0 * c.r / {_D(ky)}))",
        "h3_centeraswkt(h STRING) RETURNS STRING RETURN tl_point_text(tl_cell_center(h))",
        "h3_boundaryaswkt(h STRING) RETURNS STRING RETURN aggregate(array(0), named_struct('c', tl_cell_center(h), "
        f"'s', {r9} * pow({sq7}, 9 - CAST(split(h, ':')[0] AS INT))), (acc, z) -> acc, v -> concat('POLYGON ((', "
        f"array_join(transform(array(0, 1, 2, 3, 4, 5, 0), i -> concat(CAST(v.c.x + v.s * cos(radians(30 + 60 * i)) / {_D(kx)} AS STRING), "
        f"' ', CAST(v.c.y + v.s * sin(radians(30 + 60 * i)) / {_D(ky)} AS STRING))), ', '), '))'))",
    ]


def _h3_valid_sql() -> str:
    from towerlens.functions.cells import H3_PENTAGON_BASE_CELLS

    bits = "h3_stringtoh3(h)"
    digit = lambda i: f"(shiftright({bits}, {(15 - i) * 3}) & 7)"
    res = f"(shiftright({bits}, 52) & 15)"
    base = f"(shiftright({bits}, 45) & 127)"
    conds = [f"(shiftright({bits}, 63) & 1) = 0", f"(shiftright({bits}, 59) & 15) = 1",
             f"(shiftright({bits}, 56) & 7) = 0", f"{base} < 122"]
    for i in range(1, 16):
        conds.append(f"(CASE WHEN {i} <= {res} THEN {digit(i)} <> 7 ELSE {digit(i)} = 7 END)")
    first = "coalesce(" + ", ".join(f"CASE WHEN {i} <= {res} AND {digit(i)} <> 0 THEN {digit(i)} END"
                                    for i in range(1, 16)) + ", 0)"
    pent = ", ".join(str(b) for b in H3_PENTAGON_BASE_CELLS)
    conds.append(f"NOT ({base} IN ({pent}) AND {first} = 1)")
    hexid = " AND ".join(conds)
    return ("h3_isvalid(h STRING) RETURNS BOOLEAN RETURN coalesce(h RLIKE '^[0-9]{1,2}:-?[0-9]+:-?[0-9]+$', false) "
            f"OR coalesce({hexid}, false)")


def _text_defs() -> list[str]:
    from towerlens.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS

    pos = ", ".join("'" + w + "'" for w in sorted(set(POSITIVE_WORDS)))
    neg = ", ".join("'" + w + "'" for w in sorted(set(NEGATIVE_WORDS)))
    return [
        r"ai_summarize(t STRING, n INT DEFAULT 10) RETURNS STRING RETURN array_join(slice(filter(split(trim("
        r"regexp_extract(t, '^\\s*([^.!?\\n]*[.!?]?)', 1)), '\\s+'), w -> w <> ''), 1, n), ' ')",
        r"tl_words(t STRING) RETURNS ARRAY<STRING> RETURN filter(split(lower(regexp_replace(t, "
        r"'[^\\p{L}\\p{N}'']+', ' ')), ' '), w -> w <> '')",
        f"tl_sentiment_of(ws ARRAY<STRING>) RETURNS STRING RETURN CASE "
        f"WHEN size(filter(ws, w -> array_contains(array({pos}), w))) > 0 AND "
        f"size(filter(ws, w -> array_contains(array({neg}), w))) > 0 THEN 'mixed' "
        f"WHEN size(filter(ws, w -> array_contains(array({pos}), w))) > 0 THEN 'positive' "
        f"WHEN size(filter(ws, w -> array_contains(array({neg}), w))) > 0 THEN 'negative' ELSE 'neutral' END",
        "ai_analyze_sentiment(t STRING) RETURNS STRING RETURN CASE WHEN t IS NOT NULL THEN tl_sentiment_of(tl_words(t)) END",
    ]


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Define the ST_* / h3_* SQL functions as temporary functions of this session.

    Returns the names that could not be defined because Spark already has a
    built-in of that name (e.g. ``st_setsrid`` in Spark 4.1).
    """
    from pyspark.errors import AnalysisException

    skipped = []
    for body in _defs() + [_h3_valid_sql()] + _text_defs():
        try:
            spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION " + body)
        except AnalysisException as e:
            if "CANNOT_REPLACE_NON_SQL_UDF" not in str(e):
                raise
            skipped.append(body.split("(", 1)[0])
    return skipped
