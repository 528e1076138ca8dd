"""Hexagonal cell keys and H3-id helpers, all as Column expressions.

``cell_id`` assigns a point to a fixed hexagonal cell on a local plane
(equirectangular around ``ref_lat``) and returns a text key
``"<res>:<q>:<r>"``.  It is a binning, not the H3 geocoder: keys do not
equal H3 ids and cells of different resolutions do not nest exactly.  The
data operation the coverage queries need is "same key = same hexagon", which
this provides exactly and reproducibly in plain arithmetic (the oracle SQL
uses the same constants).

The H3 id helpers (validity, text/bigint conversion, resolution) follow the
public H3 64-bit index layout and need no package.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from towerlens.functions.exprcache import cached_expr
from towerlens.functions.geo import DEG2RAD, EARTH_RADIUS_M, _c

# Hexagon edge length in metres at resolution 9 (about 0.1053 km2
# per cell) and the aperture-7 ratio between resolutions.
RES9_EDGE_M = 201.3206
APERTURE = 7.0
DEFAULT_REF_LAT = 47.6


def edge_m(res: int) -> float:
    return RES9_EDGE_M * math.sqrt(APERTURE) ** (9 - res)


def plane_constants(res: int = 9, ref_lat: float = DEFAULT_REF_LAT) -> dict[str, float]:
    """Literal constants shared by the Column form and the oracle SQL."""
    s = edge_m(res)
    kx = EARTH_RADIUS_M * DEG2RAD * math.cos(math.radians(ref_lat))
    ky = EARTH_RADIUS_M * DEG2RAD
    return {
        "kx": kx,                           # metres per degree of longitude
        "ky": ky,                           # metres per degree of latitude
        "a": math.sqrt(3.0) / 3.0 / s,      # q = a*x - b*y
        "b": 1.0 / 3.0 / s,
        "c": 2.0 / 3.0 / s,                 # r = c*y
        "s": s,
    }


def _axial(lon: Column, lat: Column, res: int, ref_lat: float):
    k = plane_constants(res, ref_lat)
    x = lon * F.lit(k["kx"])
    y = lat * F.lit(k["ky"])
    q = x * F.lit(k["a"]) - y * F.lit(k["b"])
    r = y * F.lit(k["c"])
    t = -q - r
    rq, rr, rt = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(t + 0.5)
    dq, dr, dt = F.abs(rq - q), F.abs(rr - r), F.abs(rt - t)
    fq = F.when((dq > dr) & (dq > dt), -rr - rt).otherwise(rq)
    fr = F.when((dq > dr) & (dq > dt), rr).when(dr > dt, -rq - rt).otherwise(rr)
    return fq.cast("bigint"), fr.cast("bigint")


@cached_expr
def cell_id(lon, lat, res: int = 9, ref_lat: float = DEFAULT_REF_LAT) -> Column:
    """Hexagonal cell key of a point, e.g. ``'9:-1234:5678'``."""
    q, r = _axial(_c(lon), _c(lat), res, ref_lat)
    return F.concat_ws(":", F.lit(str(res)), q.cast("string"), r.cast("string"))


def cell_id_sql(lon: str, lat: str, res: int = 9, ref_lat: float = DEFAULT_REF_LAT) -> str:
    """The same key as ANSI SQL text (used by the oracle queries)."""
    k = plane_constants(res, ref_lat)

    def lit(v):
        return sql_double(v)

    x = f"(({lon}) * {lit(k['kx'])})"
    y = f"(({lat}) * {lit(k['ky'])})"
    q = f"({x} * {lit(k['a'])} - {y} * {lit(k['b'])})"
    r = f"({y} * {lit(k['c'])})"
    t = f"(-{q} - {r})"
    rq, rr, rt = f"floor({q} + 0.5e0)", f"floor({r} + 0.5e0)", f"floor({t} + 0.5e0)"
    dq, dr, dt = f"abs({rq} - {q})", f"abs({rr} - {r})", f"abs({rt} - {t})"
    fq = f"(CASE WHEN {dq} > {dr} AND {dq} > {dt} THEN -{rr} - {rt} ELSE {rq} END)"
    fr = f"(CASE WHEN {dq} > {dr} AND {dq} > {dt} THEN {rr} WHEN {dr} > {dt} THEN -{rq} - {rt} ELSE {rr} END)"
    return f"('{res}' || ':' || CAST(CAST({fq} AS BIGINT) AS VARCHAR) || ':' || CAST(CAST({fr} AS BIGINT) AS VARCHAR))"


def sql_double(v: float) -> str:
    """A DOUBLE literal both Spark SQL and DuckDB parse to the same value."""
    s = repr(float(v))
    if "e" not in s and "E" not in s:
        s += "e0"
    return f"({s})" if s.startswith("-") else s


def center_degrees(q, r, res, ref_lat: float = DEFAULT_REF_LAT) -> tuple[Column, Column]:
    """Longitude and latitude of a cell's centre from its two indexes (as DOUBLE)."""
    s = F.lit(RES9_EDGE_M) * F.pow(F.lit(math.sqrt(APERTURE)), F.lit(9) - res)
    x = s * (F.lit(math.sqrt(3.0)) * q + F.lit(math.sqrt(3.0) / 2.0) * r)
    y = s * F.lit(1.5) * r
    k = plane_constants(9, ref_lat)
    return x / F.lit(k["kx"]), y / F.lit(k["ky"])


def cell_center(key, ref_lat: float = DEFAULT_REF_LAT) -> Column:
    """Centre of a hexagonal cell -> struct<x: lon, y: lat>."""
    parts = F.split(_c(key), ":")
    x, y = center_degrees(parts.getItem(1).cast("double"), parts.getItem(2).cast("double"), parts.getItem(0).cast("int"), ref_lat)
    return F.struct(x.alias("x"), y.alias("y"))


def own_cells(cell_fn):
    """A user's cell ids as a Column function: ``cell_fn(lon, lat)`` maps two pandas Series of degrees to one of ids (a
    geocoder's vectorised call, say), and runs on Arrow batches.  NULL coordinates are handed on as NaN."""
    @F.pandas_udf("string")
    def cells(lon: pd.Series, lat: pd.Series) -> pd.Series:
        return pd.Series(cell_fn(lon, lat), index=lon.index).astype("string")

    return lambda lon, lat: cells(_c(lon).cast("double"), _c(lat).cast("double"))


def cell_boundary_wkt(key, ref_lat: float = DEFAULT_REF_LAT) -> Column:
    """Hexagon outline as POLYGON WKT (six corners, closed)."""
    parts = F.split(_c(key), ":")
    res = parts.getItem(0).cast("int")
    s = F.lit(RES9_EDGE_M) * F.pow(F.lit(math.sqrt(APERTURE)), F.lit(9) - res)
    c = cell_center(key, ref_lat)
    kx = EARTH_RADIUS_M * DEG2RAD * math.cos(math.radians(ref_lat))
    ky = EARTH_RADIUS_M * DEG2RAD
    pts = []
    for i in list(range(6)) + [0]:
        ang = math.radians(30 + 60 * i)
        px = c["x"] + s * F.lit(math.cos(ang)) / F.lit(kx)
        py = c["y"] + s * F.lit(math.sin(ang)) / F.lit(ky)
        pts.append(F.concat(px.cast("string"), F.lit(" "), py.cast("string")))
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *pts), F.lit("))"))


# ------------------------------------------------------------------ H3 ids
# H3 base cells that are pentagons (public H3 specification).
H3_PENTAGON_BASE_CELLS = [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]
H3_NUM_BASE_CELLS = 122


def h3_string_to_long(s) -> Column:
    """``h3_stringtoh3``: hex text -> BIGINT (NULL when not hex)."""
    s = _c(s)
    return F.when(s.rlike("^[0-9a-fA-F]{1,16}$"), F.conv(s, 16, 10).try_cast("bigint"))


def h3_long_to_string(h) -> Column:
    """``h3_h3tostring``: BIGINT -> lower-case hex text."""
    return F.lower(F.hex(_c(h)))


def h3_resolution(h) -> Column:
    return F.shiftright(_c(h), 52).bitwiseAND(F.lit(15)).cast("int")


def _bits(h: Column, shift: int, mask: int) -> Column:
    return F.shiftright(h, shift).bitwiseAND(F.lit(mask))


def h3_is_valid(h) -> Column:
    """``h3_isvalid`` for a BIGINT id.

    Checks: high bit 0, mode 1 (cell), reserved bits 0, base cell < 122,
    digits 1..res in 0..6, digits res+1..15 equal to 7, and no deleted
    K-axis sub-sequence (first non-zero digit 1) under a pentagon base cell.
    """
    return _h3_valid_long(_c(h).cast("bigint"))


def h3_is_valid_string(s) -> Column:
    """``h3_isvalid`` for a hex-text id (non-hex text is invalid)."""
    return F.coalesce(_h3_valid_long(h3_string_to_long(s)), F.lit(False))


def _h3_valid_long(h: Column) -> Column:
    res = _bits(h, 52, 15)
    base = _bits(h, 45, 127)
    ok = (F.shiftright(h, 63).bitwiseAND(F.lit(1)) == 0) & (_bits(h, 59, 15) == 1) & (_bits(h, 56, 7) == 0)
    ok = ok & (base < H3_NUM_BASE_CELLS)
    digits = [_bits(h, (15 - i) * 3, 7) for i in range(1, 16)]
    for i, d in enumerate(digits, start=1):
        ok = ok & F.when(F.lit(i) <= res, d != 7).otherwise(d == 7)
    first_nonzero = F.coalesce(*[F.when((F.lit(i) <= res) & (d != 0), d) for i, d in enumerate(digits, start=1)],
                               F.lit(0))
    is_pent = base.isin(*H3_PENTAGON_BASE_CELLS)
    ok = ok & ~(is_pent & (first_nonzero == 1))
    return F.coalesce(ok, F.lit(False))
