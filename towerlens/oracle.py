"""SQL-text helpers for the DuckDB oracle queries.

The oracle statements re-derive every answer in plain SQL arithmetic over
the driver's tables.  Where a value feeds a comparison (a centroid that
picks a cell, a distance that ranks towers) the SQL repeats the Spark
expression operation for operation, so the two engines agree bit for bit on
basic IEEE arithmetic.  Rounding uses Spark's rule (HALF_UP on the shortest
decimal text of the double).
"""

from __future__ import annotations

from towerlens.functions.cells import cell_id_sql, sql_double
from towerlens.functions.geo import DEG2RAD, EARTH_RADIUS_M

D2R = sql_double(DEG2RAD)


def sround(expr: str, n: int) -> str:
    """Spark's ROUND(double, n): HALF_UP applied to the shortest decimal text."""
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    p1, p2 = f"(({lat1}) * {D2R})", f"(({lat2}) * {D2R})"
    dp = f"((({lat2}) - ({lat1})) * {D2R})"
    dl = f"((({lon2}) - ({lon1})) * {D2R})"
    sp, sl = f"sin({dp} / 2e0)", f"sin({dl} / 2e0)"
    a = f"({sp} * {sp} + cos({p1}) * cos({p2}) * ({sl} * {sl}))"
    return f"({sql_double(2 * EARTH_RADIUS_M)} * asin(sqrt(least(1e0, {a}))))"


def tie_key(dist: str) -> str:
    """Ranking key of a distance: floored to 1e-6 (see towerlens.operators.nearest)."""
    return f"floor(({dist}) * 1e6)"


def coords_sql(wkt: str) -> str:
    """List of the numbers in a WKT text, as DOUBLE (1-based)."""
    return rf"list_transform(regexp_extract_all({wkt}, '-?[0-9]+(?:\.[0-9]+)?'), lambda v: CAST(v AS DOUBLE))"


def ring5_centroid_select(v: str = "_v") -> str:
    """SELECT-list text computing centroid_lon / centroid_lat of a closed 5-point ring.

    Mirrors ``towerlens.functions.geo.centroid`` step by step for one ring:
    coordinates shifted to the first vertex, edge terms summed left to
    right from 0, area-weighted centroid divided back.
    """
    X = [f"{v}[{2 * i + 1}]" for i in range(5)]
    Y = [f"{v}[{2 * i + 2}]" for i in range(5)]
    x0, y0 = X[0], Y[0]
    cs, sxs, sys_ = [], [], []
    for i in range(4):
        cs.append(f"(({X[i]} - {x0}) * ({Y[i + 1]} - {y0}) - ({X[i + 1]} - {x0}) * ({Y[i]} - {y0}))")
        sxs.append(f"(({X[i]} - {x0}) + ({X[i + 1]} - {x0}))")
        sys_.append(f"(({Y[i]} - {y0}) + ({Y[i + 1]} - {y0}))")
    a2 = "0e0"
    mx = "0e0"
    my = "0e0"
    for i in range(4):
        a2 = f"({a2} + {cs[i]})"
        mx = f"({mx} + {sxs[i]} * {cs[i]})"
        my = f"({my} + {sys_[i]} * {cs[i]})"
    A = f"((1e0 * abs({a2})) / 2e0)"
    sx = f"(0e0 + CASE WHEN {a2} <> 0 THEN {A} * ({mx} / ({a2} * 3e0) + {x0}) ELSE 0e0 END)"
    sy = f"(0e0 + CASE WHEN {a2} <> 0 THEN {A} * ({my} / ({a2} * 3e0) + {y0}) ELSE 0e0 END)"
    a = f"(0e0 + {A})"
    return f"{sx} / {a} AS centroid_lon, {sy} / {a} AS centroid_lat"


def cell_sql(lon: str, lat: str) -> str:
    return cell_id_sql(lon, lat)
