"""Registry of named queries: Spark DataFrame form + DuckDB oracle SQL.

Every query reads the driver's tables at ``sf_dir`` (through the fixture
derivations) so its work grows with the scale factor.  ``QUERIES`` maps a
name to ``fn(spark, sf_dir) -> DataFrame``; ``ORACLE`` maps the same name to
an SQL statement over the driver's tables (absent for rows-only checks).
"""

from __future__ import annotations

import uuid

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.functions.cells import sql_double
from towerlens.oracle import cell_sql, coords_sql, haversine_sql, ring5_centroid_select, sround, tie_key
from towerlens.plans import fixtures as fx
from towerlens.plans import pipelines as pl

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def lit(v: float) -> str:
    return sql_double(v)


CORE, METRO = pl.CORE, pl.METRO
PAD = CORE.pad(0.03)

# ------------------------------------------------------------------ shared oracle CTEs
BLD_CTE = f"""bld AS (
  SELECT building_id, height, geometry, {ring5_centroid_select('_v')}
  FROM (SELECT *, {coords_sql('geometry')} AS _v FROM buildings))"""

DT_CTE = f"""dt AS (
  SELECT building_id, height AS building_height, geometry, centroid_lon, centroid_lat,
         {cell_sql('centroid_lon', 'centroid_lat')} AS h3_res9_id
  FROM bld
  WHERE centroid_lat BETWEEN {lit(CORE.lat_min)} AND {lit(CORE.lat_max)}
    AND centroid_lon BETWEEN {lit(CORE.lon_min)} AND {lit(CORE.lon_max)})"""

BDC_CTE = """bdc AS (
  SELECT h3_res9_id, MAX(mindown) AS best_download_mbps, MAX(minup) AS best_upload_mbps,
         COUNT(*) AS provider_count
  FROM coverage_cells GROUP BY h3_res9_id)"""

_HAV_BT = haversine_sql("b.centroid_lon", "b.centroid_lat", "t.longitude", "t.latitude")

NEAR_CTE = f"""nt AS (
  SELECT * FROM towers
  WHERE latitude BETWEEN {lit(PAD.lat_min)} AND {lit(PAD.lat_max)}
    AND longitude BETWEEN {lit(PAD.lon_min)} AND {lit(PAD.lon_max)}),
ranked AS (
  SELECT b.building_id, t.tower_id AS nearest_tower_id, t.carrier AS nearest_carrier,
         t.tower_type AS nearest_tower_type, t.cell_id AS nearest_cell_id,
         t.coverage_radius_m AS nearest_coverage_radius_m, t.samples AS nearest_tower_samples,
         {_HAV_BT} AS d,
         ROW_NUMBER() OVER (PARTITION BY b.building_id ORDER BY {tie_key(_HAV_BT)}, t.tower_id) AS rn
  FROM dt b CROSS JOIN nt t)"""

GOLD_CTE = f"""gold AS (
  SELECT b.building_id, b.building_height, b.geometry, b.centroid_lon, b.centroid_lat, b.h3_res9_id,
         COALESCE(c.best_download_mbps, 0) AS best_download_mbps,
         COALESCE(c.best_upload_mbps, 0) AS best_upload_mbps,
         COALESCE(c.provider_count, 0) AS provider_count,
         r.nearest_tower_id, r.nearest_carrier, r.nearest_tower_type, r.nearest_cell_id,
         r.nearest_coverage_radius_m, r.nearest_tower_samples,
         {sround('r.d', 1)} AS distance_to_tower_m
  FROM dt b
  JOIN ranked r ON b.building_id = r.building_id AND r.rn = 1
  LEFT JOIN bdc c ON b.h3_res9_id = c.h3_res9_id)"""

GOLD_CTES = [fx.BUILDINGS_SQL, BLD_CTE, DT_CTE, fx.TOWERS_SQL, fx.CELLS_SQL, BDC_CTE, NEAR_CTE, GOLD_CTE]


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.building_coverage(fx.buildings(spark, sf_dir), fx.coverage_cells(spark, sf_dir),
                                fx.towers(spark, sf_dir), CORE, pad=0.03)


# ------------------------------------------------------------------ L1, L2
@query("building_coverage", with_(GOLD_CTES, "SELECT * FROM gold"))
def q_building_coverage(spark, sf_dir):
    return gold(spark, sf_dir)


_BUCKET_SQL = ("CASE WHEN distance_to_tower_m < 200 THEN '1: < 200m' WHEN distance_to_tower_m < 500 THEN "
               "'2: 200-500m' WHEN distance_to_tower_m < 1000 THEN '3: 500m-1km' WHEN distance_to_tower_m < 2000 "
               "THEN '4: 1-2km' ELSE '5: > 2km' END")


@query("coverage_by_distance", with_(GOLD_CTES, f"""
SELECT {_BUCKET_SQL} AS distance_bucket, COUNT(*) AS buildings,
       {sround('AVG(best_download_mbps)', 1)} AS avg_download_mbps,
       {sround('AVG(best_upload_mbps)', 1)} AS avg_upload_mbps,
       {sround('AVG(distance_to_tower_m)', 0)} AS avg_distance_m,
       {sround('AVG(provider_count)', 1)} AS avg_providers
FROM gold WHERE best_download_mbps > 0 GROUP BY 1"""))
def q_coverage_by_distance(spark, sf_dir):
    return pl.coverage_by_distance(gold(spark, sf_dir))


# ==================================================================== geometry and cells
from towerlens.functions import geo as G  # noqa: E402
from towerlens.functions.cells import cell_id  # noqa: E402
from towerlens.oracle import D2R  # noqa: E402

SITES_SILVER_CTE = """sites AS (
  SELECT site_id, CAST(SITE_LATITUDE AS DOUBLE) AS SITE_LATITUDE, CAST(SITE_LONGITUDE AS DOUBLE) AS SITE_LONGITUDE,
         CAST(SITE_LATITUDE AS DOUBLE) AS S_SITE_LATITUDE, CAST(SITE_LONGITUDE AS DOUBLE) AS S_SITE_LONGITUDE
  FROM sites_bronze WHERE SITE_LATITUDE IS NOT NULL AND SITE_LONGITUDE IS NOT NULL)"""


@query("bbox_filter", with_([fx.SITES_SQL, SITES_SILVER_CTE], f"""
SELECT site_id, S_SITE_LATITUDE, S_SITE_LONGITUDE FROM sites
WHERE S_SITE_LATITUDE BETWEEN {lit(CORE.lat_min)} AND {lit(CORE.lat_max)}
  AND S_SITE_LONGITUDE BETWEEN {lit(CORE.lon_min)} AND {lit(CORE.lon_max)}"""))
def q_bbox_filter(spark, sf_dir):
    s = pl.sites_silver(fx.sites_bronze(spark, sf_dir))
    return s.filter(CORE.contains("S_SITE_LATITUDE", "S_SITE_LONGITUDE")).select(
        "site_id", "S_SITE_LATITUDE", "S_SITE_LONGITUDE")


@query("bbox_padded", with_([fx.TOWERS_SQL], f"""
SELECT tower_id, latitude, longitude FROM towers
WHERE latitude BETWEEN {lit(PAD.lat_min)} AND {lit(PAD.lat_max)}
  AND longitude BETWEEN {lit(PAD.lon_min)} AND {lit(PAD.lon_max)}"""))
def q_bbox_padded(spark, sf_dir):
    return fx.towers(spark, sf_dir).filter(PAD.contains("latitude", "longitude")).select(
        "tower_id", "latitude", "longitude")


@query("typed_ingest", """
SELECT TRY_CAST(CAST(event_id AS VARCHAR) AS BIGINT) AS event_id,
       TRY_CAST(CASE WHEN event_id % 50 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value,
       TRY_CAST(CASE WHEN event_id % 70 = 0 THEN 'x' || CAST(user_id AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END AS INTEGER) AS user_id,
       strftime(make_timestamp((1500000000 + event_id * 60) * 1000000), '%Y-%m-%d %H:%M:%S') AS created_ts
FROM events""")
def q_typed_ingest(spark, sf_dir):
    from towerlens.sources.files import typed

    e = fx.table(spark, sf_dir, "events")
    k = F.col("event_id")
    text = e.select(k.cast("string").alias("_c0"),
                    F.when(k % 50 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("_c1"),
                    F.when(k % 70 == 0, F.concat(F.lit("x"), F.col("user_id").cast("string")))
                    .otherwise(F.col("user_id").cast("string")).alias("_c2"),
                    (F.lit(1500000000) + k * 60).cast("string").alias("_c3"))
    return text.select(*typed([("event_id", "bigint"), ("value", "double"), ("user_id", "int"),
                               ("created_ts", "epoch_text")]))


@query("surrogate_id_stable", with_([fx.SITES_SQL], "SELECT site_id, md5(CAST(site_id AS VARCHAR)) AS site_uid FROM sites_bronze WHERE SITE_LATITUDE IS NOT NULL AND SITE_LONGITUDE IS NOT NULL"))
def q_surrogate_id(spark, sf_dir):
    s = pl.sites_silver(fx.sites_bronze(spark, sf_dir))
    return pl.with_surrogate_id(s, "site_uid", ["site_id"]).select(
        "site_id", "site_uid")


@query("polygon_centroid", with_([fx.BUILDINGS_SQL, BLD_CTE], "SELECT building_id, centroid_lon, centroid_lat FROM bld"))
def q_polygon_centroid(spark, sf_dir):
    return pl.with_centroid(fx.buildings(spark, sf_dir)).select("building_id", "centroid_lon", "centroid_lat")


def _area_sql(v="_v"):
    X = [f"{v}[{2 * i + 1}]" for i in range(5)]
    Y = [f"{v}[{2 * i + 2}]" for i in range(5)]
    a2 = "0e0"
    for i in range(4):
        a2 = f"({a2} + (({X[i]} - {X[0]}) * ({Y[i + 1]} - {Y[0]}) - ({X[i + 1]} - {X[0]}) * ({Y[i]} - {Y[0]})))"
    return f"(0e0 + (1e0 * abs({a2})) / 2e0)"


_AREA_K = G.EARTH_RADIUS_M ** 2 * G.DEG2RAD ** 2 * __import__("math").cos(__import__("math").radians(47.6))


@query("polygon_area", with_([fx.BUILDINGS_SQL], f"""
SELECT building_id, {_area_sql()} AS area_deg2, {sround(f'{_area_sql()} * {lit(_AREA_K)}', 6)} AS area_m2
FROM (SELECT *, {coords_sql('geometry')} AS _v FROM buildings)"""))
def q_polygon_area(spark, sf_dir):
    b = fx.buildings(spark, sf_dir)
    b = G.materialize(b, _p=G.poly_from_wkt("geometry"))
    b = G.materialize(b, _a=G.area("_p"))
    return b.select("building_id", F.col("_a").alias("area_deg2"),
                    F.round(F.col("_a") * F.lit(_AREA_K), 6).alias("area_m2"))


@query("polygon_bbox", with_([fx.BUILDINGS_SQL], """
SELECT building_id, least(_v[1], _v[3], _v[5], _v[7], _v[9]) AS minx, least(_v[2], _v[4], _v[6], _v[8], _v[10]) AS miny,
       greatest(_v[1], _v[3], _v[5], _v[7], _v[9]) AS maxx, greatest(_v[2], _v[4], _v[6], _v[8], _v[10]) AS maxy
FROM (SELECT *, """ + coords_sql("geometry") + """ AS _v FROM buildings)"""))
def q_polygon_bbox(spark, sf_dir):
    b = G.materialize(fx.buildings(spark, sf_dir), _b=G.bbox(G.poly_from_wkt("geometry")))
    return b.select("building_id", "_b.minx", "_b.miny", "_b.maxx", "_b.maxy")


@query("polygon_valid", """
SELECT c_custkey AS shape_id,
       CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 11 = 0
            THEN 'ST_LineString' ELSE 'ST_Polygon' END AS geometry_type,
       NOT (c_custkey % 7 = 0 OR c_custkey % 13 = 0 OR c_custkey % 5 = 0 OR c_custkey % 11 = 0 OR c_custkey % 17 = 0) AS is_valid
FROM customer""")
def q_polygon_valid(spark, sf_dir):
    s = fx.test_shapes(spark, sf_dir)
    return s.select("shape_id", G.geometry_type("wkt").alias("geometry_type"),
                    G.is_valid(G.poly_from_wkt("wkt"), check_self_intersection=True).alias("is_valid"))


def _pairs(spark, sf_dir):
    n = fx.table(spark, sf_dir, "supplier").count()
    c = fx.table(spark, sf_dir, "customer").select("c_custkey").withColumn("s_suppkey", F.col("c_custkey") % F.lit(n))
    s = fx.table(spark, sf_dir, "supplier").select("s_suppkey")
    j = c.join(s, "s_suppkey")
    return j.select("c_custkey", "s_suppkey",
                    fx.loc_lon(F.col("c_custkey")).alias("lon1"), fx.loc_lat(F.col("c_custkey")).alias("lat1"),
                    fx.loc_lon(F.col("s_suppkey") + 13).alias("lon2"), fx.loc_lat(F.col("s_suppkey") + 13).alias("lat2"))


_PAIRS_CTE = f"""pairs AS (
  SELECT c_custkey, s_suppkey, {fx.loc_lon_sql('c_custkey')} AS lon1, {fx.loc_lat_sql('c_custkey')} AS lat1,
         {fx.loc_lon_sql('s_suppkey + 13')} AS lon2, {fx.loc_lat_sql('s_suppkey + 13')} AS lat2
  FROM customer JOIN supplier ON s_suppkey = c_custkey % (SELECT COUNT(*) FROM supplier))"""


@query("haversine_pairs", with_([_PAIRS_CTE], f"""
SELECT c_custkey, s_suppkey, {sround(haversine_sql('lon1', 'lat1', 'lon2', 'lat2'), 3)} AS distance_m FROM pairs"""))
def q_haversine_pairs(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return p.select("c_custkey", "s_suppkey", F.round(G.haversine_m("lon1", "lat1", "lon2", "lat2"), 3).alias("distance_m"))


_PLANAR_K = 111000.0 * __import__("math").cos(__import__("math").radians(47.6))


@query("planar_pairs", with_([_PAIRS_CTE], f"""
SELECT c_custkey, s_suppkey, {sround('sqrt((lon2 - lon1) * (lon2 - lon1) + (lat2 - lat1) * (lat2 - lat1))', 9)} AS distance_deg,
       {sround(f'sqrt((lon2 - lon1) * (lon2 - lon1) + (lat2 - lat1) * (lat2 - lat1)) * {lit(_PLANAR_K)}', 3)} AS distance_m
FROM pairs"""))
def q_planar_pairs(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    d = G.planar_deg("lon1", "lat1", "lon2", "lat2")
    return p.select("c_custkey", "s_suppkey", F.round(d, 9).alias("distance_deg"),
                    F.round(G.deg_to_m(d), 3).alias("distance_m"))


@query("cell_assign", with_([fx.BUILDINGS_SQL, BLD_CTE],
                            f"SELECT building_id, {cell_sql('centroid_lon', 'centroid_lat')} AS h3_res9_id FROM bld"))
def q_cell_assign(spark, sf_dir):
    b = pl.with_centroid(fx.buildings(spark, sf_dir))
    return b.select("building_id", cell_id("centroid_lon", "centroid_lat").alias("h3_res9_id"))


@query("cell_best", with_([fx.CELLS_SQL, BDC_CTE], "SELECT * FROM bdc"))
def q_cell_best(spark, sf_dir):
    from towerlens.operators.coverage import best_per_cell

    return best_per_cell(fx.coverage_cells(spark, sf_dir))


ALLB_CTE = f"""allb AS (
  SELECT building_id, height, geometry, centroid_lon, centroid_lat,
         {cell_sql('centroid_lon', 'centroid_lat')} AS h3_res9_id FROM bld)"""
ALLB_CTES = [fx.BUILDINGS_SQL, BLD_CTE, ALLB_CTE, fx.CELLS_SQL]


def all_buildings(spark, sf_dir):
    b = pl.with_centroid(fx.buildings(spark, sf_dir))
    return b.withColumn("h3_res9_id", cell_id("centroid_lon", "centroid_lat"))


@query("cell_join_left", with_(ALLB_CTES + [BDC_CTE], """
SELECT b.building_id, b.h3_res9_id, COALESCE(c.best_download_mbps, 0) AS best_download_mbps,
       COALESCE(c.best_upload_mbps, 0) AS best_upload_mbps, COALESCE(c.provider_count, 0) AS provider_count
FROM allb b LEFT JOIN bdc c ON b.h3_res9_id = c.h3_res9_id"""))
def q_cell_join_left(spark, sf_dir):
    from towerlens.operators.coverage import cell_coverage_join

    j = cell_coverage_join(all_buildings(spark, sf_dir), fx.coverage_cells(spark, sf_dir))
    return j.select("building_id", "h3_res9_id", "best_download_mbps", "best_upload_mbps", "provider_count")


_CELL_COLS = ("fid", "technology", "mindown", "minup", "environmnt")


@query("cell_join_inner", with_(ALLB_CTES, """
SELECT b.building_id, b.h3_res9_id, c.fid, c.technology, c.mindown, c.minup, c.environmnt
FROM allb b JOIN coverage_cells c ON b.h3_res9_id = c.h3_res9_id"""))
def q_cell_join_inner(spark, sf_dir):
    from towerlens.operators.coverage import cell_join

    b = all_buildings(spark, sf_dir).select("building_id", "h3_res9_id")
    j = cell_join(b, fx.coverage_cells(spark, sf_dir), how="inner", cell_cols=_CELL_COLS)
    return j.select("building_id", "h3_res9_id", *_CELL_COLS)


@query("cell_join_fanout", with_(ALLB_CTES, """
SELECT b.building_id, b.h3_res9_id, c.fid, c.technology, c.mindown, c.minup, c.environmnt
FROM allb b LEFT JOIN coverage_cells c ON b.h3_res9_id = c.h3_res9_id"""))
def q_cell_join_fanout(spark, sf_dir):
    from towerlens.operators.coverage import cell_join

    b = all_buildings(spark, sf_dir).select("building_id", "h3_res9_id")
    j = cell_join(b, fx.coverage_cells(spark, sf_dir), how="left", cell_cols=_CELL_COLS)
    return j.select("building_id", "h3_res9_id", *_CELL_COLS)


@query("cell_join_distinct", with_(ALLB_CTES, """
SELECT b.building_id, b.height AS building_height, ANY_VALUE(b.geometry) AS geometry, b.h3_res9_id,
       MAX(c.mindown) AS best_download_mbps, MAX(c.minup) AS best_upload_mbps, COUNT(DISTINCT c.fid) AS provider_count
FROM allb b LEFT JOIN coverage_cells c ON b.h3_res9_id = c.h3_res9_id
GROUP BY b.building_id, b.height, b.h3_res9_id"""))
def q_cell_join_distinct(spark, sf_dir):
    from towerlens.operators.coverage import cell_coverage_join

    j = cell_coverage_join(all_buildings(spark, sf_dir), fx.coverage_cells(spark, sf_dir), distinct_on="fid", fill=None)
    return j.select("building_id", F.col("height").alias("building_height"), "geometry", "h3_res9_id",
                    "best_download_mbps", "best_upload_mbps", "provider_count")


# ==================================================================== nearest neighbour variants
def _ranked_sql(left: str, keys: str, lon: str, lat: str, extra_cols: str = "", metric: str = "sphere",
                where: str = "") -> str:
    if metric == "planar":
        d = f"sqrt((t.longitude - {lon}) * (t.longitude - {lon}) + (t.latitude - {lat}) * (t.latitude - {lat}))"
    else:
        d = haversine_sql(lon, lat, "t.longitude", "t.latitude")
    return f"""ranked AS (
  SELECT {keys}, {extra_cols} t.tower_id AS nearest_tower_id, t.tower_type AS nearest_tower_type, {d} AS d,
         ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {tie_key(d)}, t.tower_id) AS rn
  FROM {left} CROSS JOIN towers t {where})"""


def _nearest_all(spark, sf_dir, **kw):
    b = pl.with_centroid(fx.buildings(spark, sf_dir)).select("building_id", "centroid_lon", "centroid_lat")
    t = fx.towers(spark, sf_dir).select("latitude", "longitude", F.col("tower_id").alias("nearest_tower_id"),
                                         F.col("tower_type").alias("nearest_tower_type"))
    from towerlens.operators.nearest import nearest

    n = nearest(b, t, left_xy=("centroid_lon", "centroid_lat"), right_xy=("longitude", "latitude"),
                right_id="nearest_tower_id", right_cols=["nearest_tower_type"], dist_col="_d", **kw)
    return n


_NEAREST_ALL_SQL = with_([fx.BUILDINGS_SQL, BLD_CTE, fx.TOWERS_SQL,
                          _ranked_sql("bld b", "b.building_id", "b.centroid_lon", "b.centroid_lat")], f"""
SELECT building_id, nearest_tower_id, nearest_tower_type, {sround('d', 1)} AS distance_to_tower_m
FROM ranked WHERE rn = 1""")


@query("nearest_tower", _NEAREST_ALL_SQL)
def q_nearest_tower(spark, sf_dir):
    n = _nearest_all(spark, sf_dir)
    return n.select("building_id", "nearest_tower_id", "nearest_tower_type", F.round("_d", 1).alias("distance_to_tower_m"))


@query("nearest_tower_grid", _NEAREST_ALL_SQL)
def q_nearest_tower_grid(spark, sf_dir):
    n = _nearest_all(spark, sf_dir, block_points=100)
    return n.select("building_id", "nearest_tower_id", "nearest_tower_type", F.round("_d", 1).alias("distance_to_tower_m"))


@query("nearest_planar", with_([fx.BUILDINGS_SQL, BLD_CTE, fx.TOWERS_SQL,
                                _ranked_sql("bld b", "b.building_id", "b.centroid_lon", "b.centroid_lat",
                                            metric="planar")], f"""
SELECT building_id, nearest_tower_id, {sround(f'd * {lit(_PLANAR_K)}', 1)} AS distance_m FROM ranked WHERE rn = 1"""))
def q_nearest_planar(spark, sf_dir):
    n = _nearest_all(spark, sf_dir, metric="planar")
    return n.select("building_id", "nearest_tower_id", F.round(G.deg_to_m(F.col("_d")), 1).alias("distance_m"))


@query("nearest_within_max", with_([fx.BUILDINGS_SQL, BLD_CTE, fx.TOWERS_SQL,
                                    _ranked_sql("bld b", "b.building_id", "b.centroid_lon", "b.centroid_lat")], f"""
SELECT b.building_id, r.nearest_tower_id, {sround('r.d', 1)} AS distance_to_tower_m
FROM bld b LEFT JOIN ranked r ON b.building_id = r.building_id AND r.rn = 1 AND r.d <= 300e0"""))
def q_nearest_within_max(spark, sf_dir):
    n = _nearest_all(spark, sf_dir, max_distance=300.0, how="left")
    return n.select("building_id", "nearest_tower_id", F.round("_d", 1).alias("distance_to_tower_m"))


@query("nearest_tower_by_technology", with_(ALLB_CTES + [fx.TOWERS_SQL, """bt AS (
  SELECT DISTINCT b.building_id, c.technology, b.centroid_lon, b.centroid_lat
  FROM allb b JOIN coverage_cells c ON b.h3_res9_id = c.h3_res9_id)""",
    _ranked_sql("bt b", "b.building_id, b.technology", "b.centroid_lon", "b.centroid_lat")], f"""
SELECT building_id, technology, nearest_tower_id, {sround('d', 1)} AS distance_to_tower_m FROM ranked WHERE rn = 1"""))
def q_nearest_by_technology(spark, sf_dir):
    from towerlens.operators.coverage import cell_join
    from towerlens.operators.nearest import nearest

    t = fx.towers(spark, sf_dir).select("latitude", "longitude", F.col("tower_id").alias("nearest_tower_id"))
    near = nearest(all_buildings(spark, sf_dir), t, left_xy=("centroid_lon", "centroid_lat"), right_xy=("longitude", "latitude"),
                   right_id="nearest_tower_id", dist_col="_d")
    cells = fx.coverage_cells(spark, sf_dir).select("h3_res9_id", "technology").distinct()
    n = cell_join(near, cells, how="inner", cell_cols=("technology",))
    return n.select("building_id", "technology", "nearest_tower_id", F.round("_d", 1).alias("distance_to_tower_m"))


# ==================================================================== site to market
MARKETS_CTE = f"""markets AS (
  SELECT ID AS market_id, Name AS market_name, State AS state, MarketType AS market_type,
         MarketTypeDetailed AS market_type_detailed, Population AS population, geometry_wkt, cx, cy
  FROM markets_bronze WHERE geometry_wkt IS NOT NULL),
within AS (
  SELECT s.site_id, s.S_SITE_LATITUDE, s.S_SITE_LONGITUDE, m.market_id, m.market_name, m.state,
         m.market_type_detailed, m.population
  FROM sites s JOIN markets m
    ON abs(s.S_SITE_LONGITUDE - m.cx) + abs(s.S_SITE_LATITUDE - m.cy) < {lit(fx.MARKET_HALF_DIAGONAL)}),
mc AS (
  SELECT market_id, market_name, state, market_type_detailed, population, {ring5_centroid_select('_v')}
  FROM (SELECT *, {coords_sql('geometry_wkt')} AS _v FROM markets)),
unmatched AS (
  SELECT s.* FROM sites s WHERE NOT EXISTS (SELECT 1 FROM within w WHERE w.site_id = s.site_id)),
nrank AS (
  SELECT u.site_id, u.S_SITE_LATITUDE, u.S_SITE_LONGITUDE, m.market_id, m.market_name, m.state,
         m.market_type_detailed, m.population,
         {haversine_sql('u.S_SITE_LONGITUDE', 'u.S_SITE_LATITUDE', 'm.centroid_lon', 'm.centroid_lat')} AS d,
         ROW_NUMBER() OVER (PARTITION BY u.site_id ORDER BY
           {tie_key(haversine_sql('u.S_SITE_LONGITUDE', 'u.S_SITE_LATITUDE', 'm.centroid_lon', 'm.centroid_lat'))},
           m.market_id) AS rn
  FROM unmatched u CROSS JOIN mc m),
nearest_m AS (
  SELECT site_id, S_SITE_LATITUDE, S_SITE_LONGITUDE, market_id, market_name, state, market_type_detailed,
         population, {sround('d / 1000e0', 2)} AS distance_km
  FROM nrank WHERE rn = 1),
enriched AS (
  SELECT site_id, S_SITE_LATITUDE, S_SITE_LONGITUDE, market_id, market_name, state, market_type_detailed,
         population, 'WITHIN' AS match_type, 0.0e0 AS distance_km FROM within
  UNION ALL
  SELECT site_id, S_SITE_LATITUDE, S_SITE_LONGITUDE, market_id, market_name, state, market_type_detailed,
         population, 'NEAREST' AS match_type, distance_km FROM nearest_m)"""
SITE_CTES = [fx.SITES_SQL, SITES_SILVER_CTE, fx.MARKETS_SQL, MARKETS_CTE]


def _sites_markets(spark, sf_dir):
    return pl.sites_silver(fx.sites_bronze(spark, sf_dir)), pl.markets_silver(fx.markets_bronze(spark, sf_dir))


@query("contains_join", with_(SITE_CTES, "SELECT * FROM within"))
def q_contains_join(spark, sf_dir):
    s, m = _sites_markets(spark, sf_dir)
    return pl.sites_in_market(s, m)


@query("contains_counts", with_(SITE_CTES, """
SELECT m.market_id, COUNT(DISTINCT w.site_id) AS n_sites
FROM markets m LEFT JOIN within w ON m.market_id = w.market_id GROUP BY m.market_id"""))
def q_contains_counts(spark, sf_dir):
    from towerlens.operators.spatial_join import contains_counts

    s, m = _sites_markets(spark, sf_dir)
    c = contains_counts(m, s, point_xy=("S_SITE_LONGITUDE", "S_SITE_LATITUDE"), wkt_col="geometry_wkt",
                        poly_id="market_id", point_id="site_id", out_col="n_sites")
    return c.select("market_id", "n_sites")


@query("unmatched_sites", with_(SITE_CTES, "SELECT site_id FROM unmatched"))
def q_unmatched_sites(spark, sf_dir):
    s, m = _sites_markets(spark, sf_dir)
    w = pl.sites_in_market(s, m)
    return s.join(w.select("site_id"), "site_id", "left_anti").select("site_id")


@query("nearest_market", with_(SITE_CTES, "SELECT * FROM nearest_m"))
def q_nearest_market(spark, sf_dir):
    s, m = _sites_markets(spark, sf_dir)
    return pl.sites_nearest_market(s, m, pl.sites_in_market(s, m))


@query("site_market_enriched", with_(SITE_CTES, "SELECT * FROM enriched"))
def q_site_market_enriched(spark, sf_dir):
    return pl.match_sites(fx.sites_bronze(spark, sf_dir), fx.markets_bronze(spark, sf_dir))


@query("sites_per_market", with_(SITE_CTES, """
SELECT market_name, state, COUNT(*) AS sites FROM enriched GROUP BY market_name, state"""))
def q_sites_per_market(spark, sf_dir):
    return pl.sites_per_market(pl.match_sites(fx.sites_bronze(spark, sf_dir), fx.markets_bronze(spark, sf_dir)))


@query("n10_sites_outside_markets", with_(SITE_CTES, """
SELECT site_id, market_name, distance_km FROM enriched WHERE match_type = 'NEAREST'"""))
def q_n10(spark, sf_dir):
    e = pl.match_sites(fx.sites_bronze(spark, sf_dir), fx.markets_bronze(spark, sf_dir))
    return (e.filter(F.col("match_type") == "NEAREST").select("site_id", "market_name", "distance_km")
            .orderBy(F.desc("distance_km"), "site_id"))


# ==================================================================== coverage variants and summaries
COV5_CTES = [fx.BUILDINGS_SQL, BLD_CTE, DT_CTE, fx.TOWERS_SQL, fx.CELLS_SQL, """cov5 AS (
  SELECT b.building_id, b.building_height, ANY_VALUE(b.geometry) AS geometry, b.centroid_lon, b.centroid_lat,
         b.h3_res9_id, MAX(c.mindown) AS best_download_mbps, MAX(c.minup) AS best_upload_mbps,
         COUNT(DISTINCT c.fid) AS provider_count
  FROM dt b LEFT JOIN coverage_cells c ON b.h3_res9_id = c.h3_res9_id
  GROUP BY b.building_id, b.building_height, b.centroid_lon, b.centroid_lat, b.h3_res9_id)""",
             f"""r5 AS (
  SELECT b.building_id, t.tower_id AS nearest_tower_id, t.carrier AS nearest_carrier,
         t.tower_type AS nearest_tower_type, t.cell_id AS nearest_cell_id,
         t.coverage_radius_m AS nearest_coverage_radius_m, t.samples AS nearest_tower_samples, {_HAV_BT} AS d,
         ROW_NUMBER() OVER (PARTITION BY b.building_id ORDER BY {tie_key(_HAV_BT)}, t.tower_id) AS rn
  FROM cov5 b CROSS JOIN towers t)""", f"""l5 AS (
  SELECT c.*, r.nearest_tower_id, r.nearest_carrier, r.nearest_tower_type, r.nearest_cell_id,
         r.nearest_coverage_radius_m, r.nearest_tower_samples, {sround('r.d', 1)} AS distance_to_tower_m
  FROM cov5 c JOIN r5 r ON c.building_id = r.building_id AND r.rn = 1)"""]


def cov5(spark, sf_dir):
    return pl.building_coverage(fx.buildings(spark, sf_dir), fx.coverage_cells(spark, sf_dir),
                                fx.towers(spark, sf_dir), CORE, pad=None, distinct_on="fid", fill=None)


@query("coverage_distinct_providers", with_(COV5_CTES, "SELECT * FROM l5"))
def q_cov5(spark, sf_dir):
    return cov5(spark, sf_dir)


@query("tower_type_summary", with_(COV5_CTES, f"""
SELECT nearest_tower_type, COUNT(*) AS buildings,
       {sround('AVG(distance_to_tower_m)', 1)} AS avg_distance_m, {sround('MIN(distance_to_tower_m)', 1)} AS min_distance_m,
       {sround('MAX(distance_to_tower_m)', 1)} AS max_distance_m,
       {sround('AVG(best_download_mbps)', 1)} AS avg_download_mbps, {sround('AVG(best_upload_mbps)', 1)} AS avg_upload_mbps,
       {sround('AVG(provider_count)', 1)} AS avg_providers
FROM l5 WHERE best_download_mbps IS NOT NULL GROUP BY nearest_tower_type"""))
def q_tower_type_summary(spark, sf_dir):
    return pl.tower_type_summary(cov5(spark, sf_dir))


@query("covered_share", with_(GOLD_CTES, f"""
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE best_download_mbps > 0) AS covered,
       {sround('(COUNT(*) FILTER (WHERE best_download_mbps > 0)) * 100.0e0 / COUNT(*)', 1)} AS covered_pct
FROM gold"""))
def q_covered_share(spark, sf_dir):
    return pl.covered_share(gold(spark, sf_dir), F.col("best_download_mbps") > 0)


# ==================================================================== telemetry overlay
_HEALTH_SQL = ("CASE WHEN prb_utilization_pct >= 85 OR latency_ms >= 120 OR packet_loss_pct >= 3 THEN 'critical' "
               "WHEN prb_utilization_pct >= 70 OR latency_ms >= 90 OR packet_loss_pct >= 1.5 THEN 'watch' "
               "ELSE 'healthy' END")
KPI_LATEST_CTE = f"""kpi_latest AS (
  SELECT tower_id, event_ts AS kpi_snapshot_ts, prb_utilization_pct, latency_ms, packet_loss_pct, throughput_mbps,
         {_HEALTH_SQL} AS tower_health_band
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tower_id ORDER BY event_ts DESC, event_id DESC) AS rn
        FROM tower_kpis) WHERE rn = 1)"""
DEMAND_LATEST_CTE = f"""demand_latest AS (
  SELECT building_id, event_ts AS demand_snapshot_ts, demand_users, traffic_mix, indoor_penetration_factor,
         {sround('demand_users * (1.1e0 - indoor_penetration_factor / 2.0e0)', 2)} AS effective_radio_load_score
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY building_id ORDER BY event_ts DESC, order_key DESC) AS rn
        FROM building_demand) WHERE rn = 1)"""


@query("kpis_latest", with_([fx.KPIS_SQL, KPI_LATEST_CTE], "SELECT * FROM kpi_latest"))
def q_kpis_latest(spark, sf_dir):
    return pl.kpis_latest(fx.tower_kpis(spark, sf_dir), tie="event_id")


@query("demand_latest", with_([fx.DEMAND_SQL, DEMAND_LATEST_CTE], "SELECT * FROM demand_latest"))
def q_demand_latest(spark, sf_dir):
    return pl.demand_latest(fx.building_demand(spark, sf_dir), tie="order_key")


@query("ops_overlay", with_(GOLD_CTES + [fx.KPIS_SQL, KPI_LATEST_CTE, fx.DEMAND_SQL, DEMAND_LATEST_CTE], """
SELECT g.*, d.demand_snapshot_ts, d.demand_users, d.traffic_mix, d.indoor_penetration_factor,
       d.effective_radio_load_score, k.kpi_snapshot_ts, k.prb_utilization_pct, k.latency_ms, k.packet_loss_pct,
       k.throughput_mbps, k.tower_health_band,
       CASE WHEN k.tower_health_band = 'critical' OR d.effective_radio_load_score >= 45 THEN 'critical'
            WHEN k.tower_health_band = 'watch' OR d.effective_radio_load_score >= 28 THEN 'watch'
            ELSE 'healthy' END AS building_service_risk_band
FROM gold g LEFT JOIN demand_latest d ON g.building_id = d.building_id
LEFT JOIN kpi_latest k ON g.nearest_tower_id = k.tower_id"""))
def q_ops_overlay(spark, sf_dir):
    return pl.ops_overlay(gold(spark, sf_dir), pl.demand_latest(fx.building_demand(spark, sf_dir), tie="order_key"),
                          pl.kpis_latest(fx.tower_kpis(spark, sf_dir), tie="event_id"))


# ==================================================================== designer flow
def _register_domain_views(spark, sf_dir):
    from towerlens.functions.sql import register_sql_functions

    register_sql_functions(spark)
    tag = abs(hash(sf_dir)) % 10**8
    names = {"towers": f"tl_towers_{tag}", "cells": f"tl_cells_{tag}", "buildings": f"tl_buildings_{tag}"}
    fx.towers(spark, sf_dir).createOrReplaceTempView(names["towers"])
    fx.coverage_cells(spark, sf_dir).createOrReplaceTempView(names["cells"])
    fx.buildings(spark, sf_dir).createOrReplaceTempView(names["buildings"])
    return names


_DES_BUCKET = ("CASE WHEN d < 500 THEN '0-500m' WHEN d < 1000 THEN '500-1000m' WHEN d < 2000 THEN '1000-2000m' "
               "WHEN d < 3000 THEN '2000-3000m' ELSE '3000m+' END")


@query("designer_buckets", with_(ALLB_CTES + [fx.TOWERS_SQL, """jd AS (
  SELECT * FROM (SELECT b.building_id, b.centroid_lon, b.centroid_lat, c.fid, c.technology, c.mindown, c.minup,
                        ROW_NUMBER() OVER (PARTITION BY b.building_id, c.technology ORDER BY c.fid) AS rn0
                 FROM allb b JOIN coverage_cells c ON b.h3_res9_id = c.h3_res9_id) WHERE rn0 = 1)""",
    _ranked_sql("jd b", "b.building_id, b.technology", "b.centroid_lon", "b.centroid_lat", "b.mindown, b.minup,")],
    f"""
SELECT {_DES_BUCKET} AS distance_bucket, AVG(mindown) AS avg_mindown, AVG(minup) AS avg_minup,
       MIN(mindown) AS min_mindown, MAX(mindown) AS max_mindown, MIN(minup) AS min_minup, MAX(minup) AS max_minup,
       COUNT(*) AS building_count
FROM ranked WHERE rn = 1 GROUP BY 1"""))
def q_designer_buckets(spark, sf_dir):
    from towerlens.plans.flows import designer_coverage_flow
    from towerlens.plans.nodes import run_flow

    v = _register_domain_views(spark, sf_dir)
    ctx = run_flow(designer_coverage_flow(v["towers"], v["cells"], v["buildings"]), spark)
    return ctx["by_distance.aggregated_data"]


@query("tower_type_counts", with_([fx.TOWERS_SQL],
                                  "SELECT tower_type, COUNT(tower_id) AS tower_count FROM towers GROUP BY tower_type"))
def q_tower_type_counts(spark, sf_dir):
    from towerlens.plans.flows import tower_type_count_flow
    from towerlens.plans.nodes import run_flow

    v = _register_domain_views(spark, sf_dir)
    return run_flow(tower_type_count_flow(v["towers"]), spark)["by_type.aggregated_data"]


# ==================================================================== dataflow nodes
def _agg_cfg(groups, aggs):
    return {"group_bys": [{"expr": g, "type": "expr"} for g in groups],
            "aggregations": [dict({"columnExpr": {"expr": e, "type": "expr"}, "fn": fn}, **({"alias": a} if a else {}),
                                  **extra) for e, fn, a, extra in aggs]}


@query("agg_node_all_functions", f"""
SELECT l_returnflag, SUM(l_quantity) AS sum_qty, {sround('AVG(l_extendedprice)', 4)} AS avg_price,
       COUNT(l_orderkey) AS n, MIN(l_discount) AS min_disc, MAX(l_tax) AS max_tax, AVG(l_quantity) AS mean_qty,
       MEDIAN(l_quantity) AS median_qty, {sround('STDDEV_SAMP(l_quantity)', 6)} AS sd_qty,
       {sround('VAR_SAMP(l_quantity)', 6)} AS var_qty, {sround('SUM(l_tax)', 4)} AS sum_tax
FROM lineitem GROUP BY l_returnflag""")
def q_agg_node_all(spark, sf_dir):
    from towerlens.plans.nodes import run_step

    cfg = _agg_cfg(["l_returnflag"], [
        ("l_returnflag", "-", None, {}), ("l_quantity", "SUM", "sum_qty", {}), ("l_extendedprice", "AVG", "avg_price", {}),
        ("l_orderkey", "COUNT", "n", {}), ("l_discount", "MIN", "min_disc", {}), ("l_tax", "MAX", "max_tax", {}),
        ("l_quantity", "MEAN", "mean_qty", {}), ("l_quantity", "MEDIAN", "median_qty", {}),
        ("l_quantity", "STDDEV", "sd_qty", {}), ("l_quantity", "VARIANCE", "var_qty", {}),
        ("l_tax", "sum", "sum_tax", {})])
    out = run_step("aggregate", cfg, {"data": fx.table(spark, sf_dir, "lineitem")}, spark)
    return run_step("transform", {"expressions": [
        "l_returnflag", "sum_qty", "round(avg_price, 4) AS avg_price", "n", "min_disc", "max_tax", "mean_qty",
        "median_qty", "round(sd_qty, 6) AS sd_qty", "round(var_qty, 6) AS var_qty", "round(sum_tax, 4) AS sum_tax"]},
        {"data": out}, spark)


@query("agg_node_percentile", """
SELECT l_linestatus, quantile_cont(l_quantity, 0.0) AS p_low, quantile_cont(l_quantity, 1.0) AS p_high,
       quantile_cont(l_quantity, 0.5) AS p_nan, quantile_cont(l_quantity, 0.5) AS p_bool,
       quantile_cont(l_quantity, 0.5) AS p_missing, quantile_cont(l_quantity, 0.9) AS p90
FROM lineitem GROUP BY l_linestatus""")
def q_agg_node_percentile(spark, sf_dir):
    from towerlens.plans.nodes import run_step

    cfg = _agg_cfg(["l_linestatus"], [
        ("l_quantity", "PERCENTILE", "p_low", {"percentage": -0.1}),
        ("l_quantity", "PERCENTILE", "p_high", {"percentage": 1.5}),
        ("l_quantity", "PERCENTILE", "p_nan", {"percentage": float("nan")}),
        ("l_quantity", "PERCENTILE", "p_bool", {"percentage": True}),
        ("l_quantity", "PERCENTILE", "p_missing", {}),
        ("l_quantity", "PERCENTILE", "p90", {"percentage": 0.9})])
    return run_step("aggregate", cfg, {"data": fx.table(spark, sf_dir, "lineitem")}, spark)


@query("agg_node_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_agg_node_distinct(spark, sf_dir):
    from towerlens.plans.nodes import run_step

    cfg = {"group_bys": [{"expr": "l_returnflag"}, {"expr": "l_linestatus"}], "aggregations": []}
    return run_step("aggregate", cfg, {"data": fx.table(spark, sf_dir, "lineitem")}, spark)


@query("agg_node_global", "SELECT COUNT(l_orderkey) AS n, SUM(l_quantity) AS qty FROM lineitem")
def q_agg_node_global(spark, sf_dir):
    from towerlens.plans.nodes import run_step

    cfg = _agg_cfg([], [("l_orderkey", "COUNT", "n", {}), ("l_quantity", "SUM", "qty", {})])
    return run_step("aggregate", cfg, {"data": fx.table(spark, sf_dir, "lineitem")}, spark)


@query("agg_node_identity", "SELECT * FROM nation")
def q_agg_node_identity(spark, sf_dir):
    from towerlens.plans.nodes import run_step

    return run_step("aggregate", {}, {"data": fx.table(spark, sf_dir, "nation")}, spark)


_JOIN_COND = "left.o_custkey = right.c_custkey AND right.c_mktsegment = 'BUILDING'"
_JOIN_SQL = {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "full": "FULL OUTER JOIN"}


def _join_query(how: str):
    def run(spark, sf_dir):
        from towerlens.plans.nodes import run_step

        o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
        c = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
        exprs = ["`left`.o_orderkey", "`left`.o_totalprice"]
        if how not in ("left semi", "left anti"):
            exprs += ["`right`.c_custkey", "`right`.c_mktsegment"]
        return run_step("join", {"join_type": how, "join_conditions": _JOIN_COND, "expressions": exprs},
                         {"left": o, "right": c}, spark)
    return run


for _how, _kw in _JOIN_SQL.items():
    query(f"join_node_{_how}", f"""
SELECT o.o_orderkey, o.o_totalprice, c.c_custkey, c.c_mktsegment
FROM orders o {_kw} customer c ON o.o_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING'""")(_join_query(_how))
query("join_node_left_semi", """
SELECT o.o_orderkey, o.o_totalprice FROM orders o
WHERE EXISTS (SELECT 1 FROM customer c WHERE o.o_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING')""")(
    _join_query("left semi"))
query("join_node_left_anti", """
SELECT o.o_orderkey, o.o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE o.o_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING')""")(
    _join_query("left anti"))


@query("join_node_cross", "SELECT n.n_nationkey, r.r_regionkey FROM nation n CROSS JOIN region r")
def q_join_node_cross(spark, sf_dir):
    from towerlens.plans.nodes import run_step

    return run_step("join", {"join_type": "cross", "join_conditions": "",
                      "expressions": ["`left`.n_nationkey", "`right`.r_regionkey"]},
                     {"left": fx.table(spark, sf_dir, "nation"), "right": fx.table(spark, sf_dir, "region")},
                     spark)


@query("sql_node_params", """
SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS region_text FROM nation
WHERE n_regionkey = 1 AND n_nationkey >= 5""")
def q_sql_node_params(spark, sf_dir):
    from towerlens.plans.nodes import run_step

    q = ("SELECT n_nationkey, n_name, n_regionkey::string AS region_text FROM tl_nation_v "
         "WHERE n_regionkey = :region AND n_nationkey >= :min_key")
    return run_step("sql", {"query": q}, {"tl_nation_v": fx.table(spark, sf_dir, "nation")}, spark,
                    params={"region": 1, "min_key": 5, "unused": 3})


# ==================================================================== expectations (Q1-Q6)
_KPI_RULES_SQL = [("tower_id_not_null", "drop", "tower_id IS NOT NULL"),
                  ("utilization_in_bounds", "drop", "prb_utilization_pct BETWEEN 0 AND 100"),
                  ("latency_positive", "drop", "latency_ms > 0")]


@query("expectation_metrics", with_([fx.RAW_KPIS_SQL], "\nUNION ALL\n".join(
    f"SELECT 'ops_app_bronze_tower_hourly_kpis' AS dataset, '{n}' AS rule, '{a}' AS action, "
    f"COUNT(*) FILTER (WHERE coalesce({p}, false)) AS passed, COUNT(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed "
    f"FROM raw_kpis" for n, a, p in _KPI_RULES_SQL)))
def q_expectation_metrics(spark, sf_dir):
    from towerlens.plans.quality import RULES, expectation_metrics

    return expectation_metrics(fx.raw_kpis(spark, sf_dir), RULES["ops_app_bronze_tower_hourly_kpis"],
                               "ops_app_bronze_tower_hourly_kpis")


@query("expectation_drop", with_([fx.RAW_KPIS_SQL], "SELECT * FROM raw_kpis WHERE " + " AND ".join(
    f"coalesce({p}, false)" for _, _, p in _KPI_RULES_SQL)))
def q_expectation_drop(spark, sf_dir):
    from towerlens.plans.quality import RULES, apply_expectations

    kept, _ = apply_expectations(fx.raw_kpis(spark, sf_dir), RULES["ops_app_bronze_tower_hourly_kpis"])
    return kept


@query("expectation_tower_rules", with_([fx.TOWERS_SQL], "\nUNION ALL\n".join(
    f"SELECT 'silver_tmobile_towers_seattle' AS dataset, '{n}' AS rule, '{a}' AS action, "
    f"COUNT(*) FILTER (WHERE coalesce({p}, false)) AS passed, COUNT(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed "
    f"FROM towers" for n, a, p in [
        ("tmobile_only", "fail", "net = 260"), ("point_geometry", "fail", "true"),
        ("in_seattle_bbox", "drop", "latitude BETWEEN 47.40 AND 47.80 AND longitude BETWEEN -122.50 AND -122.10"),
        ("radius_positive", "warn", "coverage_radius_m IS NULL OR coverage_radius_m > 0")])))
def q_expectation_tower_rules(spark, sf_dir):
    from towerlens.plans.quality import RULES, apply_expectations

    rules = RULES["silver_tmobile_towers_seattle"]
    _, metrics = apply_expectations(fx.towers(spark, sf_dir), rules, "silver_tmobile_towers_seattle")
    return metrics


# ==================================================================== streaming ingest
@query("stream_kpis_once", with_([fx.RAW_KPIS_SQL], "SELECT tower_id, event_ts, prb_utilization_pct, latency_ms, "
                                 "packet_loss_pct, throughput_mbps FROM raw_kpis WHERE " + " AND ".join(
                                     f"coalesce({p}, false)" for _, _, p in _KPI_RULES_SQL)))
def q_stream_kpis_once(spark, sf_dir):
    from towerlens.plans.quality import RULES
    from towerlens.sources.files import KPI_COLUMNS
    from towerlens.streaming.ingest import read_appended, stream_csv_dir, stream_to_table

    root = _csv_folder(spark, "stream-kpis")
    raw = fx.raw_kpis(spark, sf_dir).drop("event_id")
    opts = {"header": "false", "compression": "gzip", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    raw.filter(F.col("event_ts") < F.lit("2024-01-15").cast("timestamp_ntz")).write.options(**opts).csv(f"{root}/in/a")
    raw.filter(F.col("event_ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).write.options(**opts).csv(
        f"{root}/in/b/nested")
    rules = RULES["ops_app_bronze_tower_hourly_kpis"]
    for _ in range(2):      # the second update finds no new files and appends nothing
        sdf = stream_csv_dir(spark, f"{root}/in", KPI_COLUMNS)
        stream_to_table(sdf, f"{root}/table", f"{root}/checkpoint", rules)
    return read_appended(spark, f"{root}/table").withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


# ==================================================================== signal analysis
_SIG_CTES = [fx.BUILDINGS_SQL, fx.TOWERS_SQL, fx.CELLS_SQL, f"""bc AS (
  SELECT building_id, {cell_sql('centroid_lon', 'centroid_lat')} AS h3_res9_id, a * {lit(_AREA_K)} AS a
  FROM (SELECT building_id, {ring5_centroid_select('_v')}, {_area_sql('_v')} AS a
        FROM (SELECT *, {coords_sql('geometry')} AS _v FROM buildings)))""", """density AS (
  SELECT h3_res9_id, COUNT(DISTINCT building_id) AS buildings_in_hex, AVG(a) AS avg_a, SUM(a) AS sum_a
  FROM bc GROUP BY h3_res9_id)""", f"""tc AS (
  SELECT {cell_sql('longitude', 'latitude')} AS h3_res9_id, COUNT(DISTINCT tower_id) AS towers_in_hex
  FROM towers GROUP BY 1)""", f"""sig AS (
  SELECT c.h3_res9_id, c.fid, c.mindown AS download_speed_mbps, c.minup AS upload_speed_mbps,
         COALESCE(d.buildings_in_hex, 0) AS building_count,
         {sround('COALESCE(d.avg_a, 0e0)', 3)} AS avg_building_area_sqm,
         {sround('COALESCE(d.sum_a, 0e0)', 3)} AS total_building_area_sqm,
         COALESCE(t.towers_in_hex, 0) AS tower_count,
         {sround('least(100e0, greatest(0e0, 50e0 + 20e0 * COALESCE(t.towers_in_hex, 0) + c.mindown / 10e0 - 0.5e0 * COALESCE(d.buildings_in_hex, 0)))', 1)} AS estimated_signal_quality
  FROM coverage_cells c LEFT JOIN density d ON c.h3_res9_id = d.h3_res9_id
  LEFT JOIN tc t ON c.h3_res9_id = t.h3_res9_id)"""]


def _signal(spark, sf_dir):
    return pl.signal_analysis(fx.coverage_cells(spark, sf_dir), fx.buildings(spark, sf_dir), fx.towers(spark, sf_dir))


@query("signal_analysis", with_(_SIG_CTES, "SELECT * FROM sig"))
def q_signal_analysis(spark, sf_dir):
    return _signal(spark, sf_dir)


@query("signal_distribution", with_(_SIG_CTES, f"""
SELECT CASE WHEN estimated_signal_quality >= 80 THEN 'Excellent (80-100)' WHEN estimated_signal_quality >= 60
            THEN 'Good (60-79)' WHEN estimated_signal_quality >= 40 THEN 'Fair (40-59)' ELSE 'Poor (0-39)' END
         AS signal_quality_category,
       COUNT(*) AS hex_count, {sround('AVG(download_speed_mbps)', 1)} AS avg_download_mbps,
       {sround('AVG(building_count)', 1)} AS avg_buildings_per_hex
FROM sig GROUP BY 1"""))
def q_signal_distribution(spark, sf_dir):
    return pl.signal_distribution(_signal(spark, sf_dir))


@query("signal_summary", with_(_SIG_CTES, f"""
SELECT COUNT(*) AS total_hexagons, {sround('AVG(download_speed_mbps)', 1)} AS avg_download_mbps,
       {sround('AVG(upload_speed_mbps)', 1)} AS avg_upload_mbps, SUM(building_count) AS total_buildings_covered,
       {sround('AVG(estimated_signal_quality)', 1)} AS avg_signal_quality,
       {sround('MIN(estimated_signal_quality)', 1)} AS min_signal_quality,
       {sround('MAX(estimated_signal_quality)', 1)} AS max_signal_quality
FROM sig"""))
def q_signal_summary(spark, sf_dir):
    return pl.signal_summary(_signal(spark, sf_dir))


# ==================================================================== enriched buildings
AB = pl.ANALYSIS_BOX
_ENR_CTES = [fx.BUILDINGS_SQL, BLD_CTE, fx.TOWERS_SQL, fx.CELLS_SQL, f"""db AS (
  SELECT building_id, height, centroid_lat, centroid_lon, {cell_sql('centroid_lon', 'centroid_lat')} AS h3_res9_id
  FROM bld WHERE centroid_lat BETWEEN {lit(AB.lat_min)} AND {lit(AB.lat_max)}
    AND centroid_lon BETWEEN {lit(AB.lon_min)} AND {lit(AB.lon_max)})""",
             _ranked_sql("db b", "b.building_id", "b.centroid_lon", "b.centroid_lat", "t.cell_id AS nearest_tower_cell_id,"),
             f"""enr AS (
  SELECT b.building_id, b.height, b.centroid_lat, b.centroid_lon, b.h3_res9_id, c.fid, c.technology,
         c.mindown AS min_download_mbps, c.minup AS min_upload_mbps, c.environmnt AS environment_type,
         CASE WHEN c.technology IS NULL THEN 'No Coverage' WHEN c.mindown >= 35 THEN 'Strong (35+ Mbps)'
              WHEN c.mindown >= 7 THEN 'Moderate (7+ Mbps)' ELSE 'Weak' END AS coverage_quality,
         r.nearest_tower_id, r.nearest_tower_type AS nearest_tower_radio, r.nearest_tower_cell_id,
         {sround('r.d', 1)} AS nearest_tower_distance_m,
         CASE WHEN r.d < 200 THEN 'Very Close (<200m)' WHEN r.d < 500 THEN 'Close (200-500m)'
              WHEN r.d < 1000 THEN 'Moderate (500m-1km)' ELSE 'Far (>1km)' END AS tower_proximity_band
  FROM db b LEFT JOIN coverage_cells c ON b.h3_res9_id = c.h3_res9_id
  JOIN ranked r ON b.building_id = r.building_id AND r.rn = 1)"""]


def _enriched(spark, sf_dir):
    return pl.enriched_buildings(fx.buildings(spark, sf_dir), fx.coverage_cells(spark, sf_dir), fx.towers(spark, sf_dir))


def _enriched_summary(spark, sf_dir, *args):
    classes = pl.enriched_classes(fx.buildings(spark, sf_dir), fx.coverage_cells(spark, sf_dir), fx.towers(spark, sf_dir))
    return pl.class_summary(classes, *args, rows="rows")


@query("enriched_buildings", with_(_ENR_CTES, "SELECT * FROM enr"))
def q_enriched_buildings(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query("quality_distribution", with_(_ENR_CTES, f"""
SELECT coverage_quality, COUNT(*) AS buildings, {sround('AVG(nearest_tower_distance_m)', 0)} AS avg_tower_dist_m
FROM enr GROUP BY coverage_quality"""))
def q_quality_distribution(spark, sf_dir):
    return _enriched_summary(spark, sf_dir, "coverage_quality", "nearest_tower_distance_m", "avg_tower_dist_m", 0)


@query("proximity_distribution", with_(_ENR_CTES, f"""
SELECT tower_proximity_band, COUNT(*) AS buildings, {sround('AVG(min_download_mbps)', 1)} AS avg_download_mbps
FROM enr GROUP BY tower_proximity_band"""))
def q_proximity_distribution(spark, sf_dir):
    return _enriched_summary(spark, sf_dir, "tower_proximity_band", "min_download_mbps", "avg_download_mbps")


@query("quality_by_proximity", with_(_ENR_CTES, f"""
SELECT coverage_quality, tower_proximity_band, COUNT(*) AS buildings, {sround('AVG(min_download_mbps)', 1)} AS avg_download_mbps
FROM enr GROUP BY coverage_quality, tower_proximity_band"""))
def q_quality_by_proximity(spark, sf_dir):
    return _enriched_summary(spark, sf_dir, ["coverage_quality", "tower_proximity_band"], "min_download_mbps", "avg_download_mbps")


@query("time_of_day", """
SELECT event_id, date_trunc('hour', ts) AS hour_start, hour(ts) AS hour_of_day, isodow(ts) - 1 AS weekday,
       CASE WHEN hour(ts) BETWEEN 18 AND 23 THEN 'video_heavy' WHEN hour(ts) BETWEEN 7 AND 9 THEN 'commute' ELSE 'balanced' END AS traffic_mix,
       CASE WHEN hour(ts) BETWEEN 7 AND 10 THEN 2.2e0 WHEN hour(ts) BETWEEN 16 AND 20 THEN 2.6e0 WHEN hour(ts) BETWEEN 0 AND 5 THEN 0.45e0
            ELSE 1e0 END * CASE WHEN isodow(ts) >= 6 THEN 0.7e0 ELSE 1e0 END AS hour_weight,
       least(20e0, greatest(5e0, value)) AS clipped
FROM events""")
def q_time_of_day(spark, sf_dir):
    from towerlens.functions import bands as B

    return fx.table(spark, sf_dir, "events").select(
        "event_id", B.hour_floor("ts").alias("hour_start"), F.hour("ts").alias("hour_of_day"), F.weekday("ts").alias("weekday"),
        B.traffic_mix("ts").alias("traffic_mix"), B.hour_weight("ts").alias("hour_weight"), B.clip("value", 5.0, 20.0).alias("clipped"))


def _csv_folder(spark, name):
    from towerlens.session import run_folder

    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


_CSV_ORDERS = "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders"


@query("csv_headerless", _CSV_ORDERS)
def q_csv_headerless(spark, sf_dir):
    from towerlens.sources.files import read_headerless_csv, write_shard

    path = _csv_folder(spark, "orders-shards")
    write_shard(fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    return read_headerless_csv(spark, path, [("o_orderkey", "bigint"), ("o_totalprice", "double"), ("o_orderpriority", "string")], glob="*.csv.gz")


@query("csv_declared", _CSV_ORDERS)
def q_csv_declared(spark, sf_dir):
    from towerlens.sources.files import read_csv_schema

    path = _csv_folder(spark, "orders-csv")
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    rows.write.option("header", "true").csv(path)
    return read_csv_schema(spark, path, rows.schema, header=True)


@query("csv_inferred", _CSV_ORDERS)
def q_csv_inferred(spark, sf_dir):
    from towerlens.sources.files import read_csv_infer

    path = _csv_folder(spark, "orders-csv")
    fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority").write.option("header", "true").csv(path)
    return read_csv_infer(spark, path).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


# ==================================================================== tower exploration
_OCID_CTE = """ocid AS (
  SELECT CASE (s_suppkey * 4 + j) % 4 WHEN 0 THEN 'LTE' WHEN 1 THEN 'NR' WHEN 2 THEN 'GSM' ELSE 'UMTS' END AS radio,
         CASE WHEN (s_suppkey * 4 + j) % 50 = 0 THEN 302 ELSE 310 END AS mcc,
         CASE j WHEN 0 THEN 260 WHEN 1 THEN 410 WHEN 2 THEN 120 ELSE 480 END AS net,
         CAST(10000 + (s_suppkey * 4 + j) % 97 AS INTEGER) AS area,
         1000000 + (s_suppkey * 4 + j) * 13 AS cell,
         CAST(200 + 100 * ((s_suppkey * 4 + j) % 20) AS INTEGER) AS range_m,
         CAST(1 + ((s_suppkey * 4 + j) * 7) % 50 AS INTEGER) AS samples
  FROM supplier CROSS JOIN range(4) AS r(j))"""


def _ocid(spark, sf_dir):
    from towerlens.sources.files import TOWER_COLUMNS, typed

    rows = fx.opencellid_rows(spark, sf_dir)
    return rows.select(*typed(TOWER_COLUMNS, source_cols=rows.columns))


@query("carrier_towers", f"""
SELECT CASE kk % 4 WHEN 0 THEN 'LTE' WHEN 1 THEN 'NR' WHEN 2 THEN 'GSM' ELSE 'UMTS' END AS radio, 260 AS net, 1000000 + kk * 13 AS cell
FROM (SELECT s_suppkey * 4 AS kk FROM supplier)
WHERE {fx.loc_lat_sql('kk + 13')} BETWEEN {pl.METRO.lat_min!r} AND {pl.METRO.lat_max!r}
  AND {fx.loc_lon_sql('kk + 13')} BETWEEN {pl.METRO.lon_min!r} AND {pl.METRO.lon_max!r}""")
def q_carrier_towers(spark, sf_dir):
    return pl.carrier_towers(_ocid(spark, sf_dir), box=pl.METRO).select("radio", "net", "cell")


@query("carrier_breakdown", with_([_OCID_CTE], f"""
SELECT radio, net, COUNT(*) AS record_count, COUNT(DISTINCT cell) AS unique_cell_ids,
       {sround('AVG(range_m)', 0)} AS avg_range_m, {sround('AVG(samples)', 1)} AS avg_samples
FROM ocid GROUP BY radio, net"""))
def q_carrier_breakdown(spark, sf_dir):
    return pl.carrier_breakdown(_ocid(spark, sf_dir))


@query("top_towers", with_([_OCID_CTE], """
SELECT radio, net AS mnc, CASE net WHEN 260 THEN 'T-Mobile' WHEN 410 THEN 'AT&T' ELSE 'MNC-' || CAST(net AS VARCHAR) END AS carrier,
       area AS lac_tac, cell AS cell_id, range_m, samples
FROM ocid ORDER BY samples DESC, cell LIMIT 20"""))
def q_top_towers(spark, sf_dir):
    return pl.top_towers(_ocid(spark, sf_dir), 20).drop("lon", "lat", "created_ts", "updated_ts")


@query("sample_n", with_([fx.BUILDINGS_SQL], "SELECT * FROM buildings ORDER BY md5('7|' || CAST(building_id AS VARCHAR)) LIMIT 100"))
def q_sample_n(spark, sf_dir):
    return pl.sample_n(fx.buildings(spark, sf_dir), 100, seed=7, key_cols=["building_id"])


# ==================================================================== transcripts
_TRANSCRIPT_CTE = r"""tr AS (
  SELECT conv_id, COUNT(*) AS turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript
  FROM conversations GROUP BY conv_id),
trw AS (
  SELECT *, list_filter(string_split(lower(regexp_replace(transcript, '[^\p{L}\p{N}'']+', ' ', 'g')), ' '),
                        lambda w: w <> '') AS ws,
         list_filter(regexp_split_to_array(trim(regexp_extract(transcript, '^\s*([^.!?\n]*[.!?]?)', 1), ' '), '\s+'),
                     lambda w: w <> '') AS sw
  FROM tr)"""


def _lex_sql(words):
    return "[" + ", ".join("'" + w + "'" for w in sorted(set(words))) + "]"


@query("transcript_enrichment")
def q_transcript_enrichment(spark, sf_dir):
    from towerlens.plans.flows import transcript_flow
    from towerlens.plans.nodes import run_flow
    from towerlens.functions.sql import register_sql_functions

    register_sql_functions(spark)
    name = f"tl_transcripts_{abs(hash(sf_dir)) % 10**8}"
    fx.transcripts(spark, sf_dir).createOrReplaceTempView(name)
    return run_flow(transcript_flow(name), spark)["scored.enriched_data"]


def _transcript_oracle():
    from towerlens.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS

    pos, neg = _lex_sql(POSITIVE_WORDS), _lex_sql(NEGATIVE_WORDS)
    p = f"len(list_filter(ws, lambda w: list_contains({pos}, w)))"
    n = f"len(list_filter(ws, lambda w: list_contains({neg}, w)))"
    return with_([_TRANSCRIPT_CTE], f"""
SELECT array_to_string(sw[1:10], ' ') AS transcript_summary,
       CASE WHEN {p} > 0 AND {n} > 0 THEN 'mixed' WHEN {p} > 0 THEN 'positive' WHEN {n} > 0 THEN 'negative'
            ELSE 'neutral' END AS sentiment,
       conv_id, turns, transcript
FROM trw""")


ORACLE["transcript_enrichment"] = _transcript_oracle()


# ==================================================================== sample questions
@query("n1_covered_buildings", with_(GOLD_CTES, "SELECT COUNT(*) AS buildings FROM gold WHERE best_download_mbps > 0"))
def q_n1(spark, sf_dir):
    return gold(spark, sf_dir).filter(F.col("best_download_mbps") > 0).agg(F.count(F.lit(1)).alias("buildings"))


@query("n2_download_by_bucket", with_(GOLD_CTES, f"""
SELECT {_BUCKET_SQL} AS distance_bucket, {sround('AVG(best_download_mbps)', 1)} AS avg_download_mbps
FROM gold WHERE best_download_mbps > 0 GROUP BY 1"""))
def q_n2(spark, sf_dir):
    return q_coverage_by_distance(spark, sf_dir).select("distance_bucket", "avg_download_mbps").orderBy("distance_bucket")


@query("n3_closest_buildings", with_(GOLD_CTES, """
SELECT building_id, nearest_tower_id, distance_to_tower_m FROM gold
ORDER BY distance_to_tower_m, building_id LIMIT 10"""))
def q_n3(spark, sf_dir):
    return (gold(spark, sf_dir).select("building_id", "nearest_tower_id", "distance_to_tower_m")
            .orderBy("distance_to_tower_m", "building_id").limit(10))


@query("n4_top_provider_cell", with_([fx.CELLS_SQL], """
SELECT h3_res9_id, COUNT(DISTINCT fid) AS providers FROM coverage_cells
GROUP BY h3_res9_id ORDER BY providers DESC, h3_res9_id LIMIT 1"""))
def q_n4(spark, sf_dir):
    c = fx.coverage_cells(spark, sf_dir)
    return (c.groupBy("h3_res9_id").agg(F.count_distinct("fid").alias("providers"))
            .orderBy(F.desc("providers"), "h3_res9_id").limit(1))


@query("n5_speed_vs_distance", with_(GOLD_CTES, "SELECT building_id, best_download_mbps, distance_to_tower_m FROM gold"))
def q_n5(spark, sf_dir):
    return gold(spark, sf_dir).select("building_id", "best_download_mbps", "distance_to_tower_m")


@query("n6_avg_download", with_(GOLD_CTES, f"SELECT {sround('AVG(best_download_mbps)', 2)} AS avg_best_download_mbps FROM gold"))
def q_n6(spark, sf_dir):
    return gold(spark, sf_dir).agg(F.round(F.avg("best_download_mbps"), 2).alias("avg_best_download_mbps"))


@query("n7_uncovered_near_tower", with_(GOLD_CTES, """
SELECT building_id, nearest_tower_id, distance_to_tower_m FROM gold WHERE best_download_mbps = 0
ORDER BY distance_to_tower_m, building_id LIMIT 1"""))
def q_n7(spark, sf_dir):
    return (gold(spark, sf_dir).filter(F.col("best_download_mbps") == 0)
            .select("building_id", "nearest_tower_id", "distance_to_tower_m")
            .orderBy("distance_to_tower_m", "building_id").limit(1))


@query("n8_worst_bucket", with_(GOLD_CTES, f"""
SELECT distance_bucket, avg_download_mbps FROM (
  SELECT {_BUCKET_SQL} AS distance_bucket, {sround('AVG(best_download_mbps)', 1)} AS avg_download_mbps
  FROM gold WHERE best_download_mbps > 0 GROUP BY 1)
ORDER BY avg_download_mbps, distance_bucket LIMIT 1"""))
def q_n8(spark, sf_dir):
    return (q_coverage_by_distance(spark, sf_dir).select("distance_bucket", "avg_download_mbps")
            .orderBy("avg_download_mbps", "distance_bucket").limit(1))


@query("n9_fast_cells", with_([fx.CELLS_SQL], """
SELECT COUNT(DISTINCT h3_res9_id) AS cells FROM coverage_cells WHERE mindown >= 100"""))
def q_n9(spark, sf_dir):
    return (fx.coverage_cells(spark, sf_dir).filter(F.col("mindown") >= 100)
            .agg(F.count_distinct("h3_res9_id").alias("cells")))


# ==================================================================== map feeds (L12), profiles
@query("map_points", with_(GOLD_CTES, """
SELECT building_id, centroid_lat, centroid_lon, best_download_mbps AS weight,
       CASE WHEN best_download_mbps >= 100 THEN 'green' WHEN best_download_mbps >= 35 THEN 'orange' ELSE 'red' END AS color
FROM gold WHERE best_download_mbps > 0"""))
def q_map_points(spark, sf_dir):
    return pl.map_points(gold(spark, sf_dir))


_MAPBOX = CORE.pad(0.01)


@query("map_towers", with_([fx.TOWERS_SQL], f"""
SELECT tower_id, tower_type, latitude, longitude, coverage_radius_m FROM towers
WHERE latitude BETWEEN {lit(_MAPBOX.lat_min)} AND {lit(_MAPBOX.lat_max)}
  AND longitude BETWEEN {lit(_MAPBOX.lon_min)} AND {lit(_MAPBOX.lon_max)}"""))
def q_map_towers(spark, sf_dir):
    return pl.map_towers(fx.towers(spark, sf_dir), CORE, 0.01)


@query("table_summary", """
SELECT 'buildings' AS table_name, COUNT(*) AS rows, 3 AS n_cols, 'building_id, height, geometry' AS columns FROM customer
UNION ALL
SELECT 'coverage_cells', COUNT(*), 6, 'fid, technology, mindown, minup, environmnt, h3_res9_id' FROM part
UNION ALL
SELECT 'missing_table', NULL, NULL, NULL""")
def q_table_summary(spark, sf_dir):
    from towerlens.sources.tables import table_summary

    return table_summary(spark, {"buildings": fx.buildings(spark, sf_dir),
                                 "coverage_cells": fx.coverage_cells(spark, sf_dir),
                                 "missing_table": "tl_no_such_table_here"})


@query("describe_heights", with_([fx.BUILDINGS_SQL], """
SELECT MIN(height) AS min, quantile_cont(height, 0.5) AS median, MAX(height) AS max,
       quantile_cont(height, 0.05) AS p05, quantile_cont(height, 0.95) AS p95, SUM(height) AS sum FROM buildings"""))
def q_describe_heights(spark, sf_dir):
    return pl.describe_numeric(fx.buildings(spark, sf_dir), "height")


@query("value_counts_tower_type", with_([fx.TOWERS_SQL], "SELECT tower_type, COUNT(*) AS count FROM towers GROUP BY 1"))
def q_value_counts(spark, sf_dir):
    return pl.value_counts(fx.towers(spark, sf_dir), "tower_type")


# ==================================================================== H3 ids and cell geometry
_H3_BASE = 617700169958293503          # 8928308280fffff, a valid resolution-9 id
_H3_DIGIT9_MASK = 7 << 18


@query("h3_checks", f"""
SELECT p_partkey, printf('%x', h) AS h3_id,
       NOT (p_partkey % 8 = 7 OR p_partkey % 9 = 0) AS is_valid,
       CAST((h >> 52) & 15 AS INTEGER) AS resolution, h AS h3_long
FROM (SELECT p_partkey,
             CASE WHEN p_partkey % 9 = 0 THEN xor((({_H3_BASE} & ~{_H3_DIGIT9_MASK}) | ((p_partkey % 8) << 18)), {3 << 59})
                  ELSE (({_H3_BASE} & ~{_H3_DIGIT9_MASK}) | ((p_partkey % 8) << 18)) END AS h
      FROM part)""")
def q_h3_checks(spark, sf_dir):
    from towerlens.functions.cells import h3_is_valid_string, h3_long_to_string, h3_resolution, h3_string_to_long

    k = F.col("p_partkey")
    h = F.lit(_H3_BASE).bitwiseAND(F.lit(~_H3_DIGIT9_MASK)).bitwiseOR(F.shiftleft(k % 8, 18))
    h = F.when(k % 9 == 0, h.bitwiseXOR(F.lit(3 << 59))).otherwise(h)
    p = fx.table(spark, sf_dir, "part").select("p_partkey", h.alias("_h"))
    s = p.select("p_partkey", h3_long_to_string("_h").alias("h3_id"))
    return s.select("p_partkey", "h3_id", h3_is_valid_string("h3_id").alias("is_valid"),
                    h3_resolution(h3_string_to_long("h3_id")).alias("resolution"),
                    h3_string_to_long("h3_id").alias("h3_long"))


def _center_sql(key: str) -> tuple[str, str]:
    import math as _m

    from towerlens.functions.cells import APERTURE, RES9_EDGE_M

    kx = G.EARTH_RADIUS_M * G.DEG2RAD * _m.cos(_m.radians(47.6))
    ky = G.EARTH_RADIUS_M * G.DEG2RAD
    s = f"({lit(RES9_EDGE_M)} * pow({lit(_m.sqrt(APERTURE))}, 9 - CAST(split_part({key}, ':', 1) AS INTEGER)))"
    q = f"CAST(split_part({key}, ':', 2) AS DOUBLE)"
    r = f"CAST(split_part({key}, ':', 3) AS DOUBLE)"
    x = f"({s} * ({lit(_m.sqrt(3.0))} * {q} + {lit(_m.sqrt(3.0) / 2.0)} * {r}) / {lit(kx)})"
    y = f"({s} * 1.5e0 * {r} / {lit(ky)})"
    return x, y


_CX, _CY = _center_sql("h3_res9_id")


@query("cell_centers", with_([fx.CELLS_SQL], f"""
SELECT DISTINCT h3_res9_id, {sround(_CX, 9)} AS center_lon, {sround(_CY, 9)} AS center_lat,
       {cell_sql(_CX, _CY)} = h3_res9_id AS center_in_cell
FROM coverage_cells"""))
def q_cell_centers(spark, sf_dir):
    from towerlens.functions.cells import cell_center

    c = fx.coverage_cells(spark, sf_dir).select("h3_res9_id").distinct()
    c = G.materialize(c, _c=cell_center("h3_res9_id"))
    return c.select("h3_res9_id", F.round("_c.x", 9).alias("center_lon"), F.round("_c.y", 9).alias("center_lat"),
                    (cell_id(F.col("_c.x"), F.col("_c.y")) == F.col("h3_res9_id")).alias("center_in_cell"))


# ==================================================================== simplification (G19), coordinate fallback
@query("simplify_midpoints", with_([fx.MARKETS_SQL], "SELECT ID, 9 AS points_before, 5 AS points_after FROM markets_bronze"))
def q_simplify_midpoints(spark, sf_dir):
    from towerlens.operators.simplify import simplify

    m = fx.markets_bronze(spark, sf_dir).select("ID", G.materialize_ring_midpoints("geometry_wkt").alias("geometry_wkt"))
    points = lambda c: F.size(F.split(c, ","))
    both = simplify(m, "geometry_wkt", 0.001, out_col="simple")
    return both.select("ID", points("geometry_wkt").alias("points_before"), points("simple").alias("points_after"))


@query("simplify_markets", with_([fx.MARKETS_SQL], "SELECT ID, geometry_wkt FROM markets_bronze"))
def q_simplify_markets(spark, sf_dir):
    from towerlens.operators.simplify import simplify

    return simplify(fx.markets_bronze(spark, sf_dir).select("ID", "geometry_wkt"), "geometry_wkt", 0.001)


_SITES_RING_CTE = """sites AS (
  SELECT site_id, COALESCE(SITE_LATITUDE, RING_LATITUDE) AS SITE_LATITUDE,
         COALESCE(SITE_LONGITUDE, RING_LONGITUDE) AS SITE_LONGITUDE,
         COALESCE(SITE_LATITUDE, RING_LATITUDE) AS S_SITE_LATITUDE,
         COALESCE(SITE_LONGITUDE, RING_LONGITUDE) AS S_SITE_LONGITUDE
  FROM sites_bronze)"""


@query("site_market_coalesced", with_([fx.SITES_SQL, _SITES_RING_CTE, fx.MARKETS_SQL, MARKETS_CTE],
                                      "SELECT * FROM enriched"))
def q_site_market_coalesced(spark, sf_dir):
    return pl.match_sites(fx.sites_bronze(spark, sf_dir), fx.markets_bronze(spark, sf_dir), coalesce_ring=True)



# ==================================================================== scalable transcript features (L9, per turn)
def _conversation_oracle():
    from towerlens.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS

    pos, neg = _lex_sql(POSITIVE_WORDS), _lex_sql(NEGATIVE_WORDS)
    return rf"""
WITH per AS (SELECT conv_id, turn, role || ': ' || text AS line FROM conversations),
pw AS (
  SELECT conv_id, turn,
         array_to_string(list_filter(regexp_split_to_array(trim(regexp_extract(line, '^\s*([^.!?\n]*[.!?]?)', 1), ' '), '\s+'),
                                     lambda w: w <> '')[1:10], ' ') AS s,
         list_filter(string_split(lower(regexp_replace(line, '[^\p{{L}}\p{{N}}'']+', ' ', 'g')), ' '), lambda w: w <> '') AS ws
  FROM per),
agg AS (
  SELECT conv_id, COUNT(*) AS turns, arg_min(s, turn) AS transcript_summary,
         SUM(len(list_filter(ws, lambda w: list_contains({pos}, w)))) AS p,
         SUM(len(list_filter(ws, lambda w: list_contains({neg}, w)))) AS n
  FROM pw GROUP BY conv_id)
SELECT conv_id, turns, transcript_summary,
       CASE WHEN p > 0 AND n > 0 THEN 'mixed' WHEN p > 0 THEN 'positive' WHEN n > 0 THEN 'negative'
            ELSE 'neutral' END AS sentiment
FROM agg"""


@query("conversation_features", _conversation_oracle())
def q_conversation_features(spark, sf_dir):
    return pl.conversation_features(fx.table(spark, sf_dir, "conversations"))


# ==================================================================== medallion chain (K7, P3, P7-P9, P12) and its feeds
_OCID_TOWERS = f"""towers AS (
  SELECT 1000000 + kk * 13 AS tower_id, 'T-Mobile' AS carrier,
         CASE kk % 4 WHEN 0 THEN 'LTE' WHEN 1 THEN 'NR' WHEN 2 THEN 'GSM' ELSE 'UMTS' END AS tower_type,
         CAST(10000 + kk % 97 AS INTEGER) AS lac_tac, 1000000 + kk * 13 AS cell_id,
         CAST(200 + 100 * (kk % 20) AS INTEGER) AS coverage_radius_m, CAST(1 + (kk * 7) % 50 AS INTEGER) AS samples,
         {fx.loc_lat_sql('kk + 13')} AS latitude, {fx.loc_lon_sql('kk + 13')} AS longitude
  FROM (SELECT s_suppkey * 4 AS kk FROM supplier) WHERE kk % 50 <> 0)"""


def _in_metro_sql(lat: str, lon: str) -> str:
    return (f"{lat} BETWEEN {lit(METRO.lat_min)} AND {lit(METRO.lat_max)} AND {lon} BETWEEN {lit(METRO.lon_min)} AND {lit(METRO.lon_max)}")


def _dataset(spark, sf_dir, name):
    """Build one dataset of the chain, and all it needs, below the shared folder."""
    from towerlens.plans.datasets import run_datasets
    from towerlens.plans.medallion import coverage_registry

    root = _csv_folder(spark, "coverage")
    bronze = {
        "bronze_fcc_bdc_h3": lambda s: fx.coverage_cells(s, sf_dir),
        "bronze_building_footprints": lambda s: fx.buildings(s, sf_dir).withColumnRenamed("geometry", "wkt"),
        "bronze_cell_towers": lambda s: _ocid(s, sf_dir),
        "ops_app_bronze_tower_hourly_kpis": lambda s: _fed(s, sf_dir, "kpis"),
        "ops_app_bronze_building_hourly_demand": lambda s: _fed(s, sf_dir, "demand"),
    }
    run_datasets(spark, coverage_registry(bronze), names=[name], path_of=lambda n: f"{root}/{n}")
    return spark.read.parquet(f"{root}/{name}")


def _fed(spark, sf_dir, feed: str) -> DataFrame:
    """A bronze table filled from gzip shards by one triggered update; a second update finds nothing new."""
    from towerlens.plans.quality import RULES
    from towerlens.sources.files import DEMAND_COLUMNS, KPI_COLUMNS, TOWER_COLUMNS
    from towerlens.streaming.ingest import read_appended, stream_csv_dir, stream_to_table

    columns, rules, rows = {
        "kpis": (KPI_COLUMNS, "ops_app_bronze_tower_hourly_kpis", lambda: fx.raw_kpis(spark, sf_dir).drop("event_id")),
        "demand": (DEMAND_COLUMNS, "ops_app_bronze_building_hourly_demand", lambda: fx.building_demand(spark, sf_dir).drop("order_key")),
        "towers": (TOWER_COLUMNS, "bronze_cell_towers", lambda: fx.opencellid_rows(spark, sf_dir)),
    }[feed]
    root = _csv_folder(spark, feed)
    options = {"header": "false", "compression": "gzip", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    rows().write.options(**options).csv(f"{root}/in/shards")
    for _ in range(2):
        stream_to_table(stream_csv_dir(spark, f"{root}/in", columns), f"{root}/table", f"{root}/checkpoint", RULES[rules])
    return read_appended(spark, f"{root}/table")


@query("silver_towers", with_([_OCID_TOWERS], f"""
SELECT tower_id, carrier, tower_type, lac_tac, cell_id, coverage_radius_m, samples, latitude, longitude FROM towers
WHERE {_in_metro_sql('latitude', 'longitude')}"""))
def q_silver_towers(spark, sf_dir):
    return _dataset(spark, sf_dir, "silver_tmobile_towers_seattle").select(
        "tower_id", "carrier", "tower_type", "lac_tac", "cell_id", "coverage_radius_m", "samples", "latitude", "longitude")


@query("silver_buildings", with_([fx.BUILDINGS_SQL, BLD_CTE], f"""
SELECT building_id, height, geometry, centroid_lon, centroid_lat, {cell_sql('centroid_lon', 'centroid_lat')} AS h3_res9_id
FROM bld WHERE {_in_metro_sql('centroid_lat', 'centroid_lon')}"""))
def q_silver_buildings(spark, sf_dir):
    return _dataset(spark, sf_dir, "silver_building_footprints_seattle")


@query("silver_cells", with_([fx.CELLS_SQL], f"""
SELECT fid, technology, mindown, minup, environmnt, h3_res9_id FROM coverage_cells WHERE {_in_metro_sql(_CY, _CX)}"""))
def q_silver_cells(spark, sf_dir):
    return _dataset(spark, sf_dir, "silver_fcc_bdc_h3_seattle").drop("center_lat", "center_lon")


_CHAIN_CTES = [_OCID_TOWERS if c is fx.TOWERS_SQL else c for c in GOLD_CTES]


@query("pipeline_gold", with_(_CHAIN_CTES, f"""
SELECT {_BUCKET_SQL} AS distance_bucket, COUNT(*) AS buildings,
       {sround('AVG(best_download_mbps)', 1)} AS avg_download_mbps, {sround('AVG(best_upload_mbps)', 1)} AS avg_upload_mbps,
       {sround('AVG(distance_to_tower_m)', 0)} AS avg_distance_m, {sround('AVG(provider_count)', 1)} AS avg_providers
FROM gold WHERE best_download_mbps > 0 GROUP BY 1"""))
def q_pipeline_gold(spark, sf_dir):
    return _dataset(spark, sf_dir, "gold_coverage_by_distance_bucket")


@query("stream_towers_once", with_([_OCID_CTE], "SELECT radio, mcc, net, area, cell, range_m, samples FROM ocid WHERE mcc = 310"))
def q_stream_towers_once(spark, sf_dir):
    return _fed(spark, sf_dir, "towers").select("radio", "mcc", "net", "area", "cell", "range_m", "samples")


_DEMAND_OK = "building_id IS NOT NULL AND demand_users >= 0 AND indoor_penetration_factor BETWEEN 0.4e0 AND 1e0"


@query("stream_demand_once", with_([fx.DEMAND_SQL], f"""
SELECT building_id, CAST(event_ts AS TIMESTAMP) AS event_ts, demand_users, traffic_mix, indoor_penetration_factor
FROM building_demand WHERE {_DEMAND_OK}"""))
def q_stream_demand_once(spark, sf_dir):
    return _fed(spark, sf_dir, "demand").withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query("overlay_from_stream", with_([*_CHAIN_CTES, fx.DEMAND_SQL, fx.RAW_KPIS_SQL, f"""d AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY building_id
    ORDER BY event_ts DESC, demand_users DESC, traffic_mix DESC, indoor_penetration_factor DESC) AS rn FROM building_demand WHERE {_DEMAND_OK})
  WHERE rn = 1)""", """k AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tower_id ORDER BY event_ts DESC, prb_utilization_pct DESC, latency_ms DESC) AS rn
    FROM raw_kpis WHERE """ + " AND ".join(f"coalesce({p}, false)" for _, _, p in _KPI_RULES_SQL) + """) WHERE rn = 1
    AND packet_loss_pct BETWEEN 0 AND 100 AND throughput_mbps >= 0)"""], """
SELECT g.building_id, g.nearest_tower_id, d.demand_users, d.traffic_mix, k.prb_utilization_pct, k.latency_ms
FROM gold g LEFT JOIN d USING (building_id) LEFT JOIN k ON k.tower_id = g.nearest_tower_id"""))
def q_overlay_from_stream(spark, sf_dir):
    return _dataset(spark, sf_dir, "ops_app_gold_downtown_building_coverage").select(
        "building_id", "nearest_tower_id", "demand_users", "traffic_mix", "prb_utilization_pct", "latency_ms")


from towerlens import queries_geometry, queries_storage  # noqa: E402,F401  (they register their queries here)
