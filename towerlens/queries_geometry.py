"""Registered queries on polygons of many vertices, cells in polygons, sketches and the last open figures.
Part of the registry in ``towerlens.queries``."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from towerlens.functions import geo as G
from towerlens.functions.cells import cell_boundary_wkt, cell_center, plane_constants
from towerlens.oracle import cell_sql, haversine_sql, sround
from towerlens.plans import fixtures as fx
from towerlens.plans import pipelines as pl
from towerlens.queries import (_CX, _CY, _OCID_CTE, ALLB_CTES, BLD_CTE, BDC_CTE, SITE_CTES, _csv_folder, _ranked_sql, _sites_markets, all_buildings, lit, query, with_)

_H = fx.MARKET_HALF_DIAGONAL


def _ring_wkt(x, y, n: Column) -> Column:
    """Outline text of a ring of ``n`` vertices and the first again; ``x`` and ``y`` map a vertex's number to a place."""
    return F.array_join(F.transform(F.sequence(F.lit(0), n), lambda i: F.concat(x(i % n).cast("string"), F.lit(" "), y(i % n).cast("string"))), ", ")


def _fine_markets(spark, sf_dir):
    """Market diamonds with many vertices on their sides: 100,000 for market 12, 2,000 for the others."""
    k = F.col("n_nationkey").cast("bigint")
    cx, cy = fx.market_center(k)
    n = F.when(k == 12, 100_000).otherwise(2_000)

    def corner(i, turn):        # a diamond is |dx| + |dy| = h: a triangle wave of the number, moved by a quarter for x
        at = F.pmod(i / n + turn, F.lit(1.0))
        return F.lit(_H) * (F.abs(at * 4 - 2) - 1)

    ring = _ring_wkt(lambda i: cx + corner(i, 0.25), lambda i: cy + corner(i, 0.5), n)
    return fx.table(spark, sf_dir, "nation").select(k.cast("string").alias("market_id"), F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("wkt"))


# ------------------------------------------------------------------ polygons of many vertices
@query("contains_many_vertices", with_(SITE_CTES, "SELECT site_id, market_id FROM within"))
def q_contains_many_vertices(spark, sf_dir):
    from towerlens.operators.spatial_join import contains_join

    sites, _ = _sites_markets(spark, sf_dir)
    return contains_join(sites.select("site_id", "S_SITE_LONGITUDE", "S_SITE_LATITUDE"), _fine_markets(spark, sf_dir), wkt_col="wkt",
                         point_xy=("S_SITE_LONGITUDE", "S_SITE_LATITUDE"), poly_id="market_id", point_keys=["site_id"]).select("site_id", "market_id")


# ------------------------------------------------------------------ cells in polygons
def _cells_oracle() -> str:
    k = plane_constants()
    x = f"({lit(k['s'])} * ({lit(math.sqrt(3.0))} * CAST(q AS DOUBLE) + {lit(math.sqrt(3.0) / 2.0)} * CAST(r AS DOUBLE)) / {lit(k['kx'])})"
    y = f"({lit(k['s'])} * 1.5e0 * CAST(r AS DOUBLE) / {lit(k['ky'])})"
    pitch = 1.5 * k["s"] / k["ky"]
    first, last = int(47.38 / pitch), int(47.82 / pitch) + 1
    across = math.sqrt(3.0) * k["s"] / k["kx"]
    low, high = int(-122.52 / across - last / 2) - 1, int(-122.07 / across - first / 2) + 1
    return with_([fx.MARKETS_SQL, f"""cells AS (
  SELECT '9:' || q || ':' || r AS cell, {x} AS x, {y} AS y FROM range({low}, {high}) a(q), range({first}, {last}) b(r))"""], f"""
SELECT ID AS market_id, cell FROM markets_bronze JOIN cells ON abs(x - cx) + abs(y - cy) < {lit(_H)}""")


@query("cells_in_markets", _cells_oracle())
def q_cells_in_markets(spark, sf_dir):
    from towerlens.operators.polygon_cover import cells_in_polygon

    markets = fx.markets_bronze(spark, sf_dir).select(F.col("ID").alias("market_id"), "geometry_wkt")
    return cells_in_polygon(markets, ["market_id"], "geometry_wkt")


@query("cell_boundaries", with_([fx.CELLS_SQL], f"""
SELECT DISTINCT h3_res9_id, 'ST_Polygon' AS kind, 7 AS corners, true AS center_inside, {cell_sql(_CX, _CY)} = h3_res9_id AS center_in_cell FROM coverage_cells"""))
def q_cell_boundaries(spark, sf_dir):
    from towerlens.functions.cells import cell_id

    cells = fx.coverage_cells(spark, sf_dir).select("h3_res9_id").distinct()
    made = G.materialize(cells, wkt=cell_boundary_wkt("h3_res9_id"), c=cell_center("h3_res9_id"))
    rings = G.poly_from_wkt("wkt")
    return made.select("h3_res9_id", G.geometry_type("wkt").alias("kind"), F.size(rings.getItem(0)).alias("corners"),
                       G.contains(rings, F.col("c.x"), F.col("c.y")).alias("center_inside"),
                       (cell_id(F.col("c.x"), F.col("c.y")) == F.col("h3_res9_id")).alias("center_in_cell"))


# ------------------------------------------------------------------ validity of long rings
@query("polygon_valid_large", "SELECT n_nationkey AS shape_id, 10001 + CASE WHEN n_nationkey % 4 >= 2 THEN 4001 ELSE 0 END AS points, "
                              "n_nationkey % 4 IN (0, 3) AS is_valid FROM nation")
def q_polygon_valid_large(spark, sf_dir):
    """Rings of 10,000 vertices: plain, with a part in reverse order, with a hole through the shell, with a hole inside."""
    k = F.col("n_nationkey").cast("bigint")
    cx, cy = fx.market_center(k)
    n = F.lit(10_000)

    def turned(i):
        return F.when((k % 4 == 1) & (i >= 3000) & (i < 7000), F.lit(9999) - i).otherwise(i) * F.lit(2 * math.pi) / n

    shell = _ring_wkt(lambda i: cx + F.lit(_H) * F.cos(turned(i)), lambda i: cy + F.lit(_H) * F.sin(turned(i)), n)
    off = F.when(k % 4 == 2, 0.8 * _H).otherwise(0.1 * _H)
    hole = _ring_wkt(lambda i: cx + off + F.lit(_H / 2) * F.cos(i * F.lit(2 * math.pi / 4000)), lambda i: cy + F.lit(_H / 2) * F.sin(i * F.lit(2 * math.pi / 4000)), F.lit(4000))
    shapes = fx.table(spark, sf_dir, "nation").select(k.alias("shape_id"), F.concat(
        F.lit("POLYGON (("), shell, F.when(k % 4 >= 2, F.concat(F.lit("), ("), hole)).otherwise(""), F.lit("))")).alias("wkt"))
    parsed = G.materialize(shapes.repartition(8), rings=G.poly_from_wkt("wkt"))
    return parsed.select("shape_id", F.aggregate("rings", F.lit(0), lambda m, r: m + F.size(r)).alias("points"),
                         G.is_valid("rings", check_self_intersection=True).alias("is_valid"))


# ------------------------------------------------------------------ bounding boxes that overlap a box
_MEET = (-122.40, 47.55, -122.30, 47.65)


@query("markets_meeting_box", with_([fx.MARKETS_SQL], f"""
SELECT ID AS market_id FROM markets_bronze
WHERE cx + {lit(_H)} >= {lit(_MEET[0])} AND cx - {lit(_H)} <= {lit(_MEET[2])} AND cy + {lit(_H)} >= {lit(_MEET[1])} AND cy - {lit(_H)} <= {lit(_MEET[3])}"""))
def q_markets_meeting_box(spark, sf_dir):
    markets = fx.markets_bronze(spark, sf_dir)
    return markets.filter(G.bbox_overlaps(G.poly_from_wkt("geometry_wkt"), *_MEET)).select(F.col("ID").alias("market_id"))


# ------------------------------------------------------------------ distinct counts that roll up
@query("distinct_roll_up", with_([fx.CELLS_SQL], f"""
SELECT 'cell' AS level, h3_res9_id AS name, COUNT(DISTINCT fid) AS providers, true AS close FROM coverage_cells GROUP BY 2
UNION ALL SELECT 'technology', CAST(technology AS VARCHAR), COUNT(DISTINCT fid), true FROM coverage_cells GROUP BY 2
UNION ALL SELECT 'row', CAST(floor({_CY} * 100) AS VARCHAR), COUNT(DISTINCT fid), true FROM coverage_cells GROUP BY 2
UNION ALL SELECT 'all', 'all', COUNT(DISTINCT fid), true FROM coverage_cells""".replace("CAST(floor", "CAST(CAST(floor").replace("* 100) AS VARCHAR)", "* 100) AS BIGINT) AS VARCHAR)")))
def q_distinct_roll_up(spark, sf_dir):
    """Providers by cell, technology, row of cells and in all: exact counts, and whether those rolled up from one stored
    table of sketches lie within three standard errors."""
    from towerlens.operators.sketches import distinct_count, distinct_sketches, estimated, relative_error, roll_up
    from towerlens.operators.skew import written

    cells = fx.coverage_cells(spark, sf_dir).withColumn("technology", F.col("technology").cast("string"))
    cells = G.materialize(cells, c=cell_center("h3_res9_id")).withColumn("row", F.floor(F.col("c.y") * 100).cast("string")).withColumn("all", F.lit("all")).drop("c")
    kept = written(distinct_sketches(cells, ["h3_res9_id", "technology", "row", "all"], "fid"), "providers")
    out = None
    for level, key in (("cell", "h3_res9_id"), ("technology", "technology"), ("row", "row"), ("all", "all")):
        exact, about = distinct_count(cells, [key], "fid", out_col="providers"), estimated(roll_up(kept, [key]), out_col="about")
        near = F.abs(F.col("about") - F.col("providers")) <= F.greatest(F.lit(0.0), 3 * relative_error() * F.col("providers"))
        one = exact.join(about, key).select(F.lit(level).alias("level"), F.col(key).alias("name"), "providers", near.alias("close"))
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------------ longest texts (F13), uncovered buildings near a tower
_TEXTS = (("customer", "c_name"), ("customer", "c_mktsegment"), ("nation", "n_name"), ("documents", "text"), ("pages", "url"))


@query("longest_texts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(max(length({c})) AS INTEGER) AS longest, count({c}) AS n FROM {t}" for t, c in _TEXTS))
def q_longest_texts(spark, sf_dir):
    from towerlens.sources.tables import text_lengths

    out = None
    for table in dict.fromkeys(t for t, _ in _TEXTS):
        one = text_lengths(table, fx.table(spark, sf_dir, table), [c for t, c in _TEXTS if t == table])
        out = one if out is None else out.unionByName(one)
    return out


@query("n7_uncovered_buildings", with_([*ALLB_CTES, BDC_CTE, fx.TOWERS_SQL, _ranked_sql("allb b", "b.building_id", "b.centroid_lon", "b.centroid_lat")], f"""
SELECT r.building_id, r.nearest_tower_id, {sround('r.d', 1)} AS distance_to_tower_m
FROM ranked r JOIN allb b ON b.building_id = r.building_id LEFT JOIN bdc c ON c.h3_res9_id = b.h3_res9_id
WHERE r.rn = 1 AND COALESCE(c.best_download_mbps, 0) = 0 ORDER BY r.d, r.building_id LIMIT 10"""))
def q_n7_uncovered(spark, sf_dir):
    """Of all buildings, those without coverage that are nearest to a tower (N7 on rows that have an answer)."""
    from towerlens.operators.coverage import cell_coverage_join

    covered = cell_coverage_join(all_buildings(spark, sf_dir), fx.coverage_cells(spark, sf_dir))
    bare = covered.filter(F.col("best_download_mbps") == 0).select("building_id", "centroid_lon", "centroid_lat")
    near = pl.nearest_tower(bare, fx.towers(spark, sf_dir), carry={"tower_id": "nearest_tower_id"})
    return (near.orderBy("_dist", "building_id").limit(10)
            .select("building_id", "nearest_tower_id", F.round("_dist", 1).alias("distance_to_tower_m")))


# ------------------------------------------------------------------ towers from shards to answers
_NEAR = pl.BBox(47.50, 47.70, -122.45, -122.20)
_HERE_CTE = f"""here AS (
  SELECT * FROM (SELECT o.*, {fx.loc_lat_sql('(cell - 1000000) // 13 + 13')} AS lat, {fx.loc_lon_sql('(cell - 1000000) // 13 + 13')} AS lon FROM ocid o)
  WHERE mcc = 310 AND lat BETWEEN {lit(_NEAR.lat_min)} AND {lit(_NEAR.lat_max)} AND lon BETWEEN {lit(_NEAR.lon_min)} AND {lit(_NEAR.lon_max)})"""


def _explored(spark, sf_dir):
    root = _csv_folder(spark, "explore")
    for name, part in (("a", 0), ("nested/b", 1)):
        shard = fx.opencellid_rows(spark, sf_dir).filter(F.pmod(F.xxhash64("cell"), F.lit(2)) == part)
        shard.write.options(header="false", compression="gzip").csv(f"{root}/{name}")
    return pl.explore_towers(spark, root, _NEAR)


@query("explore_towers_carriers", with_([_OCID_CTE, _HERE_CTE], f"""
SELECT radio, net, COUNT(*) AS record_count, COUNT(DISTINCT cell) AS unique_cell_ids,
       {sround('AVG(range_m)', 0)} AS avg_range_m, {sround('AVG(samples)', 1)} AS avg_samples FROM here GROUP BY radio, net"""))
def q_explore_carriers(spark, sf_dir):
    return _explored(spark, sf_dir)[1]


@query("explore_towers_top", with_([_OCID_CTE, _HERE_CTE], """
SELECT radio, net AS mnc, CASE net WHEN 260 THEN 'T-Mobile' WHEN 410 THEN 'AT&T' ELSE 'MNC-' || CAST(net AS VARCHAR) END AS carrier,
       area AS lac_tac, cell AS cell_id, range_m, samples FROM here ORDER BY samples DESC, cell LIMIT 20"""))
def q_explore_top(spark, sf_dir):
    return _explored(spark, sf_dir)[2].drop("lon", "lat", "created_ts", "updated_ts")


# ------------------------------------------------------------------ geometry functions by their SQL names
@query("sql_geometry_functions", with_([fx.BUILDINGS_SQL, BLD_CTE, fx.MARKETS_SQL], f"""
SELECT building_id, 'ST_Point' AS kind, centroid_lon AS x, centroid_lat AS y,
       {sround(haversine_sql('centroid_lon', 'centroid_lat', '-122.335e0', '47.608e0'), 3)} AS metres,
       abs(centroid_lon + 122.30e0) + abs(centroid_lat - 47.60e0) < {lit(_H)} AS inside, true AS same_text
FROM bld"""))
def q_sql_geometry(spark, sf_dir):
    """The functions as a user writes them in SQL, on a frame bound by the SQL step."""
    from towerlens.functions.sql import register_sql_functions
    from towerlens.plans.nodes import run_step

    register_sql_functions(spark)
    placed = pl.with_centroid(fx.buildings(spark, sf_dir)).select("building_id", "centroid_lon", "centroid_lat")
    corners = [(-122.30, 47.60 - _H), (-122.30 + _H, 47.60), (-122.30, 47.60 + _H), (-122.30 - _H, 47.60), (-122.30, 47.60 - _H)]
    text = "SELECT building_id, st_geometrytype(p) AS kind, st_x(p) AS x, st_y(p) AS y, round(st_distancesphere(p, st_point(:lon, :lat)), 3) AS metres, " \
           "st_contains(st_geomfromtext(:area), p) AS inside, st_astext(p) = p AS same_text " \
           "FROM (SELECT building_id, st_point(centroid_lon, centroid_lat) AS p FROM placed)"
    return run_step("sql", {"query": text}, {"placed": placed}, spark, {
        "lon": -122.335, "lat": 47.608, "area": "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in corners) + "))"})
