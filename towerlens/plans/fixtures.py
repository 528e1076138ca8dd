"""Domain tables derived from the driver's TPC-H-like tables by formula.

The reference's own inputs (building footprints, coverage hexagons, tower
files, telemetry shards, site and market files) are not shipped.  Each
domain table is derived here from a driver table by a fixed formula, once
as a DataFrame (what the queries run on) and once as SQL text (what the
DuckDB oracle runs on).  Both forms must stay in step.

Every derived table is a projection of one driver table, so its size grows
with the scale factor, and the DataFrame forms keep Spark's column pruning
and filter pushdown into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.functions.cells import cell_id, cell_id_sql
from towerlens.functions.exprcache import cached_frame

# Derivation constants (see FIXTURES.md).
CORE_BBOX = (47.595, 47.625, -122.355, -122.325)      # lat_min, lat_max, lon_min, lon_max
METRO_BBOX = (47.40, 47.80, -122.50, -122.10)
TOWER_TYPES = ["LTE", "NR", "GSM", "UMTS"]
TRAFFIC_MIXES = ["video_heavy", "commute", "balanced"]
MARKET_HALF_DIAGONAL = 0.04503
TMOBILE_MNC = 260


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ loc(k)
def loc_lat(k: Column) -> Column:
    return F.when(k % 2 == 0, F.lit(47.595) + ((k * 7919) % 301) / F.lit(1e4)) \
        .otherwise(F.lit(47.4) + ((k * 7919) % 4001) / F.lit(1e4))


def loc_lon(k: Column) -> Column:
    return F.when(k % 2 == 0, F.lit(-122.355) + ((k * 6101) % 301) / F.lit(1e4)) \
        .otherwise(F.lit(-122.5) + ((k * 6101) % 4001) / F.lit(1e4))


def loc_lat_sql(k: str) -> str:
    return (f"(CASE WHEN ({k}) % 2 = 0 THEN 47.595e0 + ((({k}) * 7919) % 301) / 1e4 "
            f"ELSE 47.4e0 + ((({k}) * 7919) % 4001) / 1e4 END)")


def loc_lon_sql(k: str) -> str:
    return (f"(CASE WHEN ({k}) % 2 = 0 THEN -122.355e0 + ((({k}) * 6101) % 301) / 1e4 "
            f"ELSE -122.5e0 + ((({k}) * 6101) % 4001) / 1e4 END)")


def _f5(c: Column) -> Column:
    return F.format_string("%.5f", c)


def _rect_wkt(cx: Column, cy: Column, hw: Column, hh: Column) -> Column:
    x1, x2, y1, y2 = _f5(cx - hw), _f5(cx + hw), _f5(cy - hh), _f5(cy + hh)
    return F.concat(F.lit("POLYGON (("), x1, F.lit(" "), y1, F.lit(", "), x2, F.lit(" "), y1, F.lit(", "),
                    x2, F.lit(" "), y2, F.lit(", "), x1, F.lit(" "), y2, F.lit(", "), x1, F.lit(" "), y1,
                    F.lit("))"))


def _rect_wkt_sql(cx: str, cy: str, hw: str, hh: str) -> str:
    x1, x2 = f"printf('%.5f', {cx} - {hw})", f"printf('%.5f', {cx} + {hw})"
    y1, y2 = f"printf('%.5f', {cy} - {hh})", f"printf('%.5f', {cy} + {hh})"
    return (f"('POLYGON ((' || {x1} || ' ' || {y1} || ', ' || {x2} || ' ' || {y1} || ', ' || {x2} || ' ' || {y2}"
            f" || ', ' || {x1} || ' ' || {y2} || ', ' || {x1} || ' ' || {y1} || '))')")


def _diamond_wkt(cx: Column, cy: Column, h: float) -> Column:
    pts = [(cx, cy - h), (cx + h, cy), (cx, cy + h), (cx - h, cy), (cx, cy - h)]
    parts = []
    for i, (x, y) in enumerate(pts):
        if i:
            parts.append(F.lit(", "))
        parts += [_f5(x), F.lit(" "), _f5(y)]
    return F.concat(F.lit("POLYGON (("), *parts, F.lit("))"))


def _diamond_wkt_sql(cx: str, cy: str, h: float) -> str:
    hs = repr(h) + "e0"
    pts = [(cx, f"{cy} - {hs}"), (f"{cx} + {hs}", cy), (cx, f"{cy} + {hs}"), (f"{cx} - {hs}", cy),
           (cx, f"{cy} - {hs}")]
    body = " || ', ' || ".join(f"printf('%.5f', {x}) || ' ' || printf('%.5f', {y})" for x, y in pts)
    return f"('POLYGON ((' || {body} || '))')"


# ------------------------------------------------------------------ buildings
@cached_frame
def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """building_id, height, geometry (WKT rectangle) -- from customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return c.select(
        k.alias("building_id"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise((F.lit(3) + k % 40).cast("double")).alias("height"),
        _rect_wkt(loc_lon(k), loc_lat(k), (F.lit(1) + k % 5) / F.lit(1e5), (F.lit(1) + k % 3) / F.lit(1e5))
        .alias("geometry"),
    )


BUILDINGS_SQL = f"""buildings AS (
  SELECT c_custkey AS building_id,
         CASE WHEN c_custkey % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(3 + c_custkey % 40 AS DOUBLE) END AS height,
         {_rect_wkt_sql(loc_lon_sql('c_custkey'), loc_lat_sql('c_custkey'), '((1 + c_custkey % 5) / 1e5)', '((1 + c_custkey % 3) / 1e5)')} AS geometry
  FROM customer)"""


# ------------------------------------------------------------------ towers
@cached_frame
def towers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver tower schema (14 columns) -- from supplier, loc(id + 13)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    types = F.array(*[F.lit(t) for t in TOWER_TYPES])
    lon, lat = loc_lon(k + 13), loc_lat(k + 13)
    return s.select(
        k.alias("tower_id"),
        F.lit("T-Mobile").alias("carrier"),
        types[(k % 4).cast("int")].alias("tower_type"),
        F.lit(TMOBILE_MNC).alias("net"),
        (F.lit(10000) + k % 97).cast("int").alias("lac_tac"),
        (F.lit(1000000) + k * 13).alias("cell_id"),
        (F.lit(200) + F.lit(100) * (k % 20)).cast("int").alias("coverage_radius_m"),
        (F.lit(1) + (k * 7) % 50).cast("int").alias("samples"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.from_unixtime(F.lit(1500000000) + k * 3600).alias("created_ts"),
        F.from_unixtime(F.lit(1600000000) + k * 3600).alias("updated_ts"),
        (-(F.lit(60) + k % 40)).cast("int").alias("avg_signal"),
        F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")).alias("location"),
    )


TOWERS_SQL = f"""towers AS (
  SELECT s_suppkey AS tower_id, 'T-Mobile' AS carrier,
         CASE s_suppkey % 4 WHEN 0 THEN 'LTE' WHEN 1 THEN 'NR' WHEN 2 THEN 'GSM' ELSE 'UMTS' END AS tower_type,
         {TMOBILE_MNC} AS net,
         CAST(10000 + s_suppkey % 97 AS INTEGER) AS lac_tac,
         1000000 + s_suppkey * 13 AS cell_id,
         CAST(200 + 100 * (s_suppkey % 20) AS INTEGER) AS coverage_radius_m,
         CAST(1 + (s_suppkey * 7) % 50 AS INTEGER) AS samples,
         {loc_lat_sql('s_suppkey + 13')} AS latitude,
         {loc_lon_sql('s_suppkey + 13')} AS longitude
  FROM supplier)"""


# ------------------------------------------------------------------ coverage cells
@cached_frame
def coverage_cells(spark: SparkSession, sf_dir: str, res: int = 9) -> DataFrame:
    """fid, technology, mindown, minup, environmnt, h3_res9_id (+ centre) -- from part."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    k = F.col("p_partkey")
    size = F.col("p_size")
    key = cell_id(loc_lon(k + 31), loc_lat(k + 31), res)
    out = p.select(
        k.alias("fid"),
        (F.lit(400) + F.lit(100) * (k % 2)).alias("technology"),
        F.when(size < 15, 7).when(size < 40, 35).otherwise(100).alias("mindown"),
        F.when(size < 15, 1).when(size < 40, 3).otherwise(20).alias("minup"),
        (k % 2).alias("environmnt"),
        key.alias("h3_res9_id"),
    )
    return out


CELLS_SQL = f"""coverage_cells AS (
  SELECT p_partkey AS fid, 400 + 100 * (p_partkey % 2) AS technology,
         CASE WHEN p_size < 15 THEN 7 WHEN p_size < 40 THEN 35 ELSE 100 END AS mindown,
         CASE WHEN p_size < 15 THEN 1 WHEN p_size < 40 THEN 3 ELSE 20 END AS minup,
         p_partkey % 2 AS environmnt,
         {cell_id_sql(loc_lon_sql('p_partkey + 31'), loc_lat_sql('p_partkey + 31'))} AS h3_res9_id
  FROM part)"""


# ------------------------------------------------------------------ telemetry
@cached_frame
def tower_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly tower KPI events -- from events; tower id spread over the supplier count."""
    n = table(spark, sf_dir, "supplier").count()
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    k = F.col("event_id")
    util = (F.lit(5) + (k * 37) % 96).cast("double")
    return e.select(
        ((k * 31) % F.lit(n)).alias("tower_id"),
        F.col("ts").alias("event_ts"),
        util.alias("prb_utilization_pct"),
        (F.lit(10) + (k * 53) % 130).cast("double").alias("latency_ms"),
        (((k * 29) % 400) / F.lit(1e2)).alias("packet_loss_pct"),
        (F.lit(300.0) - F.lit(2.0) * util).alias("throughput_mbps"),
        k.alias("event_id"),
    )


KPIS_SQL = """tower_kpis AS (
  SELECT (event_id * 31) % (SELECT COUNT(*) FROM supplier) AS tower_id, ts AS event_ts,
         CAST(5 + (event_id * 37) % 96 AS DOUBLE) AS prb_utilization_pct,
         CAST(10 + (event_id * 53) % 130 AS DOUBLE) AS latency_ms,
         ((event_id * 29) % 400) / 1e2 AS packet_loss_pct,
         300e0 - 2e0 * CAST(5 + (event_id * 37) % 96 AS DOUBLE) AS throughput_mbps,
         event_id
  FROM events)"""


@cached_frame
def building_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly building demand events -- from orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    mixes = F.array(*[F.lit(m) for m in TRAFFIC_MIXES])
    return o.select(
        F.col("o_custkey").alias("building_id"),
        F.col("o_orderdate").alias("event_ts"),
        (F.lit(1) + F.floor(F.col("o_totalprice") / F.lit(8000.0))).cast("bigint").alias("demand_users"),
        mixes[(k % 3).cast("int")].alias("traffic_mix"),
        (F.lit(0.4) + (k % 60) / F.lit(1e2)).alias("indoor_penetration_factor"),
        k.alias("order_key"),
    )


DEMAND_SQL = """building_demand AS (
  SELECT o_custkey AS building_id, o_orderdate AS event_ts,
         CAST(1 + floor(o_totalprice / 8000e0) AS BIGINT) AS demand_users,
         CASE o_orderkey % 3 WHEN 0 THEN 'video_heavy' WHEN 1 THEN 'commute' ELSE 'balanced' END AS traffic_mix,
         0.4e0 + (o_orderkey % 60) / 1e2 AS indoor_penetration_factor,
         o_orderkey AS order_key
  FROM orders)"""


# ------------------------------------------------------------------ sites and markets
@cached_frame
def sites_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """site_id, SITE_LATITUDE/LONGITUDE (NULL for every 17th), RING_LATITUDE/LONGITUDE -- from customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    null = k % 17 == 0
    return c.select(
        k.alias("site_id"),
        F.when(null, F.lit(None).cast("double")).otherwise(loc_lat(k)).alias("SITE_LATITUDE"),
        F.when(null, F.lit(None).cast("double")).otherwise(loc_lon(k)).alias("SITE_LONGITUDE"),
        loc_lat(k + 1).alias("RING_LATITUDE"),
        loc_lon(k + 1).alias("RING_LONGITUDE"),
    )


SITES_SQL = f"""sites_bronze AS (
  SELECT c_custkey AS site_id,
         CASE WHEN c_custkey % 17 = 0 THEN CAST(NULL AS DOUBLE) ELSE {loc_lat_sql('c_custkey')} END AS SITE_LATITUDE,
         CASE WHEN c_custkey % 17 = 0 THEN CAST(NULL AS DOUBLE) ELSE {loc_lon_sql('c_custkey')} END AS SITE_LONGITUDE,
         {loc_lat_sql('c_custkey + 1')} AS RING_LATITUDE,
         {loc_lon_sql('c_custkey + 1')} AS RING_LONGITUDE
  FROM customer)"""


def market_center(k: Column) -> tuple[Column, Column]:
    return F.lit(-122.46) + (k % 5) * F.lit(0.08), F.lit(47.44) + F.floor(k / 5) * F.lit(0.08)


@cached_frame
def markets_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ID, Name, State, MarketType, MarketTypeDetailed, Population, geometry_wkt -- from nation."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("n_nationkey").cast("bigint")
    cx, cy = market_center(k)
    return n.select(
        k.cast("string").alias("ID"),
        F.col("n_name").alias("Name"),
        F.lit("WA").alias("State"),
        F.lit("Small/Rural").alias("MarketType"),
        F.when(k % 2 == 0, F.lit("Small")).otherwise(F.lit("Rural")).alias("MarketTypeDetailed"),
        (F.lit(1000) * (k + 1)).cast("int").alias("Population"),
        _diamond_wkt(cx, cy, MARKET_HALF_DIAGONAL).alias("geometry_wkt"),
    )


_MCX = "(-122.46e0 + (n_nationkey % 5) * 0.08e0)"
_MCY = "(47.44e0 + floor(n_nationkey / 5) * 0.08e0)"
MARKETS_SQL = f"""markets_bronze AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS ID, n_name AS Name, 'WA' AS State, 'Small/Rural' AS MarketType,
         CASE WHEN n_nationkey % 2 = 0 THEN 'Small' ELSE 'Rural' END AS MarketTypeDetailed,
         CAST(1000 * (n_nationkey + 1) AS INTEGER) AS Population,
         {_diamond_wkt_sql(_MCX, _MCY, MARKET_HALF_DIAGONAL)} AS geometry_wkt,
         {_MCX} AS cx, {_MCY} AS cy
  FROM nation)"""


# ------------------------------------------------------------------ transcripts
@cached_frame
def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transcript per conversation: turns joined in order (aggregated per conv_id)."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return (c.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", F.concat(F.col("role"), F.lit(": "), F.col("text"))
                                                       .alias("line")))).alias("_t"),
                 F.count("*").alias("turns"))
            .select("conv_id", "turns", F.array_join(F.transform("_t", lambda s: s["line"]), "\n").alias("transcript")))


@cached_frame
def opencellid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14 headerless OpenCellID columns as text -- supplier x 4 carriers."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    nets = F.array(*[F.lit(v) for v in (260, 410, 120, 480)])
    radios = F.array(*[F.lit(t) for t in TOWER_TYPES])
    x = s.select(k, F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j"))
    kk = F.col("s_suppkey") * 4 + F.col("j")
    return x.select(
        radios[(kk % 4).cast("int")].alias("radio"),
        F.when(kk % 50 == 0, F.lit(302)).otherwise(F.lit(310)).cast("string").alias("mcc"),
        nets[F.col("j").cast("int")].cast("string").alias("net"),
        (F.lit(10000) + kk % 97).cast("string").alias("area"),
        (F.lit(1000000) + kk * 13).cast("string").alias("cell"),
        F.lit("0").alias("unit"),
        loc_lon(kk + 13).cast("string").alias("lon"),
        loc_lat(kk + 13).cast("string").alias("lat"),
        (F.lit(200) + F.lit(100) * (kk % 20)).cast("string").alias("range"),
        (F.lit(1) + (kk * 7) % 50).cast("string").alias("samples"),
        F.lit("1").alias("changeable"),
        (F.lit(1500000000) + kk * 3600).cast("string").alias("created"),
        (F.lit(1600000000) + kk * 3600).cast("string").alias("updated"),
        (-(F.lit(60) + kk % 40)).cast("string").alias("averageSignal"),
    )


# ------------------------------------------------------------------ shapes for validity checks
@cached_frame
def test_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """shape_id, wkt -- from customer: valid rectangles plus unclosed, 3-point,
    zero-area, self-crossing and non-polygon shapes chosen by key."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    x1, y1 = _f5(loc_lon(k) - F.lit(1e-4)), _f5(loc_lat(k) - F.lit(1e-4))
    x2, y2 = _f5(loc_lon(k) + F.lit(1e-4)), _f5(loc_lat(k) + F.lit(1e-4))
    x3 = _f5(loc_lon(k) + F.lit(3e-4))

    def poly(*pts):
        body = []
        for i, (x, y) in enumerate(pts):
            if i:
                body.append(F.lit(", "))
            body += [x, F.lit(" "), y]
        return F.concat(F.lit("POLYGON (("), *body, F.lit("))"))

    wkt = (F.when(k % 7 == 0, poly((x1, y1), (x2, y1), (x2, y2), (x1, y2)))
           .when(k % 13 == 0, poly((x1, y1), (x2, y1), (x1, y1)))
           .when(k % 5 == 0, poly((x1, y1), (x2, y1), (x3, y1), (x1, y1)))
           .when(k % 11 == 0, F.concat(F.lit("LINESTRING ("), x1, F.lit(" "), y1, F.lit(", "), x2, F.lit(" "), y2,
                                       F.lit(")")))
           .when(k % 17 == 0, poly((x1, y1), (x3, y2), (x2, y1), (x1, y2), (x1, y1)))
           .otherwise(poly((x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1))))
    return c.select(k.alias("shape_id"), wkt.alias("wkt"))


# ------------------------------------------------------------------ raw telemetry with rule violations
@cached_frame
def raw_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze KPI rows as ingested, with NULL ids, out-of-range utilisation and non-positive latency."""
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    k = F.col("event_id")
    return e.select(
        F.when(k % 97 == 0, F.lit(None).cast("bigint")).otherwise((k * 31) % 100).alias("tower_id"),
        F.col("ts").alias("event_ts"),
        (((k * 37) % 121) - 10).cast("double").alias("prb_utilization_pct"),
        (((k * 53) % 140) - 5).cast("double").alias("latency_ms"),
        (((k * 29) % 400) / F.lit(1e2)).alias("packet_loss_pct"),
        (F.lit(300.0) - F.lit(2.0) * ((k * 37) % 121)).alias("throughput_mbps"),
        k.alias("event_id"),
    )


RAW_KPIS_SQL = """raw_kpis AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS BIGINT) ELSE (event_id * 31) % 100 END AS tower_id,
         ts AS event_ts,
         CAST(((event_id * 37) % 121) - 10 AS DOUBLE) AS prb_utilization_pct,
         CAST(((event_id * 53) % 140) - 5 AS DOUBLE) AS latency_ms,
         ((event_id * 29) % 400) / 1e2 AS packet_loss_pct,
         300e0 - 2e0 * ((event_id * 37) % 121) AS throughput_mbps,
         event_id
  FROM events)"""


# ------------------------------------------------------------------ footprints in zipped shapefiles
def shapefile_zip(attributes: list[str], polygons: list[list[list[tuple[float, float]]] | None], name: str = "bldg_footprints", width: int = 12) -> bytes:
    """A zip with one polygon shapefile and a text attribute, HEIGHT, by the public format."""
    import io
    import struct
    import zipfile

    records = []
    for i, rings in enumerate(polygons, start=1):
        content = struct.pack("<i", 0)
        if rings is not None:
            pts, starts = [p for r in rings for p in r], [sum(map(len, rings[:k])) for k in range(len(rings))]
            xs, ys = zip(*pts)
            content = struct.pack(f"<i4d2i{len(starts)}i{2 * len(pts)}d", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(pts), *starts,
                                  *[c for p in pts for c in p])
        records.append(struct.pack(">ii", i, len(content) // 2) + content)
    ends = [100]
    for r in records:
        ends.append(ends[-1] + len(r))

    def head(size: int) -> bytes:
        return struct.pack(">i20xi", 9994, size // 2) + struct.pack("<ii4d32x", 1000, 5, 0, 0, 0, 0)

    index = b"".join(struct.pack(">ii", at // 2, len(r) // 2 - 4) for at, r in zip(ends, records))
    table = (struct.pack("<4BIHH20x", 3, 26, 1, 1, len(records), 65, 1 + width) + b"HEIGHT".ljust(11, b"\0") + b"C" + bytes(4) + bytes([width, 0])
             + bytes(14) + b"\r" + b"".join(b" " + a.encode().ljust(width) for a in attributes) + b"\x1a")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr(f"{name}.shp", head(ends[-1]) + b"".join(records))
        zf.writestr(f"{name}.shx", head(100 + len(index)) + index)
        zf.writestr(f"{name}.dbf", table)
    return out.getvalue()


def building_archives(spark: SparkSession, sf_dir: str, per_archive: int = 400) -> DataFrame:
    """``path, content``: the buildings in zipped shapefiles of at most ``per_archive``, with ``id height`` as attribute."""
    import pyarrow as pa

    def pack(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["building_id"])
        rings = [[[(p["x"], p["y"]) for p in ring] for ring in r["rings"]] for r in rows]
        texts = [f"{r['building_id']}" if r["height"] is None else f"{r['building_id']} {r['height']:g}" for r in rows]
        return pa.table({"path": [f"part-{rows[0]['part']}.zip"], "content": pa.array([shapefile_zip(texts, rings)], pa.binary())})

    from towerlens.functions.geo import poly_from_wkt

    shapes = buildings(spark, sf_dir).select("building_id", "height", poly_from_wkt("geometry").alias("rings"),
                                             F.floor(F.col("building_id") / per_archive).alias("part"))
    return shapes.groupBy("part").applyInArrow(pack, "path string, content binary")
