"""Composed analyses (the reference's notebooks and pipeline datasets).

Each function takes DataFrames and returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.functions import bands as B
from towerlens.functions.cells import cell_id
from towerlens.functions.exprcache import cached_expr
from towerlens.functions.geo import centroid, materialize, multipolygon_parts, parts_centroid, poly_from_wkt
from towerlens.operators.coverage import cell_coverage_join, cell_join
from towerlens.operators.latest import latest_per_key
from towerlens.operators.nearest import nearest
from towerlens.operators.quantiles import exact_percentiles
from towerlens.operators.skew import checkpointed
from towerlens.operators.spatial_join import contains_join


@dataclass(frozen=True)
class BBox:
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    def pad(self, d: float) -> "BBox":
        return BBox(self.lat_min - d, self.lat_max + d, self.lon_min - d, self.lon_max + d)

    def contains(self, lat, lon):
        lat = F.col(lat) if isinstance(lat, str) else lat
        lon = F.col(lon) if isinstance(lon, str) else lon
        return lat.between(self.lat_min, self.lat_max) & lon.between(self.lon_min, self.lon_max)


# The reference's bounding boxes (downtown core and metro).
CORE = BBox(47.595, 47.625, -122.355, -122.325)
METRO = BBox(47.40, 47.80, -122.50, -122.10)
ANALYSIS_BOX = BBox(47.58, 47.64, -122.36, -122.31)

TOWER_CARRY = {
    "tower_id": "nearest_tower_id",
    "carrier": "nearest_carrier",
    "tower_type": "nearest_tower_type",
    "cell_id": "nearest_cell_id",
    "coverage_radius_m": "nearest_coverage_radius_m",
    "samples": "nearest_tower_samples",
}


@cached_expr
def _polygon_measures(geom: str, area: bool):
    from towerlens.functions.geo import area_m2

    p = poly_from_wkt(F.col(geom))
    c = centroid(F.col("_p"))
    return p, c, (area_m2(F.col("_p")) if area else None)


def with_centroid(buildings: DataFrame, geom: str = "geometry", area_col: str | None = None) -> DataFrame:
    """Adds centroid_lon / centroid_lat (and optionally the area in m2).

    The WKT is parsed once per row; the parse and the measures are CPU work,
    so a small single-partition input is first spread over the cores.
    """
    from towerlens.operators.skew import spread

    p, c, a = _polygon_measures(geom, area_col is not None)
    b = materialize(spread(buildings), _p=p)
    cols = {"_c": c}
    if area_col:
        cols[area_col] = a
    b = materialize(b, **cols).drop("_p")
    return (b.withColumn("centroid_lon", F.col("_c")["x"]).withColumn("centroid_lat", F.col("_c")["y"])
            .drop("_c"))


def downtown_buildings(buildings: DataFrame, box: BBox = CORE, res: int = 9) -> DataFrame:
    """Buildings in the box with centroid and cell; a silver table that has the columns is not parsed again."""
    have = {"centroid_lon", "centroid_lat"} <= set(buildings.columns)
    b = (buildings if have else with_centroid(buildings)).filter(box.contains("centroid_lat", "centroid_lon"))
    return b.withColumn("h3_res9_id", cell_id("centroid_lon", "centroid_lat", res))


def nearest_tower(points: DataFrame, towers: DataFrame, carry: dict | None = None, pad_box: BBox | None = None,
                  how: str = "inner", **kw) -> DataFrame:
    """Nearest tower per point; tower columns renamed by ``carry``; distance unrounded."""
    carry = carry or TOWER_CARRY
    t = towers
    if pad_box is not None:
        t = t.filter(pad_box.contains("latitude", "longitude"))
    t = t.select("latitude", "longitude", *[F.col(k).alias(v) for k, v in carry.items()])
    first = list(carry.values())[0]
    return nearest(points, t, left_xy=("centroid_lon", "centroid_lat"), right_xy=("longitude", "latitude"),
                   right_id=first, right_cols=list(carry.values()), dist_col="_dist", how=how, **kw)


def building_coverage(buildings: DataFrame, cells: DataFrame, towers: DataFrame, box: BBox = CORE,
                      pad: float | None = 0.03, distinct_on: str | None = None, fill: int | None = 0,
                      **kw) -> DataFrame:
    """L1: one row per downtown building with best coverage and nearest tower (16 columns)."""
    b = downtown_buildings(buildings, box).withColumnRenamed("height", "building_height")
    cov = cell_coverage_join(b, cells, "h3_res9_id", fill=fill, distinct_on=distinct_on)
    near = nearest_tower(cov, towers, pad_box=box.pad(pad) if pad is not None else None, **kw)
    return near.select(
        "building_id", "building_height", "geometry", "centroid_lon", "centroid_lat", "h3_res9_id",
        "best_download_mbps", "best_upload_mbps", "provider_count",
        *TOWER_CARRY.values(),
        F.round("_dist", 1).alias("distance_to_tower_m"),
    )


def coverage_by_distance(cov: DataFrame) -> DataFrame:
    """L2: covered buildings per distance band with rounded averages."""
    return (cov.filter(F.col("best_download_mbps") > 0)
            .withColumn("distance_bucket", B.band("distance_to_tower_m", B.DISTANCE_BANDS_GOLD,
                                                  B.DISTANCE_BANDS_GOLD_ELSE))
            .groupBy("distance_bucket")
            .agg(F.count(F.lit(1)).alias("buildings"),
                 F.round(F.avg("best_download_mbps"), 1).alias("avg_download_mbps"),
                 F.round(F.avg("best_upload_mbps"), 1).alias("avg_upload_mbps"),
                 F.round(F.avg("distance_to_tower_m"), 0).alias("avg_distance_m"),
                 F.round(F.avg("provider_count"), 1).alias("avg_providers")))


# ------------------------------------------------------------------ telemetry overlay
def kpis_latest(kpis: DataFrame, tie: str | None = None) -> DataFrame:
    """Latest row per tower; among equal times the greatest ``tie``, or of all other columns in their order."""
    latest = latest_per_key(kpis, ["tower_id"], "event_ts", tie)
    return latest.select(
        "tower_id", F.col("event_ts").alias("kpi_snapshot_ts"), "prb_utilization_pct", "latency_ms",
        "packet_loss_pct", "throughput_mbps",
        B.health_band("prb_utilization_pct", "latency_ms", "packet_loss_pct").alias("tower_health_band"))


def demand_latest(demand: DataFrame, tie: str | None = None) -> DataFrame:
    """Latest row per building, ties as in ``kpis_latest``."""
    latest = latest_per_key(demand, ["building_id"], "event_ts", tie)
    return latest.select(
        "building_id", F.col("event_ts").alias("demand_snapshot_ts"), "demand_users", "traffic_mix",
        "indoor_penetration_factor",
        B.load_score("demand_users", "indoor_penetration_factor").alias("effective_radio_load_score"))


def ops_overlay(cov: DataFrame, demand_latest_df: DataFrame, kpis_latest_df: DataFrame) -> DataFrame:
    """Coverage + latest demand (by building) + latest KPI (by nearest tower) + risk band."""
    from towerlens.operators.coverage import keyed_left_join

    d = demand_latest_df.select("building_id", "demand_snapshot_ts", "demand_users", "traffic_mix",
                                "indoor_penetration_factor", "effective_radio_load_score")
    k = kpis_latest_df.select(F.col("tower_id").alias("nearest_tower_id"), "kpi_snapshot_ts",
                              "prb_utilization_pct", "latency_ms", "packet_loss_pct", "throughput_mbps",
                              "tower_health_band")
    # demand is one row per building (unique key, same cardinality as cov): a
    # plain shuffle join; KPIs are one row per tower (small, proven by count).
    j = cov.join(d, "building_id", "left")
    j = keyed_left_join(j, k, ["nearest_tower_id"], "left", salt_cols=["building_id"])
    return j.withColumn("building_service_risk_band",
                        B.risk_band("tower_health_band", "effective_radio_load_score"))


# ------------------------------------------------------------------ site to market
def sites_silver(sites_bronze: DataFrame, coalesce_ring: bool = False) -> DataFrame:
    lat = F.col("SITE_LATITUDE").cast("double")
    lon = F.col("SITE_LONGITUDE").cast("double")
    if coalesce_ring:
        lat = F.coalesce(lat, F.col("RING_LATITUDE").cast("double"))
        lon = F.coalesce(lon, F.col("RING_LONGITUDE").cast("double"))
    return (sites_bronze.select("site_id", lat.alias("SITE_LATITUDE"), lon.alias("SITE_LONGITUDE"),
                                lat.alias("S_SITE_LATITUDE"), lon.alias("S_SITE_LONGITUDE"))
            .filter(F.col("SITE_LATITUDE").isNotNull() & F.col("SITE_LONGITUDE").isNotNull()))


def markets_silver(markets_bronze: DataFrame) -> DataFrame:
    return markets_bronze.select(
        F.col("ID").alias("market_id"), F.col("Name").alias("market_name"), F.col("State").alias("state"),
        F.col("MarketType").alias("market_type"), F.col("MarketTypeDetailed").alias("market_type_detailed"),
        F.col("Population").alias("population"), "geometry_wkt",
    ).filter(F.col("geometry_wkt").isNotNull())


MARKET_COLS = ["market_id", "market_name", "state", "market_type_detailed", "population"]
SITE_COLS = ["site_id", "S_SITE_LATITUDE", "S_SITE_LONGITUDE"]


def sites_in_market(sites: DataFrame, markets: DataFrame, **kw) -> DataFrame:
    """Sites whose point lies in a market polygon (fan-out kept when polygons overlap)."""
    pts = sites.select(*SITE_COLS)
    polys = markets.select(*MARKET_COLS, "geometry_wkt")
    j = contains_join(pts, polys, point_xy=("S_SITE_LONGITUDE", "S_SITE_LATITUDE"), wkt_col="geometry_wkt",
                      poly_id="market_id", point_keys=["site_id"], **kw)
    return j.select(*SITE_COLS, *MARKET_COLS)


def sites_nearest_market(sites: DataFrame, markets: DataFrame, within: DataFrame, **kw) -> DataFrame:
    """J10 + J9: sites in no market -> nearest market centroid, distance in km (2 places)."""
    unmatched = sites.select(*SITE_COLS).join(within.select("site_id").distinct(), "site_id", "left_anti")
    cents = (materialize(markets, _c=parts_centroid(multipolygon_parts("geometry_wkt")))
             .select(*MARKET_COLS, F.col("_c")["x"].alias("_mx"), F.col("_c")["y"].alias("_my")))
    near = nearest(unmatched, cents, left_xy=("S_SITE_LONGITUDE", "S_SITE_LATITUDE"), right_xy=("_mx", "_my"),
                   right_id="market_id", right_cols=MARKET_COLS, dist_col="_dist", **kw)
    return near.select(*SITE_COLS, *MARKET_COLS, F.round(F.col("_dist") / F.lit(1000.0), 2).alias("distance_km"))


def match_sites(sites_bronze: DataFrame, markets_bronze: DataFrame, coalesce_ring: bool = False,
                one_per_site: bool = False, max_distance_km: float | None = None) -> DataFrame:
    """Every site with its market -- WITHIN (contained) or NEAREST (centroid)."""
    sites = sites_silver(sites_bronze, coalesce_ring)
    markets = markets_silver(markets_bronze)
    # the union and the anti join below both read it: written once
    within = checkpointed(sites_in_market(sites, markets))
    if one_per_site:
        w = Window.partitionBy("site_id").orderBy("market_id")
        within = within.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    kw = {"max_distance": max_distance_km * 1000.0} if max_distance_km is not None else {}
    near = sites_nearest_market(sites, markets, within, **kw)
    a = within.select(*SITE_COLS, *MARKET_COLS, F.lit("WITHIN").alias("match_type"),
                      F.lit(0.0).alias("distance_km"))
    b = near.select(*SITE_COLS, *MARKET_COLS, F.lit("NEAREST").alias("match_type"), "distance_km")
    return a.unionByName(b)


def sites_per_market(enriched: DataFrame) -> DataFrame:
    """Sites per market (name, state), most first."""
    return (enriched.groupBy("market_name", "state").agg(F.count(F.lit(1)).alias("sites"))
            .orderBy(F.desc("sites"), "market_name", "state"))


# ------------------------------------------------------------------ summaries over the coverage table
def tower_type_summary(cov: DataFrame, decimals: int = 1) -> DataFrame:
    """A10: by nearest tower type -- buildings, distance avg/min/max, speeds, providers."""
    d = F.col("distance_to_tower_m")
    return (cov.filter(F.col("best_download_mbps").isNotNull())
            .groupBy("nearest_tower_type")
            .agg(F.count(F.lit(1)).alias("buildings"),
                 F.round(F.avg(d), decimals).alias("avg_distance_m"),
                 F.round(F.min(d), decimals).alias("min_distance_m"),
                 F.round(F.max(d), decimals).alias("max_distance_m"),
                 F.round(F.avg("best_download_mbps"), 1).alias("avg_download_mbps"),
                 F.round(F.avg("best_upload_mbps"), 1).alias("avg_upload_mbps"),
                 F.round(F.avg("provider_count"), 1).alias("avg_providers")))


def covered_share(df: DataFrame, covered) -> DataFrame:
    """Total, covered and covered percentage in one pass."""
    cond = F.expr(covered) if isinstance(covered, str) else covered
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(cond).alias("covered")).select(
        "total", "covered",
        F.round(F.col("covered") * F.lit(100.0) / F.col("total"), 1).alias("covered_pct"))


def class_summary(df: DataFrame, keys, value: str, value_alias: str, decimals: int = 1, rows: str | None = None) -> DataFrame:
    """Count and rounded average per class (or per pair of classes).

    With ``rows`` a row of ``df`` stands for that many, and ``value`` is a struct of the ``total`` and the number ``n`` of
    their known values."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    count, mean = F.count(F.lit(1)), F.avg(value)
    if rows is not None:
        n = F.sum(F.col(value)["n"])
        count, mean = F.sum(rows), F.when(n > 0, F.sum(F.col(value)["total"]) / n)
    return df.groupBy(*keys).agg(count.alias("buildings"), F.round(mean, decimals).alias(value_alias))


def describe_numeric(df: DataFrame, col: str, quantiles=(0.05, 0.95), **kw) -> DataFrame:
    """Min / median / max / quantiles / sum of one column (exact percentiles, see ``operators.quantiles``)."""
    c = F.col(col)
    ends = df.agg(F.min(c).alias("min"), F.max(c).alias("max"), F.sum(c).alias("sum"), F.lit(1).alias("_one"))
    names = [f"p{int(round(q * 100)):02d}" for q in quantiles]
    ranks = exact_percentiles(df, [], [("median", c, 0.5), *zip(names, [c] * len(names), quantiles)], **kw).withColumn("_one", F.lit(1))
    return ends.join(ranks, "_one").select("min", "median", "max", *names, "sum")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------------ enriched buildings (L4)
def _near_buildings(buildings: DataFrame, towers: DataFrame, box: BBox) -> DataFrame:
    """Buildings in the box with nearest tower and proximity band.  Both depend on the building only: they are found
    before the coverage rows multiply the buildings."""
    b = downtown_buildings(buildings, box)
    carry = {"tower_id": "nearest_tower_id", "tower_type": "nearest_tower_radio", "cell_id": "nearest_tower_cell_id",
             "latitude": "nearest_tower_lat", "longitude": "nearest_tower_lon"}
    t = towers.select(F.col("latitude").alias("_tlat"), F.col("longitude").alias("_tlon"),
                      *[F.col(k).alias(v) for k, v in carry.items()])
    near = nearest(b, t, left_xy=("centroid_lon", "centroid_lat"),
                   right_xy=("_tlon", "_tlat"), right_id="nearest_tower_id", right_cols=list(carry.values()),
                   dist_col="_dist")
    return near.select("building_id", "height", "centroid_lat", "centroid_lon", "h3_res9_id", "nearest_tower_id", "nearest_tower_radio",
                       "nearest_tower_cell_id", F.round("_dist", 1).alias("nearest_tower_distance_m"),
                       B.band("_dist", B.PROXIMITY_BANDS, B.PROXIMITY_BANDS_ELSE).alias("tower_proximity_band"))


def _quality_cells(cells: DataFrame) -> DataFrame:
    return cells.select(
        "h3_res9_id", "fid", "technology", F.col("mindown").alias("min_download_mbps"), F.col("minup").alias("min_upload_mbps"),
        F.col("environmnt").alias("environment_type"), B.coverage_quality("technology", "mindown").alias("coverage_quality"))


def _quality_or_none() -> Column:
    """The quality class; a building without coverage rows has the class of a missing technology."""
    none = F.lit(None).cast("int")
    return F.coalesce(F.col("coverage_quality"), B.coverage_quality(none, none))


def enriched_buildings(buildings: DataFrame, cells: DataFrame, towers: DataFrame, box: BBox = ANALYSIS_BOX
                       ) -> DataFrame:
    """L4: buildings x coverage rows (LEFT, un-aggregated) x nearest tower, with classes."""
    near = _near_buildings(buildings, towers, box)
    out = cell_join(near, _quality_cells(cells), "h3_res9_id", "left",
                    cell_cols=("fid", "technology", "min_download_mbps", "min_upload_mbps", "environment_type", "coverage_quality"))
    return out.select(
        "building_id", "height", "centroid_lat", "centroid_lon", "h3_res9_id", "fid", "technology", "min_download_mbps",
        "min_upload_mbps", "environment_type", _quality_or_none().alias("coverage_quality"),
        "nearest_tower_id", "nearest_tower_radio", "nearest_tower_cell_id", "nearest_tower_distance_m", "tower_proximity_band")


def enriched_classes(buildings: DataFrame, cells: DataFrame, towers: DataFrame, box: BBox = ANALYSIS_BOX) -> DataFrame:
    """What ``class_summary`` needs of ``enriched_buildings``, without making its rows: one row for each cell, proximity
    band and quality class, with the number of ``rows`` and ``total`` and ``n`` of the values that are averaged.

    Buildings and coverage rows are counted by cell and class before they meet, so a cell gives at most as many rows as
    it has pairs of classes, however many pairs of a building and a coverage row it has."""
    def known(column: str) -> Column:
        value = F.col(column).cast("double")
        return F.struct(F.sum(value).alias("total"), F.count(value).alias("n")).alias(column)

    def times(column: str, copies: Column) -> Column:
        return F.struct((F.col(column)["total"] * copies).alias("total"),
                        (F.coalesce(F.col(column)["n"], F.lit(0).cast("long")) * copies).alias("n")).alias(column)

    places = _near_buildings(buildings, towers, box).groupBy("h3_res9_id", "tower_proximity_band").agg(
        F.count(F.lit(1)).alias("_buildings"), known("nearest_tower_distance_m"))
    classes = _quality_cells(cells).groupBy("h3_res9_id", "coverage_quality").agg(F.count(F.lit(1)).alias("_cells"), known("min_download_mbps"))
    met = cell_join(places, classes, "h3_res9_id", "left", cell_cols=("coverage_quality", "_cells", "min_download_mbps"))
    n_buildings, n_cells = F.col("_buildings"), F.coalesce(F.col("_cells"), F.lit(1).cast("long"))
    return met.select("h3_res9_id", "tower_proximity_band", _quality_or_none().alias("coverage_quality"),
                      (n_buildings * n_cells).alias("rows"), times("nearest_tower_distance_m", n_cells), times("min_download_mbps", n_buildings))


# ------------------------------------------------------------------ signal analysis
def signal_analysis(cells: DataFrame, buildings: DataFrame, towers: DataFrame, res: int = 9) -> DataFrame:
    """Per coverage row -- buildings and towers inside its hexagon, areas, signal score.

    "Point inside the hexagon" is exactly "point's cell key equals the
    hexagon's key" on this grid, so the containment join is an equi-join on
    the key, pre-aggregated per key before it meets the coverage rows.
    """
    from towerlens.functions.geo import area_m2

    b = with_centroid(buildings, area_col="_a")
    b = b.select("building_id", "_a", cell_id("centroid_lon", "centroid_lat", res).alias("h3_res9_id"))
    density = b.groupBy("h3_res9_id").agg(F.count_distinct("building_id").alias("buildings_in_hex"),
                                          F.avg("_a").alias("avg_building_area_sqm"),
                                          F.sum("_a").alias("total_building_area_sqm"))
    t = towers.select("tower_id", cell_id("longitude", "latitude", res).alias("h3_res9_id"))
    tcount = t.groupBy("h3_res9_id").agg(F.count_distinct("tower_id").alias("towers_in_hex"))
    from towerlens.operators.coverage import keyed_left_join

    j = keyed_left_join(cells.select("fid", "h3_res9_id", "mindown", "minup"), density, ["h3_res9_id"], "left")
    j = keyed_left_join(j, tcount, ["h3_res9_id"], "left")
    nb = F.coalesce(F.col("buildings_in_hex"), F.lit(0).cast("bigint"))
    nt = F.coalesce(F.col("towers_in_hex"), F.lit(0).cast("bigint"))
    return j.select(
        "h3_res9_id", "fid", F.col("mindown").alias("download_speed_mbps"), F.col("minup").alias("upload_speed_mbps"),
        nb.alias("building_count"),
        F.round(F.coalesce(F.col("avg_building_area_sqm"), F.lit(0.0)), 3).alias("avg_building_area_sqm"),
        F.round(F.coalesce(F.col("total_building_area_sqm"), F.lit(0.0)), 3).alias("total_building_area_sqm"),
        nt.alias("tower_count"),
        B.signal_score(nt, F.col("mindown"), nb).alias("estimated_signal_quality"))


def signal_distribution(sig: DataFrame) -> DataFrame:
    """Hexagons per signal-quality category."""
    return (sig.withColumn("signal_quality_category",
                           B.band_desc("estimated_signal_quality", B.SIGNAL_CATEGORIES, B.SIGNAL_CATEGORIES_ELSE))
            .groupBy("signal_quality_category")
            .agg(F.count(F.lit(1)).alias("hex_count"),
                 F.round(F.avg("download_speed_mbps"), 1).alias("avg_download_mbps"),
                 F.round(F.avg("building_count"), 1).alias("avg_buildings_per_hex")))


def signal_summary(sig: DataFrame) -> DataFrame:
    """Whole-table summary of the signal analysis."""
    return sig.agg(F.count(F.lit(1)).alias("total_hexagons"),
                   F.round(F.avg("download_speed_mbps"), 1).alias("avg_download_mbps"),
                   F.round(F.avg("upload_speed_mbps"), 1).alias("avg_upload_mbps"),
                   F.sum("building_count").alias("total_buildings_covered"),
                   F.round(F.avg("estimated_signal_quality"), 1).alias("avg_signal_quality"),
                   F.round(F.min("estimated_signal_quality"), 1).alias("min_signal_quality"),
                   F.round(F.max("estimated_signal_quality"), 1).alias("max_signal_quality"))


# ------------------------------------------------------------------ tower exploration
def carrier_towers(towers_raw: DataFrame, net: int = 260, box: BBox = CORE) -> DataFrame:
    """P12 + P7: records of one carrier inside a box."""
    return towers_raw.filter((F.col("net") == net) & box.contains("lat", "lon"))


def carrier_breakdown(towers_raw: DataFrame) -> DataFrame:
    """By radio and network -- records, distinct cells, average range and samples."""
    return (towers_raw.groupBy("radio", "net")
            .agg(F.count(F.lit(1)).alias("record_count"), F.count_distinct("cell").alias("unique_cell_ids"),
                 F.round(F.avg("range_m"), 0).alias("avg_range_m"), F.round(F.avg("samples"), 1).alias("avg_samples")))


def top_towers(towers_raw: DataFrame, k: int = 20) -> DataFrame:
    """T2 + P20: the k towers with most samples (id tie-break) with carrier labels."""
    return (towers_raw.select("radio", F.col("net").alias("mnc"), B.carrier_name("net").alias("carrier"),
                              F.col("area").alias("lac_tac"), F.col("cell").alias("cell_id"), "lon", "lat",
                              "range_m", "samples", "created_ts", "updated_ts")
            .orderBy(F.desc("samples"), F.asc("cell_id")).limit(k))


def explore_towers(spark, path: str, box: BBox = METRO, country: int = 310, k: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From a folder of gzip tower shards to the answers: the country's towers in the box, their breakdown by
    radio and carrier, and the k with most samples.  The shards are read once for each answer that is asked for, with
    the columns that it needs."""
    from towerlens.sources.files import TOWER_COLUMNS, read_headerless_csv

    rows = read_headerless_csv(spark, path, TOWER_COLUMNS, glob="*.csv.gz", recursive=True)
    here = rows.filter((F.col("mcc") == country) & box.contains("lat", "lon"))
    return here, carrier_breakdown(here), top_towers(here, k)


def sample_n(df: DataFrame, n: int, seed: int = 42, key_cols=None) -> DataFrame:
    """T4: reproducible sample of n rows: order by a seeded digest of the key, keep n."""
    return df.withColumn("_h", _digest([F.lit(seed), *map(F.col, key_cols or df.columns)])).orderBy("_h").limit(n).drop("_h")


def sample_with_replacement(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """T4: each row as often as a Poisson draw says."""
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def _digest(cols) -> Column:
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]).cast("binary"))


def with_surrogate_id(df: DataFrame, name: str = "id", natural_keys=None) -> DataFrame:
    """Surrogate id -- a digest of natural keys (the same in every run and engine), else monotonically increasing."""
    if natural_keys:
        return df.withColumn(name, _digest(map(F.col, natural_keys)))
    return df.withColumn(name, F.monotonically_increasing_id())


# ------------------------------------------------------------------ map feeds
def map_points(cov: DataFrame) -> DataFrame:
    """Covered building points with a weight (download speed) for a heat map."""
    return cov.filter(F.col("best_download_mbps") > 0).select(
        "building_id", "centroid_lat", "centroid_lon", F.col("best_download_mbps").alias("weight"),
        B.band_desc("best_download_mbps", B.SPEED_COLOURS, B.SPEED_COLOURS_ELSE).alias("color"))


def map_towers(towers: DataFrame, box: BBox = CORE, pad: float = 0.01) -> DataFrame:
    """Towers inside the padded box for map markers."""
    return towers.filter(box.pad(pad).contains("latitude", "longitude")).select(
        "tower_id", "tower_type", "latitude", "longitude", "coverage_radius_m")


# ------------------------------------------------------------------ transcripts
def enrich_transcripts(df: DataFrame, text_col: str = "transcript", max_words: int = 10) -> DataFrame:
    """Summary and sentiment prepended to every input column."""
    from towerlens.functions.text import sentiment, summarize

    return df.select(summarize(text_col, max_words).alias("transcript_summary"),
                     sentiment(text_col).alias("sentiment"), "*")


def conversation_features(turns: DataFrame, max_words: int = 10) -> DataFrame:
    """Transcript summary and sentiment per conversation without assembling the transcript.

    Both decompose over turns: the leading sentence stops at the turn
    separator, so it comes from the first turn; lexicon counts add up.  Each
    turn is scored where it lies and ``min(struct(turn, summary))`` / sums
    aggregate partially on the map side, so a conversation with a huge
    number of turns never becomes one row or one task's burden.
    """
    from towerlens.functions.text import lexicon_counts, sentiment_label, summarize

    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    per = turns.select("conv_id", "turn", summarize(line, max_words).alias("_s"), lexicon_counts(line).alias("_c"))
    agg = per.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"),
                                     F.min(F.struct("turn", "_s")).alias("_first"),
                                     F.sum(F.col("_c")["pos"]).alias("_p"), F.sum(F.col("_c")["neg"]).alias("_n"))
    return agg.select("conv_id", "turns", F.col("_first")["_s"].alias("transcript_summary"),
                      sentiment_label("_p", "_n").alias("sentiment"))
