"""Registered queries on how tables are kept: rules counted while written, layouts, feeds that stay current, resets;
and on the k nearest.  Part of the registry in ``towerlens.queries``."""

from __future__ import annotations

from pyspark.sql import functions as F

from towerlens.oracle import sround
from towerlens.plans import fixtures as fx
from towerlens.queries import (_KPI_RULES_SQL, BLD_CTE, _csv_folder, _nearest_all, _ranked_sql, query, with_)

_KPI_CSV = {"header": "false", "compression": "gzip", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
_KPI_NAMES = "tower_id, event_ts, prb_utilization_pct, latency_ms, packet_loss_pct, throughput_mbps"


# ------------------------------------------------------------------ the k nearest
_K_SQL = with_([fx.BUILDINGS_SQL, BLD_CTE, fx.TOWERS_SQL, _ranked_sql("bld b", "b.building_id", "b.centroid_lon", "b.centroid_lat")], f"""
SELECT building_id, nearest_tower_id, nearest_tower_type, {sround('d', 1)} AS distance_to_tower_m, CAST(rn AS INTEGER) AS place
FROM ranked WHERE rn <= 3""")


def _three_nearest(spark, sf_dir, **kw):
    return _nearest_all(spark, sf_dir, k=3, rank_col="place", **kw).select(
        "building_id", "nearest_tower_id", "nearest_tower_type", F.round("_d", 1).alias("distance_to_tower_m"), "place")


@query("nearest_k", _K_SQL)
def q_nearest_k(spark, sf_dir):
    return _three_nearest(spark, sf_dir)


@query("nearest_k_blocks", _K_SQL)
def q_nearest_k_blocks(spark, sf_dir):
    return _three_nearest(spark, sf_dir, block_points=100)


# ------------------------------------------------------------------ rules counted while rows are written
@query("published_counts", with_([fx.RAW_KPIS_SQL], "\nUNION ALL\n".join(
    f"SELECT 'kpis' AS dataset, '{n}' AS rule, '{a}' AS action, COUNT(*) FILTER (WHERE coalesce({p}, false)) AS passed, "
    f"COUNT(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed, (SELECT COUNT(*) FROM raw_kpis WHERE "
    + " AND ".join(f"coalesce({q}, false)" for _, _, q in _KPI_RULES_SQL) + ") AS rows_published FROM raw_kpis" for n, a, p in _KPI_RULES_SQL)))
def q_published_counts(spark, sf_dir):
    from towerlens.plans.datasets import publish
    from towerlens.plans.quality import RULES

    path = _csv_folder(spark, "published") + "/kpis"
    counts = publish(fx.raw_kpis(spark, sf_dir), RULES["ops_app_bronze_tower_hourly_kpis"], path, "kpis", cluster_by=("tower_id",))
    return counts.withColumn("rows_published", F.lit(spark.read.parquet(path).count()))


@query("stream_rule_counts", with_([fx.RAW_KPIS_SQL], "\nUNION ALL\n".join(
    f"SELECT CAST(CASE WHEN event_ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END AS BIGINT) AS epoch, '{n}' AS rule, '{a}' AS action, "
    f"COUNT(*) FILTER (WHERE coalesce({p}, false)) AS passed, COUNT(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed "
    f"FROM raw_kpis GROUP BY 1" for n, a, p in _KPI_RULES_SQL)))
def q_stream_rule_counts(spark, sf_dir):
    from towerlens.plans.quality import RULES
    from towerlens.sources.files import KPI_COLUMNS
    from towerlens.streaming.ingest import rule_counts, stream_csv_dir, stream_to_table

    root = _csv_folder(spark, "counted")
    raw, day = fx.raw_kpis(spark, sf_dir).drop("event_id"), F.lit("2024-01-15").cast("timestamp_ntz")
    for name, shard in (("a", raw.filter(F.col("event_ts") < day)), ("b", raw.filter(F.col("event_ts") >= day))):
        shard.write.options(**_KPI_CSV).csv(f"{root}/in/{name}")
        stream_to_table(stream_csv_dir(spark, f"{root}/in", KPI_COLUMNS), f"{root}/table", f"{root}/checkpoint",
                        RULES["ops_app_bronze_tower_hourly_kpis"])
    return rule_counts(spark, f"{root}/table")


# ------------------------------------------------------------------ layout (K6)
_BOX = (47.595, 47.605, -122.355, -122.345)      # latitude and longitude
_BOX_SQL = f"centroid_lat BETWEEN {_BOX[0]}e0 AND {_BOX[1]}e0 AND centroid_lon BETWEEN {_BOX[2]}e0 AND {_BOX[3]}e0"


@query("layout_pruning", with_([fx.BUILDINGS_SQL, BLD_CTE], f"""
SELECT COUNT(*) AS rows_in_box, CAST(SUM(building_id) AS BIGINT) AS id_sum, true AS few_files, true AS fewer_than_by_latitude
FROM bld WHERE {_BOX_SQL}"""))
def q_layout_pruning(spark, sf_dir):
    """Buildings in 64 files on the curve: files that a box on both coordinates has to open, by their statistics, against
    the same number of files ordered by latitude, then longitude."""
    from towerlens.plans.pipelines import with_centroid
    from towerlens.sources.tables import file_statistics, write_table

    root, columns = _csv_folder(spark, "layout"), ["centroid_lat", "centroid_lon"]
    placed = with_centroid(fx.buildings(spark, sf_dir)).select("building_id", *columns)
    write_table(placed, path=f"{root}/curve", files=64, cluster_by=columns)
    placed.repartitionByRange(64, *columns).write.parquet(f"{root}/order")
    met = F.expr(f"max_centroid_lat >= {_BOX[0]} AND min_centroid_lat <= {_BOX[1]} AND max_centroid_lon >= {_BOX[2]} AND min_centroid_lon <= {_BOX[3]}")

    def opened(name):
        files = file_statistics(spark.read.parquet(f"{root}/{name}"), columns)
        return files.agg(F.count_if(met).alias(name), F.count(F.lit(1)).alias(f"{name}_files")).withColumn("one", F.lit(1))

    box = spark.read.parquet(f"{root}/curve").filter(_BOX_SQL.replace("e0", "")).agg(
        F.count(F.lit(1)).alias("rows_in_box"), F.sum(F.col("building_id").cast("long")).alias("id_sum"), F.lit(1).alias("one"))
    return box.join(opened("curve"), "one").join(opened("order"), "one").select(
        "rows_in_box", "id_sum", (4 * F.col("curve") <= F.col("curve_files")).alias("few_files"),
        (F.col("curve") < F.col("order")).alias("fewer_than_by_latitude"))


# ------------------------------------------------------------------ latest row per key, kept current (R8), and resets
_LATEST_SQL = with_([fx.RAW_KPIS_SQL], f"""
SELECT {_KPI_NAMES} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tower_id ORDER BY event_ts DESC, prb_utilization_pct DESC NULLS LAST, latency_ms DESC NULLS LAST,
                               packet_loss_pct DESC NULLS LAST, throughput_mbps DESC NULLS LAST) AS rn FROM raw_kpis) WHERE rn = 1""")


@query("stream_latest_continuous", _LATEST_SQL)
def q_stream_latest(spark, sf_dir):
    """Five shards of mixed age, so that most hold rows older than the table's, and the second one twice."""
    from towerlens.sources.files import KPI_COLUMNS
    from towerlens.streaming.ingest import latest_per_key_stream, read_latest, stream_csv_dir

    root = _csv_folder(spark, "latest")
    raw = fx.raw_kpis(spark, sf_dir)
    share = F.pmod(F.xxhash64("event_id"), F.lit(5))
    for name, part in (("a", 0), ("b", 1), ("c", 2), ("again", 1), ("d", 3), ("e", 4)):
        raw.filter(share == part).drop("event_id").write.options(**_KPI_CSV).csv(f"{root}/in/{name}")
        latest_per_key_stream(stream_csv_dir(spark, f"{root}/in", KPI_COLUMNS), ["tower_id"], "event_ts", None, f"{root}/state",
                              f"{root}/checkpoint", buckets=16)
    return read_latest(spark, f"{root}/state").withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query("stream_reset", with_([fx.RAW_KPIS_SQL], "SELECT COUNT(*) AS n, COUNT(*) AS n_after_reset, COUNT(DISTINCT tower_id) AS towers FROM raw_kpis WHERE "
                             + " AND ".join(f"coalesce({p}, false)" for _, _, p in _KPI_RULES_SQL)))
def q_stream_reset(spark, sf_dir):
    from towerlens.plans.quality import RULES
    from towerlens.sources.files import KPI_COLUMNS
    from towerlens.streaming.ingest import generation, read_appended, reset_stream, stream_csv_dir, stream_to_table

    root = _csv_folder(spark, "reset")
    fx.raw_kpis(spark, sf_dir).drop("event_id").write.options(**_KPI_CSV).csv(f"{root}/in/shard")

    def update(folders):
        stream_to_table(stream_csv_dir(spark, f"{root}/in", KPI_COLUMNS), *folders, RULES["ops_app_bronze_tower_hourly_kpis"])
        return read_appended(spark, folders[0])

    n = update(generation(spark, f"{root}/feed")).count()
    again = update(reset_stream(spark, f"{root}/feed"))
    return again.agg(F.lit(n).cast("long").alias("n"), F.count(F.lit(1)).alias("n_after_reset"), F.count_distinct("tower_id").alias("towers"))


# ------------------------------------------------------------------ zipped shapefiles
@query("shapefile_archives", with_([fx.BUILDINGS_SQL, BLD_CTE], f"""
SELECT building_id, height, {sround('centroid_lon', 7)} AS centroid_lon, {sround('centroid_lat', 7)} AS centroid_lat,
       'part-' || (building_id // 400) || '.zip' AS archive FROM bld"""))
def q_shapefile_archives(spark, sf_dir):
    """The buildings, written to zipped shapefiles of 400 and read from all of them at once."""
    from towerlens.functions.geo import centroid, materialize, poly_from_wkt
    from towerlens.sources.archives import shapes_in

    read = shapes_in(fx.building_archives(spark, sf_dir), "bldg_footprints", "height")
    words = F.split("attribute", " ")
    placed = materialize(read, c=centroid(poly_from_wkt("wkt")))
    return placed.select(words.getItem(0).cast("long").alias("building_id"), F.get(words, F.lit(1)).cast("double").alias("height"),
                         F.round("c.x", 7).alias("centroid_lon"), F.round("c.y", 7).alias("centroid_lat"), "archive")
