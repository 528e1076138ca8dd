"""The coverage datasets from bronze to gold, registered with their rules and layout.

Bronze frames come from the caller (files, streams or tables); everything after
them is built here.  Silver tables carry what later steps filter and join by (centroids, cells, cell
centres), so geometry is parsed once, and are laid out by it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.functions.cells import cell_center, cell_id
from towerlens.functions.geo import materialize
from towerlens.plans import pipelines as pl
from towerlens.plans.datasets import Registry
from towerlens.plans.quality import RULES

# The carrier of the silver tower table.
CARRIER, CARRIER_NET = "T-Mobile", 260

BRONZE = ("bronze_fcc_bdc_h3", "bronze_building_footprints", "bronze_cell_towers", "ops_app_bronze_tower_hourly_kpis",
          "ops_app_bronze_building_hourly_demand")


def silver_towers(bronze: DataFrame, box: pl.BBox = pl.METRO) -> DataFrame:
    """One carrier's towers inside the box, under the names that later steps use; the cell number is the id."""
    return pl.carrier_towers(bronze, CARRIER_NET, box).select(
        F.col("cell").alias("tower_id"), F.lit(CARRIER).alias("carrier"), F.col("radio").alias("tower_type"), "net",
        F.col("area").alias("lac_tac"), F.col("cell").alias("cell_id"), F.col("range_m").alias("coverage_radius_m"), "samples",
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "created_ts", "updated_ts", "avg_signal",
        F.format_string("POINT (%s %s)", F.col("lon").cast("string"), F.col("lat").cast("string")).alias("location"))


def silver_buildings(bronze: DataFrame, box: pl.BBox = pl.METRO) -> DataFrame:
    """Footprints whose centroid lies in the box, with centroid and cell."""
    placed = pl.with_centroid(bronze.withColumnRenamed("wkt", "geometry"))
    return placed.filter(box.contains("centroid_lat", "centroid_lon")).withColumn("h3_res9_id", cell_id("centroid_lon", "centroid_lat"))


def silver_cells(bronze: DataFrame, box: pl.BBox = pl.METRO) -> DataFrame:
    """Coverage rows whose cell centre lies in the box, with that centre."""
    centred = materialize(bronze, _c=cell_center("h3_res9_id")).withColumns(
        {"center_lat": F.col("_c")["y"], "center_lon": F.col("_c")["x"]}).drop("_c")
    return centred.filter(box.contains("center_lat", "center_lon"))


def coverage_registry(bronze: Mapping[str, Callable[[SparkSession], DataFrame]]) -> Registry:
    """All datasets; ``bronze`` gives a function for each name in ``BRONZE`` that is wanted."""
    registry = Registry()

    def add(name: str, build, *upstream: str, cluster_by: tuple[str, ...] = ()) -> None:
        registry.dataset(name, upstream, RULES[name], cluster_by)(lambda spark, made: build(*(made[u] for u in upstream)))

    for name, read in bronze.items():
        registry.dataset(name, (), RULES[name])(lambda spark, made, read=read: read(spark))
    add("silver_tmobile_towers_seattle", silver_towers, "bronze_cell_towers", cluster_by=("latitude", "longitude"))
    add("silver_building_footprints_seattle", silver_buildings, "bronze_building_footprints", cluster_by=("h3_res9_id",))
    add("silver_fcc_bdc_h3_seattle", silver_cells, "bronze_fcc_bdc_h3", cluster_by=("h3_res9_id",))
    add("gold_downtown_building_coverage", pl.building_coverage, "silver_building_footprints_seattle", "silver_fcc_bdc_h3_seattle",
        "silver_tmobile_towers_seattle", cluster_by=("h3_res9_id",))
    add("gold_coverage_by_distance_bucket", pl.coverage_by_distance, "gold_downtown_building_coverage")
    add("ops_app_silver_tower_kpis_latest", pl.kpis_latest, "ops_app_bronze_tower_hourly_kpis", cluster_by=("tower_id",))
    add("ops_app_silver_building_demand_latest", pl.demand_latest, "ops_app_bronze_building_hourly_demand", cluster_by=("building_id",))
    add("ops_app_gold_downtown_building_coverage", pl.ops_overlay, "gold_downtown_building_coverage",
        "ops_app_silver_building_demand_latest", "ops_app_silver_tower_kpis_latest", cluster_by=("h3_res9_id",))
    return registry
