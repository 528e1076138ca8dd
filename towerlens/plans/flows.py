"""Dataflows made of the steps in ``towerlens.plans.nodes``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any, ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.functions.bands import DISTANCE_BANDS_DESIGNER, DISTANCE_BANDS_DESIGNER_ELSE, band_sql
from towerlens.operators.nearest import nearest
from towerlens.plans.nodes import PORTS, STEPS, Frames, both


@dataclass(frozen=True)
class Nearest:
    """The nearest right row of every left row, see ``towerlens.operators.nearest``."""

    template: ClassVar[str] = "nearest"
    left: tuple[str, str]
    right: tuple[str, str]
    right_id: str
    columns: Mapping[str, str]
    distance: str
    metric: str

    @classmethod
    def read(cls, config: Mapping[str, Any]) -> Nearest:
        return cls((config["left_lon"], config["left_lat"]), (config["right_lon"], config["right_lat"]), config["right_id"],
                   dict(config.get("right_columns") or {config["right_id"]: config["right_id"]}),
                   config.get("distance_col", "distance_m"), config.get("metric", "sphere"))

    def run(self, frames: Frames, spark: SparkSession, params: Mapping[str, Any]) -> DataFrame:
        left, right = both(frames)
        lon, lat = self.right
        right = right.select(F.col(lon).alias("_nlon"), F.col(lat).alias("_nlat"), *[F.col(k).alias(v) for k, v in self.columns.items()])
        return nearest(left, right, left_xy=self.left, right_xy=("_nlon", "_nlat"), right_id=self.columns[self.right_id],
                       right_cols=list(self.columns.values()), dist_col=self.distance, metric=self.metric)


STEPS[Nearest.template] = Nearest.read


class Flow:
    """Collects steps; each call adds one and returns the reference of its output."""

    def __init__(self) -> None:
        self.steps: list[dict] = []

    def add(self, name: str, template: str, config: Mapping[str, Any], **inputs: str) -> str:
        self.steps.append({"id": name, "template": template, "config": config, "inputs": inputs})
        return f"{name}.{PORTS.get(template, 'written')}"

    def table(self, name: str, table: str) -> str:
        return self.add(name, "source", {"table_source": {"tableName": table}})

    def project(self, name: str, rows: str, *expressions: str) -> str:
        return self.add(name, "transform", {"expressions": list(expressions)}, data=rows)

    def summary(self, name: str, rows: str, by: str, **measures: tuple[str, str]) -> str:
        return self.add(name, "aggregate", {"group_bys": [{"expr": by}], "aggregations": [
            {"fn": fn, "columnExpr": {"expr": of}, "alias": alias} for alias, (fn, of) in measures.items()]}, data=rows)


# Columns of the coverage output, one row per building and technology.
COVERAGE_OUTPUT = ("building_id", "height", "geometry", "h3_res9_id", "technology", "mindown", "minup", "environmnt",
                   "nearest_tower_id", "nearest_tower_carrier", "nearest_tower_type", "coverage_radius_m", "distance_to_nearest_tower_m")


def designer_coverage_flow(towers_table: str, cells_table: str, buildings_table: str, output_table: str | None = None) -> list[dict]:
    """Coverage of each building by technology with its nearest tower (``coverage.joined_data``), and figures by distance
    (``by_distance.aggregated_data``).

    A building's nearest tower does not depend on the technology: it is searched once per building, before the
    coverage rows multiply them.  Of several coverage rows of a building and technology the one with the lowest
    ``fid`` counts, by ``min`` over a struct, which combines before the shuffle."""
    flow = Flow()
    towers, cells = flow.table("towers", towers_table), flow.table("cells", cells_table)
    shapes = flow.project("shapes", flow.table("buildings", buildings_table),
                          "building_id", "height", "geometry", "ST_Centroid(geometry) AS centre")
    placed = flow.project("placed", shapes, "building_id", "height", "geometry",
                          "h3_h3tostring(h3_pointash3(ST_AsText(centre), 9)) AS h3_res9_id",
                          "ST_X(centre) AS centroid_lon", "ST_Y(centre) AS centroid_lat")
    near = flow.add("near", "nearest", {
        "left_lon": "centroid_lon", "left_lat": "centroid_lat", "right_lon": "longitude", "right_lat": "latitude", "right_id": "tower_id",
        "right_columns": {"tower_id": "nearest_tower_id", "carrier": "nearest_tower_carrier", "tower_type": "nearest_tower_type",
                          "coverage_radius_m": "coverage_radius_m"}, "distance_col": "distance_to_nearest_tower_m"},
        left=placed, right=towers)
    best = flow.add("best", "sql", {"query": """
        SELECT h3_res9_id AS cell, technology AS best_technology, min(struct(fid, mindown, minup, environmnt)) AS best
        FROM cells_in GROUP BY h3_res9_id, technology"""}, cells_in=cells)
    coverage = flow.add("coverage", "join", {
        "join_type": "inner", "join_conditions": "left.h3_res9_id = right.cell",
        "expressions": [{"technology": "best_technology AS technology"}.get(c, f"best.{c}" if c in ("mindown", "minup", "environmnt") else c)
                        for c in COVERAGE_OUTPUT]}, left=near, right=best)
    band = band_sql("distance_to_nearest_tower_m", DISTANCE_BANDS_DESIGNER, DISTANCE_BANDS_DESIGNER_ELSE)
    banded = flow.project("banded", coverage, "mindown", "minup", f"{band} AS distance_bucket")
    figures = {f"{fn}_{of}": (fn.upper(), of) for of in ("mindown", "minup") for fn in ("avg", "min", "max")}
    flow.summary("by_distance", banded, "distance_bucket", **figures, building_count=("COUNT", "distance_bucket"))
    if output_table:
        schema, _, table = output_table.rpartition(".")
        flow.add("written", "output", {"schema": schema, "table_name": table}, data=coverage)
    return flow.steps


def tower_type_count_flow(towers_table: str) -> list[dict]:
    """Towers by type (``by_type.aggregated_data``)."""
    flow = Flow()
    flow.summary("by_type", flow.table("towers", towers_table), "tower_type", tower_count=("COUNT", "tower_id"))
    return flow.steps


def transcript_flow(table: str) -> list[dict]:
    """Transcripts with summary and sentiment in front (``scored.enriched_data``)."""
    flow = Flow()
    flow.add("scored", "enrich", {"expressions": ["ai_summarize(transcript, 10) AS transcript_summary",
                                                  "ai_analyze_sentiment(transcript) AS sentiment"]}, data=flow.table("transcripts", table))
    return flow.steps
