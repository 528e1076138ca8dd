"""Data-quality expectations: warn, drop and fail rules.

A rule is (name, predicate, action).  ``Watched`` counts all rules of a dataset
while its rows are written, so a table and its counts take one pass; what
breaks a ``fail`` rule is never published.  ``expectation_metrics`` counts a
frame that is not written.  ``drop`` rules become one filter.  A rule passes
only when its predicate is TRUE (NULL is a violation) unless
``null_passes=True``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.functions.cells import h3_is_valid_string
from towerlens.functions.geo import geometry_type, is_valid, poly_from_wkt

WARN, DROP, FAIL = "warn", "drop", "fail"


class ExpectationFailed(RuntimeError):
    pass


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str | Callable[[], Column]
    action: str = WARN

    def column(self) -> Column:
        return self.predicate() if callable(self.predicate) else F.expr(self.predicate)


def expect(name, predicate):
    return Expectation(name, predicate, WARN)


def expect_or_drop(name, predicate):
    return Expectation(name, predicate, DROP)


def expect_or_fail(name, predicate):
    return Expectation(name, predicate, FAIL)


def _ok(rule: Expectation, null_passes: bool) -> Column:
    return F.coalesce(rule.column(), F.lit(null_passes))


def expectation_metrics(df: DataFrame, rules: Sequence[Expectation], dataset: str = "",
                        null_passes: bool = False) -> DataFrame:
    """One row per rule: dataset, rule, action, passed, failed (one pass over ``df``)."""
    aggs = []
    for i, r in enumerate(rules):
        aggs.append(F.count_if(_ok(r, null_passes)).alias(f"p{i}"))
        aggs.append(F.count_if(~_ok(r, null_passes)).alias(f"f{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                              F.col(f"p{i}").alias("passed"), F.col(f"f{i}").alias("failed"))
                     for i, r in enumerate(rules)])
    return wide.select(F.lit(dataset).alias("dataset"), F.inline(rows))


def apply_expectations(df: DataFrame, rules: Sequence[Expectation], dataset: str = "",
                       null_passes: bool = False, check_fail: bool = True) -> tuple[DataFrame, DataFrame]:
    """Returns (rows kept by the drop rules, metrics).

    ``fail`` rules are checked eagerly (one aggregation job) and raise
    ``ExpectationFailed`` on any violation, so a caller that writes only
    after this returns never commits a failing dataset.
    """
    metrics = expectation_metrics(df, rules, dataset, null_passes)
    fail_rules = [r for r in rules if r.action == FAIL]
    if check_fail and fail_rules:
        bad = expectation_metrics(df, fail_rules, dataset, null_passes).filter("failed > 0").collect()
        if bad:
            detail = ", ".join(f"{b['rule']} ({b['failed']} rows)" for b in bad)
            raise ExpectationFailed(f"{dataset}: expectation failed: {detail}")
    return dropped(df, rules, null_passes), metrics


def dropped(df: DataFrame, rules: Sequence[Expectation], null_passes: bool = False) -> DataFrame:
    """The rows that all drop rules let through."""
    keep = [_ok(r, null_passes) for r in rules if r.action == DROP]
    return df.filter(reduce(lambda a, b: a & b, keep)) if keep else df


class Watched:
    """Rows that are counted by rule while something else reads them: ``rows`` has the drop rules applied behind the
    counters, so one pass (the write of those rows) gives the table and the counts."""

    def __init__(self, df: DataFrame, rules: Sequence[Expectation], dataset: str = "", null_passes: bool = False):
        from pyspark.sql import Observation

        self.rules, self.dataset, self._seen = list(rules), dataset, Observation()
        counts = [F.count_if(~_ok(r, null_passes)).alias(f"f{i}") for i, r in enumerate(self.rules)]
        self.rows = dropped(df.observe(self._seen, F.count(F.lit(1)).alias("n"), *counts), rules, null_passes)

    def counts(self) -> list[tuple[str, str, str, int, int]]:
        """Dataset, rule, action, passed and failed, once the rows have been read to their end."""
        seen = self._seen.get
        return [(self.dataset, r.name, r.action, seen["n"] - seen[f"f{i}"], seen[f"f{i}"]) for i, r in enumerate(self.rules)]

    def check(self) -> None:
        """Raise if a fail rule was broken."""
        bad = [f"{name} ({failed} rows)" for _, name, action, _, failed in self.counts() if action == FAIL and failed]
        if bad:
            raise ExpectationFailed(f"{self.dataset}: expectation failed: {', '.join(bad)}")


COUNTS = "dataset string, rule string, action string, passed long, failed long"


# ------------------------------------------------------------------ rule catalogue
def _h3_ok(col: str) -> Callable[[], Column]:
    # accepts an H3 hex id, or a key of the hexagonal grid used by this library
    return lambda: h3_is_valid_string(F.col(col)) | F.col(col).rlike(r"^[0-9]{1,2}:-?[0-9]+:-?[0-9]+$")


def _valid_geometry() -> Column:
    return is_valid(poly_from_wkt(F.col("geometry")), check_self_intersection=True)


def _point_geometry() -> Column:
    return geometry_type(F.col("location")) == "ST_Point"


def _centroid_in_metro() -> Column:
    from towerlens.functions.geo import centroid

    c = centroid(poly_from_wkt(F.col("geometry")))
    return c["y"].between(47.40, 47.80) & c["x"].between(-122.50, -122.10)


# The reference's rules, by dataset (name, predicate, action).
RULES: dict[str, list[Expectation]] = {
    "bronze_fcc_bdc_h3": [
        expect("valid_fid", "fid IS NOT NULL"),
        expect_or_drop("parsable_h3", _h3_ok("h3_res9_id")),
        expect("known_technology", "technology IS NOT NULL"),
    ],
    "bronze_building_footprints": [
        expect_or_drop("wkt_present", "wkt IS NOT NULL"),
        expect_or_drop("polygon_format", "wkt LIKE 'POLYGON%'"),
        expect("non_negative_height", "height IS NULL OR height >= 0"),
    ],
    "bronze_cell_towers": [
        expect_or_drop("non_null_cell", "cell IS NOT NULL"),
        expect_or_drop("valid_mcc_310", "mcc = 310"),
        expect_or_drop("valid_lat_lon", "lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"),
    ],
    "ops_app_bronze_tower_hourly_kpis": [
        expect_or_drop("tower_id_not_null", "tower_id IS NOT NULL"),
        expect_or_drop("utilization_in_bounds", "prb_utilization_pct BETWEEN 0 AND 100"),
        expect_or_drop("latency_positive", "latency_ms > 0"),
    ],
    "ops_app_bronze_building_hourly_demand": [
        expect_or_drop("building_id_not_null", "building_id IS NOT NULL"),
        expect_or_drop("non_negative_demand_users", "demand_users >= 0"),
        expect_or_drop("indoor_penetration_in_range", "indoor_penetration_factor BETWEEN 0.4 AND 1.0"),
    ],
    "silver_fcc_bdc_h3_seattle": [
        expect_or_drop("in_seattle_bbox", "center_lat BETWEEN 47.40 AND 47.80 AND center_lon BETWEEN -122.50 AND -122.10"),
        expect("known_5g_technology", "technology IS NOT NULL"),
        expect("non_null_speeds", "mindown IS NOT NULL AND minup IS NOT NULL"),
    ],
    "silver_building_footprints_seattle": [
        expect_or_drop("valid_geometry", _valid_geometry),
        expect_or_drop("centroid_in_seattle_bbox", _centroid_in_metro),
        expect("non_negative_height", "height IS NULL OR height >= 0"),
    ],
    "silver_tmobile_towers_seattle": [
        expect_or_fail("tmobile_only", "net = 260"),
        expect_or_fail("point_geometry", _point_geometry),
        expect_or_drop("in_seattle_bbox", "latitude BETWEEN 47.40 AND 47.80 AND longitude BETWEEN -122.50 AND -122.10"),
        expect("radius_positive", "coverage_radius_m IS NULL OR coverage_radius_m > 0"),
    ],
    "ops_app_silver_tower_kpis_latest": [
        expect_or_drop("valid_utilization", "prb_utilization_pct BETWEEN 0 AND 100"),
        expect_or_drop("valid_packet_loss", "packet_loss_pct BETWEEN 0 AND 100"),
        expect_or_drop("valid_throughput", "throughput_mbps >= 0"),
    ],
    "ops_app_silver_building_demand_latest": [
        expect_or_drop("valid_demand_users", "demand_users >= 0"),
        expect("valid_mix", "traffic_mix IN ('video_heavy', 'commute', 'balanced')"),
    ],
    "gold_downtown_building_coverage": [
        expect_or_fail("non_negative_speeds", "best_download_mbps >= 0 AND best_upload_mbps >= 0"),
        expect_or_fail("reasonable_distance", "distance_to_tower_m BETWEEN 0 AND 50000"),
        expect_or_fail("valid_h3", _h3_ok("h3_res9_id")),
        expect_or_drop("has_nearest_tower", "nearest_tower_id IS NOT NULL"),
        expect("has_5g_coverage", "best_download_mbps > 0"),
    ],
    "gold_coverage_by_distance_bucket": [
        expect_or_fail("bucket_has_buildings", "buildings > 0"),
        expect_or_fail("non_negative_avg_speed", "avg_download_mbps >= 0"),
        expect("non_null_avg_speed", "avg_download_mbps IS NOT NULL"),
    ],
    "ops_app_gold_downtown_building_coverage": [
        expect_or_fail("non_negative_download", "best_download_mbps >= 0"),
        expect_or_drop("has_building_id", "building_id IS NOT NULL"),
        expect_or_drop("has_nearest_tower", "nearest_tower_id IS NOT NULL"),
    ],
}
