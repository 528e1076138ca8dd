"""Operators against brute force: nearest, contains-join, latest per key, salted joins."""

import pytest
import towerlens.operators.nearest as nearest_module
from pyspark.sql import functions as F

from towerlens.operators.latest import latest_per_key
from tests.nearest_plain import nearest_bruteforce
from towerlens.operators.nearest import nearest
from towerlens.operators.skew import salted_join
from towerlens.operators.spatial_join import contains_counts, contains_join


def search(kw):
    return {k: v for k, v in kw.items() if k != "left_keys"}


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def points(spark):
    # clustered and spread points; some exact duplicates of tower positions
    return spark.range(600).select(
        F.col("id").alias("pid"),
        F.when(F.col("id") % 3 == 0, F.lit(-122.34) + (F.col("id") % 17) * 1e-4)
        .otherwise(F.lit(-122.9) + (F.col("id") * 7919 % 1000) / 800.0).alias("x"),
        F.when(F.col("id") % 3 == 0, F.lit(47.61) + (F.col("id") % 13) * 1e-4)
        .otherwise(F.lit(47.0) + (F.col("id") * 6101 % 1000) / 900.0).alias("y"))


@pytest.fixture(scope="module")
def towers(spark):
    return spark.range(120).select(
        F.col("id").alias("tid"),
        F.when(F.col("id") < 80, F.lit(-122.34) + (F.col("id") % 9) * 2e-4)
        .otherwise(F.lit(-122.8) + (F.col("id") * 37 % 100) / 90.0).alias("tx"),
        F.when(F.col("id") < 80, F.lit(47.61) + (F.col("id") % 7) * 2e-4)
        .otherwise(F.lit(47.1) + (F.col("id") * 53 % 100) / 95.0).alias("ty"))


@pytest.mark.parametrize("block_points", [200_000, 7])
def test_nearest_equals_bruteforce(spark, points, towers, block_points):
    kw = dict(left_xy=("x", "y"), right_xy=("tx", "ty"), right_id="tid", left_keys=["pid"], dist_col="d")
    got = nearest(points, towers, block_points=block_points, **search(kw))
    ref = nearest_bruteforce(points, towers, **kw)
    assert rows(got, "pid", "tid") == rows(ref, "pid", "tid")
    g = {r["pid"]: r["d"] for r in got.collect()}
    for r in ref.collect():
        assert g[r["pid"]] == pytest.approx(r["d"], abs=1e-6)


def test_nearest_planar_equals_bruteforce(spark, points, towers):
    kw = dict(left_xy=("x", "y"), right_xy=("tx", "ty"), right_id="tid", left_keys=["pid"], dist_col="d",
              metric="planar")
    assert rows(nearest(points, towers, **search(kw)), "pid", "tid") == rows(nearest_bruteforce(points, towers, **kw), "pid", "tid")


def test_nearest_ties_lower_id_wins(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0)], "pid long, x double, y double")
    right = spark.createDataFrame([(7, 0.0, 0.001), (3, 0.0, -0.001), (9, 0.5, 0.5)], "tid long, tx double, ty double")
    out = nearest(left, right, left_xy=("x", "y"), right_xy=("tx", "ty"), right_id="tid").first()
    assert out["tid"] == 3


def test_nearest_edge_cases(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0), (3, 179.99, 0.0)], "pid long, x double, y double")
    right = spark.createDataFrame([(5, -179.99, 0.0), (6, 10.0, 10.0)], "tid long, tx double, ty double")
    kw = dict(left_xy=("x", "y"), right_xy=("tx", "ty"), right_id="tid", dist_col="d")
    inner = {r["pid"]: r["tid"] for r in nearest(left, right, **kw).collect()}
    assert inner == {1: 6, 3: 5}                      # across the antimeridian; NULL point dropped
    outer = {r["pid"]: r["tid"] for r in nearest(left, right, how="left", **kw).collect()}
    assert outer == {1: 6, 2: None, 3: 5}
    empty = right.limit(0)
    assert nearest(left, empty, **kw).count() == 0
    assert nearest(left, empty, how="left", **kw).count() == 3
    near = {r["pid"]: r["tid"] for r in nearest(left, right, how="left", max_distance=5000.0, **kw).collect()}
    assert near == {1: None, 2: None, 3: 5}


def test_contains_join_equals_bruteforce(spark):
    polys = spark.createDataFrame([
        (i, f"POLYGON (({i} 0, {i + 1.5} 0, {i + 1.5} 1.5, {i} 1.5, {i} 0), "
            f"({i + 0.5} 0.5, {i + 0.7} 0.5, {i + 0.7} 0.7, {i + 0.5} 0.7, {i + 0.5} 0.5))") for i in range(6)],
        "poly_id long, wkt string")
    pts = spark.range(500).select(F.col("id").alias("pid"), (F.col("id") * 0.0137 % 8.0).alias("x"),
                                  (F.col("id") * 0.0071 % 1.8).alias("y"))
    got = contains_join(pts, polys, point_xy=("x", "y"), wkt_col="wkt", poly_id="poly_id", point_keys=["pid"])
    from towerlens.functions.geo import contains, poly_from_wkt

    ref = pts.crossJoin(polys).filter(contains(poly_from_wkt("wkt"), F.col("x"), F.col("y")))
    assert rows(got, "pid", "poly_id") == rows(ref, "pid", "poly_id")
    assert rows(got, "pid", "poly_id")                 # overlaps give fan-out, holes exclude
    counts = contains_counts(polys, pts, point_xy=("x", "y"), wkt_col="wkt", poly_id="poly_id", point_id="pid")
    assert counts.count() == 6


def latest_per_key_window(df, keys, ts, tie):
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc(), F.col(tie).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def test_salted_left_join_keeps_null_keys(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    small = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    got = salted_join(big, small, ["k"], "left", hot_rows=100, fraction=0.5)
    assert rows(got.na.fill(-1), "v", "w") == rows(big.join(small, "k", "left").na.fill(-1), "v", "w")


def test_latest_per_key_matches_window(spark):
    df = spark.range(2000).select((F.col("id") % 37).alias("k"), (F.col("id") % 11).alias("ts"),
                                  F.col("id").alias("tie"), (F.col("id") * 3).alias("v"))
    a = latest_per_key(df, ["k"], "ts", "tie")
    b = latest_per_key_window(df, ["k"], "ts", "tie")
    assert rows(a, "k", "ts", "tie", "v") == rows(b, "k", "ts", "tie", "v")


def test_latest_late_event_does_not_replace_newer(spark):
    df = spark.createDataFrame([(1, "2024-01-02", 1, "new"), (1, "2024-01-01", 2, "late")],
                               "k int, ts string, tie int, v string")
    assert latest_per_key(df, ["k"], "ts", "tie").first()["v"] == "new"


def test_salted_join_hot_key_exact(spark):
    big = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
                                    F.col("id").alias("v"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    got = salted_join(big, small, ["k"], "left", hot_rows=500, fraction=0.5)
    ref = big.join(small, "k", "left")
    assert got.count() == ref.count()
    assert rows(got, "v", "w") == rows(ref, "v", "w")


@pytest.mark.parametrize("block_points", [200_000, 50])
def test_nearest_repeated_left_rows_shared_coordinates_and_limits(spark, monkeypatch, block_points):
    monkeypatch.setattr(nearest_module, "LEFT_PER_TASK", 40)
    left = spark.range(300).select((F.col("id") % 100).alias("pid"), (F.col("id") % 10 * 0.01).alias("x"), (F.col("id") % 7 * 0.01).alias("y"),
                                   F.lit("row").alias("_d"))
    far = spark.range(300, 340).select(F.col("id").alias("pid"), F.lit(120.0).alias("x"), F.lit(-40.0).alias("y"), F.lit("row").alias("_d"))
    left = left.unionByName(far)
    right = spark.range(2000).select(F.col("id").alias("tid"), (F.col("id") % 20 * 0.004).alias("tx"), (F.floor(F.col("id") / 20) % 5 * 0.01).alias("ty"))
    kw = dict(left_xy=("x", "y"), right_xy=("tx", "ty"), right_id="tid", dist_col="d", block_points=block_points)
    got = nearest(left, right, **kw)
    assert got.columns == ["pid", "x", "y", "_d", "tid", "d"] and got.count() == 340
    want = {(r["x"], r["y"]): r["tid"] for r in nearest_bruteforce(
        left.select("x", "y").distinct(), right, left_keys=["x", "y"], left_xy=("x", "y"), right_xy=("tx", "ty"), right_id="tid").collect()}
    assert all(want[r["x"], r["y"]] == r["tid"] for r in got.collect())
    near = nearest(left, right, how="left", max_distance=300.0, **kw).collect()
    true = {(r["pid"], r["x"], r["y"]): (r["tid"], r["d"]) for r in got.collect()}
    assert len(near) == 340 and all((r["tid"] is None) == (true[r["pid"], r["x"], r["y"]][1] > 300.0) for r in near)


def test_contains_join_salted_path(spark):
    polys = spark.createDataFrame([(i, f"POLYGON (({i} 0, {i + 1} 0, {i + 1} 1, {i} 1, {i} 0))") for i in range(4)],
                                  "poly_id long, wkt string")
    pts = spark.range(400).select(F.col("id").alias("pid"), (F.col("id") % 40 / 10.0 + 0.05).alias("x"),
                                  F.lit(0.5).alias("y"))
    got = contains_join(pts, polys, point_xy=("x", "y"), wkt_col="wkt", poly_id="poly_id", point_keys=["pid"],
                        broadcast_bytes=0, hot_rows=5)
    assert got.count() == 400
    assert rows(got.filter("pid = 13"), "pid", "poly_id") == [(13, 1)]


def _in_ring(ring, x, y):
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def _square(x, y, w):
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]


def _ring_text(ring):
    return "(" + ", ".join(f"{x} {y}" for x, y in ring) + ")"


def test_contains_join_multipolygons_of_mixed_size(spark):
    shapes = {
        1: [[_square(0, 0, 4), _square(1, 1, 2)]],                                        # large, with a hole
        2: [[_square(1.2, 1.2, 0.25)], [_square(30, 10, 0.5), _square(30.1, 10.1, 0.2)]],    # two parts, one holed
        3: [[_square(2, 2, 0.01)]],
        4: [[_square(-170, -60, 340)]],
    }
    text = lambda parts: ("POLYGON " + "(" + ", ".join(map(_ring_text, parts[0])) + ")" if len(parts) == 1 else
                          "MULTIPOLYGON (" + ", ".join("(" + ", ".join(map(_ring_text, p)) + ")" for p in parts) + ")")
    polys = spark.createDataFrame([(k, text(v)) for k, v in shapes.items()] + [(9, None), (10, "POINT (1 1)")], "poly_id long, wkt string")
    pts = [(i, x, y) for i, (x, y) in enumerate([(0.5, 0.5), (1.3, 1.3), (2.005, 2.005), (30.05, 10.05), (30.2, 10.2), (2.5, 1.5), (179.0, 0.0), (3.5, 3.5)])]
    df = spark.createDataFrame(pts + [(99, None, 1.0)], "pid long, x double, y double")
    want = sorted((i, k) for i, x, y in pts for k, parts in shapes.items()
                  if any(sum(_in_ring(r, x, y) for r in p) % 2 for p in parts))
    for kw in ({}, {"broadcast_bytes": 0}):
        got = contains_join(df, polys, point_xy=("x", "y"), wkt_col="wkt", poly_id="poly_id", point_keys=["pid"], **kw)
        assert rows(got, "pid", "poly_id") == want
    from towerlens.functions.geo import multipolygon_parts, parts_bbox
    from towerlens.operators.spatial_join import polygon_tiles

    p = polys.withColumn("_parts", multipolygon_parts("wkt")).filter("_parts is not null").withColumn("_bb", parts_bbox(F.col("_parts")))
    assert max(r["count"] for r in polygon_tiles(p).groupBy("poly_id").count().collect()) <= 4
    with pytest.raises(Exception, match="not a geometry"):
        contains_join(df, polys.unionByName(spark.createDataFrame([(11, "garbage")], polys.schema)), point_xy=("x", "y"),
                      wkt_col="wkt", poly_id="poly_id").collect()


def test_centroid_and_area_of_parts(spark):
    from towerlens.functions.geo import multipolygon_parts, parts_area, parts_centroid

    df = spark.createDataFrame([("MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((10 0, 11 0, 11 1, 10 1, 10 0)))",), ("POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))",)], "w string")
    a, b = df.select(parts_area(multipolygon_parts("w")).alias("a"), parts_centroid(multipolygon_parts("w")).alias("c")).collect()
    assert a["a"] == pytest.approx(5.0) and a["c"]["x"] == pytest.approx((4 * 1 + 10.5) / 5) and a["c"]["y"] == pytest.approx((4 + 0.5) / 5)
    assert b["a"] == 4.0 and tuple(b["c"]) == (1.0, 1.0)


def test_site_in_multipolygon_market_is_within(spark):
    from towerlens.plans import pipelines as pl
    from towerlens.plans.fixtures import markets_bronze, sites_bronze
    from tests.conftest import SF_SMALL

    sites = sites_bronze(spark, SF_SMALL)
    markets = markets_bronze(spark, SF_SMALL)
    before = pl.match_sites(sites, markets)
    wide = markets.withColumn("geometry_wkt", F.regexp_replace("geometry_wkt", r"^POLYGON \\((.*)\\)$", "MULTIPOLYGON ((\\$1), ((170 80, 171 80, 171 81, 170 80)))"))
    after = pl.match_sites(sites, wide)
    same = lambda d: sorted((r["site_id"], r["market_id"]) for r in d.filter("match_type = 'WITHIN'").collect())
    assert same(before) == same(after) and same(before)


def _fanout_sides(spark):
    """Two hot keys, a plain one, keys of one side only, null keys, and equal rows on both sides."""
    big = spark.createDataFrame([("a", i // 2) for i in range(400)] + [("b", i) for i in range(30)] + [("c", 1), ("only", 2)]
                                + [(None, 3)] * 5, "k string, bid int")
    small = spark.createDataFrame([("a", i // 3) for i in range(90)] + [("b", i) for i in range(700)] + [("c", 5), ("other", 6), (None, 7)],
                                  "k string, sid int")
    return big, small


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("pairs, most_tasks", [(500, 10_000), (500, 20), (1, 16), (10**9, 10_000)])
def test_fanout_join_equals_plain_join(spark, how, pairs, most_tasks):
    from collections import Counter

    from towerlens.operators.skew import fanout_join

    big, small = _fanout_sides(spark)
    got = fanout_join(big, small, ["k"], how, pairs=pairs, most_tasks=most_tasks)
    assert got.columns == ["k", "bid", "sid"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, big.join(small, ["k"], how).collect()))


def test_fanout_join_shares_out_the_rows_it_makes(spark):
    """A key whose rows are few on both sides but many together is made in many tasks."""
    from towerlens.operators.skew import fanout_join

    big, small = _fanout_sides(spark)
    made = fanout_join(big, small, ["k"], "inner", pairs=500).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == 400 * 90 + 30 * 700 + 1
    assert max(r["count"] for r in made) <= 6000


def test_fanout_join_deals_rows_at_equal_distances(spark):
    """A key that comes back at equal distances is cut as evenly as any other."""
    from towerlens.operators.skew import fanout_join

    one = spark.range(0, 3200, 1, 1).selectExpr("IF(id % 16 = 0, -1, id) AS k", "id")
    made = fanout_join(one.withColumnRenamed("id", "bid"), one.withColumnRenamed("id", "sid"), ["k"], "inner", pairs=160)
    made = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(made) == 200 * 200 + 3000
    assert max(made) <= 4000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_fanout_join_cuts_one_row_that_meets_many(spark, monkeypatch, how):
    """Few pairs, but nearly all of one big row: they are cut as well."""
    from towerlens.operators import skew

    monkeypatch.setattr(skew, "PART_ROWS", 100)
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    big = spark.createDataFrame([("a", 1), ("b", 2), ("only", 3), (None, 4)], "k string, bid int")
    small = spark.createDataFrame([("a", i // 2) for i in range(2000)] + [("b", 5), (None, 6)], "k string, sid int")
    joined = skew.fanout_join(big, small, ["k"], how)
    got, want = [sorted(map(str, map(tuple, d.collect()))) for d in (joined, big.join(small, ["k"], how))]
    assert got == want and joined.columns == ["k", "bid", "sid"]
    assert max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()) <= 1000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_fanout_join_of_keys_alone(spark, how):
    from collections import Counter

    from towerlens.operators.skew import fanout_join

    big, small = _fanout_sides(spark)
    got = fanout_join(big, small.select("k"), ["k"], how, pairs=500)
    want = big.join(small.select("k"), ["k"], how)
    assert got.columns == ["k", "bid"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_enriched_classes_equal_the_summary_of_all_rows(spark):
    """Counted by class before they meet, buildings and coverage rows give what their pairs give, in far fewer rows."""
    from towerlens.plans import pipelines as pl

    def square(x, y):
        return f"POLYGON (({x} {y}, {x + 1e-4} {y}, {x + 1e-4} {y + 1e-4}, {x} {y + 1e-4}, {x} {y}))"

    spots = [(-122.340, 47.600), (-122.330, 47.610), (-122.320, 47.620)]
    buildings = spark.createDataFrame([(i // 2, None if i % 5 == 0 else float(i), square(*spots[i % 3])) for i in range(90)],
                                      "building_id long, height double, geometry string")
    placed = pl.downtown_buildings(buildings, pl.ANALYSIS_BOX)
    keys = sorted(r[0] for r in placed.select("h3_res9_id").distinct().collect())
    assert len(keys) == 3
    cells = spark.createDataFrame([(i, None if i % 7 == 0 else 400, None if i % 4 == 0 else i, 1, 0, keys[i % 2]) for i in range(80)] + [(99, 400, 7, 1, 0, None)],
                                  "fid long, technology int, mindown int, minup int, environmnt int, h3_res9_id string")
    towers = spark.createDataFrame([(1, "LTE", 11, 47.6005, -122.3405), (2, "NR", 12, 47.62, -122.335)],
                                   "tower_id long, tower_type string, cell_id long, latitude double, longitude double")
    everything = pl.enriched_buildings(buildings, cells, towers)
    classes = pl.enriched_classes(buildings, cells, towers)
    assert everything.count() == 30 * 40 * 2 + 30
    assert classes.count() <= 3 * 4
    for by, value in ((["coverage_quality"], "nearest_tower_distance_m"), (["coverage_quality", "tower_proximity_band"], "min_download_mbps")):
        want = pl.class_summary(everything, by, value, "v", 3)
        got = pl.class_summary(classes, by, value, "v", 3, rows="rows")
        assert got.columns == want.columns and rows(got, *got.columns) == rows(want, *want.columns)
        assert got.filter("coverage_quality = 'No Coverage'").count()


def test_spread_shares_out_a_file_of_one_row_group(spark, tmp_path):
    """A file of one row group is read in many splits, all but one of which are empty."""
    from towerlens.operators.skew import spread

    spark.range(0, 1_000_000, 1, 1).selectExpr("id", "uuid() AS text").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    cores = spark.sparkContext.defaultParallelism
    known = df.filter("id >= 0")
    assert known.rdd.getNumPartitions() >= min(cores, 4) and known.groupBy(F.spark_partition_id()).count().count() == 1
    shares = [r["count"] for r in spread(known).groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) >= cores and max(shares) < 2_000_000 / cores and sum(shares) == 1_000_000
