"""Property checks (hypothesis): grid nearest = brute force, convex centroid inside, WKT round trip."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from towerlens.functions import geo as G
from tests.nearest_plain import nearest_bruteforce
from towerlens.operators.nearest import nearest

coord = st.tuples(st.floats(-123.0, -121.0, allow_nan=False), st.floats(47.0, 48.5, allow_nan=False))
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(left=st.lists(coord, min_size=1, max_size=40), right=st.lists(coord, min_size=1, max_size=25),
       block_points=st.sampled_from([200_000, 3]))
def test_grid_nearest_equals_bruteforce(spark, left, right, block_points):
    ldf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(left)], "pid long, x double, y double")
    rdf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(right)], "tid long, tx double, ty double")
    kw = dict(left_xy=("x", "y"), right_xy=("tx", "ty"), right_id="tid", dist_col="d")
    got = {r["pid"]: r["tid"] for r in nearest(ldf, rdf, block_points=block_points, **kw).collect()}
    want = {r["pid"]: r["tid"] for r in nearest_bruteforce(ldf, rdf, left_keys=["pid"], **kw).collect()}
    assert got == want


@SETTINGS
@given(cx=st.floats(-100, 100), cy=st.floats(-60, 60), r=st.floats(0.001, 5.0), n=st.integers(3, 12),
       phase=st.floats(0, 6.28))
def test_convex_centroid_inside_and_wkt_round_trip(spark, cx, cy, r, n, phase):
    pts = [(cx + r * math.cos(phase + 2 * math.pi * k / n), cy + r * math.sin(phase + 2 * math.pi * k / n))
           for k in range(n)]
    wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in pts + pts[:1]) + "))"
    p = G.poly_from_wkt(F.lit(wkt))
    row = spark.range(1).select(G.centroid(p).alias("c"), G.to_wkt(p).alias("w")).first()
    c = row["c"]
    assert spark.range(1).select(G.contains(p, F.lit(c["x"]), F.lit(c["y"])).alias("v")).first()["v"] is True
    again = spark.range(1).select(G.to_wkt(G.poly_from_wkt(F.lit(row["w"]))).alias("w")).first()["w"]
    assert again == row["w"]
