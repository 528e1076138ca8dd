"""Hand-made shapes for the spatial functions (Column forms and SQL forms)."""

import math

import pytest
from pyspark.sql import functions as F

from towerlens.functions import geo as G

SQUARE = "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"
SQUARE_CW = "POLYGON ((0 0, 0 1, 1 1, 1 0, 0 0))"
L_SHAPE = "POLYGON ((0 0, 2 0, 2 1, 1 1, 1 2, 0 2, 0 0))"
HOLED = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))"


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_haversine_known_values(spark):
    assert one(spark, G.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))) == 0.0
    one_deg = one(spark, G.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    assert one_deg == pytest.approx(6371000 * math.pi / 180, abs=1e-6)
    anti = one(spark, G.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(180.0), F.lit(0.0)))
    assert anti == pytest.approx(math.pi * 6371000, rel=1e-12)


def test_haversine_symmetric(spark):
    a = one(spark, G.haversine_m(F.lit(-122.3), F.lit(47.6), F.lit(-122.1), F.lit(47.7)))
    b = one(spark, G.haversine_m(F.lit(-122.1), F.lit(47.7), F.lit(-122.3), F.lit(47.6)))
    assert a == pytest.approx(b, rel=1e-15)


@pytest.mark.parametrize("wkt,area,cx,cy", [
    (SQUARE, 1.0, 0.5, 0.5),
    (SQUARE_CW, 1.0, 0.5, 0.5),
    (L_SHAPE, 3.0, 5 / 6, 5 / 6),
    (HOLED, 12.0, 2.0, 2.0),
])
def test_area_and_centroid(spark, wkt, area, cx, cy):
    p = G.poly_from_wkt(F.lit(wkt))
    assert one(spark, G.area(p)) == pytest.approx(area)
    c = one(spark, G.centroid(p))
    assert (c["x"], c["y"]) == pytest.approx((cx, cy))


def test_contains_with_hole_and_edges(spark):
    p = G.poly_from_wkt(F.lit(HOLED))
    assert one(spark, G.contains(p, F.lit(0.5), F.lit(0.5))) is True
    assert one(spark, G.contains(p, F.lit(2.0), F.lit(2.0))) is False      # in the hole
    assert one(spark, G.contains(p, F.lit(5.0), F.lit(2.0))) is False      # outside
    # shared edge of two squares: exactly one of them owns the point (half-open rule)
    left = G.poly_from_wkt(F.lit("POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"))
    right = G.poly_from_wkt(F.lit("POLYGON ((1 0, 2 0, 2 1, 1 1, 1 0))"))
    owners = [one(spark, G.contains(left, F.lit(1.0), F.lit(0.5))),
              one(spark, G.contains(right, F.lit(1.0), F.lit(0.5)))]
    assert owners.count(True) == 1


@pytest.mark.parametrize("wkt,valid", [
    (SQUARE, True),
    (HOLED, True),
    ("POLYGON ((0 0, 1 0, 1 1, 0 1))", False),         # not closed
    ("POLYGON ((0 0, 1 0, 0 0))", False),              # fewer than 4 points
    ("POLYGON ((0 0, 1 0, 2 0, 0 0))", False),         # zero area
    ("LINESTRING (0 0, 1 1)", False),
    (None, False),
    ("", False),
])
def test_is_valid(spark, wkt, valid):
    assert one(spark, G.is_valid(G.poly_from_wkt(F.lit(wkt).cast("string")))) is valid


def test_self_intersection_option(spark):
    bowtie = G.poly_from_wkt(F.lit("POLYGON ((0 0, 1 1, 1 0, 0 1, 0 0))"))
    assert one(spark, G.is_valid(bowtie, check_self_intersection=True)) is False
    assert one(spark, G.is_valid(G.poly_from_wkt(F.lit(SQUARE)), check_self_intersection=True)) is True


def test_geometry_type_and_wkt_round_trip(spark):
    assert one(spark, G.geometry_type(F.lit("POINT (1 2)"))) == "ST_Point"
    assert one(spark, G.geometry_type(F.lit("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))"))) == "ST_MultiPolygon"
    text = one(spark, G.to_wkt(G.poly_from_wkt(F.lit(HOLED))))
    again = one(spark, G.to_wkt(G.poly_from_wkt(F.lit(text))))
    assert text == again
    assert one(spark, F.size(G.multipolygon_parts(
        F.lit("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))")))) == 2


def test_bbox(spark):
    b = one(spark, G.bbox(G.poly_from_wkt(F.lit(L_SHAPE))))
    assert (b["minx"], b["miny"], b["maxx"], b["maxy"]) == (0, 0, 2, 2)


def test_sql_functions_agree_with_columns(spark):
    from towerlens.functions.sql import register_sql_functions

    register_sql_functions(spark)
    r = spark.sql(f"""SELECT st_area('{HOLED}') AS a, st_x(st_centroid('{L_SHAPE}')) AS cx,
                      st_contains('{HOLED}', st_point(2, 2)) AS c, st_isvalid('{SQUARE}') AS v,
                      st_distancesphere(st_point(0, 0), st_point(0, 1)) AS d,
                      st_geometrytype(st_point(1, 2)) AS t""").first()
    assert r["a"] == pytest.approx(12.0)
    assert r["cx"] == pytest.approx(5 / 6)
    assert r["c"] is False and r["v"] is True and r["t"] == "ST_Point"
    assert r["d"] == pytest.approx(111194.92664455874)


def test_simplify_keeps_small_rings():
    ring = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    assert G.simplify_ring_dp(ring, 10.0) == ring
    long_ring = [(0, 0), (1, 0.0001), (2, 0), (2, 2), (0, 2), (0, 0)]
    out = G.simplify_ring_dp(long_ring, 0.01)
    assert (1, 0.0001) not in out and out[0] == out[-1]


def test_simplify_job(spark):
    from towerlens.operators.simplify import simplify

    wkt = "POLYGON ((0 0, 1 0.0001, 2 0, 2 2, 0 2, 0 0))"
    df = spark.createDataFrame([(1, wkt), (2, SQUARE)], "id long, w string")
    out = {r["id"]: r["w"] for r in simplify(df, "w", 0.01).collect()}
    assert out[2] == SQUARE
    assert "0.0001" not in out[1] and out[1].startswith("POLYGON ((")


def test_point_from_wkb_hex(spark):
    import struct

    for x, y in [(-122.3321, 47.6062), (0.0, -0.5), (1e-310, 180.0)]:
        wkb = (b"\x01" + struct.pack("<I", 1) + struct.pack("<dd", x, y)).hex()
        p = one(spark, G.point_from_wkb_hex(F.lit(wkb)))
        assert (p["x"], p["y"]) == (x, y)
    assert one(spark, G.point_from_wkb_hex(F.lit("00"))) is None


def test_simplify_parts_holes_and_other_rows(spark):
    import math

    from towerlens.operators.simplify import simplify

    circle = [(20 + math.cos(t / 200 * 2 * math.pi) * 3, 20 + math.sin(t / 200 * 2 * math.pi) * 3) for t in range(200)]
    rings = [[*circle, circle[0]], [(20 + (x - 20) / 3, 20 + (y - 20) / 3) for x, y in [*circle, circle[0]]], [(10.0, 10.0), (11.0, 10.0), (11.0, 11.0), (10.0, 10.0)]]
    body = [", ".join(f"{x!r} {y!r}" for x, y in r) for r in rings]
    rows = [(1, f"POLYGON (({body[0]}), ({body[1]}))"), (2, f"MULTIPOLYGON ((({body[0]}), ({body[1]})), (({body[2]})))"), (3, None), (4, "POINT (1 2)"),
            (5, "POLYGON ((0 0, 1 0, x 1, 1 1, 0 1, 0.5 0.5, 0 0))"), (6, "POLYGON ((0 0, 1 0, 1 1, 0 0))")]
    df = spark.createDataFrame(rows, "id long, w string").repartition(9)
    out = {r["id"]: r for r in simplify(df, "w", 0.05, "s").collect()}
    assert {k: r["s"] for k, r in out.items() if k > 2} == dict(rows[2:]) and out[1]["w"] == rows[0][1]
    thin = [[p for p, k in zip(r, G.ring_points_kept(__import__("numpy").asarray(r), 0.05)) if k] for r in rings]
    text = ["(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in thin]
    assert 8 < len(thin[0]) < 40 and out[1]["s"] == f"POLYGON ({text[0]}, {text[1]})"
    assert out[2]["s"] == f"MULTIPOLYGON (({text[0]}, {text[1]}), ({text[2]}))"
    assert simplify(df.limit(0), "w", 0.05).collect() == [] and simplify(df, "w", 0.05).columns == ["id", "w"]
