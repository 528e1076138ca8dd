"""Polygons of many vertices, cells in polygons and crossing edges, against plain tests."""

import math
import random

import pytest
from pyspark.sql import functions as F

from towerlens.functions import geo as G
from towerlens.functions.cells import cell_center, cell_id, own_cells
from towerlens.operators import polygon_cover as P
from towerlens.operators.spatial_join import contains_join


def ring(cx, cy, r, n, wobble=0.0, turn=0.0):
    """A star-like ring of ``n`` vertices, closed."""
    pts = []
    for i in range(n):
        a = turn + 2 * math.pi * i / n
        q = r * (1 + wobble * math.sin(37 * a) + wobble * math.cos(1001 * a) / 3)
        pts.append((cx + q * math.cos(a), cy + q * math.sin(a)))
    return [*pts, pts[0]]


def text(*rings):
    return "(" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in rings) + ")"


def inside(parts, x, y):
    odd = False
    for rings in parts:
        for r in rings:
            for (ax, ay), (bx, by) in zip(r, r[1:]):
                if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                    odd = not odd
    return odd


def shapes():
    big = ring(10, 50, 1, 3000, 0.2)
    out = {1: [[big, ring(10, 50, 0.3, 900)]], 2: [[ring(11.5, 50, 0.7, 700, 0.1)], [ring(13.5, 50.5, 0.4, 800)]], 3: [[ring(10.2, 50.2, 0.1, 12)]],
           4: [[ring(12, 49, 1e-4, 600)]], 5: [[[(9, 51), (14, 51), (14, 52), (9, 52), (9, 51)]]]}
    return out, [(k, ("POLYGON " + text(*p[0])) if len(p) == 1 else "MULTIPOLYGON (" + ", ".join(text(*x) for x in p) + ")") for k, p in out.items()]


def points(parts):
    rng = random.Random(1)
    pts = [(rng.uniform(8, 15), rng.uniform(48, 53)) for _ in range(1500)]
    pts += [v for k in (1, 2, 4) for v in rng.sample(parts[k][0][0], 60)]                            # on vertices
    pts += [(12 + rng.uniform(-2e-4, 2e-4), 49 + rng.uniform(-2e-4, 2e-4)) for _ in range(200)] + [(9.0, 51.0), (14.0, 51.5), (10.0, 50.0)]
    return [(i, float(x), float(y)) for i, (x, y) in enumerate(pts)] + [(9000, None, 50.0), (9001, 10.4, 50.0), (9001, 10.4, 50.0)]


@pytest.mark.parametrize("small", [False, True])
def test_contains_join_with_covers(spark, small):
    parts, rows = shapes()
    pts = points(parts)
    want = sorted((i, k) for i, x, y in pts if x is not None for k, p in parts.items() if inside(p, x, y))
    polys = spark.createDataFrame(rows, "id int, wkt string").withColumn("name", F.concat(F.lit("n"), "id"))
    got = contains_join(spark.createDataFrame(pts, "pid int, x double, y double"), polys, point_xy=("x", "y"), wkt_col="wkt", poly_id="id",
                        **({"broadcast_bytes": 0, "hot_rows": 50} if small else {})).collect()
    assert sorted((r["pid"], r["id"]) for r in got) == want
    assert set(got[0].asDict()) == {"pid", "x", "y", "id", "name"} and all(r["name"] == f"n{r['id']}" for r in got)


def test_few_vertices_are_tested_for_a_point(spark):
    """Of 100,000 vertices a point meets about the square root, and most points meet none."""
    n = 100_000
    polys = spark.createDataFrame([(1, "POLYGON " + text(ring(10, 50, 1, n, 0.05)))], "id long, wkt string").select(
        "id", G.multipolygon_parts("wkt").alias("_parts")).withColumn("_bb", G.parts_bbox("_parts")).withColumn("_vertices", F.lit(n))
    tiles, slabs = P.polygon_cover(polys, "id")
    long = slabs.agg(F.max(F.size("_edges")), F.avg(F.size("_edges")), F.sum(F.size("_edges"))).first()
    assert long[0] < 25_000 and long[1] < 2_500 and long[2] < 3 * n
    kinds = {r["_whole"]: r["count"] for r in tiles.groupBy("_whole").count().collect()}
    assert kinds[True] > 6 * kinds[False]


def test_cells_of_polygons(spark):
    rows = [(1, "POLYGON ((-122.40 47.55, -122.30 47.56, -122.28 47.66, -122.38 47.64, -122.40 47.55), (-122.35 47.58, -122.33 47.58, -122.33 47.6, -122.35 47.6, -122.35 47.58))"),
            (2, "MULTIPOLYGON (((-122.2 47.5, -122.18 47.5, -122.18 47.52, -122.2 47.52, -122.2 47.5)), ((-122.1 47.5, -122.09 47.5, -122.09 47.51, -122.1 47.5)))"),
            (3, "POLYGON ((-122.2 47.5, -122.1999 47.5, -122.1999 47.5001, -122.2 47.5))"), (4, None), (5, "POLYGON " + text(ring(-122.3, 47.6, 0.05, 5000, 0.1)))]
    polys = spark.createDataFrame(rows, "id int, wkt string")
    got = {(r["id"], r["cell"]) for r in P.cells_in_polygon(polys, ["id"], "wkt").collect()}
    # every cell about the polygons, by its centre
    grid = spark.range(0, 260).selectExpr("-122.42 + id * 0.0014 AS x").crossJoin(spark.range(0, 190).selectExpr("47.48 + id * 0.001 AS y")).select(
        cell_id("x", "y").alias("cell")).distinct().select("cell", cell_center("cell").alias("c")).select("cell", "c.x", "c.y")
    parts = {r["id"]: [[[(p["x"], p["y"]) for p in q] for q in part] for part in r["p"]] for r in
             polys.dropna().select("id", G.multipolygon_parts("wkt").alias("p")).collect()}
    every = grid.collect()
    want = {(k, r["cell"]) for k, p in parts.items() for r in every if inside(p, r["x"], r["y"])}
    assert got == want and len([g for g in got if g[0] == 1]) > 500 and not [g for g in got if g[0] in (3, 4)]


def test_cells_of_a_users_own(spark):
    fn = own_cells(lambda lon, lat: lon.round(1).astype(str) + "/" + lat.round(1).astype(str))
    got = spark.createDataFrame([(1.04, 2.06), (None, 3.0)], "x double, y double").select(fn("x", "y").alias("c")).collect()
    assert got[0]["c"] == "1.0/2.1" and "nan" in got[1]["c"]


def test_validity_of_long_rings_and_of_rings_against_each_other(spark):
    fine = ring(0, 0, 1, 10_000)
    bow = [*fine[:4000], *reversed(fine[4000:8000]), *fine[8000:]]
    rows = [("fine", text(fine)), ("bow", text(bow)), ("hole", text(fine, ring(0, 0, 0.5, 4000))), ("through", text(fine, ring(0.9, 0, 0.5, 4000))),
            ("holes that cross", text(fine, ring(0.1, 0, 0.2, 50), ring(0.3, 0, 0.2, 50))), ("wall", text([(0, 0), (0, 1), (0, 2), (1, 2), (1, 0), (0, 0)])),
            ("tie", text([(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)])), ("tall tie", text([(0, 0), (1, 9), (1, 0), (0, 9), (0, 0)])),
            ("touching hole", text([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(0, 0), (2, 1), (1, 2), (0, 0)]))]
    got = spark.createDataFrame([(k, f"POLYGON {t}") for k, t in rows], "k string, wkt string").select(
        "k", G.is_valid(G.poly_from_wkt("wkt"), check_self_intersection=True).alias("ok")).collect()
    assert {r["k"] for r in got if r["ok"]} == {"fine", "hole", "wall", "touching hole"}
