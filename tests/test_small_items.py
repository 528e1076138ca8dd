"""Items of the inventory that have no query of their own: read back what was written, and functions by name."""

import struct

import pytest
from pyspark.sql import functions as F

from towerlens.functions import geo as G
from towerlens.plans.nodes import ConfigError, run_step
from towerlens.plans.pipelines import sample_with_replacement
from towerlens.sources.tables import drop_table, text_lengths, write_table


def test_output_step_writes_its_input_and_hands_it_on(spark):
    write_table(spark.sql("SELECT 1 AS k, CAST(NULL AS STRING) AS t UNION ALL SELECT 2, 'x'"), "tl_in")
    try:
        for _ in range(2):
            handed = run_step("output", {"table_name": "tl_out"}, {"data": spark.table("tl_in")}, spark)
            assert sorted((r["k"], r["t"]) for r in spark.table("tl_out").collect()) == [(1, None), (2, "x")] and handed.count() == 2
        with pytest.raises(ConfigError):
            run_step("output", {}, {"data": spark.table("tl_in")}, spark)
    finally:
        drop_table(spark, "tl_in")
        drop_table(spark, "tl_out")


def test_points_from_binary_wkb(spark):
    points = [struct.pack("<BIdd", 1, 1, -122.3321, 47.6062), struct.pack("<BIdd", 1, 1, -0.0, 5e-324), struct.pack(">BIdd", 0, 1, 1.0, 2.0), b"", None]
    df = spark.createDataFrame([(i, None if p is None else bytearray(p)) for i, p in enumerate(points)], "i int, g binary")
    got = [r["p"] for r in df.select("i", G.point_from_wkb("g").alias("p")).orderBy("i").collect()]
    assert (got[0]["x"], got[0]["y"]) == (-122.3321, 47.6062) and got[1]["y"] == 5e-324 and got[2:] == [None] * 3


def test_polygons_as_text(spark):
    text = "POLYGON ((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0), (0.1 0.1, 0.2 0.1, 0.2 0.2, 0.1 0.1))"
    df = spark.createDataFrame([(text,), ("POINT (1 2)",), (None,)], "w string")
    got = [r[0] for r in df.select(G.to_wkt(G.poly_from_wkt("w"))).collect()]
    assert got == [text, None, None]


def test_declared_schema_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "b")], "a int, b string")
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string"] and df.filter("a IS NULL AND b = 'b'").count() == 1
    got = {r["column_name"]: (r["longest"], r["n"]) for r in text_lengths("t", df.withColumn("c", F.lit("äöü")), ["b", "c"]).collect()}
    assert got == {"b": (1, 1), "c": (3, 2)}
    assert text_lengths("t", df.limit(0), ["b"]).first()["longest"] is None


def test_sample_with_replacement_repeats_rows(spark):
    got = sample_with_replacement(spark.range(200), 3.0, seed=5)
    values = [r["id"] for r in got.collect()]
    assert 450 < len(values) < 750 and len(set(values)) < len(values) and set(values) <= set(range(200))
    assert sorted(values) == sorted(r["id"] for r in sample_with_replacement(spark.range(200), 3.0, seed=5).collect())
