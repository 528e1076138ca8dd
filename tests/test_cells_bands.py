"""Cell keys, H3 id checks and banding rules."""

import pytest
from pyspark.sql import functions as F

from towerlens.functions import bands as B
from towerlens.functions import cells as C


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_known_h3_id(spark):
    assert one(spark, C.h3_string_to_long(F.lit("8928308280fffff"))) == 617700169958293503
    assert one(spark, C.h3_long_to_string(F.lit(617700169958293503))) == "8928308280fffff"
    assert one(spark, C.h3_is_valid_string(F.lit("8928308280fffff"))) is True
    assert one(spark, C.h3_resolution(F.lit(617700169958293503))) == 9


def test_h3_digit_rules(spark):
    # a used digit (resolution 9: digits 1..9) equal to 7 is invalid
    base = 617700169958293503
    bad = (base & ~(7 << 18)) | (7 << 18)
    assert one(spark, C.h3_is_valid(F.lit(bad))) is False
    # wrong mode (edge mode 2) is invalid
    assert one(spark, C.h3_is_valid(F.lit(base ^ (3 << 59)))) is False
    assert one(spark, C.h3_is_valid_string(F.lit("zz"))) is False
    assert one(spark, C.h3_is_valid_string(F.lit(None).cast("string"))) is False


def test_cell_of_cell_center_is_the_cell(spark):
    df = spark.range(200).select((F.lit(-122.5) + F.col("id") * 0.002).alias("x"),
                                 (F.lit(47.4) + F.col("id") * 0.0017).alias("y"))
    k = df.select(C.cell_id("x", "y").alias("k"))
    c = k.select("k", C.cell_center("k").alias("c"))
    back = c.select((C.cell_id(F.col("c.x"), F.col("c.y")) == F.col("k")).alias("same"))
    assert back.filter(~F.col("same")).count() == 0


def test_cell_sql_matches_column(spark):
    from towerlens.functions.sql import register_sql_functions

    register_sql_functions(spark)
    df = spark.range(300).select((F.lit(-122.5) + F.col("id") * 0.0013).alias("x"),
                                 (F.lit(47.4) + F.col("id") * 0.0011).alias("y"))
    out = df.select((C.cell_id("x", "y") == F.expr("h3_longlatash3string(x, y, 9)")).alias("same"))
    assert out.filter(~F.col("same")).count() == 0


@pytest.mark.parametrize("d,label", [
    (199.9, "1: < 200m"), (200.0, "2: 200-500m"), (499.99, "2: 200-500m"), (500.0, "3: 500m-1km"),
    (1999.0, "4: 1-2km"), (2000.0, "5: > 2km"), (None, "5: > 2km"),
])
def test_distance_bands_null_to_else(spark, d, label):
    v = F.lit(d).cast("double")
    assert one(spark, B.band(v, B.DISTANCE_BANDS_GOLD, B.DISTANCE_BANDS_GOLD_ELSE)) == label


@pytest.mark.parametrize("util,lat,loss,band", [
    (85.0, 10.0, 0.0, "critical"), (84.9, 119.9, 2.99, "watch"), (70.0, 0.0, 0.0, "watch"),
    (10.0, 89.9, 1.49, "healthy"), (None, None, None, "healthy"),
])
def test_health_band(spark, util, lat, loss, band):
    c = B.health_band(F.lit(util).cast("double"), F.lit(lat).cast("double"), F.lit(loss).cast("double"))
    assert one(spark, c) == band


@pytest.mark.parametrize("health,load,band", [
    ("critical", 0.0, "critical"), (None, 45.0, "critical"), ("watch", None, "watch"), (None, 28.0, "watch"),
    (None, None, "healthy"), ("healthy", 27.99, "healthy"),
])
def test_risk_band_missing_telemetry_is_healthy(spark, health, load, band):
    assert one(spark, B.risk_band(F.lit(health).cast("string"), F.lit(load).cast("double"))) == band


def test_load_score_and_signal_score(spark):
    assert one(spark, B.load_score(F.lit(10), F.lit(0.5))) == pytest.approx(8.5)
    assert one(spark, B.signal_score(F.lit(5), F.lit(100), F.lit(0))) == 100.0
    assert one(spark, B.signal_score(F.lit(0), F.lit(7), F.lit(200))) == 0.0
    assert one(spark, B.carrier_name(F.lit(999))) == "MNC-999"
    assert one(spark, B.carrier_name(F.lit(260))) == "T-Mobile"
