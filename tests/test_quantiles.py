"""Exact percentiles of groups that are too large for one buffer."""

import random

import pytest
from pyspark.sql import functions as F

import towerlens.operators.quantiles as module
from towerlens.operators.quantiles import exact_percentiles
from towerlens.plans.nodes import run_step

FRACTIONS = (0.0, 0.05, 0.25, 0.5, 0.9, 0.999, 1.0)


def values():
    """Many shapes: even, heavy tails, half of all rows one value, few values, a hot value above a few others."""
    rng = random.Random(8)
    rows = [("even", rng.uniform(-5, 5)) for _ in range(20_000)]
    rows += [("tails", rng.choice((-1, 1)) * 10.0 ** rng.uniform(-300, 300)) for _ in range(9_000)]
    rows += [("hot", 5.0) for _ in range(30_000)] + [("hot", float(rng.randint(0, 4))) for _ in range(40)] + [("hot", rng.uniform(5, 6)) for _ in range(5_000)]
    rows += [("two", float(rng.random() < 0.3)) for _ in range(8_000)]
    rows += [(None, float(i % 977)) for i in range(7_000)]
    rows += [("small", float(i)) for i in range(10)] + [("none", None)] * 6_000 + [("one", 3.5)]
    rng.shuffle(rows)
    return rows


def builtin(df, groups, fractions):
    return df.groupBy(*groups).agg(*[F.percentile("v", p).alias(f"p{i}") for i, p in enumerate(fractions)])


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_large_groups_equal_the_builtin(spark):
    df = spark.createDataFrame(values(), "g string, v double").repartition(6)
    asked = [(f"p{i}", F.col("v"), p) for i, p in enumerate(FRACTIONS)]
    want = sorted_rows(builtin(df, ["g"], FRACTIONS))
    assert sorted_rows(exact_percentiles(df, ["g"], asked, small_rows=300)) == want
    assert sorted_rows(exact_percentiles(df, ["g"], asked, small_rows=20)) == want
    assert sorted_rows(exact_percentiles(df, ["g"], asked)) == want


def test_one_group_with_all_rows_and_no_state_beyond_a_bracket(spark, monkeypatch):
    """The values that are sorted are at most ``small_rows`` for each rank, though the group has 65,000 rows."""
    df = spark.createDataFrame(values(), "g string, v double")
    asked = [("low", F.col("v"), 0.05), ("mid", F.col("v"), 0.5), ("high", F.col("v") * 2, 0.95)]
    want = df.agg(F.percentile("v", 0.05), F.percentile("v", 0.5), F.percentile(F.col("v") * 2, 0.95)).first()
    sizes = []
    real = module.written

    def spy(frame, name):
        out = real(frame, name)
        if name == "candidates":
            sizes.append(max((r["count"] for r in out.filter("_few").groupBy("_side", "_m").count().collect()), default=0))
        return out

    monkeypatch.setattr(module, "written", spy)
    assert tuple(exact_percentiles(df, [], asked, small_rows=50).first()) == tuple(want)
    assert sizes and max(sizes) <= 50


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_percentiles(df, [], [("m", F.col("v"), 0.5)], small_rows=0).collect()[0][0] is None
    assert exact_percentiles(df, ["g"], [("m", F.col("v"), 0.5)]).collect() == []
    nulls = spark.createDataFrame([("a", None)] * 5, "g string, v double")
    assert sorted_rows(exact_percentiles(nulls, ["g"], [("m", F.col("v"), 0.5)], small_rows=1)) == [("a", None)]


def test_aggregate_step_keeps_names_order_and_null_groups(spark, monkeypatch):
    monkeypatch.setattr(module, "SMALL_ROWS", 100)
    df = spark.createDataFrame(values(), "g string, v double")
    cfg = {"group_bys": [{"expr": "g"}], "aggregations": [
        {"columnExpr": {"expr": "v"}, "fn": "PERCENTILE", "percentage": 0.9}, {"columnExpr": {"expr": "v"}, "fn": "COUNT", "alias": "n"},
        {"columnExpr": {"expr": "v + 1"}, "fn": "median", "alias": "mid"}]}
    plain = df.groupBy("g").agg(F.percentile("v", 0.9), F.count("v").alias("n"), F.median(F.col("v") + 1).alias("mid"))
    got = run_step("aggregate", cfg, {"data": df}, spark)
    assert [c.replace(" ", "") for c in got.columns] == [c.replace(" ", "") for c in plain.columns]
    assert sorted_rows(got) == sorted_rows(plain)
    total = run_step("aggregate", {"aggregations": cfg["aggregations"][1:]}, {"data": df}, spark)
    assert sorted_rows(total) == sorted_rows(df.agg(F.count("v"), F.median(F.col("v") + 1)))


def test_sql_step_leaves_the_callers_views_alone(spark):
    spark.range(3).createOrReplaceTempView("cells_in")
    try:
        one = run_step("sql", {"query": "SELECT id, '{x} :y' AS t FROM cells_in WHERE id > :low"}, {"cells_in": spark.range(10, 15)}, spark, {"low": 12})
        two = run_step("sql", {"query": "with a as (select id * 2 as id from cells_in) select a.id, o.id as other from a join other o on o.id = a.id"},
                       {"cells_in": spark.range(4), "other": spark.range(100)}, spark)
        assert sorted(r["id"] for r in one.collect()) == [13, 14] and one.first()["t"] == "{x} :y"
        assert sorted(r["other"] for r in two.collect()) == [0, 2, 4, 6]
        assert spark.table("cells_in").count() == 3
        assert [t.name for t in spark.catalog.listTables() if t.isTemporary and t.name == "other"] == []
    finally:
        spark.catalog.dropTempView("cells_in")


@pytest.mark.parametrize("how", ["first", "second"])
def test_two_flows_in_one_session(spark, how):
    """Flows whose inputs have the same name do not see each other's."""
    a = run_step("sql", {"query": "SELECT max(id) AS m FROM data"}, {"data": spark.range(5)}, spark)
    b = run_step("sql", {"query": "SELECT max(id) AS m FROM data"}, {"data": spark.range(9)}, spark)
    first, second = (a, b) if how == "first" else (b, a)
    assert {first.first()["m"], second.first()["m"]} == {4, 8} and a.first()["m"] == 4
