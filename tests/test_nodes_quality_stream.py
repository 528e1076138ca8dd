"""Dataflow nodes, expectations and the incremental file ingest."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from towerlens.plans import nodes as N
from towerlens.plans.quality import (RULES, ExpectationFailed, apply_expectations, expect, expect_or_drop,
                                     expect_or_fail, expectation_metrics)


# ------------------------------------------------------------------ nodes
def test_source_node_errors(spark):
    with pytest.raises(ValueError, match="either 'file_source' or 'table_source'"):
        N.run_step("source", {}, {}, spark)
    with pytest.raises(ValueError, match="'path' is required"):
        N.run_step("source", {"file_source": {"format": "csv"}}, {}, spark)
    with pytest.raises(ValueError, match="'tableName' is required"):
        N.run_step("source", {"table_source": {"tableName": ""}}, {}, spark)


def test_option_normalisation():
    opts = N.reader_options({"headerRows": True, "inferSchema": False, "sep": "';'", "dataAddress": "'!Sheet1'",
                                "limit": 5})
    assert opts == {"headerRows": "1", "inferSchema": "false", "sep": ";", "dataAddress": "Sheet1", "limit": "5"}


def test_file_source_reads_csv(spark):
    d = tempfile.mkdtemp(prefix="tl-src-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("x,y\n1,2\n3,4\n")
    df = N.run_step("source", {"file_source": {"path": os.path.join(d, "a.csv"), "format": "csv", "headerRows": True,
                                        "inferSchema": True}}, {}, spark)
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2), (3, 4)]


def test_join_node_errors_and_cross(spark):
    a = spark.range(3)
    with pytest.raises(ValueError, match="Both left and right"):
        N.run_step("join", {"join_type": "inner"}, {"left": a}, spark)
    out = N.run_step("join", {"join_type": "cross", "join_conditions": ""}, {"left": a, "right": a}, spark)
    assert out.count() == 9


def test_aggregate_node_shapes(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    same = N.run_step("aggregate", {}, {"data": df}, spark)
    assert same is df
    distinct = N.run_step("aggregate", {"group_bys": [{"expr": "g"}]}, {"data": df}, spark)
    assert distinct.count() == 2
    cfg = {"group_bys": [{"expr": "g"}], "aggregations": [
        {"columnExpr": {"expr": "g"}, "fn": "-"},
        {"columnExpr": {"expr": "v"}, "fn": "PERCENTILE", "percentage": 1.5, "alias": "p"},
        {"columnExpr": {"expr": "v"}, "fn": "max", "alias": "m"}]}
    out = {r["g"]: (r["p"], r["m"]) for r in N.run_step("aggregate", cfg, {"data": df}, spark).collect()}
    assert out == {0: (8.0, 8.0), 1: (9.0, 9.0)}
    with pytest.raises(ValueError):
        N.Measure.read({"columnExpr": {"expr": "v"}, "fn": "drop table x; --"})


def test_percentage_fallbacks():
    share = lambda p: N.Measure.read({"percentage": p}).percentage
    assert share(-0.1) == 0.0 and share(1.5) == 1.0 and share(0.9) == 0.9 and share(1) == 1.0
    assert share(float("nan")) == share(float("inf")) == share(True) == share(None) == share("x") == 0.5


def test_sql_node_binds_only_known_params(spark):
    df = spark.range(10)
    out = N.run_step("sql", {"query": "SELECT id, id::string AS s FROM tl_t WHERE id >= :lo"},
                     {"tl_t": df}, spark, params={"lo": 7, "other": 1})
    assert [r["id"] for r in out.collect()] == [7, 8, 9]


def test_output_node_requires_name(spark):
    with pytest.raises(ValueError, match="'table_name' is required"):
        N.run_step("output", {"catalog": "c"}, {"data": spark.range(1)}, spark)
    assert N.Output.read({"catalog": "", "schema": "s", "table_name": "t"}).table == "s.t"


# ------------------------------------------------------------------ expectations
def test_every_rule_has_pass_violate_and_null(spark):
    assert sum(len(v) for v in RULES.values()) == 41


def test_metrics_and_drop(spark):
    df = spark.createDataFrame([(1, 50.0), (None, 50.0), (2, 150.0), (3, None)], "tower_id long, u double")
    rules = [expect_or_drop("id", "tower_id IS NOT NULL"), expect_or_drop("u", "u BETWEEN 0 AND 100"),
             expect("warn_u", "u > 10")]
    kept, metrics = apply_expectations(df, rules, "t")
    assert [r["tower_id"] for r in kept.collect()] == [1]
    m = {r["rule"]: (r["passed"], r["failed"]) for r in metrics.collect()}
    assert m == {"id": (3, 1), "u": (2, 2), "warn_u": (3, 1)}
    _, m2 = apply_expectations(df, [expect("warn_u", "u > 10")], "t", null_passes=True)
    assert m2.first()["failed"] == 0          # the NULL row passes; the rest are > 10


def test_fail_rule_raises_before_write(spark):
    df = spark.createDataFrame([(1,), (-1,)], "v int")
    with pytest.raises(ExpectationFailed):
        apply_expectations(df, [expect_or_fail("pos", "v > 0")], "t")
    kept, _ = apply_expectations(df.filter("v > 0"), [expect_or_fail("pos", "v > 0")], "t")
    assert kept.count() == 1


def test_spatial_rules(spark):
    towers = spark.createDataFrame([("POINT (1 2)", 260, 47.6, -122.3, 500)],
                                   "location string, net int, latitude double, longitude double, coverage_radius_m int")
    m = expectation_metrics(towers, RULES["silver_tmobile_towers_seattle"], "towers")
    assert all(r["failed"] == 0 for r in m.collect())


# ------------------------------------------------------------------ streaming ingest
def _write_gz(spark, rows, path):
    spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string").write.option(
        "compression", "gzip").csv(path)


def test_stream_ingest_is_incremental(spark):
    from towerlens.sources.files import KPI_COLUMNS
    from towerlens.streaming.ingest import stream_csv_dir, stream_to_table

    root = tempfile.mkdtemp(prefix="tl-stream-")
    _write_gz(spark, [("1", "2024-01-01 00:00:00", "50", "10", "0.1", "200")], f"{root}/in/s1")
    _write_gz(spark, [("2", "2024-01-01 01:00:00", "x", "10", "0.1", "200"),      # malformed -> NULL -> dropped
                      ("3", "2024-01-01 01:00:00", "60", "0", "0.1", "200")], f"{root}/in/nested/s2")
    with open(f"{root}/in/ignored.txt", "w") as f:
        f.write("9,2024-01-01 00:00:00,50,10,0.1,200\n")
    rules = RULES["ops_app_bronze_tower_hourly_kpis"]

    def run():
        stream_to_table(stream_csv_dir(spark, f"{root}/in", KPI_COLUMNS), f"{root}/out", f"{root}/ckpt", rules)
        return spark.read.parquet(f"{root}/out").count()

    assert run() == 1
    assert run() == 1                      # nothing new -> nothing appended
    _write_gz(spark, [("4", "2024-01-02 00:00:00", "20", "30", "0.2", "260")], f"{root}/in/s3")
    assert run() == 2                      # only the new shard's row


def test_stream_fail_rule_stops_batch(spark):
    from towerlens.sources.files import KPI_COLUMNS
    from towerlens.streaming.ingest import stream_csv_dir, stream_to_table

    root = tempfile.mkdtemp(prefix="tl-stream-fail-")
    _write_gz(spark, [("1", "2024-01-01 00:00:00", "50", "10", "0.1", "-5")], f"{root}/in/s1")
    with pytest.raises(Exception):
        stream_to_table(stream_csv_dir(spark, f"{root}/in", KPI_COLUMNS), f"{root}/out", f"{root}/ckpt",
                        [expect_or_fail("throughput", "throughput_mbps >= 0")])
    assert not os.path.exists(f"{root}/out") or spark.read.parquet(f"{root}/out").count() == 0


def test_latest_per_key_stream_matches_batch(spark):
    from towerlens.operators.latest import latest_per_key
    from towerlens.sources.files import KPI_COLUMNS
    from towerlens.streaming.ingest import latest_per_key_stream, read_latest, stream_csv_dir

    root = tempfile.mkdtemp(prefix="tl-latest-")
    _write_gz(spark, [("1", "2024-01-01 00:00:00", "50", "10", "0.1", "200"),
                      ("1", "2024-01-01 02:00:00", "60", "10", "0.1", "180")], f"{root}/in/s1")
    latest_per_key_stream(stream_csv_dir(spark, f"{root}/in", KPI_COLUMNS), ["tower_id"], "event_ts", None,
                          f"{root}/state", f"{root}/ckpt")
    _write_gz(spark, [("1", "2024-01-01 01:00:00", "99", "10", "0.1", "100"),      # late, older event
                      ("2", "2024-01-01 01:00:00", "20", "10", "0.1", "260")], f"{root}/in/s2")
    latest_per_key_stream(stream_csv_dir(spark, f"{root}/in", KPI_COLUMNS), ["tower_id"], "event_ts", None,
                          f"{root}/state", f"{root}/ckpt")
    got = read_latest(spark, f"{root}/state")
    allrows = spark.read.schema("a string, b string, c string, d string, e string, f string").csv(f"{root}/in",
                                                                                                 recursiveFileLookup=True)
    from towerlens.sources.files import typed

    want = latest_per_key(allrows.toDF(*[f"_c{i}" for i in range(6)]).select(*typed(KPI_COLUMNS)),
                          ["tower_id"], "event_ts", None)
    key = lambda df: sorted((r["tower_id"], r["prb_utilization_pct"]) for r in df.collect())
    assert key(got) == key(want) == [(1, 60.0), (2, 20.0)]


def test_dataset_registry_order_and_rules(spark):
    from towerlens.plans.datasets import Registry, run_datasets

    reg = Registry()

    @reg.dataset("gold", upstream=["silver"], rules=[expect_or_fail("pos", "v >= 0")])
    def gold(spark, inputs):
        return inputs["silver"].selectExpr("v * 2 AS v")

    @reg.dataset("silver", rules=[expect_or_drop("small", "v < 5")], cluster_by=["v"])
    def silver(spark, inputs):
        return spark.range(10).selectExpr("id AS v")

    assert reg.order() == ["silver", "gold"]
    root = tempfile.mkdtemp(prefix="tl-ds-")
    m = run_datasets(spark, reg, path_of=lambda n: f"{root}/{n}")
    assert spark.read.parquet(f"{root}/gold").count() == 5
    assert {r["rule"]: r["failed"] for r in m["silver"].collect()} == {"small": 5}
