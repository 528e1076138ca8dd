"""Publishing with rules, layouts, the continuous latest table and generations of feeds."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from towerlens.operators.latest import latest_per_key
from towerlens.plans.datasets import Registry, publish, run_datasets
from towerlens.plans.quality import ExpectationFailed, Watched, expect, expect_or_drop, expect_or_fail
from towerlens.sources import shared
from towerlens.sources.tables import clustered, ctas, drop_table, file_statistics, preview, use_namespace, write_table
from towerlens.streaming.ingest import (generation, latest_per_key_stream, read_appended, read_latest, reset_stream, rule_counts, stream_csv_dir,
                                        stream_to_table)

COLUMNS = [("k", "int"), ("ts", "int"), ("v", "int")]


def folder():
    return tempfile.mkdtemp(prefix="tl-storage-")


def shard(spark, rows, path):
    spark.createDataFrame([tuple(None if x is None else str(x) for x in r) for r in rows], "a string, b string, c string").coalesce(1).write.option(
        "compression", "gzip").csv(path)


# ------------------------------------------------------------------ rules in the pass that writes
def test_publish_runs_the_plan_once_and_counts(spark):
    root, calls = folder(), spark.sparkContext.accumulator(0)

    def tick(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    df = spark.range(1000).repartition(4).mapInArrow(tick, "id long")
    rules = [expect_or_drop("small", "id < 900"), expect("even", "id % 2 = 0"), expect_or_fail("known", "id IS NOT NULL")]
    counts = publish(df, rules, f"{root}/t", "t", cluster_by=["id"])
    assert calls.value == 1000
    assert {r["rule"]: (r["action"], r["passed"], r["failed"]) for r in counts.collect()} == {
        "small": ("drop", 900, 100), "even": ("warn", 500, 500), "known": ("fail", 1000, 0)}
    assert spark.read.parquet(f"{root}/t").count() == 900
    assert os.listdir(root) == ["t"]


def test_nothing_is_published_after_a_failure(spark):
    root = folder()
    publish(spark.range(5), [expect_or_fail("few", "id < 5")], f"{root}/t")
    with pytest.raises(ExpectationFailed, match=r"few \(3 rows\)"):
        publish(spark.range(8), [expect_or_fail("few", "id < 5")], f"{root}/t", "t")
    assert spark.read.parquet(f"{root}/t").count() == 5 and os.listdir(root) == ["t"]
    with pytest.raises(ExpectationFailed):
        publish(spark.range(8), [expect_or_fail("few", "id < 5")], f"{root}/new")
    assert os.listdir(root) == ["t"]


def test_empty_dataset_and_no_rules(spark):
    root = folder()
    counts = publish(spark.range(0), [expect_or_fail("few", "id < 5")], f"{root}/t")
    assert [(r["passed"], r["failed"]) for r in counts.collect()] == [(0, 0)] and spark.read.parquet(f"{root}/t").count() == 0
    assert publish(spark.range(3), [], f"{root}/u").collect() == [] and spark.read.parquet(f"{root}/u").count() == 3


def test_datasets_as_tables(spark):
    reg = Registry()
    reg.dataset("tl_silver", rules=[expect_or_drop("small", "v < 5")], cluster_by=["v"])(lambda spark, made: spark.range(10).selectExpr("id AS v", "id AS w"))
    reg.dataset("tl_gold", upstream=["tl_silver"])(lambda spark, made: made["tl_silver"].agg(F.sum("w").alias("s")))
    try:
        for _ in range(2):
            counts = run_datasets(spark, reg)
            assert spark.table("tl_gold").first()["s"] == 10 and spark.table("tl_silver").count() == 5
            assert counts["tl_silver"].first()["failed"] == 5
    finally:
        drop_table(spark, "tl_silver")
        drop_table(spark, "tl_gold")


def test_counts_of_each_batch(spark):
    root = folder()
    rules = [expect_or_drop("pos", "v > 0"), expect("late", "ts > 1")]
    for name, rows in (("a", [(1, 1, 5), (2, 1, -1), (3, 2, None)]), ("b", [(4, 3, 7)])):
        shard(spark, rows, f"{root}/in/{name}")
        stream_to_table(stream_csv_dir(spark, f"{root}/in", COLUMNS), f"{root}/t", f"{root}/c", rules)
    stream_to_table(stream_csv_dir(spark, f"{root}/in", COLUMNS), f"{root}/t", f"{root}/c", rules)      # nothing new
    got = sorted((r["epoch"], r["rule"], r["passed"], r["failed"]) for r in rule_counts(spark, f"{root}/t").collect())
    assert got == [(0, "late", 1, 2), (0, "pos", 1, 2), (1, "late", 1, 0), (1, "pos", 1, 0)]
    assert sorted(r["k"] for r in read_appended(spark, f"{root}/t").collect()) == [1, 4]


def test_a_broken_batch_is_not_published(spark):
    root = folder()
    rules = [expect_or_fail("pos", "v > 0")]
    shard(spark, [(1, 1, 5)], f"{root}/in/a")
    stream_to_table(stream_csv_dir(spark, f"{root}/in", COLUMNS), f"{root}/t", f"{root}/c", rules)
    shard(spark, [(2, 1, 5), (3, 1, -1)], f"{root}/in/b")
    with pytest.raises(Exception, match="expectation failed"):
        stream_to_table(stream_csv_dir(spark, f"{root}/in", COLUMNS), f"{root}/t", f"{root}/c", rules)
    assert [r["k"] for r in read_appended(spark, f"{root}/t").collect()] == [1]
    assert rule_counts(spark, f"{root}/t").select("epoch").distinct().count() == 1


def test_watched_counts_only_what_was_read_once(spark):
    w = Watched(spark.range(100), [expect_or_drop("big", "id >= 40")], "d")
    assert w.rows.count() == 60 and w.counts() == [("d", "big", "drop", 60, 40)]


# ------------------------------------------------------------------ latest row per key
def test_latest_after_each_of_five_batches(spark):
    """Late rows, rows seen before, NULL keys and a key that moves on; each time the same as over all rows so far."""
    root, seen = folder(), []
    batches = [[(k, 10, k) for k in range(40)], [(1, 5, 100), (2, 20, 200), (None, 3, 1)], [(2, 20, 200), (1, 5, 100)], [(50, 1, 1), (None, 4, 2), (2, 19, 0)],
               [(k, 9, -1) for k in range(40)] + [(3, 11, 33)]]
    for i, rows in enumerate(batches):
        seen += rows
        shard(spark, rows, f"{root}/in/{i}")
        latest_per_key_stream(stream_csv_dir(spark, f"{root}/in", COLUMNS), ["k"], "ts", "v", f"{root}/s", f"{root}/c", buckets=8)
        want = latest_per_key(spark.createDataFrame(seen, "k int, ts int, v int"), ["k"], "ts", "v")
        assert sorted(map(str, read_latest(spark, f"{root}/s").collect())) == sorted(map(str, want.collect()))
    live = json.loads(shared.read_text(spark, f"{root}/s/manifests/4"))["live"]
    assert len(shared.names(spark, f"{root}/s/manifests")) == 2 and len(live) == 8


def test_bytes_written_follow_the_batch_not_the_table(spark):
    root = folder()
    shard(spark, [(k, 1, k) for k in range(20_000)], f"{root}/in/0")
    run = lambda: latest_per_key_stream(stream_csv_dir(spark, f"{root}/in", COLUMNS), ["k"], "ts", None, f"{root}/s", f"{root}/c", buckets=64)
    run()
    shard(spark, [(7, 2, 0), (8, 2, 0)], f"{root}/in/1")
    run()
    whole, part = (shared.folder_bytes(spark, f"{root}/s/data/{e}") for e in (0, 1))
    assert 10 * part < whole
    assert read_latest(spark, f"{root}/s").filter("ts = 2").count() == 2 and read_latest(spark, f"{root}/s").count() == 20_000
    # two more batches on the same buckets: what the first wrote for them goes
    for e in (2, 3):
        shard(spark, [(7, e + 1, 0), (8, e + 1, 0)], f"{root}/in/{e}")
        run()
    assert len([n for n in shared.names(spark, f"{root}/s/data/0") if n.startswith("_bucket")]) in (62, 63)
    assert not [n for n in shared.names(spark, f"{root}/s/data/1") if n.startswith("_bucket")]


def test_a_replayed_batch_changes_nothing(spark):
    """The manifest of a batch that died before its commit is made again from the one before it."""
    root = folder()
    for e, rows in enumerate([[(1, 1, 1), (2, 1, 1)], [(1, 2, 2)]]):
        shard(spark, rows, f"{root}/in/{e}")
        latest_per_key_stream(stream_csv_dir(spark, f"{root}/in", COLUMNS), ["k"], "ts", None, f"{root}/s", f"{root}/c", buckets=4)
    want = sorted(map(str, read_latest(spark, f"{root}/s").collect()))
    os.remove(f"{root}/c/commits/1")
    if os.path.exists(f"{root}/c/commits/.1.crc"):
        os.remove(f"{root}/c/commits/.1.crc")
    latest_per_key_stream(stream_csv_dir(spark, f"{root}/in", COLUMNS), ["k"], "ts", None, f"{root}/s", f"{root}/c", buckets=4)
    assert sorted(map(str, read_latest(spark, f"{root}/s").collect())) == want


def test_read_latest_before_the_first_batch(spark):
    assert read_latest(spark, f"{folder()}/nothing") is None


# ------------------------------------------------------------------ generations
def test_reset_reads_everything_again(spark):
    root = folder()
    shard(spark, [(1, 1, 1), (2, 1, 1)], f"{root}/in/a")

    def update(folders):
        stream_to_table(stream_csv_dir(spark, f"{root}/in", COLUMNS), *folders)
        return sorted(r["k"] for r in read_appended(spark, folders[0]).collect())

    assert update(generation(spark, f"{root}/feed")) == [1, 2] == update(generation(spark, f"{root}/feed"))
    new = reset_stream(spark, f"{root}/feed")
    assert not os.path.exists(new[0]) and new == generation(spark, f"{root}/feed")
    assert update(new) == [1, 2] and shared.names(spark, f"{root}/feed") == ["1", "generation"]


# ------------------------------------------------------------------ layout and tables
def test_curve_layout_opens_few_files_on_each_column(spark):
    df = spark.range(40_000).select(F.rand(3).alias("x"), (F.rand(4) * 1000).alias("y"), "id").union(spark.sql("SELECT NULL, 5D, -1L")).union(
        spark.sql("SELECT 1e9D, -1e9D, -2L"))
    root = folder()
    write_table(df, path=f"{root}/t", cluster_by=["x", "y"], file_bytes=20_000)
    table = spark.read.parquet(f"{root}/t")
    files = file_statistics(table, ["x", "y"])
    n = files.count()
    assert n > 20 and table.count() == 40_002 and files.agg(F.sum("rows")).first()[0] == 40_002
    for met in ("max_x >= 0.4 AND min_x <= 0.45", "max_y >= 400 AND min_y <= 450", "max_x >= 0.4 AND min_x <= 0.45 AND max_y >= 400 AND min_y <= 450"):
        opened = files.filter(met).count()
        assert opened <= (n / 2 if "AND max_y" not in met[5:] else n / 6)
    assert sorted(r["id"] for r in table.filter("x BETWEEN 0.4 AND 0.45 AND y < 50").collect()) == sorted(
        r["id"] for r in df.filter("x BETWEEN 0.4 AND 0.45 AND y < 50").collect())


def test_text_columns_and_one_column_are_ordered(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("s"), "id")
    assert clustered(df, ["s", "id"], 4).rdd.getNumPartitions() <= 4
    assert clustered(df, ["id"], 4).count() == 1000 and clustered(spark.range(0).withColumn("b", F.lit(1)), ["id", "b"], 3).count() == 0


def test_tables_by_name(spark):
    use_namespace(spark, "tl_space")
    try:
        made = ctas(spark, "tl_made", "SELECT id, id * 2 AS twice FROM range(100)", files=3)
        assert made.count() == 100 and len(made.inputFiles()) == 3
        assert preview(made, 7).count() == 7
        write_table(spark.sql("SELECT 'x' AS other"), "tl_made", overwrite_schema=True)
        assert spark.table("tl_made").columns == ["other"]
        drop_table(spark, "tl_made")
        assert not spark.catalog.tableExists("tl_made")
    finally:
        spark.sql("USE default")
        spark.sql("DROP SCHEMA tl_space CASCADE")


def test_what_the_library_writes_on_its_way_can_be_removed(spark):
    from towerlens.operators.skew import written
    from towerlens.session import remove_intermediates, run_folder

    other = spark.range(7)
    assert written(other, "numbers").count() == 7 and shared.exists(spark, run_folder(spark))
    remove_intermediates(spark)
    assert not shared.exists(spark, run_folder(spark))
    assert written(other, "numbers").count() == 7


def test_ranges_are_cut_by_rows_in_memory_and_within_a_frequent_value(spark, tmp_path, monkeypatch):
    """Equal values take little room in files, so a file may hold more rows than a task can sort; and one value may have them all."""
    from towerlens.sources import tables

    monkeypatch.setattr(tables, "SORT_BYTES", 100_000)
    path = f"{tmp_path}/t"
    publish(spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("v")), [], path, "t", cluster_by=["k"])
    rows = [r["rows"] for r in file_statistics(spark.read.parquet(path), ["k"]).collect()]
    assert sum(rows) == 20_000 and len(rows) >= 5 and max(rows) < 6_000
