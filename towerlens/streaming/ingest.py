"""Incremental file ingest with Structured Streaming.

A feed is a directory of headerless ``*.csv.gz`` shards (nested folders
allowed).  ``stream_csv_dir`` is the file source; each update appends only
files not seen before (the checkpoint records them), and
``trigger(availableNow=True)`` processes what is there and stops, which is
the reference's triggered, non-continuous update.  Rules are counted while a
micro-batch is written; drop rules take rows from it, and a batch that breaks a
fail rule is never published and stops the query.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.plans.quality import COUNTS, Expectation, ExpectationFailed, Watched
from towerlens.sources import shared
from towerlens.sources.files import text_schema, typed


def stream_csv_dir(spark: SparkSession, path: str, columns: Sequence[tuple[str, str]],
                   glob: str = "*.csv.gz", recursive: bool = True, max_files_per_trigger: int | None = None
                   ) -> DataFrame:
    """Streaming read of headerless CSV shards -> typed columns."""
    r = (spark.readStream.schema(text_schema(len(columns))).option("header", "false")
         .option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(path).select(*typed(columns))


def stream_to_table(sdf: DataFrame, path: str, checkpoint: str, rules: Sequence[Expectation] = (),
                    await_termination: bool = True, name: str = ""):
    """Append the stream to a table at ``path`` with one triggered update.

    Each batch is written beside its place, its rules counted on the way, and becomes the partition of its own number
    (``epoch``) if it breaks no fail rule; a broken one is removed and the query stops.  A batch that is run again after
    a failure takes its partition's place and adds nothing.  ``read_appended`` gives the table, ``rule_counts`` the
    counts of each batch."""
    root = path.rstrip("/")

    def write_batch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        beside = f"{root}.staging/epoch={epoch}"
        watched = Watched(batch, rules, f"{name or root} batch {epoch}")
        watched.rows.write.mode("overwrite").parquet(beside)
        try:
            watched.check()
        except ExpectationFailed:
            shared.delete(spark, beside)
            raise
        if rules:
            spark.createDataFrame(watched.counts(), COUNTS).drop("dataset").coalesce(1).write.mode("overwrite").parquet(f"{root}/_rules/epoch={epoch}")
        shared.replace(spark, beside, f"{root}/epoch={epoch}")

    q = sdf.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if await_termination:
        q.awaitTermination()
    return q


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``stream_to_table``."""
    return spark.read.parquet(path).drop("epoch")


def rule_counts(spark: SparkSession, path: str) -> DataFrame:
    """``epoch, rule, action, passed, failed`` of each batch of such a table."""
    return spark.read.parquet(f"{path.rstrip('/')}/_rules").select(F.col("epoch").cast("long"), "rule", "action", "passed", "failed")


# ------------------------------------------------------------------ latest row per key, kept current
def latest_per_key_stream(sdf: DataFrame, keys: Sequence[str], ts: str, tie: str | None, path: str,
                          checkpoint: str, buckets: int = 64, await_termination: bool = True):
    """Keep a 'latest row per key' table current as shards arrive.

    Rows lie in ``buckets`` by the hash of their key.  A batch is reduced to its latest row per key and merged with the
    buckets that it touches, which alone are written anew; a manifest (one small file) then names the batch that each
    bucket was last written by.  After every batch the table equals ``latest_per_key`` over all rows so far.  A batch
    that is run again starts from the manifest before it.  Buckets that neither the present manifest nor the one before
    it names are removed.  The number of buckets is fixed by the first batch; a bucket is merged in one task, so it
    should be a share of the table that a task can hold on disk.
    """
    from towerlens.operators.latest import latest_per_key

    root = path.rstrip("/")

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = _manifest(spark, root, below=epoch)
        n = before["buckets"] if before else buckets
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int")
        fresh = latest_per_key(batch, keys, ts, tie).withColumn("_bucket", bucket).persist()
        try:
            touched = [str(r[0]) for r in fresh.select("_bucket").distinct().collect()]      # at most ``buckets``
            live = dict(before["live"]) if before else {}
            old = {b: live[b] for b in touched if b in live}
            both = fresh
            if old:
                both = fresh.unionByName(_read_live(spark, root, old, before["schema"]).withColumn("_bucket", bucket))
            latest_per_key(both, keys, ts, tie).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{root}/data/{epoch}")
        finally:
            fresh.unpersist()
        now = {"buckets": n, "schema": batch.schema.json(), "live": live | {b: epoch for b in touched}}
        shared.write_text(spark, f"{root}/manifests/{epoch}", json.dumps(now))
        _retire(spark, root, epoch)

    q = (sdf.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if await_termination:
        q.awaitTermination()
    return q


def _epochs(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in shared.names(spark, f"{root}/manifests") if n.isdigit())


def _manifest(spark: SparkSession, root: str, below: int | None = None) -> dict | None:
    """The newest manifest, or the newest of an epoch before ``below``."""
    known = [e for e in _epochs(spark, root) if below is None or e < below]
    return json.loads(shared.read_text(spark, f"{root}/manifests/{known[-1]}")) if known else None


def _read_live(spark: SparkSession, root: str, live: dict[str, int], schema: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*[f"{root}/data/{e}/_bucket={b}" for b, e in live.items()])


def _retire(spark: SparkSession, root: str, epoch: int) -> None:
    """Remove manifests before the last two, and the buckets that only they name."""
    known = [e for e in _epochs(spark, root) if e <= epoch]
    kept = {(b, e) for m in known[-2:] for b, e in json.loads(shared.read_text(spark, f"{root}/manifests/{m}"))["live"].items()}
    for m in known[:-2]:
        for b, e in json.loads(shared.read_text(spark, f"{root}/manifests/{m}"))["live"].items():
            if (b, e) not in kept:
                shared.delete(spark, f"{root}/data/{e}/_bucket={b}")
        shared.delete(spark, f"{root}/manifests/{m}")


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that ``latest_per_key_stream`` keeps; None before its first batch."""
    now = _manifest(spark, path.rstrip("/"))
    return _read_live(spark, path.rstrip("/"), now["live"], now["schema"]) if now else None


# ------------------------------------------------------------------ generations
def generation(spark: SparkSession, root: str) -> tuple[str, str]:
    """Table folder and checkpoint folder of a feed, which belong together: a checkpoint tells which files the table
    has, so neither is ever replaced without the other."""
    number = shared.read_text(spark, f"{root.rstrip('/')}/generation") or "0"
    return f"{root.rstrip('/')}/{number}/table", f"{root.rstrip('/')}/{number}/checkpoint"


def reset_stream(spark: SparkSession, root: str, table: str | None = None) -> tuple[str, str]:
    """Begin a feed anew.  A new, empty generation becomes the present one in one step, then the old one goes; a
    catalog table on the old folder is dropped.  Returns the new folders."""
    old = int(shared.read_text(spark, f"{root.rstrip('/')}/generation") or "0")
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    shared.write_text(spark, f"{root.rstrip('/')}/generation", str(old + 1))
    shared.delete(spark, f"{root.rstrip('/')}/{old}")
    return generation(spark, root)
