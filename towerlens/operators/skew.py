"""Size checks and skew-safe equi-joins.

Two rules the operators follow:

* a side is broadcast only after its size is *proven*: the bytes of its values
  are added up (``proven_small``); otherwise the join shuffles;
* a shuffled join on a key that can be hot (a grid cell, a polygon tile, a
  coverage cell) salts the hot keys: the big side's rows of a hot key are
  spread over ``n`` sub-keys and the small side's rows of that key are
  copied ``n`` times.  Hot keys are found from a sample of the big side; the
  sample only decides how work is spread, never which rows are returned, so
  the result is exact.  The hot-key table has at most ``1 / (fraction *
  threshold)`` rows per sampled row, a proven bound, and is broadcast.

Where neither side is unique, few rows can make very many: ``fanout_join``
counts the pairs of each key, cuts both sides of a key by them, and keeps the
small rows of a cut in short arrays that each big row unfolds.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
DEFAULT_HOT_ROWS = 2_000_000          # rows per key that one task should handle
DEFAULT_SAMPLE_FRACTION = 0.01
PAIRS_PER_TASK = 4_000_000            # rows that one cut of a key may make
ROWS_PER_TASK = 500_000               # rows that one task of a fan-out should read
PART_ROWS = 100_000                   # small rows in a cut, that is rows that one big row makes there
PACKS_PER_CUT = 64                    # arrays that hold them
MOST_TASKS = 10_000
ROW_GROUP_BYTES = 128 << 20           # of a Parquet file, which one task reads


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (in ``spark.checkpoint.dir``), computed once.

    Without a persisted copy, writing the checkpoint recomputes the plan a
    second time; the copy is released as soon as the files are written.  The
    result's lineage starts at the written files, so a lost executor does not
    recompute the upstream plan.
    """
    from pyspark import StorageLevel

    from towerlens.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet below the checkpoint folder and read it back.  Like a checkpoint this cuts the lineage
    at files that all executors share; it is columnar, and its size is known (``file_bytes``)."""
    from towerlens.session import run_folder

    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files that a frame reads."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def memory_bytes(df: DataFrame) -> int:
    """Bytes that the values of a frame take, one pass: texts by their length, nested values by that of their JSON
    form, anything else and every row's header by 16.  Files alone prove little, as equal values are stored once."""
    width = F.lit(16 * (1 + len(df.columns))).cast("long")
    for f in df.schema.fields:
        column, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("string", "binary", "varchar", "char"):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind in ("array", "map", "struct"):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def proven_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a frame that reads files takes at most ``max_bytes`` in memory.  A frame of large files is told by their
    size alone."""
    limit = BROADCAST_BYTES if max_bytes is None else max_bytes
    return 4 * file_bytes(df) <= limit and memory_bytes(df) <= limit


def broadcast_if_proven(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """A ``written`` frame, marked for broadcast only if it is proven small.  Beyond that joins shuffle; rows are the same."""
    return F.broadcast(df) if proven_small(df, max_bytes) else df


def row_count_at_most(df: DataFrame, limit: int) -> int | None:
    """Exact row count if it is <= limit, else None (reads at most limit+1 rows)."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None


def spread(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Give CPU-heavy per-row work at least one partition per core.

    A small input (one parquet row group) runs on one core, however many
    splits its file is read in: all but one of them are empty.  Files are
    therefore left as they come only if they fill a row group for every core
    (or are very many), so this never adds a shuffle at scale.  A plan that
    already contains an exchange runs at shuffle parallelism and is left alone
    (asking it for its RDD would make adaptive execution run its stages eagerly).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in df._jdf.queryExecution().sparkPlan().toString():
        return df
    if df.rdd.getNumPartitions() >= cores:
        files = df.inputFiles()
        if not files or len(files) >= 16 * cores or file_bytes(df) >= cores * ROW_GROUP_BYTES:
            return df
    return df.repartition(cores, *[F.col(k) for k in keys]) if keys else df.repartition(cores)


def hot_keys(big: DataFrame, keys: Sequence[str], hot_rows: int = DEFAULT_HOT_ROWS,
             fraction: float = DEFAULT_SAMPLE_FRACTION, seed: int = 7) -> DataFrame:
    """Keys whose estimated row count exceeds ``hot_rows``, with a salt count.

    Estimated from a Bernoulli sample; the output has at most
    ``sampled_rows / (fraction * hot_rows)`` rows.
    """
    est = (big.select(*keys).sample(False, fraction, seed)
           .groupBy(*keys).count()
           .withColumn("est_rows", F.col("count") / F.lit(fraction))
           .filter(F.col("est_rows") > F.lit(hot_rows)))
    return est.select(*keys, F.ceil(F.col("est_rows") / F.lit(hot_rows)).cast("int").alias("_n_salt"))


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
                salt_cols: Sequence[str] | None = None, hot_rows: int = DEFAULT_HOT_ROWS,
                fraction: float = DEFAULT_SAMPLE_FRACTION, hot: DataFrame | None = None) -> DataFrame:
    """Shuffle equi-join ``big`` x ``small`` on ``keys`` with hot keys salted.

    ``how`` is 'inner' or 'left' (big side preserved).  ``salt_cols`` are the
    big-side columns hashed to pick a salt (default: all big columns).
    """
    keys = list(keys)
    hot = hot if hot is not None else hot_keys(big, keys, hot_rows, fraction)
    hot_b = F.broadcast(hot)
    salt_src = [F.col(c) for c in (salt_cols or big.columns)]
    # rows with a NULL key match nothing; they are spread too, instead of meeting in one task
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    b = (big.join(hot_b, keys, "left")
         .withColumn("_salt", F.when(null_key, F.pmod(F.xxhash64(*salt_src), F.lit(1024)).cast("int"))
                     .when(F.col("_n_salt").isNull(), F.lit(0))
                     .otherwise(F.pmod(F.xxhash64(*salt_src), F.col("_n_salt")).cast("int")))
         .drop("_n_salt"))
    s = (small.join(hot_b, keys, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_n_salt"), F.lit(1)) - 1)))
         .drop("_n_salt"))
    return b.join(s, keys + ["_salt"], how).drop("_salt")


def fanout_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", salt_cols: Sequence[str] | None = None,
                hot_rows: int = DEFAULT_HOT_ROWS, pairs: int = PAIRS_PER_TASK, most_tasks: int = MOST_TASKS) -> DataFrame:
    """Equi-join of two sides that both repeat their keys, shared out by the rows that it makes.

    ``how`` is 'inner' or 'left' (big side preserved).  Both sides are written once and the pairs of every key are counted
    exactly.  A key with more than ``pairs`` (more, if that would take over ``2 * most_tasks`` cuts) has its big rows cut
    into ``p`` and its small rows into ``q`` parts; each part meets each, so ``q`` copies of a big and ``p`` of a small row
    are shuffled, about as many as the square root of the cuts.  Rows are dealt by a hash of their place in the written
    files, so neither equal rows nor rows at equal distances meet in one part.

    The small rows of a cut meet the big ones packed in arrays, which are unfolded row by row, so that the join itself
    handles a pair of a big row and an array.  A task holds all that one big row makes in a cut at once: a part therefore
    has about ``PART_ROWS`` small rows at most, also where a key has few pairs.
    """
    keys, spark = list(keys), big.sparkSession
    big, small = written(big, "fanout-big"), written(small, "fanout-small")
    nb, ns = F.col("_nb"), F.col("_ns")
    each = written(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nb"))
                   .join(small.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ns")), keys)
                   .withColumn("_pairs", nb.cast("double") * ns), "pairs")
    total, most = (v or 0 for v in each.agg(F.sum("_pairs"), F.max("_ns")).first())
    if total <= pairs and most <= PART_ROWS:
        if proven_small(small):
            return big.join(F.broadcast(small), keys, how)
        return salted_join(big, small, keys, how, salt_cols=salt_cols, hot_rows=hot_rows)
    unit = max(pairs, total / (2 * most_tasks))
    cuts = F.ceil(F.col("_pairs") / F.lit(float(unit)))
    hot = (each.filter((F.col("_pairs") > F.lit(float(unit))) | (ns > PART_ROWS))        # few: below total / unit, and below rows / PART_ROWS
           .withColumn("_np", F.least(nb, F.greatest(F.lit(1), F.ceil(F.sqrt(cuts * nb / ns)))))
           .withColumn("_nq", F.least(ns, F.greatest(F.ceil(cuts / F.col("_np")), F.ceil(ns / PART_ROWS)))))
    hot = F.broadcast(hot.select(*keys, "_np", "_nq"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()

    def dealt(n, seed: int = 0):
        return F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.coalesce(n, F.lit(1).cast("long")))

    def copies(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(n), F.lit(1).cast("long")) - 1))

    known = big if how == "left" else big.filter(~null_key)
    b = (known.join(hot, keys, "left")
         .withColumn("_np", F.when(null_key, F.lit(1024).cast("long")).otherwise(F.col("_np")))      # they match nothing, but stay
         .withColumn("_p", dealt(F.col("_np"))).withColumn("_q", copies("_nq")).withColumn("_hot", F.col("_nq").isNotNull()).drop("_np", "_nq"))
    row = F.struct(F.lit(True).alias("_met"), *[F.col(f"`{c}`") for c in small.columns if c not in keys])
    s = (small.filter(~null_key).join(hot, keys, "left")
         .withColumn("_q", dealt(F.col("_nq"))).withColumn("_pack", dealt(F.lit(PACKS_PER_CUT).cast("long"), 1))
         .groupBy(*keys, "_q", "_np", "_pack").agg(F.collect_list(row).alias("_rows")).withColumn("_p", copies("_np")).drop("_np", "_pack"))
    tasks = min(most_tasks, max(spark.sparkContext.defaultParallelism, int(total // (2 * unit)) + 1, (big.count() + small.count()) // ROWS_PER_TASK + 1))
    on = [*keys, "_p", "_q"]
    j = b.repartition(tasks, *on).join(s.repartition(tasks, *on).hint("merge"), on, how)
    if how == "left":       # a big row of a hot key meets every part of the small rows, and has its rows from those that are not empty
        j = j.filter(F.col("_rows").isNotNull() | ~F.col("_hot"))
    unfolded = F.inline_outer("_rows") if how == "left" else F.inline("_rows")
    return j.select("*", unfolded).drop("_p", "_q", "_hot", "_rows", "_met")
