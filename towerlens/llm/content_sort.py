"""Exact duplicates by sorting contents (DataFrame functions only).

Sampled splitters range-partition the rows by content (a bounded prefix of
the normalised text, then its 64-bit hash, so that splitters stay small and
texts that share a long opening still part); an external sort puts equal texts
next to each other; the window that follows compares each whole text with its
neighbour and keeps the smallest identifier of every run.

A text that a sample shows to hold a notable share of the rows is cut over
several ranges by a salt of its rows' ids, and, where one id (or none) has a
notable share of such a text, of their places in the input too.  Its ranges are joined through a small table (one
row per such text, at most ``4 x partitions`` of them), filled by a
pre-aggregating group-by over whole texts.

Defined cases: null text counts as empty; empty texts are equal to each
other; a null id sorts after all others, so ``keep_id`` is null only where a
group has no id at all; of rows that repeat id and text one is kept; an empty
table gives an empty result; further columns, whatever their names, are left
alone (``drop_exact_duplicates``) or not read (``exact_duplicates``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import stored

#: bytes 0x20 and 0x09 to 0x0D, in runs
WHITE = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 64
SAMPLE_ROWS = 20_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _hot_texts(rows: DataFrame, partitions: int) -> tuple[DataFrame | None, bool]:
    """Hash and salt count of the texts which a sample shows to exceed a quarter of a partition, and whether one id (or
    none) has that many rows of such a text."""
    total = rows.count()
    if not total:
        return None, False
    share = min(1.0, SAMPLE_ROWS / total)
    sampled = max(1.0, total * share)
    least = max(3, int(sampled / (4 * partitions)))
    counts = (rows.sample(share, 17).groupBy(F.xxhash64(normalised(F.col("text"))).alias("content"), F.xxhash64("id").alias("who"))
              .count().groupBy("content").agg(F.sum("count").alias("count"), F.max("count").alias("most")))
    found = (counts.filter(F.col("count") >= least)
             .withColumn("cuts", F.greatest(F.lit(2), F.ceil(F.col("count") * (4 * partitions / sampled)).cast("int")))
             .select("content", "cuts", "most").collect())       # at most sampled / least rows
    if not found:
        return None, False
    hot = rows.sparkSession.createDataFrame([(r["content"], r["cuts"]) for r in found], "content long, cuts int")
    return hot, any(r["most"] >= least for r in found)


def _sorted_runs(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows ``(row, id, content, cuts, text, keep, size, nth)``, and the table of hot texts."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).select(
        "row", F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).alias("text"))
    hot, same_ids = _hot_texts(rows, partitions)
    keyed = rows.withColumn("norm", normalised(F.col("text"))).select(
        "row", "id", F.substring("norm", 1, PREFIX_CHARS).alias("prefix"), F.xxhash64("norm").alias("content"))
    keys = ["prefix", "content"]
    if hot is not None:
        # rows of a hot text are told apart by their ids; many rows of one id by their place in the input as well, which is
        # written first, so that every later step sees the same salts
        place = [F.monotonically_increasing_id()] if same_ids else []
        keyed = keyed.join(F.broadcast(hot), "content", "left").withColumn("salt", F.when(F.col("cuts").isNull(), 0).otherwise(
            F.pmod(F.xxhash64("id", *place), F.col("cuts"))).cast("int"))
        if same_ids:
            keyed = stored(keyed, "salted")
        keys.append("salt")
    ranged = keyed.repartitionByRange(*keys)
    # the text is normalised again after the exchange, so that it crosses it once only
    ranged = ranged.withColumn("norm", normalised(F.col("row").getField(text_col)))
    # the ranges already hold equal keys together, so this adds a sort and no exchange
    run = Window.partitionBy(*keys, "norm")
    out = (ranged
           .withColumn("nth", F.row_number().over(run.orderBy(F.col("id").asc_nulls_last())))
           .withColumn("keep", F.min("id").over(run))
           .withColumn("size", F.count(F.lit(1)).over(run)))
    if hot is None:
        return out, None
    # whole texts are the grouping keys; each map task sends at most one row for each hot text
    groups = (keyed.filter(F.col("cuts").isNotNull())
              .groupBy(normalised(F.col("row").getField(text_col)).alias("norm"))
              .agg(F.min(F.struct(F.col("id").isNull(), "id", "salt")).alias("first"), F.count(F.lit(1)).alias("hot_size"))
              .select(F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), F.col("first.id").alias("hot_keep"),
                      F.col("first.salt").alias("hot_salt"), "hot_size"))
    return out, groups


def _resolved(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    out, groups = _sorted_runs(df, id_col, text_col)
    out = out.withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
    if groups is not None:
        out = out.join(F.broadcast(groups), "sha", "left").withColumns({
            "keep": F.when(F.col("hot_size").isNull(), F.col("keep")).otherwise(F.col("hot_keep")),
            "size": F.coalesce("hot_size", "size"),
            # of a hot text the row that stays is the first one of one salt
            "nth": F.when(F.col("hot_size").isNull() | (F.col("salt") == F.col("hot_salt")), F.col("nth")).otherwise(0)})
    return out.withColumn("kept", (F.col("nth") == 1) & F.col("id").eqNullSafe(F.col("keep")))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` (of the normalised text)."""
    narrow = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return _resolved(narrow, "id", "text").select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "kept",
        F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows and columns, with one row (of the smallest id) of each group of equal texts."""
    return _resolved(df, id_col, text_col).filter("kept").select("row.*")
