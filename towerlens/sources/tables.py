"""Tables: scan by name, overwrite, create-as-select, views, namespaces, profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.operators.skew import file_bytes as file_bytes_of
from towerlens.operators.skew import memory_bytes, written


FILE_BYTES = 128 << 20
SORT_BYTES = 256 << 20          # of rows in memory, that one task should sort
_CURVE_BITS = 16
_CUTS = 256


def hilbert_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on a Hilbert curve of points of a grid, ``(n, dimensions)`` integers below ``2 ** bits``.  Neighbours on the
    curve are neighbours on the grid, so a stretch of the curve is a compact region (Skilling's transform of axes)."""
    x = cells.astype(np.int64).T.copy()
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(len(x)):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(flip, q - 1, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & q, q - 1, 0)
    x ^= turn
    place = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            place = place << 1 | axis >> b & 1
    return place


def curve_key(df: DataFrame, columns: Sequence[str]) -> Column | None:
    """Place of a row on a Hilbert curve over ``columns``, each by its rank among the column's quantiles, so that crowded
    regions are cut as finely as they are full.  None if a column is not numeric or there is only one."""
    if len(columns) < 2 or not all(isinstance(df.schema[c].dataType, T.NumericType) for c in columns):
        return None
    bits = min(_CURVE_BITS, 62 // len(columns))
    wide = [F.col(f"`{c}`").cast("double") for c in columns]
    cuts = df.agg(*[F.percentile_approx(F.when(~F.isnan(c), c), [i / _CUTS for i in range(_CUTS + 1)], 5000).alias(f"q{i}") for i, c in enumerate(wide)]).first()
    known = [np.unique(np.asarray(q if q else [0.0])) for q in cuts]

    @F.pandas_udf("long")
    def place(*values: pd.Series) -> pd.Series:
        ranks = [np.interp(np.nan_to_num(v.to_numpy(float), nan=q[0]), q, np.linspace(0, 2 ** bits - 1, len(q))) for v, q in zip(values, known)]
        return pd.Series(hilbert_place(np.stack(ranks, axis=1).astype(np.int64), bits))

    return place(*wide)


def ranges_of(stored: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """How many ranges a frame that reads files is cut into: each takes ``file_bytes`` at most as a file and, as equal
    values take little room in files, ``SORT_BYTES`` in the task that sorts it."""
    return max(1, -(-file_bytes_of(stored) // file_bytes), -(-memory_bytes(stored) // SORT_BYTES))


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Rows in ``files`` ranges, so that statistics of files and row groups prune on every one of ``columns``: by place on
    a curve over several numeric columns, else by their order.  Rows with equal values are cut too, by their place in
    ``df``, so that no task has all rows of a frequent value."""
    key = curve_key(df, columns)
    if key is not None:
        df, columns = df.withColumn("_curve", key), ["_curve"]
    out = df.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(files, *columns, "_place")
    return out.sortWithinPartitions(*columns).drop("_curve", "_place")


def write_table(df: DataFrame, name: str | None = None, *, path: str | None = None, fmt: str = "parquet",
                overwrite_schema: bool = False, files: int | None = None, file_bytes: int = FILE_BYTES,
                cluster_by: Sequence[str] | None = None, partition_by: Sequence[str] | None = None) -> None:
    """K1/K4/K5/K6: overwrite a managed table (or a path).

    ``files`` fixes the file count.  ``cluster_by`` lays rows out so that reads which filter on those columns open few
    files (see ``clustered``); without ``files`` the rows are written once as they come, and their size decides how many
    files of ``file_bytes`` they take (cutting into ranges would run the plan twice anyway, to find the cuts).
    """
    out = df
    if cluster_by:
        if not files:
            out = written(df, "unordered")
            files = ranges_of(out, file_bytes)
        out = clustered(out, cluster_by, files)
    elif files:
        out = out.repartition(files)
    w = out.write.mode("overwrite").format(fmt)
    if overwrite_schema:
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is not None:
        w.save(path)
    else:
        if name is None:
            raise ValueError("write_table: a table name or a path is required")
        w.saveAsTable(name)


def file_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each file of a table: path, rows, and least and largest value of each of ``columns``."""
    ends = [f(F.col(f"`{c}`")).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)


def ctas(spark: SparkSession, name: str, query: str, **kw) -> DataFrame:
    """K3: create-or-replace a table from a query (written through ``write_table``)."""
    write_table(spark.sql(query), name, **kw)
    return spark.read.table(name)


def use_namespace(spark: SparkSession, schema: str, create: bool = True) -> None:
    """CREATE SCHEMA IF NOT EXISTS + USE."""
    if create:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.sql(f"USE {schema}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def preview(df: DataFrame, n: int = 1000) -> DataFrame:
    """The first n rows (a LIMIT, still lazy)."""
    return df.limit(n)


def text_lengths(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """the longest text of each column, and how many texts there are, in one pass."""
    wide = df.agg(*[f(F.length(F.col(f"`{c}`")) if f is F.max else F.col(f"`{c}`")).alias(f"{f.__name__}{i}")
                    for i, c in enumerate(columns) for f in (F.max, F.count)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"max{i}").alias("longest"), F.col(f"count{i}").alias("n"))
                     for i, c in enumerate(columns)])
    return wide.select(F.lit(name).alias("table_name"), F.inline(rows))


def table_summary(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> DataFrame:
    """One row per table -- name, rows, column count, column names.

    Counts are separate distributed aggregations unioned together; a name
    that does not resolve is reported with NULL counts, not raised.
    """
    parts = []
    missing = []
    for name, src in tables.items():
        try:
            df = spark.read.table(src) if isinstance(src, str) else src
            cols = df.columns
        except Exception:  # noqa: BLE001 - a missing table is reported, not fatal
            missing.append(name)
            continue
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(cols)).alias("n_cols"),
            F.lit(", ".join(cols)).alias("columns")))
    schema = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("rows", T.LongType()),
                           T.StructField("n_cols", T.IntegerType()), T.StructField("columns", T.StringType())])
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    if missing:
        miss = spark.createDataFrame([(m, None, None, None) for m in missing], schema)
        out = miss if out is None else out.unionByName(miss)
    return out if out is not None else spark.createDataFrame([], schema)
