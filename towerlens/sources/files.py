"""File readers: headerless CSV with positional names, declared schema, header + inference.

Text ingest casts leniently (``try_cast``): a malformed number becomes NULL
and is then removed by the dataset's drop rules, instead of failing the job
(Spark is ANSI by default and a plain cast would raise).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 14 columns of the tower feed (bronze) and their types;
# created/updated are epoch seconds rendered as text timestamps.
TOWER_COLUMNS = [
    ("radio", "string"), ("mcc", "int"), ("net", "int"), ("area", "int"), ("cell", "bigint"),
    ("unit", "int"), ("lon", "double"), ("lat", "double"), ("range_m", "int"), ("samples", "int"),
    ("changeable", "int"), ("created_ts", "epoch_text"), ("updated_ts", "epoch_text"), ("avg_signal", "int"),
]
KPI_COLUMNS = [
    ("tower_id", "bigint"), ("event_ts", "timestamp"), ("prb_utilization_pct", "double"),
    ("latency_ms", "double"), ("packet_loss_pct", "double"), ("throughput_mbps", "double"),
]
DEMAND_COLUMNS = [
    ("building_id", "bigint"), ("event_ts", "timestamp"), ("demand_users", "bigint"),
    ("traffic_mix", "string"), ("indoor_penetration_factor", "double"),
]


def epoch_text(col) -> Column:
    """``from_unixtime(bigint)`` -> 'yyyy-MM-dd HH:mm:ss' in the session time zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_unixtime(c.try_cast("bigint"))


def typed(columns: Sequence[tuple[str, str]], source_cols: Sequence[str] | None = None) -> list[Column]:
    """Positional text columns -> named, leniently cast columns."""
    out = []
    for i, (name, typ) in enumerate(columns):
        src = F.col(source_cols[i] if source_cols else f"_c{i}")
        if typ == "epoch_text":
            out.append(epoch_text(src).alias(name))
        elif typ == "string":
            out.append(src.cast("string").alias(name))
        else:
            out.append(src.try_cast(typ).alias(name))
    return out


def text_schema(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n)])


def read_headerless_csv(spark: SparkSession, path: str, columns: Sequence[tuple[str, str]],
                        glob: str | None = None, recursive: bool = False) -> DataFrame:
    """S3: headerless (optionally gzip) CSV -> named, typed columns."""
    r = spark.read.schema(text_schema(len(columns))).option("header", "false")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.csv(path).select(*typed(columns))


def read_csv_schema(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """CSV with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE").csv(path)


def read_csv_infer(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row and inferred types (one extra pass over the data)."""
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


def write_shard(df: DataFrame, directory: str, compression: str = "gzip") -> None:
    """Append one headerless gzip CSV shard (Spark names the files uniquely)."""
    df.write.mode("append").option("header", "false").option("compression", compression).csv(directory)
