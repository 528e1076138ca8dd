"""Session helpers.

On a cluster the session is built by the platform; the library only reads
settings from it.  ``local_session`` is for tests and the bench: it sets the
few knobs that matter on one machine and, only when unset, a checkpoint
directory in a fresh scratch folder.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "towerlens") -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small shuffles feeding CPU-heavy geometry stages should still use every core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TOWERLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's value is always kept.  Only when nothing is configured on a
    local master (a test run) a fresh scratch folder is made and registered;
    on any other master executors would each write to a disk of their own, so
    a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="towerlens-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def run_folder(spark: SparkSession) -> str:
    """The folder of this application below the checkpoint folder: all that the library writes on its way lies there,
    so that ``remove_intermediates`` can take it away."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/towerlens-{spark.sparkContext.applicationId}"


def remove_intermediates(spark: SparkSession) -> None:
    """Remove what the library wrote on its way in this application.  For when its results have been stored or read:
    frames that it returned read these files."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
