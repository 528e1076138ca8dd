"""Folders and small files in whatever store Spark writes to, through Hadoop's file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if it is not there."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, where = _at(spark, path)
    return fs.getContentSummary(where).getLength()


def replace(spark: SparkSession, made: str, path: str) -> None:
    """Put a finished folder or file in the place of ``path``.  The old one goes last before the rename; a store without
    renames copies."""
    fs, new = _at(spark, made)
    _, old = _at(spark, path)
    fs.mkdirs(old.getParent())
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"could not rename {made} to {path}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: it is written beside its place and renamed."""
    fs, beside = _at(spark, f"{path}.new")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    replace(spark, f"{path}.new", path)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    size = fs.getFileStatus(where).getLen()
    source = fs.open(where)
    try:
        return bytes(source.readNBytes(int(size))).decode()
    finally:
        source.close()
