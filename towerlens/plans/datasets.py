"""Named datasets (materialized views) with expectations and layout.

``@dataset`` registers a function ``fn(spark, inputs) -> DataFrame`` under a
name, with its upstream names, expectation rules and clustering columns.
``run_datasets`` builds them in dependency order (a depth-first walk over the
declared upstreams -- no scheduler).  A dataset is written beside its place
while its rules are counted, and published by a rename if no fail rule is
broken, else removed: one pass, and readers never see a failed dataset.
Downstream datasets read the published ones, so each plan starts from
materialized data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from towerlens.plans.quality import COUNTS, Expectation, Watched
from towerlens.sources import shared
from towerlens.sources.tables import FILE_BYTES, clustered, ranges_of


@dataclass
class Dataset:
    name: str
    fn: Callable[[SparkSession, Mapping[str, DataFrame]], DataFrame]
    upstream: tuple[str, ...] = ()
    rules: tuple[Expectation, ...] = ()
    cluster_by: tuple[str, ...] = ()
    comment: str = ""


@dataclass
class Registry:
    datasets: dict[str, Dataset] = field(default_factory=dict)

    def dataset(self, name: str, upstream: Sequence[str] = (), rules: Sequence[Expectation] = (),
                cluster_by: Sequence[str] = (), comment: str = ""):
        def deco(fn):
            self.datasets[name] = Dataset(name, fn, tuple(upstream), tuple(rules), tuple(cluster_by), comment)
            return fn
        return deco

    def order(self, names: Sequence[str] | None = None) -> list[str]:
        seen: list[str] = []
        visiting: set[str] = set()

        def visit(n: str) -> None:
            if n in seen:
                return
            if n in visiting:
                raise ValueError(f"dataset cycle through {n!r}")
            visiting.add(n)
            for u in self.datasets[n].upstream:
                if u in self.datasets:
                    visit(u)
            visiting.discard(n)
            seen.append(n)

        for n in names or list(self.datasets):
            visit(n)
        return seen


def publish(df: DataFrame, rules: Sequence[Expectation], path: str, dataset: str = "", cluster_by: Sequence[str] = (),
            file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a dataset beside its place, counting its rules on the way, and put it there only if no fail rule is broken.

    The dataset's plan runs once.  A layout is made from the written rows, whose size decides the number of files.
    Returns the counts, one row a rule."""
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    watched = Watched(df, rules, dataset)
    try:
        watched.rows.write.parquet(beside)
        watched.check()
        done = beside
        if cluster_by:
            done = f"{beside}-ordered"
            stored = spark.read.schema(df.schema).parquet(beside)
            clustered(stored, cluster_by, ranges_of(stored, file_bytes)).write.parquet(done)
        shared.replace(spark, done, path)
    finally:
        shared.delete(spark, beside)
    return spark.createDataFrame(watched.counts(), COUNTS)


def run_datasets(spark: SparkSession, registry: Registry, table_of: Callable[[str], str] | None = None,
                 names: Sequence[str] | None = None, path_of: Callable[[str], str] | None = None
                 ) -> dict[str, DataFrame]:
    """Build, check and publish datasets in dependency order; returns the counts of each dataset's rules.

    With ``path_of`` a dataset is a folder.  Otherwise it is a table, whose files lie in a folder of that name below
    the warehouse; the table is put on the published folder."""
    counts: dict[str, DataFrame] = {}
    published: dict[str, DataFrame] = {}
    for n in registry.order(names):
        d = registry.datasets[n]
        out = d.fn(spark, {u: published[u] for u in d.upstream if u in published})
        if path_of is not None:
            counts[n] = publish(out, d.rules, path_of(n), n, d.cluster_by)
            published[n] = spark.read.schema(out.schema).parquet(path_of(n))
        else:
            table = table_of(n) if table_of else n
            path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/published/{table}"
            counts[n] = publish(out, d.rules, path, n, d.cluster_by)
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.catalog.createTable(table, path=path, source="parquet", schema=out.schema)
            published[n] = spark.read.table(table)
    return counts
