"""Cell-keyed coverage joins.

Buildings (points) join coverage rows on the hexagonal cell key.  The
coverage side is reduced to one row per cell *before* the join (the
aggregation runs map-side first), so the join is N x (distinct cells) and
never fans out.  The building side is the big one and a single cell can hold
a large share of it; the join therefore goes through ``keyed_left_join``:
broadcast when the per-cell table is proven small, otherwise a shuffle join
with hot cells salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.operators.skew import fanout_join, proven_small, row_count_at_most, salted_join, written


def best_per_cell(cells: DataFrame, key: str = "h3_res9_id", distinct_on: str | None = None) -> DataFrame:
    """MAX(mindown), MAX(minup) and the provider count per cell.

    ``distinct_on=None`` counts coverage rows (``COUNT(*)``); ``distinct_on='fid'``
    counts distinct providers (``COUNT(DISTINCT fid)``).
    """
    cnt = F.count(F.lit(1)) if distinct_on is None else F.count_distinct(distinct_on)
    return cells.groupBy(key).agg(
        F.max("mindown").alias("best_download_mbps"),
        F.max("minup").alias("best_upload_mbps"),
        cnt.alias("provider_count"),
    )


def keyed_left_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left",
                    broadcast_rows: int | None = None, salt_cols: Sequence[str] | None = None,
                    hot_rows: int | None = None, store: bool = True) -> DataFrame:
    """Equi-join a big side to a keyed side; broadcast only behind a proven size.

    The keyed side is written once: the size proof adds up the bytes of the
    written rows and the join reads them, so the keyed side's (often
    aggregated) plan runs a single time.  ``store=False`` is for a plain
    table, which costs nothing to read twice.  ``broadcast_rows`` replaces
    the limit in bytes by one in rows.
    """
    if store or not small.inputFiles():
        small = written(small, "keyed")
    if proven_small(small) if broadcast_rows is None else row_count_at_most(small, broadcast_rows) is not None:
        return big.join(F.broadcast(small), list(keys), how)
    kw = {"hot_rows": hot_rows} if hot_rows else {}
    return salted_join(big, small, keys, how, salt_cols=salt_cols, **kw)


def cell_coverage_join(points: DataFrame, cells: DataFrame, key: str = "h3_res9_id", fill: int | None = 0,
                       distinct_on: str | None = None, **kw) -> DataFrame:
    """LEFT join of points to the per-cell best coverage.

    ``fill=0`` turns missing coverage into 0 speeds and 0 providers (gold
    form); ``fill=None`` keeps NULL speeds and count 0 (archive form).
    """
    per_cell = best_per_cell(cells, key, distinct_on)
    j = keyed_left_join(points, per_cell, [key], "left", **kw)
    cnt = F.coalesce(F.col("provider_count"), F.lit(0).cast("bigint")).alias("provider_count")
    if fill is None:
        return j.withColumn("provider_count", cnt)
    return (j.withColumn("best_download_mbps", F.coalesce(F.col("best_download_mbps"), F.lit(fill)))
            .withColumn("best_upload_mbps", F.coalesce(F.col("best_upload_mbps"), F.lit(fill)))
            .withColumn("provider_count", cnt))


def cell_join(points: DataFrame, cells: DataFrame, key: str = "h3_res9_id", how: str = "inner",
              cell_cols: Sequence[str] = ("technology", "mindown", "minup", "environmnt"), **kw) -> DataFrame:
    """Un-aggregated join, one output row per (point, coverage row).

    Fan-out is the semantics here: a cell gives as many rows as its points
    times its coverage rows, so the work is shared out by those rows.
    """
    return fanout_join(points, cells.select(key, *cell_cols), [key], how, **kw)
