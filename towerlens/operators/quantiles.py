"""Exact percentiles without holding a group's values in one place.

Spark's ``percentile`` keeps every distinct value of a group in one buffer.
That is fine for groups of at most ``SMALL_ROWS`` rows, which keep it.  In a
larger group a percentile is one or two values of known rank, and those are
found by narrowing:

1. a quantile sketch (bounded, merged on the way) of the candidates of each
   rank gives a grid of values, and the grid cells around the rank are a
   bracket that holds it, as the sketch's error is far below a cell;
2. one pass counts the values below, at the ends of and inside each bracket,
   which proves that the rank lies there and where; a rank at an end is
   answered, however many rows have that value;
3. the values strictly inside are the candidates of the next round, a few
   hundredths of the former ones; at most ``SMALL_ROWS`` of them are sorted.

Candidates are written, so a round reads what the round before left.  No state
grows beyond a sketch or ``SMALL_ROWS`` values, also if one group has all rows.
Interpolation between two ranks is that of ``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.operators.skew import broadcast_if_proven, written

SMALL_ROWS = 1 << 20
GRID = 256                   # cells of a round's grid
_ACCURACY = 10_000           # of the sketch: ranks are off by at most a ten-thousandth


def exact_percentiles(df: DataFrame, groups: Sequence[str], asked: Sequence[tuple[str, Column, float]],
                      small_rows: int | None = None) -> DataFrame:
    """``groups`` and, for each ``(alias, numeric column, fraction)``, the exact percentile of the column in the group.

    NULL values are left out, a group without values has NULL; NULL group keys are groups; no groups at all give one row."""
    limit = SMALL_ROWS if small_rows is None else small_rows
    keys = [f"_g{i}" for i in range(len(groups))] or ["_g0"]
    own = [F.expr(g) for g in groups] or [F.lit(0)]
    values = [f"_v{i}" for i in range(len(asked))]
    rows = df.select(*[c.alias(k) for c, k in zip(own, keys)], *[c.cast("double").alias(v) for (_, c, _), v in zip(asked, values)])
    plain = [F.percentile(v, p).alias(f"_p{i}") for i, (v, (_, _, p)) in enumerate(zip(values, asked))]
    sizes = rows.groupBy(*keys).agg(*[F.count(v).alias(f"_n{i}") for i, v in enumerate(values)])
    big = written(sizes.filter(F.greatest(*[F.col(f"_n{i}") for i in range(len(asked))], F.lit(0)) > limit), "large-groups")
    out = [*[F.col(k).alias(g) for k, g in zip(keys, groups)], *[F.col(f"_p{i}").alias(a) for i, (a, _, _) in enumerate(asked)]]
    if big.isEmpty():
        return (rows.groupBy(*keys) if groups else rows.groupBy()).agg(*plain).select(*out)
    few = broadcast_if_proven(big.select(*[F.col(k).alias(f"b{k}") for k in keys]))
    same = [F.col(k).eqNullSafe(F.col(f"b{k}")) for k in keys]
    small = rows.join(few, same, "left_anti").groupBy(*keys).agg(*plain)
    if not groups:
        small = small.limit(0)
    found = _select(rows.join(few, same, "left_semi"), big, keys, [p for _, _, p in asked], limit)
    return small.unionByName(found).select(*out)


def _select(rows: DataFrame, big: DataFrame, keys: list[str], fractions: list[float], limit: int) -> DataFrame:
    """Percentiles of large groups.  A target is one of the two ranks (``_side``) about a place (``_at``) among the values
    of one measure of one group, and belongs to a set of candidates."""
    names = [*keys, "_m"]
    measures = F.array(*[F.struct(F.lit(i).alias("_m"), F.col(f"_v{i}").alias("_v")) for i in range(len(fractions))])
    places = F.array(*[F.struct(F.lit(i).alias("_m"), ((F.col(f"_n{i}") - 1) * F.lit(float(p))).alias("_at")) for i, p in enumerate(fractions)])
    candidates = written(rows.select(*keys, F.inline(measures)).filter(F.col("_v").isNotNull()).withColumn("_set", F.lit(0)), "values")
    targets = written(big.select(*keys, F.inline(places)).filter(F.col("_at") >= 0).select(
        *names, F.lit(0).alias("_set"), "_at", F.posexplode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_side", "_k")), "targets")
    answers = []
    while not targets.isEmpty():
        grid = candidates.groupBy(*names, "_set").agg(
            F.percentile_approx("_v", [i / GRID for i in range(GRID + 1)], _ACCURACY).alias("_grid"), F.count(F.lit(1)).alias("_n"))
        cell = F.floor(F.col("_k") * GRID / F.col("_n")).cast("int")
        brackets = written(_meet(grid, targets, names).select(
            *names, "_set", "_side", "_at", "_k", F.when(cell >= 2, F.get("_grid", cell - 2)).alias("_low"),
            F.when(cell + 3 <= GRID, F.get("_grid", cell + 3)).alias("_high")), "brackets")
        v, low, high = F.col("_v"), F.col("_low"), F.col("_high")
        between = (low.isNull() | (v > low)) & (high.isNull() | (v < high))
        counts = written(_meet(candidates, brackets, names).groupBy(*names, "_set", "_side", "_at", "_k", "_low", "_high").agg(
            F.count_if(v < low).alias("_below"), F.count_if(v == low).alias("_first"), F.count_if(between).alias("_mid"),
            F.count_if(v == high).alias("_last")), "counts")
        inner = F.col("_k") - F.col("_below") - F.col("_first")
        is_low, is_mid = (inner < 0) & (F.col("_k") >= F.col("_below")), (inner >= 0) & (inner < F.col("_mid"))
        is_high = (inner >= F.col("_mid")) & (inner < F.col("_mid") + F.col("_last"))
        if not counts.filter(~(is_low | is_mid | is_high)).isEmpty():
            raise RuntimeError("a quantile sketch was further off than its accuracy allows")
        answers.append(counts.filter(~is_mid).select(*names, "_side", "_at", F.when(is_low, low).otherwise(high).alias("_value")))
        open_ones = written(counts.filter(is_mid).select(*names, "_set", "_side", "_at", inner.alias("_k"), "_low", "_high",
                                                         (F.col("_mid") <= limit).alias("_few")), "open")
        kept = written(_meet(candidates, open_ones, names).filter(between).select(
            *names, "_side", "_at", "_k", "_few", "_v", _set_of()), "candidates")
        answers.append(kept.filter("_few").groupBy(*names, "_side", "_at", "_k").agg(F.sort_array(F.collect_list("_v")).alias("_all"))
                       .select(*names, "_side", "_at", F.get("_all", F.col("_k").cast("int")).alias("_value")))
        targets = open_ones.filter(~F.col("_few")).select(*names, "_side", "_at", "_k", _set_of())
        candidates = kept.filter(~F.col("_few")).select(*names, "_set", "_v")
    found = reduce(DataFrame.unionByName, answers)
    value = {side: F.max(F.when(F.col("_side") == side, F.col("_value"))) for side in (0, 1)}
    at = F.first("_at")
    per = found.groupBy(*names).agg(F.when(value[0] == value[1], value[0]).otherwise(
        (F.ceil(at) - at) * value[0] + (at - F.floor(at)) * value[1]).alias("_p"))
    return per.groupBy(*keys).agg(*[F.max(F.when(F.col("_m") == i, F.col("_p"))).alias(f"_p{i}") for i in range(len(fractions))])


def _set_of() -> Column:
    """After a round each target has candidates of its own."""
    return (F.col("_side") + 1).alias("_set")


def _meet(candidates: DataFrame, targets: DataFrame, names: list[str]) -> DataFrame:
    """Candidates (or what is known of them) with each target of their set; groups may be NULL.  There are few targets:
    two for each large group and measure."""
    own = [*names, "_set"]
    other = targets.withColumnsRenamed({c: f"t{c}" for c in own})
    return candidates.join(broadcast_if_proven(other) if other.inputFiles() else other,
                           [F.col(c).eqNullSafe(F.col(f"t{c}")) for c in own]).drop(*[f"t{c}" for c in own])
