"""The nearest row by a cross join and ROW_NUMBER, for tests on small inputs."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from towerlens.operators.nearest import distance


def nearest_bruteforce(left, right, *, left_xy, right_xy, right_id, left_keys, right_cols=(), dist_col="distance_m", metric="sphere"):
    rcols = [right_id] + [c for c in right_cols if c != right_id]
    r = right.select(F.col(right_xy[0]).alias("_rx"), F.col(right_xy[1]).alias("_ry"), *rcols)
    d = distance(metric, F.col(left_xy[0]), F.col(left_xy[1]), F.col("_rx"), F.col("_ry"))
    w = Window.partitionBy(*left_keys).orderBy(F.floor(d * 1e6), F.col(right_id))
    return (left.crossJoin(r).withColumn(dist_col, d).withColumn("_rn", F.row_number().over(w))
            .filter("_rn = 1").drop("_rn", "_rx", "_ry"))
