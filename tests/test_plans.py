"""Plan shapes that matter at scale (checked on the executed physical plans)."""

from pyspark.sql import functions as F

import __spark_entry__ as E

from .conftest import SF_SMALL


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()          # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_has_no_pair_product(spark):
    p = plan(E.queries()["nearest_tower"](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_contains_join_is_an_equi_join(spark):
    p = plan(E.queries()["contains_join"](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "HashJoin" in p or "SortMergeJoin" in p


def test_latest_per_key_aggregates_without_window(spark):
    p = plan(E.queries()["kpis_latest"](spark, SF_SMALL))
    assert "Window" not in p
    assert "partial_max" in p


def test_scan_reads_only_needed_columns(spark):
    df = E.queries()["bbox_padded"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    # the tower fixture needs only the supplier key from the parquet file
    assert "ReadSchema: struct<s_suppkey:bigint>" in text


def test_pushed_filter_reaches_parquet(spark):
    from towerlens.plans.fixtures import table

    df = table(spark, SF_SMALL, "part").filter(F.col("p_size") > 40).select("p_partkey")
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,40)]" in df._jdf.queryExecution().executedPlan().toString()
