"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import __spark_entry__ as E
from strata.plans import dashboard as Q
from strata.plans import gold

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_anywhere(spark):
    own = set(E.llm.queries()) if E.llm else set()
    for name, fn in E.queries().items():
        if name in own or name == "stream_silver":
            continue
        p = _plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scan_prunes_columns(spark):
    plan = _plan(E._risk(spark, SF))
    assert "l_extendedprice" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_dedup_combines_map_side(spark):
    plan = _plan(E._crashes(spark, SF))
    assert "partial_max" in plan


def test_per_group_topk_limits_before_shuffle(spark):
    plan = _plan(Q.top_hotspots(E._hot(spark, SF)))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_preview_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(Q.preview(E._crashes(spark, SF)))


def test_normalised_risk_uses_scalar_subquery_not_a_cartesian_product(spark):
    p = _plan(gold.normalised_risk(E._risk(spark, SF)))
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_no_cross_products_in_registered_queries(spark):
    own = set(E.llm.queries()) if E.llm else set()
    for name, fn in E.queries().items():
        if name in own or name == "stream_silver":
            continue
        p = _plan(fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_stored_silver_scan_reads_only_used_columns(spark):
    plan = _plan(E._risk(spark, SF))
    schema = [line for line in plan.splitlines() if "ReadSchema" in line][0].split("ReadSchema")[1]
    assert "injuries_total" not in schema and "crash_record_id" not in schema


def test_global_top_k_has_no_full_single_task(spark):
    """A limit per task comes before the single partition, for small and large k."""
    from strata.operators.rank import top_k
    from pyspark.sql import functions as F

    for k in (10, 5000):
        df = top_k(spark.range(20_000), [F.col("id").desc()], k, rank_col="rank")
        assert df.count() == k
        assert "TakeOrderedAndProject" in _plan(df)
    rows = spark.range(20_000).select((F.col("id") % 2).alias("g"), "id")
    assert top_k(rows, [F.col("id").asc()], 3000, partition_by=["g"]).count() == 6000


def test_global_top_k_is_take_ordered(spark):
    df = Q.top_risk(E._risk(spark, SF))
    df.collect()
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
