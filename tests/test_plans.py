"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import pytest
from conftest import SF01
from millrun.plans import catalog


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _explain(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_rule_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(catalog.q_route(spark, SF01))


def test_json_parsed_once_per_record(spark):
    plan = _explain(catalog.q_start_split(spark, SF01))
    # one from_json (and one to_json of the stand-in) despite the dead-letter filter
    assert plan.count("from_json(") == 1, plan


def test_scans_are_pruned_and_filtered(spark):
    plan = _explain(catalog.q_daily_parts(spark, SF01))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    plan = _explain(catalog.q_interval_join_1h(spark, SF01))
    assert "EqualTo(event_type,click)" in plan and "EqualTo(event_type,purchase)" in plan


@pytest.mark.parametrize("name", ["q_size_stats_window", "q_size_stats_7d", "q_size_stats_coarse"])
def test_size_stats_scan_once_and_shuffle_once(spark, name):
    """All feeds come from one scan of the inspections; with broadcast dims the sums are the only shuffle above it."""
    plan = _plan(catalog.QUERIES[name](spark, SF01))
    assert plan.count("lineitem.parquet") == 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    above = plan[: plan.index("BroadcastHashJoin")]
    assert above.count("Exchange hashpartitioning") == 1 and above.count("HashAggregate") == 2


@pytest.mark.parametrize("name", ["q_new_part_flag", "q_part_stats", "q_unique_part_first"])
def test_no_sort_before_the_partial_aggregate(spark, name):
    assert "SortAggregate" not in _plan(catalog.QUERIES[name](spark, SF01))


def test_unique_part_window_is_bucketed(spark):
    plan = _explain(catalog.q_unique_part(spark, SF01))
    assert "_bucket" in plan and "Window" in plan


def test_declared_schemas_match_files(spark):
    from millrun.sources.tables import TABLE_SCHEMAS, read_table

    for sf in ("/root/testdata/sf0.001", SF01, "/root/testdata/sf0.1"):
        for name in TABLE_SCHEMAS:
            inferred = spark.read.parquet(f"{sf}/{name}.parquet").schema
            declared = read_table(spark, sf, name).schema
            assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in declared], name


def test_cluster_conf_sizes_from_input():
    from millrun.session import cluster_conf

    tb = 1 << 40
    conf = cluster_conf(100 * tb, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * tb // 2 // (256 << 20)
    assert int(cluster_conf(1 << 30, 8000)["spark.sql.shuffle.partitions"]) == 24000  # at least 3 waves
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert conf["spark.sql.files.maxPartitionBytes"] == str(512 << 20)


def test_no_cross_joins_or_row_caps_in_any_query(spark):
    """Every registered query: no cartesian or nested-loop join, no limit,
    and no Python in the plan (every operator runs JVM-side)."""
    import __spark_entry__ as se
    from conftest import SF001

    for name, fn in ((n, f) for n, f in se.queries().items() if n in catalog.QUERIES):
        plan = fn(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "GlobalLimit", "CollectLimit", "LocalLimit",
                    "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert bad not in plan, (name, bad)
