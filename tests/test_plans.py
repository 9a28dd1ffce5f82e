"""The plans that make the queries hold at scale: what is shuffled, where, and how often."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from conftest import SMALL, bag

from __spark_entry__ import queries
from shopsieve.operators import analytics, clean, quality
from shopsieve.operators.sampling import sample_exact
from shopsieve.plans.catalog import QUERIES

EVERYWHERE_FORBIDDEN = ("PythonUDF", "EvalPython", "InPandas", "MapInArrow", "CartesianProduct", "NestedLoopJoin")


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan as adaptive execution left it."""
    df._jdf.queryExecution().toRdd().count()
    return planned(df).split("== Initial Plan ==")[0]


def shuffles(plan: str) -> list[str]:
    return re.findall(r"Exchange (\w+\([^)]*\)|SinglePartition)", plan)


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", list(QUERIES))
def test_stays_in_the_engine(spark, name):
    plan = planned(queries()[name](spark, SMALL))
    assert not [word for word in EVERYWHERE_FORBIDDEN if word in plan]
    # No group is gathered in one task, but for what is limited before the shuffle, and windows within a range.
    if "Window " in plan:
        if name == "win_running_total":
            windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[[^\]]*\]", plan)
            assert windows and all(keys.startswith("__range#") for keys in windows)
        else:
            assert name in ("dq_id_samples", "dq_rule_sketches")
            assert re.search(r"Exchange hashpartitioning\(rule.*\n.*WindowGroupLimit .*Partial", plan)


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")
def test_a_hot_product_is_combined_before_its_group_is_shuffled(spark, set_conf):
    """With large tables the last join must not leave the lines partitioned by product."""
    set_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("agg_region_product", "agg_sale_amount", "agg_grouping_sets", "agg_preview"):
        plan = planned(queries()[name](spark, SMALL))
        assert re.search(r"Exchange hashpartitioning\(region#\d+, product_id#\d+L, .*\n.*partial_count", plan)


def test_verdicts_take_one_narrow_shuffle(edge, edge_rules):
    plan = planned(quality.by_id(edge, edge_rules))
    assert len(shuffles(plan)) == 1
    assert "HashAggregate(keys=[sale_id" in plan
    assert "partial_bit_or" in plan
    assert "SortAggregate" not in plan


def test_split_takes_one_shuffle_with_partial_aggregation(edge, edge_rules):
    plan = planned(clean.resolve(edge, edge_rules))
    assert len(shuffles(plan)) == 1
    assert "partial_min(kept" in plan


def test_report_adds_only_a_single_row_exchange(edge, edge_rules):
    found = shuffles(planned(quality.report(quality.by_id(edge, edge_rules), edge_rules)))
    assert len(found) == 2
    assert "SinglePartition" in found


def test_samples_are_limited_before_the_shuffle(edge, edge_rules):
    plan = planned(quality.id_samples(quality.by_id(edge, edge_rules), edge_rules))
    assert re.search(r"Exchange hashpartitioning\(rule.*\n.*WindowGroupLimit .*Partial", plan)


def test_id_list_join_does_not_shuffle_rows_again(set_conf, edge, edge_rules):
    set_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for side in clean.split_by_ids(edge, quality.bad_ids(edge, edge_rules, "region")):
        plan = planned(side)
        assert "SortMergeJoin" in plan
        # One for the rows and one for the ids.
        assert len(shuffles(plan)) == 2


def test_copies_filter_before_the_shuffle(edge):
    """A table with repeated ids is de-duplicated only as far as the sample goes."""
    plan = planned(sample_exact(clean.dedup_keep_one(edge), 3, "sale_id", 1))
    for branch in plan.split("partial_min(kept")[1:]:
        assert "md5" in branch.split("Scan ExistingRDD")[0]


def test_levels_expand_groups_not_rows(edge):
    plan = planned(analytics.aggregate_levels(edge))
    below_expand = plan[plan.index("Expand") :]
    assert "Exchange hashpartitioning(region" in below_expand


def test_windowed_broadcasts_small_groups_only(set_conf, edge):
    assert "BroadcastHashJoin" in executed(analytics.windowed(edge))
    set_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert "BroadcastHashJoin" not in executed(analytics.windowed(edge))


def test_windowed_splits_a_hot_group(spark, set_conf):
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    rows = spark.range(0, 60_000, 1, 16).selectExpr(
        "id AS sale_id",
        "CASE WHEN id % 3 = 0 THEN 'North' ELSE 'South' END AS region",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 500 END AS product_id",
        "CAST(1 AS DECIMAL(10,2)) AS price",
    )
    df = analytics.windowed(rows)
    assert "SortMergeJoin(skew=true)" in executed(df)
    hot = df.filter("region = 'North'").groupBy("total_sales", "average_sale_amount").count()
    assert bag(hot) == [(20_000, 1.0, 20_000)]
    assert df.count() == 60_000
