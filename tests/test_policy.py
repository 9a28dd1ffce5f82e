"""Missing keys in samples, one duplicate policy everywhere, snapshots run again without rows."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import MIDDLE
from shopsieve.operators import clean, quality
from shopsieve.operators.sampling import sample_exact, sample_fraction
from shopsieve.plans.catalog import agg_region_product
from shopsieve.sinks.snapshot import append_snapshot, read_snapshots


@pytest.mark.parametrize("k", [0, 1, 2, 10, 100, 101, 500])
@pytest.mark.parametrize("sortable", [1, 50_000])
def test_sample_with_a_missing_key(spark, k, sortable):
    rows = spark.range(100).select("id").unionAll(spark.range(1).select(F.lit(None).cast("long").alias("id")))
    got = [r.id for r in sample_exact(rows, k, "id", seed=3, sortable=sortable).collect()]
    assert len(got) == min(k, 101) == len(set(got))


def test_fraction_does_not_depend_on_partitions(spark):
    rows = spark.range(20_000)
    a = {r.id for r in sample_fraction(rows.repartition(3), 0.1, 5, "id").collect()}
    assert a == {r.id for r in sample_fraction(rows.repartition(11), 0.1, 5, "id").collect()} and 1700 < len(a) < 2300


@pytest.mark.parametrize("policy", ["quarantine", "keep_one"])
def test_report_follows_the_policy(edge, edge_rules, policy):
    resolved = clean.resolve(edge, edge_rules, policy)
    kept = clean.with_status(resolved, clean.CLEAN).count()
    per_id = quality.by_id(edge, edge_rules)
    assert quality.report(per_id, edge_rules, policy).first()["valid_pct_rows"] == pytest.approx(100 * kept / edge.count())
    assert quality.totals(per_id, edge_rules, policy).first()["clean_rows"] == kept
    assert clean.split_counts(per_id, edge_rules, policy).first()["clean_rows"] == kept


def test_snapshot_without_rows_replaces(spark, tmp_path):
    aggregated = agg_region_product(spark, MIDDLE.replace("0.01", "0.001"))
    first, second = datetime(2026, 1, 6, 12, 45), datetime(2026, 1, 13, 12, 45)
    for rows, at in ((aggregated, first), (aggregated, second), (aggregated.limit(0), first)):
        append_snapshot(rows, str(tmp_path), at)
    left = read_snapshots(spark, str(tmp_path))
    assert left.count() == aggregated.count() and left.select("import_date").distinct().count() == 1
