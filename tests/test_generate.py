"""Synthetic sales: domains, seeded defects, and samples of an exact size."""

from __future__ import annotations

import hashlib
from datetime import date

import pytest
from conftest import bag, ids_of
from pyspark.sql import functions as F

from shopsieve.operators import quality
from shopsieve.operators.rules import REGIONS, sales_rules
from shopsieve.operators.sampling import sample_exact, sample_fraction
from shopsieve.sources import generate

START, END, N, SEED = date(2026, 1, 1), date(2026, 6, 30), 20_000, 11


@pytest.fixture(scope="module")
def valid(spark):
    return generate.gen_sales(spark, N, SEED, START, END).cache()


def test_domains(valid):
    low_high = valid.agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in valid.columns if c != "region" for f in (F.min, F.max)],
        F.sort_array(F.collect_set("region")).alias("regions"),
        F.count_distinct("sale_id").alias("ids"),
    ).first()
    assert (low_high.min_sale_id, low_high.max_sale_id, low_high.ids) == (1, N, N)
    assert (low_high.min_customer_id, low_high.max_customer_id) == (1, 1000)
    assert (low_high.min_product_id, low_high.max_product_id) == (1, 500)
    assert (low_high.min_quantity, low_high.max_quantity) == (1, 10)
    assert low_high.min_price >= 10
    assert low_high.max_price <= 1000
    assert low_high.regions == sorted(REGIONS)
    assert (low_high.min_sale_date, low_high.max_sale_date) == ("2026-01-01", "2026-06-30")


def test_values_are_spread_evenly_and_independently(valid):
    pairs = valid.groupBy("region", "quantity").count().collect()
    assert len(pairs) == 40
    assert all(abs(r["count"] - N / 40) < 6 * (N / 40) ** 0.5 for r in pairs)


def test_valid_sales_pass_all_rules(valid):
    assert quality.bad_ids(valid, sales_rules(START, END)).count() == 0


def test_same_rows_on_any_partitioning(spark, valid):
    ids = generate.id_range(spark, 1, N).repartition(7)
    again = generate.sales_for(ids, SEED, START, END)
    assert again.exceptAll(valid).count() == valid.exceptAll(again).count() == 0
    other_seed = generate.gen_sales(spark, N, SEED + 1, START, END)
    assert other_seed.select("price").subtract(valid.select("price")).count() > 0


def test_seeded_defects_are_found_exactly(spark):
    table = generate.gen_table(spark, N, SEED, START, END)
    assert table.count() == N + 100 + 10
    rules = sales_rules(START, END)
    assert ids_of(quality.bad_ids(table, rules, "date_range")) == set(range(N + 1, N + 101))
    unreadable = ids_of(quality.bad_ids(table, rules, "date_format"))
    assert 30 < len(unreadable) < 70
    repeated = ids_of(quality.bad_ids(table, rules, "duplicate"))
    assert len(repeated) == 10
    assert repeated <= set(range(1, N + 1))
    assert quality.bad_ids(table, rules).count() == 110
    assert quality.bad_ids(table, rules, "region", "quantity", "price").count() == 0
    days = table.filter("sale_id > 20000 AND sale_date <> 'invalid'").agg(F.min("sale_date"), F.max("sale_date")).first()
    assert "2026-06-30" < days[0] <= days[1] <= "2028-06-29"


def test_copies_are_exact(valid):
    copies = generate.inject_duplicates(valid, N, SEED, unique_key=True)
    assert copies.count() == 10
    assert copies.exceptAll(valid).count() == 0


def test_copies_of_a_table_with_repeated_ids_have_distinct_ids(valid):
    hot = valid.filter("sale_id <= 300").unionByName(valid.filter("sale_id = 5").crossJoin(
        valid.sparkSession.range(150)).drop("id"))
    copies = generate.inject_duplicates(hot, 1000, SEED, share=0.1)
    assert copies.count() == len(ids_of(copies.select("sale_id"))) == 100


def _by_hash(ids, seed):
    return sorted(ids, key=lambda i: hashlib.md5(f"{i}:sample:{seed}".encode()).hexdigest())


@pytest.mark.parametrize("sortable", [0, 1, 50, 100_000])
@pytest.mark.parametrize("k", [0, 1, 37, 4_999, 5_000, 6_000])
def test_exact_sample_is_the_head_of_the_hash_order(spark, k, sortable):
    ids = spark.range(5_000).withColumnRenamed("id", "sale_id")
    sample = sample_exact(ids, k, "sale_id", 3, sortable=sortable)
    assert ids_of(sample) == set(_by_hash(range(5_000), 3)[:k])


def test_exact_sample_takes_every_column_along(valid):
    sample = sample_exact(valid, 25, "sale_id", 3)
    assert sample.columns == valid.columns
    assert bag(sample.select("sale_id")) == sorted(((i,) for i in _by_hash(range(1, N + 1), 3)[:25]), key=str)


def test_fraction(valid):
    assert 800 < sample_fraction(valid, 0.05, 1, "sale_id").count() < 1200


def test_share_is_rounded_down_exactly():
    assert generate.share_of(1_000_000, 0.005) == 5_000
    assert generate.share_of(1_000_000, 0.0005) == 500
    assert generate.share_of(1_999, 0.0005) == 0
    assert generate.share_of(100, 0.29) == 29  # int(100 * 0.29) is 28
