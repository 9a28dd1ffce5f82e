"""What must hold for any table: checked against plain Python on random small ones."""

from __future__ import annotations

from collections import defaultdict
from datetime import date
from decimal import Decimal

from conftest import bag, ids_of, sales_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopsieve.operators import analytics, clean, quality
from shopsieve.operators.rules import sales_rules

START, END = date(2026, 1, 1), date(2026, 6, 30)

rows = st.lists(
    st.tuples(
        st.none() | st.integers(0, 6),
        st.none() | st.integers(1, 2),
        st.none() | st.integers(1, 2),
        st.none() | st.integers(0, 11),
        st.none() | st.sampled_from([Decimal("0.00"), Decimal("0.01"), Decimal("999.99"), Decimal("1000.01")]),
        st.none() | st.sampled_from(["North", "South", "Centre"]),
        st.none() | st.sampled_from(["2026-01-01", "2026-06-30", "2026-07-01", "2026-02-03x", "invalid", ""]),
    ),
    max_size=25,
)
on_spark = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _row_rules(row):
    _, _, _, quantity, price, region, day = row
    if day is not None and not (day[:4].isdigit() and day[4:5] == "-" and day[5:7].isdigit() and day[7:8] == "-"):
        yield "date_format"
    if day is not None and not "2026-01-01" <= day <= "2026-06-30":
        yield "date_range"
    if region not in (None, "North", "South", "East", "West"):
        yield "region"
    if quantity is not None and not 1 <= quantity <= 10:
        yield "quantity"
    if price is not None and not Decimal("0.01") <= price <= 1000:
        yield "price"


def _expected(table):
    groups, broken = defaultdict(list), defaultdict(set)
    for row in table:
        groups[row[0]].append(row)
        broken[row[0]].update(_row_rules(row))
    for key, members in groups.items():
        if len(members) > 1:
            broken[key].add("duplicate")
    return groups, broken


def _nulls_first(row):
    return [(value is not None, value) if value is not None else (False, 0) for value in row[1:]]


@on_spark
@given(table=rows)
def test_verdicts(spark, table):
    groups, broken = _expected(table)
    df, rules = sales_frame(spark, table), sales_rules(START, END)
    per_id = quality.by_id(df, rules)
    assert {tuple(r) for r in quality.violations(per_id, rules).collect()} == {
        (name, key) for key, names in broken.items() for name in names
    }
    first = {key: min(members, key=_nulls_first) for key, members in groups.items()}
    resolved = clean.resolve(df, rules)
    for status, wanted in ((clean.CLEAN, False), (clean.QUARANTINE, True)):
        rows_of_side = clean.with_status(resolved, status).collect()
        assert {r.sale_id: tuple(r) for r in rows_of_side} == {k: v for k, v in first.items() if bool(broken[k]) is wanted}
    assert {r.sale_id: tuple(r) for r in clean.dedup_keep_one(df).collect()} == first


@on_spark
@given(table=rows)
def test_windowed_equals_a_window(spark, table):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = sales_frame(spark, table)
    over = Window.partitionBy("region", "product_id")
    count, total = F.count("sale_id").over(over), F.sum("price").over(over).cast("decimal(20,2)")
    expected = df.select(
        "*",
        count.alias("total_sales"),
        total.alias("total_sales_amount"),
        F.try_divide(total.cast("double"), count.cast("double")).alias("average_sale_amount"),
    )
    assert bag(analytics.windowed(df)) == bag(expected)


@on_spark
@given(table=rows)
def test_levels_equal_separate_groupings(spark, table):
    df = sales_frame(spark, table)
    levels = analytics.aggregate_levels(df)
    for grouping_id, keys in ((0, ["region", "product_id"]), (1, ["region"]), (2, ["product_id"])):
        columns = [*keys, *analytics.MEASURES]
        assert bag(levels.filter(f"grouping_id = {grouping_id}").select(columns)) == bag(analytics.aggregate(df, keys))


def test_both_sides_make_up_the_whole(edge, edge_rules):
    resolved = clean.resolve(edge, edge_rules)
    sides = clean.with_status(resolved, clean.CLEAN).unionByName(clean.with_status(resolved, clean.QUARANTINE))
    assert bag(sides) == bag(clean.dedup_keep_one(edge))


def test_clean_rows_are_clean(edge, edge_rules):
    kept = clean.with_status(clean.resolve(edge, edge_rules), clean.CLEAN)
    assert quality.bad_ids(kept, edge_rules).count() == 0


def test_order_and_partitioning_do_not_matter(edge, edge_rules):
    expected = bag(clean.resolve(edge, edge_rules))
    shuffled = edge.orderBy("price", "sale_id").repartition(5)
    assert bag(clean.resolve(shuffled, edge_rules)) == expected
    assert bag(clean.resolve(edge.coalesce(1), edge_rules)) == expected


def test_a_third_of_all_rows_in_one_id(spark, edge, edge_rules):
    hot = spark.range(3_000).selectExpr(
        "id % 7 AS customer_id", "id AS product_id", "1 AS quantity", "CAST(5 AS DECIMAL(10,2)) AS price"
    )
    for key in ("CAST(1 AS BIGINT)", "CAST(NULL AS BIGINT)"):
        rows = hot.selectExpr(f"{key} AS sale_id", "*", "'North' AS region", "'2026-02-01' AS sale_date")
        both = edge.unionByName(rows.select(edge.columns)).repartition(4)
        resolved = {r.sale_id: r for r in clean.resolve(both, edge_rules).collect()}
        hot_id = rows.first().sale_id
        assert resolved[hot_id].n_rows >= 3_000
        assert resolved[hot_id].status == clean.QUARANTINE
        assert len(resolved) == 16
        assert ids_of(quality.bad_ids(both, edge_rules, "duplicate")) == {None, 12, 13, hot_id}
