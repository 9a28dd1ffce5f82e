"""Rules, report and split on rows chosen for their NULLs, bounds and odd dates."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import EDGE_END, EDGE_START, bag, ids_of, sales_frame

from shopsieve.functions.casts import to_schema
from shopsieve.operators import analytics, clean, quality
from shopsieve.operators.rules import RuleSet, date_parse, matches, not_null, sales_rules, unique, year_to_date
from shopsieve.sinks.files import write_csv
from shopsieve.sources.files import read_csv


FLAGGED = {
    "duplicate": {None, 12, 13},
    "date_format": {3},
    "date_range": {3, 4, 6, 7, 15},
    "region": {10},
    "quantity": {8, 9},
    "price": {9},
}
BAD = set().union(*FLAGGED.values())
CLEAN = {1, 2, 5, 11, 14}


@pytest.mark.parametrize("name", list(FLAGGED))
def test_one_rule(edge, edge_rules, name):
    assert ids_of(quality.bad_ids(edge, edge_rules, name)) == FLAGGED[name]


def test_unions(edge, edge_rules):
    assert ids_of(quality.bad_ids(edge, edge_rules, "date_format", "date_range")) == {3, 4, 6, 7, 15}
    assert ids_of(quality.bad_ids(edge, edge_rules, "quantity", "price")) == {8, 9}
    assert ids_of(quality.bad_ids(edge, edge_rules, "duplicate", "region")) == {None, 10, 12, 13}
    assert ids_of(quality.bad_ids(edge, edge_rules)) == BAD


def test_violations_and_counts(edge, edge_rules):
    per_id = quality.by_id(edge, edge_rules)
    expected = {(name, i) for name, ids in FLAGGED.items() for i in ids}
    assert {tuple(r) for r in quality.violations(per_id, edge_rules).collect()} == expected
    assert dict(bag(quality.rule_counts(per_id, edge_rules))) == {n: len(i) for n, i in FLAGGED.items()}


def test_samples_are_the_smallest_ids(edge, edge_rules):
    found = {}
    for rule, position, sale_id in bag(quality.id_samples(quality.by_id(edge, edge_rules), edge_rules, 3)):
        found.setdefault(rule, {})[position] = sale_id
    assert found["date_range"] == {1: 3, 2: 4, 3: 6}
    assert found["duplicate"] == {1: None, 2: 12, 3: 13}
    assert found["price"] == {1: 9}


def test_report(edge, edge_rules):
    lines = {r.rule: r for r in quality.report(quality.by_id(edge, edge_rules), edge_rules).collect()}
    assert lines["duplicate"].message == "Найдены дубликаты ID: 3 записей"
    assert lines["total"].bad_ids == 11
    assert lines["total"].total_rows == 19
    assert lines["total"].valid_pct_reference == pytest.approx((19 - 11) / 19 * 100)
    assert lines["total"].valid_pct_rows == pytest.approx(5 / 19 * 100)


def test_nobody_breaks_a_rule(edge, edge_rules):
    good = edge.filter("sale_id IN (1, 2)")
    lines = quality.report(quality.by_id(good, edge_rules), edge_rules).collect()
    assert len(lines) == 7
    assert all(line.bad_ids == 0 and line.message is None for line in lines)
    assert lines[0].valid_pct_rows == 100.0


def test_empty_table(spark, edge_rules):
    empty = sales_frame(spark, [])
    per_id = quality.by_id(empty, edge_rules)
    lines = quality.report(per_id, edge_rules).collect()
    assert [(r.bad_ids, r.total_rows, r.valid_pct_reference, r.valid_pct_rows) for r in lines] == [(0, 0, None, None)] * 7
    assert bag(clean.split_counts(per_id)) == [(0, 0, 0, 0)]
    assert bag(clean.dedup_stats(empty)) == [(0, 0, 0)]
    assert bag(quality.totals(per_id)) == [(0, 0, 0, 0, 0, 0)]
    assert clean.resolve(empty, edge_rules).count() == 0
    assert analytics.aggregate(empty).count() == 0


def test_split(edge, edge_rules):
    resolved = clean.resolve(edge, edge_rules)
    kept, quarantined = (clean.with_status(resolved, s) for s in (clean.CLEAN, clean.QUARANTINE))
    assert kept.columns == quarantined.columns == edge.columns
    assert ids_of(kept.select("sale_id")) == CLEAN
    assert ids_of(quarantined.select("sale_id")) == BAD
    first_copies = {r.sale_id: r for r in quarantined.collect()}
    assert str(first_copies[None].price) == "5.00"
    assert first_copies[13].customer_id == 1


def test_split_keeping_one(edge, edge_rules):
    kept = clean.with_status(clean.resolve(edge, edge_rules, "keep_one"), clean.CLEAN)
    assert ids_of(kept.select("sale_id")) == CLEAN | {None, 12, 13}
    with pytest.raises(ValueError, match="duplicates must be"):
        clean.resolve(edge, edge_rules, "drop")


def test_a_bad_row_condemns_all_rows_of_its_id(spark, edge_rules):
    good = (7, 1, 1, 1, None, "North", "2026-02-01")
    bad = (7, 1, 1, 99, None, "North", "2026-02-01")
    resolved = clean.resolve(sales_frame(spark, [good, bad]), edge_rules, "keep_one")
    row = resolved.collect()[0]
    assert (row.status, row.quantity, row.n_rows) == (clean.QUARANTINE, 1, 2)


def test_split_by_id_list(spark, edge, edge_rules):
    ids = quality.bad_ids(edge, edge_rules)
    kept, quarantined = clean.split_by_ids(edge, ids)
    resolved = clean.resolve(edge, edge_rules)
    assert bag(kept) == bag(clean.with_status(resolved, clean.CLEAN))
    assert bag(quarantined) == bag(clean.with_status(resolved, clean.QUARANTINE))


def test_id_list_without_null_keeps_the_row_without_id(spark, edge):
    ids = spark.createDataFrame([(1,), (0,)], "sale_id bigint")
    kept, quarantined = clean.split_by_ids(edge, ids)
    assert ids_of(quarantined.select("sale_id")) == {1}
    assert None in ids_of(kept.select("sale_id"))


def test_null_in_the_id_list_does_not_match_the_stand_in(spark):
    rows = [(0, 1, 1, 1, None, "North", "2026-02-01"), (None, 1, 1, 1, None, "North", "2026-02-01")]
    kept, quarantined = clean.split_by_ids(sales_frame(spark, rows), spark.createDataFrame([(None,)], "sale_id bigint"))
    assert ids_of(kept.select("sale_id")) == {0}
    assert ids_of(quarantined.select("sale_id")) == {None}


def test_text_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("0", 2), (None, 3)], "code string, v int")
    assert bag(clean.dedup_keep_one(df, "code")) == [(None, 3), ("0", 2), ("a", 0)]
    kept, gone = clean.split_by_ids(df, spark.createDataFrame([("a",), (None,)], "code string"), "code")
    assert bag(kept) == [("0", 2)]
    assert bag(gone) == [(None, 3), ("a", 0)]
    assert bag(clean.dedup_keep_one(df.select("code"), "code")) == [(None,), ("0",), ("a",)]


def test_dedup(edge):
    assert bag(clean.dedup_stats(edge)) == [(19, 16, 3)]
    rows = {r.sale_id: r for r in clean.dedup_keep_one(edge).collect()}
    assert len(rows) == 16
    assert str(rows[None].price) == "5.00"


def test_optional_rules(edge):
    rules = sales_rules(
        EDGE_START, EDGE_END, extra=[not_null("has_region", "region"), date_parse("date_parse", "sale_date")]
    )
    assert ids_of(quality.bad_ids(edge, rules, "has_region")) == {11}
    assert ids_of(quality.bad_ids(edge, rules, "date_parse")) == {3, 4, 5, 14, 15}
    assert quality.rule_counts(quality.by_id(edge, rules), rules).count() == 8


def test_rules_without_uniqueness(edge):
    rules = RuleSet((matches("date_format", "sale_date", r"^\d"),))
    assert ids_of(quality.bad_ids(edge, rules)) == {3}
    assert ids_of(clean.with_status(clean.resolve(edge, rules), clean.QUARANTINE).select("sale_id")) == {3}


def test_uniqueness_alone(edge):
    rules = RuleSet((), unique())
    assert ids_of(quality.bad_ids(edge, rules)) == {None, 12, 13}
    assert bag(quality.rule_counts(quality.by_id(edge, rules), rules)) == [("duplicate", 3)]
    assert clean.with_status(clean.resolve(edge, rules), clean.CLEAN).count() == 13


def test_rules_on_inferred_types(spark, edge, edge_rules, tmp_path):
    write_csv(edge, str(tmp_path / "csv"))
    guessed = read_csv(spark, str(tmp_path / "csv"), infer=True)
    assert dict(guessed.dtypes)["price"] == "double"
    per_id = quality.by_id(guessed, edge_rules)
    assert {tuple(r) for r in quality.violations(per_id, edge_rules).collect()} == {
        (name, i) for name, ids in FLAGGED.items() for i in ids
    }


def test_rule_names_are_distinct(spark):
    rule = matches("x", "sale_date", "a")
    with pytest.raises(ValueError, match="repeat"):
        RuleSet((rule, rule), unique())
    with pytest.raises(KeyError):
        RuleSet((rule,)).bit("y")


def test_names_may_look_like_anything(edge):
    rules = RuleSet(
        (matches("total_rows", "sale_date", "^2"), matches("a.b c", "region", "^[NSEW]", "100 percent: %s"))
    )
    lines = {r.rule: r for r in quality.report(quality.by_id(edge, rules), rules).collect()}
    assert (lines["total_rows"].bad_ids, lines["total_rows"].message) == (1, "total_rows: 1")
    assert (lines["a.b c"].bad_ids, lines["a.b c"].message) == (1, "100 percent: 1")
    assert lines["total"].bad_ids == 2
    assert dict(bag(quality.rule_counts(quality.by_id(edge, rules), rules))) == {"total_rows": 1, "a.b c": 1}


def test_verdict_columns_are_reserved(edge, edge_rules):
    with pytest.raises(ValueError, match="taken"):
        clean.resolve(edge.withColumn("status", edge.region), edge_rules)


def test_year_to_date():
    assert year_to_date(date(2026, 5, 17)) == (date(2026, 1, 1), date(2026, 5, 17))


def test_types(edge):
    dates = {r.sale_id: r.sale_date for r in to_schema(edge).collect() if r.sale_id}
    assert dates[1] == date(2026, 1, 1)
    assert [dates[i] for i in (3, 4, 5, 14, 15)] == [None] * 5


def test_aggregate_counts_ids_and_divides_by_them(spark):
    from decimal import Decimal

    rows = [
        (1, 1, 1, 2, Decimal("10.00"), "North", "x"),
        (2, 1, 1, 3, None, "North", "x"),
        (None, 1, 1, 4, Decimal("5.00"), "North", "x"),
        (None, 1, 2, 1, Decimal("7.00"), None, "x"),
    ]
    df = sales_frame(spark, rows)
    assert bag(analytics.aggregate(df)) == [
        (None, 2, 0, Decimal("7.00"), None),
        ("North", 1, 2, Decimal("15.00"), 7.5),
    ]
    assert bag(analytics.aggregate(df, amount=analytics.line_amount()).select("total_sales_amount")) == [
        (Decimal("40.00"),),
        (Decimal("7.00"),),
    ]
    levels = {tuple(r)[:3]: tuple(r)[3:] for r in analytics.aggregate_levels(df).collect()}
    assert levels[(1, None, None)] == (0, Decimal("7.00"), None)
    assert levels[(2, None, 1)] == (2, Decimal("15.00"), 7.5)
    assert len(levels) == 6
    windowed = analytics.windowed(df)
    assert windowed.columns == [*df.columns, *analytics.MEASURES]
    assert {(r.sale_id, r.product_id, r.total_sales) for r in windowed.collect()} == {
        (1, 1, 2),
        (2, 1, 2),
        (None, 1, 2),
        (None, 2, 0),
    }
