"""Running totals, draws with replacement, mergeable distinct counts, and even slices, against plain Python."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import MIDDLE, bag, sales_frame
from pyspark.sql import functions as F

from shopsieve.operators import sampling, sketches
from shopsieve.operators.quality import by_id, rule_counts
from shopsieve.operators.running import running
from shopsieve.operators.sampling import sample_drawn
from shopsieve.plans.catalog import _by_id, star_rules
from shopsieve.sources.jdbc import even_predicates


def some_sales(n, seed=3, hot=None):
    rng = random.Random(seed)
    return [
        (
            rng.choice([None, rng.randrange(n)]), 1, rng.randrange(5), rng.randrange(9), rng.choice([None, Decimal(rng.randrange(10000)) / 100]),
            hot if hot and rng.random() < 0.6 else rng.choice(["N", "S", None]), rng.choice([None, "2026-01-01", "2026-02-0" + str(rng.randrange(1, 9))]),
        )
        for _ in range(n)
    ]


def plainly(rows):
    order = (5, 6, 0, 1, 2, 3, 4)
    def key(r):  # noqa: E306
        return [(r[c] is not None, r[c] if r[c] is not None else 0) for c in order]
    count, total, out = Counter(), Counter(), []
    for row in sorted(rows, key=key):
        count[row[5]] += 1
        total[row[5]] += row[4] or 0
        out.append((*row, count[row[5]], Decimal(total[row[5]]).quantize(Decimal("0.01"))))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("ranges", [None, 1, 7, 64])
def test_running_totals(spark, ranges):
    rows = some_sales(600, hot="W")
    got = running(sales_frame(spark, rows).repartition(5), ["region"], ["sale_date", "sale_id"], ranges=ranges)
    assert bag(got) == plainly(rows)


def test_running_totals_of_nothing_and_of_everything(spark):
    assert running(sales_frame(spark, []), ["region"], ["sale_date"]).count() == 0
    rows = some_sales(50)
    by_two = running(sales_frame(spark, rows), ["region", "product_id"], ["sale_date"], amount=F.col("quantity"), ranges=6)
    last = by_two.groupBy("region", "product_id").agg(F.max("running_count").alias("n"), F.max("running_total").alias("t"))
    whole = sales_frame(spark, rows).groupBy("region", "product_id").agg(F.count("*"), F.sum("quantity").cast("decimal(20,2)"))
    assert bag(last) == bag(whole)


def test_a_hot_region_and_day_spread_over_ranges(spark, monkeypatch):
    from shopsieve.operators import running as module

    written, keep = [], module.hand_off
    monkeypatch.setattr(module, "hand_off", lambda df, label, *rest: written.append(keep(df, label, *rest)) or written[-1])
    rows = [(i, 1, 1, 1, Decimal("1.00"), "hot", "2026-01-01") for i in range(3000)] + some_sales(300)
    got = running(sales_frame(spark, rows), ["region"], ["sale_date", "sale_id"], ranges=12)
    parts = written[0].filter("region = 'hot'").groupBy("__range").count().collect()
    assert len(parts) >= 9 and max(r["count"] for r in parts) < 1000
    assert got.filter("region = 'hot'").agg(F.max("running_total")).first()[0] == Decimal("3000.00")


# Draws


def test_draws_are_those_of_the_ranks(spark, monkeypatch):
    import hashlib

    ids = [None, *range(997)]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "id long, text string").repartition(4)
    ranked = sorted(ids, key=lambda i: "0" * 32 if i is None else hashlib.md5(f"{i}:sample:5".encode()).hexdigest())
    drawn = [ranked[int(hashlib.md5(f"{i}:draw:5".encode()).hexdigest()[:15], 16) % len(ids)] for i in range(2000)]
    expected = sorted(((i, f"t{i}") for i in drawn), key=lambda r: [(v is not None, str(v)) for v in r])
    assert bag(sample_drawn(df, 2000, "id", 5)) == expected
    monkeypatch.setattr(sampling, "BUCKETS", 7)  # cells of many ranks
    assert bag(sample_drawn(df, 2000, "id", 5)) == expected
    assert max(Counter(drawn).values()) > 3 and len(set(drawn)) < 900


def test_draws_from_little(spark):
    df = spark.createDataFrame([(1, "a")], "id long, times string")
    assert bag(sample_drawn(df, 5, "id", 1)) == [(1, "a")] * 5
    assert sample_drawn(df, 0, "id", 1).count() == 0
    assert sample_drawn(df.limit(0), 5, "id", 1).count() == 0


# Sketches


@pytest.mark.parametrize("k", [64, 256])
def test_estimates_are_close_to_counts(spark, k):
    per_id = _by_id(spark, MIDDLE)
    exact = {r.rule: r.bad_ids for r in rule_counts(per_id, star_rules()).collect()}
    found = sketches.rule_sketches(per_id, star_rules(), k)
    about = {r.rule: r.about for r in found.select("rule", sketches.estimate(F.col("hashes"), k).alias("about")).collect()}
    assert set(about) == set(exact)
    for rule, n in exact.items():
        assert about[rule] == n if n < k else abs(about[rule] / n - 1) < 4 / (k - 2) ** 0.5


def test_union_and_difference(spark):
    k = 256
    def part(low, high):  # noqa: E306
        rows = sales_frame(spark, [(i, 1, 1, 99 if i % 2 else 1, None, "AFRICA", "1996-01-01") for i in range(low, high)])
        return sketches.rule_sketches(by_id(rows, star_rules()), star_rules(), k)

    a, b, whole = part(0, 6000), part(4000, 9000), part(0, 9000)
    assert bag(sketches.united(a.unionByName(b), k)) == bag(whole)
    assert bag(sketches.united(a.limit(0), k)) == []
    both = a.filter("rule = 'quantity'").withColumnRenamed("hashes", "a").join(b.withColumnRenamed("hashes", "b"), "rule")
    shared, only = sketches.overlap(F.col("a"), F.col("b"), k)
    row = both.select(shared.alias("shared"), only.alias("only")).first()
    assert abs(row.shared / 1000 - 1) < 0.4 and abs(row.only / 2000 - 1) < 0.3
    small = part(0, 100).filter("rule = 'quantity'").withColumnRenamed("hashes", "a").join(part(50, 120).withColumnRenamed("hashes", "b"), "rule")
    assert small.select(shared, only).first()[:] == (25.0, 25.0)


# Slices


@pytest.mark.parametrize("kind", ["long", "date"])
def test_even_slices_of_skewed_keys(spark, kind):
    rng = random.Random(2)
    numbers = [int(rng.paretovariate(0.4)) for _ in range(4000)] + [None] * 50 + [7] * 1500
    if kind == "date":
        numbers = [None if n is None else date(2000, 1, 1) + timedelta(days=n % 9000) for n in numbers]
    df = spark.createDataFrame([(n,) for n in numbers], f"k {kind}")
    predicates = even_predicates(df, "k", 8)
    sizes = [df.filter(p).count() for p in predicates]
    assert sum(sizes) == len(numbers) and all(sizes)
    heaviest = Counter(n for n in numbers if n is not None).most_common(1)[0][1]
    assert max(sizes) <= heaviest + len(numbers) / 8 * 1.3
    assert len(predicates) <= 8


def test_even_slices_of_little(spark):
    df = spark.createDataFrame([(None,)], "k long")
    assert even_predicates(df, "k", 4) == ["1 = 1"] == even_predicates(df.limit(0), "k", 4) == even_predicates(df, "k", 1)
    with pytest.raises(TypeError):
        even_predicates(df.selectExpr("CAST(k AS STRING) AS k"), "k", 4)
