"""Synthetic sales with known defects, as column expressions over a table of ids.

Each column is a pure function of the id and a seed: any number of tasks can produce any
part of the table, and a lost task reproduces its rows exactly.
"""

from __future__ import annotations

from datetime import date
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsieve.functions.draws import choice, day_text, digest, draw, uniform_cents, uniform_int
from shopsieve.operators.clean import dedup_keep_one
from shopsieve.operators.rules import REGIONS
from shopsieve.operators.sampling import sample_drawn, sample_exact
from shopsieve.schema import KEY, SALES_RAW, UNREADABLE_DATE, assert_schema

# The domains of the synthetic columns and the shares of defects.
CUSTOMERS = 1000
PRODUCTS = 500
MAX_QUANTITY = 10
PRICE_CENTS = (1_000, 100_000)
INVALID_SHARE = 0.005
DUPLICATE_SHARE = 0.0005
MAX_DAYS_AHEAD = 730


def share_of(n: int, share: float) -> int:
    """``share`` of ``n``, rounded down, without binary rounding errors."""
    return int(n * Fraction(str(share)))


def _columns(ids: DataFrame, seed: int, sale_date: Column) -> DataFrame:
    """One sale per id. ``sale_date`` may use draws 1 to 3 of the second digest."""
    a, b = F.col("__a"), F.col("__b")
    drawn = ids.select(
        F.col(KEY).cast("bigint").alias(KEY),
        digest(F.col(KEY).cast("bigint"), "a", seed).alias("__a"),
        digest(F.col(KEY).cast("bigint"), "b", seed).alias("__b"),
    )
    sales = drawn.select(
        KEY,
        uniform_int(draw(a, 0), 1, CUSTOMERS).alias("customer_id"),
        uniform_int(draw(a, 1), 1, PRODUCTS).alias("product_id"),
        uniform_int(draw(a, 2), 1, MAX_QUANTITY).cast("int").alias("quantity"),
        uniform_cents(draw(a, 3), *PRICE_CENTS).alias("price"),
        choice(draw(b, 0), REGIONS).alias("region"),
        sale_date.alias("sale_date"),
    )
    return assert_schema(sales, SALES_RAW)


def sales_for(ids: DataFrame, seed: int, start: date, end: date) -> DataFrame:
    """A valid sale for each id, dated from ``start`` to ``end``."""
    days = F.date_diff(F.lit(end.isoformat()).cast("date"), F.lit(start.isoformat()).cast("date"))
    offset = F.pmod(draw(F.col("__b"), 1), days.cast("bigint") + 1)
    return _columns(ids, seed, day_text(start, offset))


def bad_dates_for(ids: DataFrame, seed: int, end: date) -> DataFrame:
    """A sale with a bad date for each id: unreadable, or 1 to 730 days after ``end``, evenly."""
    coin, ahead = draw(F.col("__b"), 1), uniform_int(draw(F.col("__b"), 2), 1, MAX_DAYS_AHEAD)
    sale_date = F.when(F.pmod(coin, F.lit(2)) == 0, F.lit(UNREADABLE_DATE)).otherwise(day_text(end, ahead))
    return _columns(ids, seed, sale_date)


def id_range(spark: SparkSession, first: int, count: int) -> DataFrame:
    return spark.range(first, first + count).withColumnRenamed("id", KEY)


def gen_sales(spark: SparkSession, n: int, seed: int, start: date, end: date) -> DataFrame:
    """``n`` valid sales with ids 1 to n."""
    return sales_for(id_range(spark, 1, n), seed, start, end)


def inject_bad_dates(
    spark: SparkSession, n: int, seed: int, end: date, share: float = INVALID_SHARE, first_id: int | None = None
) -> DataFrame:
    """``share`` of ``n`` sales with a bad date, with ids from n+1 on."""
    ids = id_range(spark, n + 1 if first_id is None else first_id, share_of(n, share))
    return bad_dates_for(ids, seed, end)


def inject_duplicates(
    df: DataFrame, n: int, seed: int, share: float = DUPLICATE_SHARE, key: str = KEY, unique_key: bool = False
) -> DataFrame:
    """Exact copies of ``share`` of ``n`` rows of ``df``, each of another id.

    ``unique_key=True`` states that ids do not repeat in ``df`` and saves a shuffle.
    """
    base = df if unique_key else dedup_keep_one(df, key)
    return sample_exact(base, share_of(n, share), key, seed)


def inject_drawn_duplicates(
    df: DataFrame, n: int, seed: int, share: float = DUPLICATE_SHARE, key: str = KEY, unique_key: bool = False
) -> DataFrame:
    """Exact copies by ``share`` of ``n`` independent draws from ``df``: a row may be copied several times."""
    base = df if unique_key else dedup_keep_one(df, key)
    return sample_drawn(base, share_of(n, share), key, seed)


def gen_combined(ids: DataFrame, n: int, last_id: int, seed: int, start: date, end: date) -> DataFrame:
    """Valid sales for ``n`` given unique ids, copies of some, and bad dates after ``last_id``."""
    valid = sales_for(ids, seed, start, end)
    copies = inject_duplicates(valid, n, seed, unique_key=True)
    bad = inject_bad_dates(ids.sparkSession, n, seed, end, first_id=last_id + 1)
    return valid.unionByName(copies).unionByName(bad)


def gen_table(spark: SparkSession, n: int, seed: int, start: date, end: date) -> DataFrame:
    """The whole synthetic table over ids 1 to n."""
    return gen_combined(id_range(spark, 1, n), n, n, seed, start, end)
