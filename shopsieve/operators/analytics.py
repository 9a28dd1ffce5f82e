"""Counts, totals and average tickets per group.

Amounts are decimals, so a total does not depend on the order in which rows are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsieve.schema import AMOUNT, KEY
from shopsieve.sinks.scratch import hand_off

GROUP = ("region", "product_id")
MEASURES = ("total_sales", "total_sales_amount", "average_sale_amount")


def line_amount() -> Column:
    """Quantity times price."""
    return (F.col("quantity").cast("decimal(10,0)") * F.col("price")).cast(AMOUNT)


def with_sale_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("sale_amount", line_amount())


def _average(total: Column, count: Column) -> Column:
    """Total over the number of ids; NULL where a group has none."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def aggregate(
    df: DataFrame, keys: Sequence[str] = GROUP, amount: str | Column = "price", counted: str = KEY
) -> DataFrame:
    """Per group: sales with an id, the sum of ``amount``, and the average ticket.

    ``amount`` is ``price`` by default; ``line_amount()`` multiplies by the quantity.
    """
    value = F.col(amount) if isinstance(amount, str) else amount
    return (
        df.groupBy(*keys)
        .agg(F.count(counted).alias("total_sales"), F.sum(value).cast(AMOUNT).alias("total_sales_amount"))
        .withColumn("average_sale_amount", _average(F.col("total_sales_amount"), F.col("total_sales")))
    )


def aggregate_levels(
    df: DataFrame, keys: Sequence[str] = GROUP, amount: str | Column = "price", counted: str = KEY
) -> DataFrame:
    """The same measures for each key alone and for all keys together.

    ``grouping_id`` tells the levels apart, as a NULL key may also be a value: bit set = key
    rolled up. The rows are aggregated once to the finest level, and only those groups are
    expanded to the levels above.
    """
    finest = aggregate(df, keys, amount, counted)
    single = [[F.col(k)] for k in keys]
    levels = single + [[F.col(k) for k in keys]] if len(keys) > 1 else single
    return (
        finest.groupingSets(levels, *keys)
        .agg(
            F.grouping_id().cast("int").alias("grouping_id"),
            F.sum("total_sales").alias("total_sales"),
            F.sum("total_sales_amount").cast(AMOUNT).alias("total_sales_amount"),
        )
        .withColumn("average_sale_amount", _average(F.col("total_sales_amount"), F.col("total_sales")))
        .select("grouping_id", *keys, *MEASURES)
    )


def windowed(
    df: DataFrame, keys: Sequence[str] = GROUP, amount: str | Column = "price", counted: str = KEY
) -> DataFrame:
    """Every row with the measures of its group: count, sum and average OVER (PARTITION BY keys).

    A window would sort all rows of a group in one task. Here the groups are aggregated and
    written first, then joined back: the planner sees the written size and broadcasts the
    groups if they are few, or else shuffles both sides, where adaptive execution splits a
    hot group over several tasks.
    """
    groups = hand_off(aggregate(df, keys, amount, counted), "groups")
    right = groups.select(*[F.col(k).alias(f"__{k}") for k in keys], *MEASURES)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(right, same).drop(*[f"__{k}" for k in keys])


def preview(aggregated: DataFrame, n: int = 20, order: Sequence[str] = GROUP) -> DataFrame:
    """The first ``n`` groups in a fixed order, to look at."""
    return aggregated.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)
