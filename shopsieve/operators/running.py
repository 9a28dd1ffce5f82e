"""Running counts and totals within groups, in an order: windows for groups that no task should hold.

A window brings all rows of a group to one task. Here the rows are cut into ranges of (group, order), so that a large group
spans many ranges. Each range counts and adds up by itself, one total per range and group is added up over
the ranges, and these offsets are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsieve.schema import AMOUNT
from shopsieve.sinks.scratch import hand_off

_RANGE, _COUNT, _TOTAL = "__range", "__count", "__total"


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str | Column = "price", ranges: int | None = None
) -> DataFrame:
    """Every row with ``running_count`` and ``running_total`` of its group up to and with itself.

    Rows are ordered by ``order``, NULLs first, and then by all other columns, so that only equal rows may change places. A missing
    amount adds nothing, but counts; a NULL key is a group. ``ranges`` says into how many ranges the table is cut; by
    default Spark decides by its size. Ranges are cut by all columns: a day or a key that owns
    a third of the rows is cut as well, and only equal rows stay together.
    """
    value = (F.col(amount) if isinstance(amount, str) else amount).cast(AMOUNT)
    columns = [*keys, *order, *(c for c in df.columns if c not in {*keys, *order})]
    ranged = df.repartitionByRange(*columns) if ranges is None else df.repartitionByRange(ranges, *columns)
    # written: the number of a range must not change when a lost task is run again
    cut = hand_off(ranged.withColumn(_RANGE, F.spark_partition_id()), "ranges")
    local = Window.partitionBy(_RANGE, *keys).orderBy(*columns[len(keys) :]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = cut.withColumns({_COUNT: F.count("*").over(local), _TOTAL: F.coalesce(F.sum(value).over(local), F.lit(0)).cast(AMOUNT)})

    totals = cut.groupBy(_RANGE, *keys).agg(F.count("*").alias(_COUNT), F.coalesce(F.sum(value), F.lit(0)).cast(AMOUNT).alias(_TOTAL))
    # a range holds whole groups but for its first and last: a group has at most one row per range here
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(_RANGE).alias("__at"),
        *(F.col(k).alias(f"__{k}") for k in keys),
        F.coalesce(F.sum(_COUNT).over(before), F.lit(0)).alias("__earlier"),
        F.coalesce(F.sum(_TOTAL).over(before), F.lit(0)).cast(AMOUNT).alias("__sum"),
    ).filter("__earlier > 0")
    # groups that begin in their range have no offset: they are most, and need not be joined
    offsets = hand_off(offsets, "offsets")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.col(_RANGE) == F.col("__at"))
    return counted.join(offsets, same, "left").select(
        *df.columns,
        (F.col(_COUNT) + F.coalesce("__earlier", F.lit(0))).alias("running_count"),
        (F.col(_TOTAL) + F.coalesce("__sum", F.lit(0))).cast(AMOUNT).alias("running_total"),
    )
