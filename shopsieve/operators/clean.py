"""De-duplication, and the split into clean and quarantined rows.

A window over the key would bring every copy of an id to one task. All of this is written
as aggregations instead: the row kept for an id is the minimum of the whole row, which each
map task reduces first, so a heavily repeated id moves one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.operators.quality import BROKEN, N_ROWS, condemned, id_bits, row_bits
from shopsieve.operators.rules import RuleSet
from shopsieve.schema import KEY

STATUS = "status"
CLEAN = "clean"
QUARANTINE = "quarantine"
POLICIES = ("quarantine", "keep_one")


def _payload(df: DataFrame, key: str) -> Column:
    """All other columns as one value; the smallest is the first row of a group in the order of
    its columns, NULLs first. As a column of its own it is built before the aggregation sorts."""
    return F.struct(*[c for c in df.columns if c != key]).alias("kept")


def dedup_keep_one(df: DataFrame, key: str = KEY) -> DataFrame:
    """One row per key, always the same one. Rows without a key share the key NULL."""
    if df.columns == [key]:
        return df.distinct()
    kept = df.select(key, _payload(df, key)).groupBy(key).agg(F.min("kept").alias("kept"))
    return kept.select(*[F.col(c) if c == key else F.col(f"kept.{c}") for c in df.columns])


def dedup_stats(df: DataFrame, key: str = KEY) -> DataFrame:
    """One row: rows before and after de-duplication, and how many went."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias(N_ROWS))
        .agg(F.coalesce(F.sum(N_ROWS), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after"))
        .withColumn("removed", F.col("rows_before") - F.col("rows_after"))
    )


def resolve(df: DataFrame, rules: RuleSet, duplicates: str = "quarantine") -> DataFrame:
    """One row per id with its verdict, in one shuffle: the columns of ``df``, then
    ``n_rows, broken, status``.

    A bad row condemns its id. ``duplicates`` says what becomes of an id that is merely
    repeated: all of it goes to quarantine, or one row is kept as clean.
    """
    if duplicates not in POLICIES:
        raise ValueError(f"duplicates must be one of {POLICIES}, not {duplicates!r}")
    taken = {N_ROWS, BROKEN, STATUS} & set(df.columns)
    if taken:
        raise ValueError(f"these columns are taken by the verdict: {sorted(taken)}")
    per_id = (
        df.select(rules.key, _payload(df, rules.key), row_bits(rules).alias("row_bits"))
        .groupBy(rules.key)
        .agg(F.min("kept").alias("kept"), F.count("*").alias(N_ROWS), F.bit_or("row_bits").alias("row_bits"))
    )
    broken = id_bits(rules, F.col(N_ROWS), F.col("row_bits"))
    condemned = broken if duplicates == "quarantine" else F.col("row_bits")
    return per_id.select(
        *[F.col(c) if c == rules.key else F.col(f"kept.{c}") for c in df.columns],
        N_ROWS,
        broken.alias(BROKEN),
        F.when(condemned != 0, F.lit(QUARANTINE)).otherwise(F.lit(CLEAN)).alias(STATUS),
    )


def with_status(resolved: DataFrame, status: str) -> DataFrame:
    """The rows of one side of the split, without the verdict columns."""
    return resolved.filter(F.col(STATUS) == status).drop(N_ROWS, BROKEN, STATUS)


def split_counts(per_id: DataFrame, rules: RuleSet | None = None, duplicates: str = "quarantine") -> DataFrame:
    """One row with the sizes of the split, from ``by_id`` alone: no row has to move.

    ``keep_one`` needs the rules, to tell repeats from other faults.
    """
    bad = F.col(BROKEN) != 0 if rules is None else condemned(rules, duplicates)
    return per_id.agg(
        F.coalesce(F.sum(N_ROWS), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_deduplicated"),
        F.count(F.when(bad, 1)).alias("quarantine_rows"),
        F.count(F.when(~bad, 1)).alias("clean_rows"),
    )


_JOIN = ["__id", "__missing"]


def _parts(column: Column, kind: T.DataType) -> list[Column]:
    """A key as a value that is never NULL and a flag, so that NULLs match by plain equality."""
    return [F.coalesce(column, F.lit(0).cast(kind)).alias("__id"), column.isNull().alias("__missing")]


def _keyed(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """One row per id, and the distinct bad ids, both with the key in parts."""
    kind = df.schema[key].dataType
    rows = df.select(*_parts(F.col(key), kind), _payload(df, key))
    one_each = rows.groupBy(*_JOIN).agg(F.min("kept").alias("kept"))
    return one_each, ids.select(*_parts(F.col(key).cast(kind), kind)).distinct()


def _unkeyed(df: DataFrame, key: str) -> list[Column]:
    original = F.when(~F.col("__missing"), F.col("__id")).alias(key)
    return [original if c == key else F.col(f"kept.{c}") for c in df.columns]


def split_by_ids(df: DataFrame, ids: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantine)`` for a given table of bad ids.

    De-duplication comes first, so both sides of the join hold one row per id and no key is
    hot. NULL matches NULL: a bad id that is missing condemns only the row without an id.
    The key is taken apart into a value and a flag before the rows are grouped, so the join
    is a plain equality on the columns they are already partitioned by, and rows are
    shuffled once. Hand in a written table of ids: Spark then knows its size and broadcasts
    it only when it is small.
    """
    one_each, bad = _keyed(df, ids, key)
    clean, quarantine = (one_each.join(bad, _JOIN, how) for how in ("left_anti", "left_semi"))
    return clean.select(*_unkeyed(df, key)), quarantine.select(*_unkeyed(df, key))


def label_by_ids(df: DataFrame, ids: DataFrame, key: str = KEY) -> DataFrame:
    """The same split as one table with a ``status``, to write both sides in one pass."""
    one_each, bad = _keyed(df, ids, key)
    joined = one_each.join(bad.withColumn("__bad", F.lit(True)), _JOIN, "left")
    status = F.when(F.col("__bad"), F.lit(QUARANTINE)).otherwise(F.lit(CLEAN))
    return joined.select(*_unkeyed(df, key), status.alias(STATUS))
