"""Checks over a table that grows by batches: a stored state per id takes each new batch.

The state holds for every id how many rows it has and which row rules they break. A new batch is
aggregated by itself and merged into the buckets of the state that it touches; older batches are not
read again. Everything that starts from ``by_id`` (report, counts, samples, totals, bad ids) starts from the state as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.operators.quality import BROKEN, N_ROWS, id_bits, row_bits
from shopsieve.operators.rules import RuleSet
from shopsieve.sinks.keyed import KeyedTable

ROW_BITS = "row_bits"


def rules_text(rules: RuleSet) -> str:
    """The rules with their bits and conditions: a state made with other rules says something else."""
    unique = rules.unique.name if rules.unique is not None else None
    return f"key {rules.key}, unique {unique}, " + ", ".join(
        f"{rules.bit(rule.name)} {rule.name}: {rule.violation}" for rule in rules.rows
    )


def _merged(name: str) -> Column:
    return F.sum(name) if name == N_ROWS else F.bit_or(name)


class CheckState:
    """``width`` (see ``KeyedTable``) suits ids that grow from batch to batch: old buckets then stay as they are."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        rules: RuleSet,
        key_type: T.DataType | None = None,
        *,
        width: int | None = None,
        buckets: int = 256,
    ) -> None:
        self.rules = rules
        layout = T.StructType(
            [
                T.StructField(rules.key, key_type or T.LongType()),
                T.StructField(N_ROWS, T.LongType()),
                T.StructField(ROW_BITS, T.LongType()),
            ]
        )
        self.table = KeyedTable(
            spark, path, layout, rules.key, width=width, buckets=buckets, merged=_merged, null_key=True, settings=rules_text(rules)
        )

    def add(self, rows: DataFrame, batch: str) -> int:
        """Take a batch, named so that a second run of it changes nothing; returns the state's version."""
        counted = (
            rows.select(self.rules.key, row_bits(self.rules).alias(ROW_BITS))
            .groupBy(self.rules.key)
            .agg(F.count("*").alias(N_ROWS), F.bit_or(ROW_BITS).alias(ROW_BITS))
        )
        return self.table.merge(counted.select(self.table.schema.names), batch)

    def per_id(self, version: int | None = None) -> DataFrame:
        """As ``by_id`` over all batches taken so far, or up to a version."""
        state = self.table.read(version)
        return state.select(self.rules.key, N_ROWS, id_bits(self.rules, F.col(N_ROWS), F.col(ROW_BITS)).alias(BROKEN))
