"""Distinct counts that can be merged: for each rule the k smallest hashes of its bad ids.

Sketches of batches, days or regions can be united without going back to the ids, and two of them say about how many
ids one has that the other has not. The relative error of an estimate is about 1 / sqrt(k - 2); up to k ids the count
is exact. The uniqueness rule needs all rows of an id: its sketch is right for the rows it was made from, and unions of it
count ids that are repeated within a part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsieve.operators.quality import violations
from shopsieve.operators.rules import RuleSet

K = 1024
#: Hashes are whole numbers below this.
SPACE = 1 << 60
LAYOUT = "rule string, hashes array<bigint>"


def id_hash(key: str) -> Column:
    """Sixty bits of a digest; a missing id has a hash of its own."""
    digits = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("none")))
    return F.conv(F.substring(digits, 1, 15), 16, 10).cast("bigint")


def rule_sketches(per_id: DataFrame, rules: RuleSet, k: int = K) -> DataFrame:
    """``rule, hashes`` for every rule, in ascending order; empty if nothing breaks it.

    Each task keeps its k smallest of a rule before anything moves, however many ids break it.
    """
    smallest = Window.partitionBy("rule").orderBy("hash")
    kept = (
        violations(per_id, rules)
        .select("rule", id_hash(rules.key).alias("hash"))
        .withColumn("place", F.row_number().over(smallest))
        .filter(F.col("place") <= k)
        .groupBy("rule")
        .agg(F.array_sort(F.collect_list("hash")).alias("hashes"))
    )
    names = per_id.sparkSession.createDataFrame([(rule.name,) for rule in rules.ordered], "rule string")
    return names.join(kept, "rule", "left").select("rule", F.coalesce("hashes", F.array().cast("array<bigint>")).alias("hashes"))


def united(sketches: DataFrame, k: int = K) -> DataFrame:
    """Sketches of the same rules over parts of a table, as one sketch for each rule.

    Sketches are at most k long, and here the k smallest of each rule are found as when they were made.
    """
    smallest = Window.partitionBy("rule").orderBy("hash")
    single = sketches.select("rule", F.explode("hashes").alias("hash")).distinct()
    kept = (
        single.withColumn("place", F.row_number().over(smallest))
        .filter(F.col("place") <= k)
        .groupBy("rule")
        .agg(F.array_sort(F.collect_list("hash")).alias("hashes"))
    )
    return sketches.select("rule").distinct().join(kept, "rule", "left").select(
        "rule", F.coalesce("hashes", F.array().cast("array<bigint>")).alias("hashes")
    )


def _bound(hashes: Column, k: int) -> Column:
    """Below this hash a sketch is complete."""
    return F.when(F.size(hashes) < k, F.lit(SPACE).cast("bigint")).otherwise(F.array_max(hashes))


def estimate(hashes: Column, k: int = K) -> Column:
    """About how many ids a sketch stands for; exact below k."""
    size = F.size(hashes)
    return F.when(size < k, size.cast("double")).otherwise(F.lit(float(k - 1)) * F.lit(float(SPACE)) / F.array_max(hashes).cast("double"))


def overlap(a: Column, b: Column, k: int = K) -> tuple[Column, Column]:
    """About how many ids both sketches have, and how many only the first has.

    Both sketches are complete below the lesser of their bounds, so there the ids can be compared; the count is scaled up
    by the share of the hashes that lies below it.
    """
    bound = F.least(_bound(a, k), _bound(b, k))
    # a full sketch is complete up to its greatest hash, which itself is left out of the count
    low = F.filter(a, lambda h: h < bound)
    shared = F.size(F.array_intersect(low, b)).cast("double")
    scale = F.lit(float(SPACE)) / bound.cast("double")
    return shared * scale, (F.size(low).cast("double") - shared) * scale
