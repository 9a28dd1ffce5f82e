"""Samples: a fraction, an exact number of rows, or independent draws, in an order given by a hash of the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopsieve.functions.draws import digest
from shopsieve.sinks.scratch import hand_off

DIGITS_PER_LEVEL = 4
HASH_DIGITS = 32
# Up to this many rows are ranked in one sort; more are narrowed down first.
SORTABLE = 50_000


def hash_order(key: str, seed: int) -> Column:
    return digest(F.col(key), "sample", seed)


def sample_fraction(df: DataFrame, fraction: float, seed: int, key: str) -> DataFrame:
    """About ``fraction`` of the rows: those whose hash of ``key`` falls below it, so the same rows on
    any partitioning. Rows without a key share one draw of their own."""
    draw = F.conv(F.substring(F.coalesce(hash_order(key, seed), F.md5(F.lit(f"none:{seed}"))), 1, 8), 16, 10).cast("long")
    return df.filter(draw < F.lit(round(fraction * (1 << 32))))


def sample_exact(df: DataFrame, k: int, key: str, seed: int, sortable: int = SORTABLE) -> DataFrame:
    """Exactly ``min(k, rows)`` rows: the first ``k`` in the order of a hash of ``key``.

    ``key`` must be unique (see ``dedup_keep_one``). A sorted limit would merge all ``k`` rows
    in one task, and ``k`` grows with the table. So the cut is found digit by digit:
    the rows are counted by the leading digits of their hash (65,536 counts per round, each
    round on the one bucket that the cut falls into) until the bucket is small. The sample is
    then a plain filter below the bucket, plus the first rows of the bucket.
    """
    if k <= 0:
        return df.limit(0)
    # a missing key has a place in the order too: the first
    hashed = df.withColumn("__hash", F.coalesce(hash_order(key, seed), F.lit("0" * HASH_DIGITS)))
    prefix, wanted = "", k
    bucket = hashed
    while len(prefix) < HASH_DIGITS:
        cut = _bucket_of(bucket, len(prefix), wanted)
        if cut is None:  # fewer rows than wanted; only in the first round, when k exceeds the table
            return df
        digits, before, size = cut
        prefix, wanted = prefix + digits, wanted - before
        bucket = hashed.filter(F.col("__hash").startswith(prefix))
        if size <= sortable:
            break
    order = [F.col("__hash"), *[F.col(c).asc_nulls_first() for c in df.columns]]
    below = hashed.filter(F.col("__hash") < F.lit(prefix))
    return below.unionByName(bucket.orderBy(*order).limit(wanted)).drop("__hash")


def _bucket_of(rows: DataFrame, start: int, wanted: int) -> tuple[str, int, int] | None:
    """Where the ``wanted``-th row lies: the next digits of its hash, the rows before that
    bucket, and the rows in it."""
    counts = rows.groupBy(F.substring("__hash", start + 1, DIGITS_PER_LEVEL).alias("digits")).agg(
        F.count("*").alias("size")
    )
    # At most 65,536 rows here, whatever the table holds.
    upto = F.sum("size").over(Window.orderBy("digits"))
    found = counts.select("digits", "size", upto.alias("upto")).filter(F.col("upto") >= wanted)
    row = found.orderBy("digits").first()
    return None if row is None else (row["digits"], row["upto"] - row["size"], row["size"])


#: Buckets of the hash order that drawn ranks are looked up in, and so the rows of the tables made from them.
BUCKETS = 1 << 16


def draw_ranks(spark: SparkSession, n: int, total: int, seed: int) -> DataFrame:
    """``n`` independent draws of a rank from 0 to ``total`` - 1, as ``rank, times``."""
    numbers = spark.range(n).select(F.conv(F.substring(digest(F.col("id"), "draw", seed), 1, 15), 16, 10).cast("long").alias("drawn"))
    return numbers.select(F.pmod("drawn", F.lit(total)).alias("rank")).groupBy("rank").agg(F.count("*").alias("times"))


def sample_drawn(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """``n`` independent draws from the rows, so a row may come several times.

    ``key`` must be unique (see ``dedup_keep_one``). Rows are ranked in the order of a hash of the key. Counts of
    the hash's buckets, at most ``BUCKETS``, say in which bucket a drawn rank lies and at which place there. Only
    hashes and keys move to find the rows at those places; whole rows are touched once, in a join with the drawn keys.
    """
    if n <= 0:
        return df.limit(0)
    spark = df.sparkSession
    kind = df.schema[key].dataType
    # a missing key has a place in the order too: the first
    hashed = df.select(
        F.coalesce(hash_order(key, seed), F.lit("0" * HASH_DIGITS)).alias("__hash"),
        F.coalesce(F.col(key), F.lit(0).cast(kind)).alias("__id"),
        F.col(key).isNull().alias("__missing"),
    ).withColumn("__bucket", F.conv(F.substring("__hash", 1, DIGITS_PER_LEVEL), 16, 10).cast("int"))
    counts = hand_off(hashed.groupBy("__bucket").agg(F.count("*").alias("__size")), "buckets")
    total = counts.agg(F.coalesce(F.sum("__size"), F.lit(0))).first()[0]
    if total == 0:
        return df.limit(0)
    # at most BUCKETS rows in this window, whatever the table holds
    upto = F.sum("__size").over(Window.orderBy("__bucket"))
    spans = counts.select("__bucket", (upto - F.col("__size")).alias("__first"), (upto - 1).alias("__last"))
    # the ranks are cut into as many cells, and each bucket is listed with the cells it overlaps
    cell = -(-total // BUCKETS)
    reach = F.sequence(F.expr(f"__first DIV {cell}L"), F.expr(f"__last DIV {cell}L"))
    listed = spans.withColumn("__cell", F.explode(reach))
    drawn = draw_ranks(spark, n, total, seed).withColumn("__cell", F.expr(f"rank DIV {cell}L"))
    places = drawn.join(F.broadcast(listed), "__cell").filter(F.col("rank").between(F.col("__first"), F.col("__last")))
    places = places.select("__bucket", (F.col("rank") - F.col("__first") + 1).alias("__place"), F.col("times").alias("__times"))
    order = Window.partitionBy("__bucket").orderBy("__hash", "__id")
    found = hashed.withColumn("__place", F.row_number().over(order).cast("long")).join(places, ["__bucket", "__place"])
    keys = hand_off(found.select("__id", "__missing", "__times"), "drawn-keys")
    rows = df.withColumns({"__id": F.coalesce(F.col(key), F.lit(0).cast(kind)), "__missing": F.col(key).isNull()})
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))
    return rows.join(keys, ["__id", "__missing"]).withColumn("__copy", repeated).select(df.columns)
