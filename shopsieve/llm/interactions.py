"""Filter interaction audit (13): what each filter removes in every order of the filters.

A document that fails a set of filters is removed by the first of them. So all that an order does
follows from how many documents fail exactly which set: one count for each part and set. The states
of an audit are the sets of filters applied so far, its edges add one filter. Counting paths forward (orders that
reach a state) and backward (orders that go on from it) weighs each edge's removals for the Shapley
sum over all orders, and the steps of each order are read from the same edges.

The texts are read once and reduced to a digest and bits in that scan; only those are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsieve.llm.common import text_or_empty

#: Names of the filters; the n-th has bit n.
FILTERS = "ABCDE"
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "#$%&*|"
COUNTS = ("n", "good", "toxic")


def text_bits(light: DataFrame) -> DataFrame:
    """``light`` with ``bits``, the filters that each text fails by itself: few words, few different words,
    many capitals, symbols. Counts are 64 bits wide, as texts may be very long."""
    counted = light.withColumn("words", F.filter(F.split("text", WORD_BREAK), lambda w: w != "")).withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "n_distinct": F.size(F.array_distinct("words")).cast("long"),
            "n_chars": F.length("text").cast("long"),
        }
    )
    fails = (
        F.col("n_words") < 50,
        100 * F.col("n_distinct") < 65 * F.col("n_words"),
        100 * (F.col("n_chars") - F.length(F.translate("text", CAPITALS, ""))) > 5 * F.col("n_chars"),
        F.length(F.translate("text", SYMBOLS, "")) < F.col("n_chars"),
    )
    bits = sum((F.when(fail, 1 << k).otherwise(0) for k, fail in enumerate(fails)), F.lit(0))
    return counted.withColumn("bits", bits.cast("int"))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and the exact set of filters they fail: part, mask, n, good, toxic.

    Equal texts meet by SHA-256. The least doc_id of a text is found from counts that are combined in each
    task, so a text that a third of all rows share moves one row per task, part and id.
    """
    light = text_bits(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            text_or_empty().alias("text"),
        )
    ).select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), "bits")
    rows = light.groupBy("digest", "bits", "part", "doc_id").agg(F.count("*").alias("n"))
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    flags = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("key"))
        .agg(*(F.coalesce(F.max(mark), F.lit(False)).alias(f"is_{name}") for name, mark in marks.items()))
        .withColumn("has_id", F.lit(True))
    )
    # rows without an id have no label; as keys they spread by their text
    keyed = rows.withColumns({"key": F.coalesce("doc_id", F.xxhash64("digest", "part")), "has_id": F.col("doc_id").isNotNull()})
    labelled = keyed.join(flags, ["key", "has_id"], "left").withColumns(
        {name: F.when(F.col(f"is_{name}"), F.col("n")).otherwise(F.lit(0).cast("long")) for name in marks}
    )
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *COUNTS)))
    missing = [F.sum(F.when(F.col("doc_id").isNull(), F.col(c)).otherwise(0)).alias(f"{c}_missing") for c in COUNTS]
    per_part = labelled.groupBy("digest", "bits", "part").agg(
        first.alias("first"), *missing, *(F.sum(c).alias(c) for c in COUNTS)
    )
    # a text has no more rows here than there are parts
    least = F.min("first.doc_id").over(Window.partitionBy("digest", "bits"))
    each = per_part.withColumn("least", least)
    # those that do not repeat: the rows of the least id, and rows without an id
    held = F.col("first.doc_id") == F.col("least")
    own = {c: F.when(held, F.col(f"first.{c}")).otherwise(0) + F.col(f"{c}_missing") for c in COUNTS}
    twin = F.lit(1 << FILTERS.index("E"))
    split = F.array(
        F.struct(F.col("bits").alias("mask"), *(own[c].alias(c) for c in COUNTS)),
        F.struct(F.col("bits").bitwiseOR(twin).alias("mask"), *((F.col(c) - own[c]).alias(c) for c in COUNTS)),
    )
    return each.select("part", F.inline(split)).groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in COUNTS))


def edges() -> list[tuple[int, int, int]]:
    """All edges of the lattice: the state, the filter added, and how many orders pass along the edge.

    Forward and backward counts are sums over edges, state by state in the order of their sizes.
    """
    n = len(FILTERS)
    states = sorted(range(1 << n), key=lambda s: (s.bit_count(), s))
    steps = [(s, f) for s in states for f in range(n) if not s >> f & 1]
    forward, backward = {0: 1}, {(1 << n) - 1: 1}
    for s, f in steps:
        forward[s | 1 << f] = forward.get(s | 1 << f, 0) + forward[s]
    for s, f in reversed(steps):
        backward[s] = backward.get(s, 0) + backward[s | 1 << f]
    return [(s, f, forward[s] * backward[s | 1 << f]) for s, f in steps]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see the contract of the query for the columns.

    Null sources count as the empty string, null texts as empty. A row without a doc_id repeats nothing and
    nothing repeats it, as its id is not smaller than any; rows that share the least id of their text do not
    repeat either. Several labels of an id count if any says so. Other columns are ignored; an empty table
    gives an empty result.
    """
    lattice = edges()
    at = {(s, f): k for k, (s, f, _) in enumerate(lattice)}
    cells = failures(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))

    def total(count: str, wanted: Callable[[Column], Column]) -> Column:
        """Over the at most 32 sets of a part."""
        return F.aggregate(F.filter("cells", lambda c: wanted(c["mask"])), F.lit(0).cast("long"), lambda a, c: a + c[count])

    literal = F.array(
        *(
            F.struct(F.lit(k).alias("edge"), F.lit(s).alias("state"), F.lit(1 << f).alias("bit"), F.lit(w).cast("long").alias("orders"))
            for k, (s, f, w) in enumerate(lattice)
        )
    )

    def fails(mask: Column) -> Column:
        return mask.bitwiseAND(F.col("bit")) != 0

    def stands(mask: Column) -> Column:
        return mask.bitwiseAND(F.col("state")) == 0

    measures = {
        "kept": total("n", lambda m: stands(m) & ~fails(m)),
        "removed": total("n", lambda m: stands(m) & fails(m)),
        "redundant": total("n", lambda m: ~stands(m) & fails(m)),
        "unique_fails": total("n", lambda m: m == F.col("bit")),
        "good_lost": total("good", lambda m: stands(m) & fails(m)),
        "toxic_lost": total("toxic", lambda m: stands(m) & fails(m)),
    }
    measured = cells.select("part", "cells", F.inline(literal)).withColumns(measures)
    # the 80 edges of a part stand in one row, and each step of an order is one of them
    found = F.array_sort(F.collect_list(F.struct("edge", "bit", "orders", *measures)))

    def shapley(bit: Column) -> Column:
        own = F.filter("found", lambda e: e["bit"] == bit)
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, e: a + e["orders"] * e["removed"])

    weighed = F.transform("found", lambda e: F.struct(*(e[c].alias(c) for c in measures), shapley(e["bit"]).alias("shapley")))
    steps = []
    for order in permutations(range(len(FILTERS))):
        state = 0
        for step, f in enumerate(order, 1):
            name = "".join(FILTERS[g] for g in order)
            steps.append(F.struct(F.lit(name).alias("filter_order"), F.lit(step).alias("step"), F.lit(at[state, f]).alias("edge")))
            state |= 1 << f
    return (
        measured.groupBy("part")
        .agg(found.alias("found"))
        .select("part", weighed.alias("found"))
        .select("part", "found", F.inline(F.array(*steps)))
        .select("part", "filter_order", "step", F.get("found", F.col("edge")).alias("of"))
        .select("part", "filter_order", "step", "of.*")
    )
