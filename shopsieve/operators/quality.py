"""From rules to bad ids, counts, samples and the report.

Everything starts from ``by_id``: one row per id with its number of rows and the rules it
breaks, as bits of a long. It is one hash aggregation with fixed-width buffers, combined
before the shuffle, so a single id that owns a third of the table costs one record per map
task. No id ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsieve.operators.rules import RuleSet

N_ROWS = "n_rows"
BROKEN = "broken"
TOTAL = "total"


def row_bits(rules: RuleSet) -> Column:
    """The row rules a row breaks."""
    bits = F.lit(0).cast("bigint")
    for rule in rules.rows:
        bits = bits.bitwiseOR(F.when(rule.violation, F.lit(rules.bit(rule.name))).otherwise(F.lit(0)).cast("bigint"))
    return bits


def id_bits(rules: RuleSet, n_rows: Column, bits: Column) -> Column:
    """The rules an id breaks: those of its rows, and uniqueness if it has several."""
    if rules.unique is None:
        return bits
    repeated = F.when(n_rows > 1, F.lit(rules.bit(rules.unique.name))).otherwise(F.lit(0)).cast("bigint")
    return bits.bitwiseOR(repeated)


def breaks(rules: RuleSet, name: str, bits: str = BROKEN) -> Column:
    return F.col(bits).bitwiseAND(F.lit(rules.bit(name)).cast("bigint")) != 0


def by_id(df: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per id, NULL being an id: ``key, n_rows, broken``.

    The bits are a column before they are aggregated: as an expression inside the aggregate
    they take a fifth longer.
    """
    return (
        df.select(rules.key, row_bits(rules).alias("row_bits"))
        .groupBy(rules.key)
        .agg(F.count("*").alias(N_ROWS), F.bit_or("row_bits").alias("row_bits"))
        .select(rules.key, N_ROWS, id_bits(rules, F.col(N_ROWS), F.col("row_bits")).alias(BROKEN))
    )


def bad_ids(df: DataFrame, rules: RuleSet, *names: str) -> DataFrame:
    """The distinct ids that break any of the named rules, or any rule at all."""
    wanted = names or tuple(rule.name for rule in rules.ordered)
    if rules.unique is None or rules.unique.name not in wanted:
        return df.filter(rules.violation(*wanted)).select(rules.key).distinct()
    if len(wanted) == 1:
        return duplicate_counts(df, rules.key).select(rules.key)
    mask = sum(rules.bit(name) for name in wanted)
    return by_id(df, rules).filter(F.col(BROKEN).bitwiseAND(F.lit(mask).cast("bigint")) != 0).select(rules.key)


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once, and how often."""
    return df.groupBy(key).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def violations(per_id: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per id and rule it breaks: ``rule, key``."""
    names = F.array_compact(F.array(*[F.when(breaks(rules, r.name), F.lit(r.name)) for r in rules.ordered]))
    return per_id.filter(F.col(BROKEN) != 0).select(F.explode(names).alias("rule"), rules.key)


def id_samples(per_id: DataFrame, rules: RuleSet, k: int = 3) -> DataFrame:
    """The ``k`` smallest bad ids of each rule: ``rule, position, key``.

    The rank limit is applied by each task before the shuffle, so at most ``k`` ids per rule
    and task move, however many break it.
    """
    first = Window.partitionBy("rule").orderBy(F.col(rules.key).asc_nulls_first())
    return (
        violations(per_id, rules)
        .withColumn("position", F.row_number().over(first))
        .filter(F.col("position") <= k)
        .select("rule", "position", rules.key)
    )


def _sum_where(condition: Column, value: Column | None = None) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.lit(1) if value is None else value)), F.lit(0)).cast("bigint")


def _count_columns(rules: RuleSet) -> dict[str, Column]:
    """For each rule the number of ids that break it, under a name no rule can clash with."""
    return {
        f"__rule_{position}": _sum_where(breaks(rules, rule.name)) for position, rule in enumerate(rules.ordered)
    }


def rule_counts(per_id: DataFrame, rules: RuleSet) -> DataFrame:
    """The number of distinct bad ids of each rule: ``rule, bad_ids``, one row per rule."""
    columns = _count_columns(rules)
    counts = per_id.agg(*[count.alias(name) for name, count in columns.items()])
    lines = [
        F.struct(F.lit(rule.name).alias("rule"), F.col(name).alias("bad_ids"))
        for rule, name in zip(rules.ordered, columns, strict=True)
    ]
    return counts.select(F.inline(F.array(*lines)))


def condemned(rules: RuleSet, duplicates: str = "quarantine") -> Column:
    """Whether an id of ``by_id`` goes to quarantine. With ``keep_one`` a mere repeat does not."""
    if duplicates == "quarantine":
        return F.col(BROKEN) != 0
    mask = sum(rules.bit(rule.name) for rule in rules.rows)
    return F.col(BROKEN).bitwiseAND(F.lit(mask).cast("bigint")) != 0


def _clean_rows(bad: Column, duplicates: str) -> Column:
    """Rows of clean ids; with ``keep_one`` one row of each stays."""
    return _sum_where(~bad) if duplicates == "keep_one" else _sum_where(~bad, F.col(N_ROWS))


def totals(per_id: DataFrame, rules: RuleSet | None = None, duplicates: str = "quarantine") -> DataFrame:
    """One row: rows and ids in all, rows that repeat an id, bad ids, clean ids and clean rows.

    ``keep_one`` needs the rules, to tell repeats from other faults.
    """
    bad = F.col(BROKEN) != 0 if rules is None else condemned(rules, duplicates)
    return per_id.agg(
        _sum_where(F.lit(True), F.col(N_ROWS)).alias("total_rows"),
        F.count("*").alias("total_ids"),
        _sum_where(bad).alias("bad_ids"),
        _sum_where(~bad).alias("clean_ids"),
        _clean_rows(bad, duplicates).alias("clean_rows"),
    ).withColumn("repeated_rows", F.col("total_rows") - F.col("total_ids"))


def percent(part: Column, whole: Column) -> Column:
    """NULL for an empty table."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def report(per_id: DataFrame, rules: RuleSet, duplicates: str = "quarantine") -> DataFrame:
    """A line per rule and one for the whole table.

    ``rule, bad_ids, message, total_rows, valid_pct_reference, valid_pct_rows``; the last three
    are about the whole table and the same on each line. A rule that nobody breaks has no
    message. The first percentage sets distinct bad *ids* against all *rows*, so further
    copies of a repeated id count as valid; the second is the share of rows that are clean under
    the policy ``duplicates``.
    """
    bad = condemned(rules, duplicates)
    columns = _count_columns(rules)
    counts = per_id.agg(
        *[count.alias(name) for name, count in columns.items()],
        _sum_where(F.col(BROKEN) != 0).alias("bad_ids"),
        _sum_where(F.lit(True), F.col(N_ROWS)).alias("total_rows"),
        _clean_rows(bad, duplicates).alias("clean_rows"),
    )

    def line(rule: str, found: Column, message: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"),
            found.alias("bad_ids"),
            F.when(found > 0, message.cast("string")).alias("message"),
        )

    lines = [
        line(rule.name, F.col(name), F.format_string(rule.message, F.col(name).cast("string")))
        for rule, name in zip(rules.ordered, columns, strict=True)
    ]
    lines.append(line(TOTAL, F.col("bad_ids"), F.lit(None)))
    rows = F.col("total_rows")
    return counts.select(
        "total_rows",
        percent(rows - F.col("bad_ids"), rows).alias("valid_pct_reference"),
        percent(F.col("clean_rows"), rows).alias("valid_pct_rows"),
        F.inline(F.array(*lines)),
    ).select("rule", "bad_ids", "message", "total_rows", "valid_pct_reference", "valid_pct_rows")
