"""The registered queries: every operator applied to the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsieve.functions.casts import as_text, to_schema
from shopsieve.operators import analytics, clean, quality, sketches
from shopsieve.operators.incremental import CheckState
from shopsieve.operators.rules import RuleSet, sales_rules, text_sales_rules, year_to_date
from shopsieve.operators.running import running
from shopsieve.operators.sampling import sample_exact, sample_fraction
from shopsieve.plans import chain, flow
from shopsieve.schema import AGGREGATED, KEY, SALES_RAW, SALES_TYPED, assert_schema
from shopsieve.sinks.files import write_csv, write_json, write_parquet
from shopsieve.sinks.keyed import KeyedTable
from shopsieve.sinks.scratch import hand_off, new_folder
from shopsieve.sinks.snapshot import append_snapshot, by_region, read_snapshots, snapshot_rows
from shopsieve.sinks.snapshot_log import SnapshotLog
from shopsieve.sources import generate
from shopsieve.sources.files import read_csv, read_csv_text, read_json, read_parquet
from shopsieve.sources.rejects import split_csv
from shopsieve.sources.star import sales_from_star, table

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries, chosen so that every rule finds something in the given tables.
SALES_START, SALES_END = date(1995, 7, 1), date(2001, 6, 30)
SALES_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
SALES_QUANTITY = (1, 45)
SALES_PRICE = (Decimal("0.01"), Decimal("990"))
FIRST_IMPORT, SECOND_IMPORT = datetime(2026, 1, 6, 12, 45), datetime(2026, 1, 13, 12, 45)
YEAR_TO = date(1998, 8, 2)
SEED = 7
GEN_START, GEN_END = date(2026, 1, 1), date(2026, 6, 30)


def star_rules() -> RuleSet:
    return sales_rules(SALES_START, SALES_END, SALES_REGIONS, SALES_QUANTITY, SALES_PRICE)


# Aggregation


def agg_region_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assert_schema(analytics.aggregate(sales_from_star(spark, sf_dir)), AGGREGATED)


def agg_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.preview(analytics.aggregate(sales_from_star(spark, sf_dir)))


def agg_sale_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.aggregate(sales_from_star(spark, sf_dir), amount=analytics.line_amount())


def agg_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.aggregate_levels(sales_from_star(spark, sf_dir))


def win_region_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written once, as it is aggregated and joined
    return analytics.windowed(hand_off(sales_from_star(spark, sf_dir), "sales"))


def sale_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.with_sale_amount(sales_from_star(spark, sf_dir))


# Rules and bad ids


def _bad_ids(*names: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.bad_ids(sales_from_star(spark, sf_dir), star_rules(), *names)

    return query


def null_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row rule on sales with missing values: how many rows break it, keep it, or neither."""
    sales = sales_from_star(spark, sf_dir)
    gaps = sales.select(
        "sale_id",
        F.nullif(F.col("quantity"), F.lit(1)).alias("quantity"),
        F.nullif(F.col("price"), F.lit(Decimal("900.00"))).alias("price"),
        F.nullif(F.col("region"), F.lit("ASIA")).alias("region"),
        F.nullif(F.col("sale_date"), F.lit("invalid")).alias("sale_date"),
    )
    rules = star_rules().rows
    outcomes = ("violated", "kept", "unknown")
    counts = [
        F.count_if(condition).alias(f"{rule.name}_{outcome}")
        for rule in rules
        for outcome, condition in zip(
            outcomes, (rule.violation, ~rule.violation, rule.violation.isNull()), strict=True
        )
    ]
    lines = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(outcome).alias("outcome"),
            F.col(f"{rule.name}_{outcome}").alias("n_rows"),
        )
        for rule in rules
        for outcome in outcomes
    ]
    return gaps.agg(*counts).select(F.inline(F.array(*lines))).filter("n_rows > 0")


def _by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.by_id(sales_from_star(spark, sf_dir), star_rules())


def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_counts(sales_from_star(spark, sf_dir), KEY)


def dq_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_counts(_by_id(spark, sf_dir), star_rules())


def dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(_by_id(spark, sf_dir), star_rules())


def dq_id_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.id_samples(_by_id(spark, sf_dir), star_rules())


def dq_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.totals(_by_id(spark, sf_dir))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_by_id(spark, sf_dir), star_rules())


def dq_report_keep_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_by_id(spark, sf_dir), star_rules(), "keep_one")


def bad_ids_year_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates outside the year up to a fixed day."""
    rules = sales_rules(*year_to_date(YEAR_TO))
    return quality.bad_ids(sales_from_star(spark, sf_dir), rules, "date_range")


def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written as JSON and read back."""
    report = dq_report(spark, sf_dir)
    path = new_folder(spark, "report")
    write_json(report, path)
    return read_json(spark, path, report.schema)


# De-duplication and split


def dedup_keep_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.dedup_keep_one(sales_from_star(spark, sf_dir))


def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.dedup_stats(sales_from_star(spark, sf_dir))


def _side(status: str, duplicates: str = "quarantine") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        resolved = clean.resolve(sales_from_star(spark, sf_dir), star_rules(), duplicates)
        return clean.with_status(resolved, status)

    return query


def _side_by_id_list(side: int) -> Query:
    """The split by a written table of bad ids."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        sales = hand_off(sales_from_star(spark, sf_dir), "sales")
        ids = hand_off(quality.bad_ids(sales, star_rules()), "bad-ids")
        return clean.split_by_ids(sales, ids)[side]

    return query


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.split_counts(_by_id(spark, sf_dir))


def split_counts_keep_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.split_counts(_by_id(spark, sf_dir), star_rules(), "keep_one")


# Missing ids: every fiftieth id of the view is gone, and those rows share the id NULL


def _sales_with_null_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = sales_from_star(spark, sf_dir)
    return sales.withColumn(KEY, F.when(F.col(KEY) % 50 != 0, F.col(KEY)))


def _null_ids_side(status: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return clean.with_status(clean.resolve(_sales_with_null_ids(spark, sf_dir), star_rules()), status)

    return query


def dedup_stats_null_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.dedup_stats(_sales_with_null_ids(spark, sf_dir))


def sample_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of exactly 500 rows of a table with a missing id."""
    one_each = hand_off(clean.dedup_keep_one(_sales_with_null_ids(spark, sf_dir)), "sales")
    return sample_exact(one_each, 500, KEY, SEED)


def sample_tenth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_fraction(sales_from_star(spark, sf_dir), 0.1, SEED, KEY)


# Sources, sinks and types


def csv_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view written as CSV with some fields spoilt, and each id with the rules it breaks."""
    text = as_text(sales_from_star(spark, sf_dir))
    number = F.col(KEY).cast("bigint")
    spoilt = text.withColumns(
        {
            KEY: F.when(number % 97 == 0, F.concat(F.lit("x"), KEY)).otherwise(F.col(KEY)),
            "quantity": F.when(number % 89 == 1, F.lit("abc"))
            .when(number % 89 == 2, F.lit("99999999999"))
            .otherwise(F.col("quantity")),
            "price": F.when(number % 83 == 1, F.lit("100000000000"))
            .when(number % 83 == 2, F.lit("990.004"))
            .when(number % 83 == 3, F.lit("0.006"))
            .otherwise(F.col("price")),
            "sale_date": F.when(number % 79 == 1, F.lit("1996-02-30")).otherwise(F.col("sale_date")),
        }
    )
    path = new_folder(spark, "sales-csv")
    write_csv(spoilt, path)
    rules = text_sales_rules(SALES_START, SALES_END, SALES_REGIONS, SALES_QUANTITY, SALES_PRICE, strict_dates=True)
    return quality.violations(quality.by_id(read_csv_text(spark, path), rules), rules)


def typed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales from text to the declared types."""
    return assert_schema(to_schema(as_text(sales_from_star(spark, sf_dir))), SALES_TYPED)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "sales-csv")
    write_csv(sales_from_star(spark, sf_dir), path)
    return read_csv(spark, path)


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file with guessed types: one unreadable date keeps the whole column as text."""
    path = new_folder(spark, "sales-csv")
    write_csv(sales_from_star(spark, sf_dir), path)
    return read_csv(spark, path, infer=True)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "sales-parquet")
    write_parquet(sales_from_star(spark, sf_dir), path, SALES_RAW)
    return read_parquet(spark, path, SALES_RAW)


def snapshot_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_region(snapshot_rows(agg_region_product(spark, sf_dir), FIRST_IMPORT))


def snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two imports, the first of them run twice."""
    path = new_folder(spark, "snapshots")
    aggregated = hand_off(agg_region_product(spark, sf_dir), "aggregated")
    for import_ts in (FIRST_IMPORT, SECOND_IMPORT, FIRST_IMPORT):
        append_snapshot(aggregated, path, import_ts)
    return read_snapshots(spark, path)


def snapshot_rerun_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two imports, the first of them run again without rows: nothing of it stays."""
    path = new_folder(spark, "snapshots")
    aggregated = hand_off(agg_region_product(spark, sf_dir), "aggregated")
    for import_ts in (FIRST_IMPORT, SECOND_IMPORT):
        append_snapshot(aggregated, path, import_ts)
    append_snapshot(aggregated.filter("total_sales < 0"), path, FIRST_IMPORT)
    return read_snapshots(spark, path)


# Synthetic sales, one for each order


def _order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias(KEY))


def _extent(ids: DataFrame) -> tuple[int, int]:
    """How many ids there are, and the last."""
    row = ids.agg(F.count("*").alias("n"), F.coalesce(F.max(KEY), F.lit(0)).alias("last")).first()
    return row["n"], row["last"]


def gen_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.sales_for(_order_ids(spark, sf_dir), SEED, GEN_START, GEN_END)


def gen_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, last = _extent(_order_ids(spark, sf_dir))
    return generate.inject_bad_dates(spark, n, SEED, GEN_END, first_id=last + 1)


def gen_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, _ = _extent(_order_ids(spark, sf_dir))
    return generate.inject_duplicates(gen_sales(spark, sf_dir), n, SEED, unique_key=True)


def gen_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _order_ids(spark, sf_dir)
    n, last = _extent(ids)
    return generate.gen_combined(ids, n, last, SEED, GEN_START, GEN_END)


def gen_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules find in the synthetic table."""
    rules = sales_rules(GEN_START, GEN_END)
    return quality.report(quality.by_id(gen_combined(spark, sf_dir), rules), rules)


# The whole chain


def sales_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = flow.FlowConfig(star_rules(), new_folder(spark, "flow"), FIRST_IMPORT)
    return flow.run(sales_from_star(spark, sf_dir), config)["snapshots"]


def gen_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = flow.FlowConfig(sales_rules(GEN_START, GEN_END), new_folder(spark, "flow"), FIRST_IMPORT)
    return flow.run(gen_combined(spark, sf_dir), config)["snapshots"]


# Tables with commits


def _two_imports(spark: SparkSession, sf_dir: str) -> tuple[SnapshotLog, int]:
    """Two imports, then the first once more for Asia alone; the log and its version before that."""
    table = SnapshotLog(spark, new_folder(spark, "snapshots"))
    aggregated = hand_off(agg_region_product(spark, sf_dir), "aggregated")
    table.add(aggregated, FIRST_IMPORT)
    before = table.add(aggregated, SECOND_IMPORT)
    table.add(aggregated.filter("region = 'ASIA'"), FIRST_IMPORT)
    return table, before


def snapshot_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_imports(spark, sf_dir)[0].read()


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was before its first import was replaced."""
    table, before = _two_imports(spark, sf_dir)
    return table.read(before)


def snapshot_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region's products from 100 to 900, from the files that may hold them."""
    return _two_imports(spark, sf_dir)[0].read_region(["EUROPE"], (100, 900))


def sales_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that share ids: the second brings new ids and replaces shared ones with one piece more."""
    one_each = to_schema(clean.dedup_keep_one(sales_from_star(spark, sf_dir)))
    sales = hand_off(one_each, "sales")
    target = KeyedTable(spark, new_folder(spark, "sales-keyed"), SALES_TYPED, KEY, width=20_000)
    target.merge(sales.filter(F.col(KEY) % 3 != 0), "first")
    target.merge(sales.filter(F.col(KEY) % 2 == 0).withColumn("quantity", F.col("quantity") + 1), "second")
    return target.read()


def _batches(spark: SparkSession, sf_dir: str) -> CheckState:
    """The sales in two batches that share ids, the first of them run twice."""
    sales = hand_off(sales_from_star(spark, sf_dir), "sales")
    state = CheckState(spark, new_folder(spark, "check-state"), star_rules(), buckets=16)
    for number in (0, 1, 0):
        state.add(sales.filter(F.col("product_id") % 2 == number), f"batch-{number}")
    return state


def dq_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_batches(spark, sf_dir).per_id(), star_rules())


def bad_ids_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir).per_id().filter(F.col(quality.BROKEN) != 0).select(KEY)


class _BrokenOff(Exception):
    pass


def pipeline_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain, broken off before its load and run again: the second run goes on from there."""
    config = chain.ChainConfig(star_rules(), new_folder(spark, "chain"), FIRST_IMPORT)
    raw = sales_from_star(spark, sf_dir)

    def fail_at_load(stage: str) -> None:
        if stage == "load":
            raise _BrokenOff

    try:
        chain.run_chain(raw, config, "sales_from_star", fail_at_load)
    except _BrokenOff:
        pass
    return chain.run_chain(raw, config, "sales_from_star")["snapshots"]


def _spoilt_lines(spark: SparkSession, sf_dir: str) -> str:
    """The view as CSV lines, some cut short, some with a field too many, some with words for numbers."""
    text = as_text(sales_from_star(spark, sf_dir))
    number = F.col(KEY).cast("bigint")
    quantity = F.when(number % 83 == 1, F.lit("abc")).otherwise(F.col("quantity"))
    price = F.when(number % 79 == 2, F.lit("n/a")).otherwise(F.col("price"))
    begin = F.concat_ws(",", KEY, "customer_id", "product_id", quantity, price, "region")
    end = F.when(number % 97 == 0, F.lit("")).when(number % 89 == 1, F.concat(F.lit(","), "sale_date", F.lit(",x")))
    path = new_folder(spark, "spoilt-csv")
    text.select(F.concat(begin, end.otherwise(F.concat(F.lit(","), "sale_date"))).alias("value")).write.text(path)
    return path


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that do not fit, with their reason and the columns that could not be read."""
    _, rejected = split_csv(spark, _spoilt_lines(spark, sf_dir), header=False)
    return rejected.filter(F.col("file").isNotNull()).select("line", "reason", F.array_join("columns", ",").alias("columns"))


def csv_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_csv(spark, _spoilt_lines(spark, sf_dir), header=False)[0]


def win_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sale with the number and total of its region's sales up to it, by date."""
    return running(sales_from_star(spark, sf_dir), ["region"], ["sale_date", KEY])


def dq_rule_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 256 smallest hashes of each rule's bad ids, and about how many ids there are."""
    found = sketches.rule_sketches(_by_id(spark, sf_dir), star_rules(), 256)
    return found.select(
        "rule",
        F.size("hashes").cast("bigint").alias("kept"),
        F.array_join(F.col("hashes").cast("array<string>"), ",").alias("hashes"),
        F.round(sketches.estimate(F.col("hashes"), 256), 3).alias("estimated"),
    )


def gen_duplicates_drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth as many draws with replacement as there are orders: some sales come several times."""
    n, _ = _extent(_order_ids(spark, sf_dir))
    return generate.inject_drawn_duplicates(gen_sales(spark, sf_dir), n, SEED, share=0.1, unique_key=True)


QUERIES: dict[str, Query] = {
    "agg_region_product": agg_region_product,
    "agg_preview": agg_preview,
    "agg_sale_amount": agg_sale_amount,
    "agg_grouping_sets": agg_grouping_sets,
    "win_region_product": win_region_product,
    "sale_amount": sale_amount,
    "bad_ids_date_format": _bad_ids("date_format"),
    "bad_ids_date_range": _bad_ids("date_range"),
    "bad_ids_date": _bad_ids("date_format", "date_range"),
    "bad_ids_region": _bad_ids("region"),
    "bad_ids_quantity": _bad_ids("quantity"),
    "bad_ids_price": _bad_ids("price"),
    "bad_ids_numeric": _bad_ids("quantity", "price"),
    "bad_ids_duplicate": _bad_ids("duplicate"),
    "bad_ids_all": _bad_ids(),
    "null_semantics": null_semantics,
    "duplicate_counts": duplicate_counts,
    "dedup_keep_one": dedup_keep_one,
    "dedup_stats": dedup_stats,
    "dq_rule_counts": dq_rule_counts,
    "dq_violations": dq_violations,
    "dq_id_samples": dq_id_samples,
    "dq_totals": dq_totals,
    "dq_report": dq_report,
    "report_roundtrip": report_roundtrip,
    "clean_rows": _side(clean.CLEAN),
    "quarantine_rows": _side(clean.QUARANTINE),
    "clean_rows_keep_one": _side(clean.CLEAN, "keep_one"),
    "clean_rows_by_id_list": _side_by_id_list(0),
    "quarantine_rows_by_id_list": _side_by_id_list(1),
    "split_counts": split_counts,
    "split_counts_keep_one": split_counts_keep_one,
    "dq_report_keep_one": dq_report_keep_one,
    "bad_ids_year_to_date": bad_ids_year_to_date,
    "clean_rows_null_ids": _null_ids_side(clean.CLEAN),
    "quarantine_rows_null_ids": _null_ids_side(clean.QUARANTINE),
    "dedup_stats_null_ids": dedup_stats_null_ids,
    "sample_null_key": sample_null_key,
    "sample_fraction": sample_tenth,
    "csv_defects": csv_defects,
    "snapshot_rerun_empty": snapshot_rerun_empty,
    "typed_sales": typed_sales,
    "csv_roundtrip": csv_roundtrip,
    "csv_inferred": csv_inferred,
    "parquet_roundtrip": parquet_roundtrip,
    "snapshot_typed": snapshot_typed,
    "snapshot_append": snapshot_append,
    "gen_sales": gen_sales,
    "gen_invalid": gen_invalid,
    "gen_duplicates": gen_duplicates,
    "gen_combined": gen_combined,
    "gen_report": gen_report,
    "sales_e2e": sales_e2e,
    "gen_e2e": gen_e2e,
    "snapshot_newest": snapshot_newest,
    "snapshot_as_of": snapshot_as_of,
    "snapshot_region": snapshot_region,
    "sales_upsert": sales_upsert,
    "dq_report_incremental": dq_report_incremental,
    "bad_ids_incremental": bad_ids_incremental,
    "pipeline_e2e": pipeline_e2e,
    "csv_rejects": csv_rejects,
    "csv_accepted": csv_accepted,
    "win_running_total": win_running_total,
    "dq_rule_sketches": dq_rule_sketches,
    "gen_duplicates_drawn": gen_duplicates_drawn,
}
