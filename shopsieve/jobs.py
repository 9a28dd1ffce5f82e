"""The steps of the chain as separate jobs that hand over tables, for a scheduler to run.

    spark-submit run_job.py generate  --rows 1000000 --to /data/raw
    spark-submit run_job.py validate  --sales /data/raw --to /data/checks
    spark-submit run_job.py clean     --sales /data/raw --checks /data/checks --to /data/split
    spark-submit run_job.py load      --sales /data/split --to /data/sales_data
    spark-submit run_job.py aggregate --sales /data/sales_data --to /data/aggregated_sales_data
    spark-submit run_job.py snapshot  --aggregated /data/aggregated_sales_data --to /data/snapshots

Or in one call, which goes on where an earlier call of the same broke off:

    spark-submit run_job.py chain     --sales /data/raw --import-ts 2026-06-30T12:45:00 --to /data/chain

CSV input: ``rejects`` first sets aside the lines that do not fit. With ``--text`` validate, clean and load take the
fields as the file has them, so that one that does not parse breaks a rule instead of becoming NULL; load counts what
it loses in ``<to>_lost``. ``validate --state DIR --batch NAME`` checks one batch of a table that grows and
reports on all of it; ``load --upsert`` merges into a table with a key; ``snapshot --versioned`` commits
imports atomically. Bounds and the policy for duplicates are options of validate, clean and chain.

``--database`` names a JSON file with a JDBC connection (url, user, password, driver); load,
aggregate and snapshot then fill tables there as well.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.functions.casts import lost_values, to_schema
from shopsieve.operators.analytics import aggregate, line_amount, preview
from shopsieve.operators.clean import CLEAN, POLICIES, QUARANTINE, STATUS, label_by_ids, with_status
from shopsieve.operators.incremental import CheckState
from shopsieve.operators.quality import N_ROWS, by_id, report, violations
from shopsieve.operators.rules import (
    PRICE_BOUNDS,
    QUANTITY_BOUNDS,
    REGIONS,
    RuleSet,
    sales_rules,
    text_sales_rules,
    unique,
    year_to_date,
)
from shopsieve.plans.chain import ChainConfig, run_chain
from shopsieve.schema import (
    AGGREGATED,
    AGGREGATED_DDL,
    KEY,
    SALES_DDL,
    SALES_RAW,
    SALES_TYPED,
    assert_schema,
)
from shopsieve.sinks.files import write_csv, write_json, write_parquet
from shopsieve.sinks.jdbc import append_snapshot_jdbc, save_jdbc
from shopsieve.sinks.keyed import WIDTH, KeyedTable
from shopsieve.sinks.scratch import hand_off
from shopsieve.sinks.snapshot import append_snapshot
from shopsieve.sinks.snapshot_log import SnapshotLog
from shopsieve.sources.files import read_csv, read_csv_text, read_parquet
from shopsieve.sources.generate import gen_table
from shopsieve.sources.rejects import split_csv

Connection = Mapping[str, str] | None


def read_sales(spark: SparkSession, path: str, kind: str, text: bool = False) -> DataFrame:
    """``text`` keeps the fields of a CSV file as they are written."""
    if kind == "csv":
        return read_csv_text(spark, path) if text else read_csv(spark, path)
    return read_parquet(spark, path, _as_text(SALES_RAW) if text else SALES_RAW)


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def rejects(spark: SparkSession, sales: str, to: str) -> DataFrame:
    """Write the rows of CSV files to ``accepted`` and the lines that do not fit to ``rejected``; returns those."""
    accepted, rejected = split_csv(spark, sales)
    write_parquet(accepted, f"{to}/accepted", SALES_RAW)
    return hand_off(rejected, "rejected", f"{to}/rejected")


def rules_for(
    as_of: date,
    text: bool = False,
    regions: Sequence[str] = REGIONS,
    quantity: tuple[int, int] = QUANTITY_BOUNDS,
    price: tuple[Decimal, Decimal] = PRICE_BOUNDS,
) -> RuleSet:
    return (text_sales_rules if text else sales_rules)(*year_to_date(as_of), regions, quantity, price)


def generate(spark: SparkSession, to: str, rows: int, as_of: date, seed: int = 0, kind: str = "parquet") -> None:
    """A synthetic raw table, dated from the start of the year to ``as_of``."""
    table = gen_table(spark, rows, seed, *year_to_date(as_of))
    (write_csv if kind == "csv" else write_parquet)(table, to)


def validate(
    spark: SparkSession,
    sales: str,
    to: str,
    as_of: date,
    kind: str = "parquet",
    *,
    text: bool = False,
    duplicates: str = "quarantine",
    state: str | None = None,
    batch: str | None = None,
    **bounds: object,
) -> DataFrame:
    """Write ``report``, ``duplicates`` and ``violations`` and return the report.

    With ``state``, ``sales`` is one batch, named ``batch``, of a table that grows, and the results are about
    all batches the state has taken.
    """
    rules = rules_for(as_of, text, **bounds)
    rows = read_sales(spark, sales, kind, text)
    if state is None:
        found_by_id = by_id(rows, rules)
    else:
        if not batch:
            raise ValueError("a batch that goes into a state needs a name")
        taken = CheckState(spark, state, rules, rows.schema[KEY].dataType)
        taken.add(rows, batch)
        found_by_id = taken.per_id()
    per_id = hand_off(found_by_id, "by-id", f"{to}/by_id")
    found = report(per_id, rules, duplicates)
    write_json(found, f"{to}/report")
    repeated = per_id.filter(F.col(N_ROWS) > 1).select(KEY, F.col(N_ROWS).alias("count"))
    write_parquet(repeated, f"{to}/duplicates")
    write_parquet(violations(per_id, rules), f"{to}/violations")
    return found


def clean(
    spark: SparkSession,
    sales: str,
    checks: str,
    to: str,
    kind: str = "parquet",
    *,
    text: bool = False,
    duplicates: str = "quarantine",
    csv: str | None = None,
) -> DataFrame:
    """Write the raw rows, one per id, to the folders ``status=clean`` and ``status=quarantine``; with ``csv``
    also as CSV files in its folders ``clean`` and ``quarantine``. ``keep_one`` does not condemn an id for being repeated."""
    found = read_parquet(spark, f"{checks}/violations")
    ids = (found if duplicates == "quarantine" else found.filter(F.col("rule") != unique().name)).select(KEY)
    split = hand_off(label_by_ids(read_sales(spark, sales, kind, text), ids), "split", to, (STATUS,))
    if csv is not None:
        for side in (CLEAN, QUARANTINE):
            write_csv(with_status(split, side), f"{csv}/{side}")
    return split


def load(
    spark: SparkSession,
    sales: str,
    to: str,
    database: Connection = None,
    *,
    text: bool = False,
    upsert: bool = False,
    width: int = WIDTH,
) -> DataFrame:
    """Write the clean rows with their declared types, and to ``<to>_lost`` how many values became NULL by it.

    With ``upsert``, ``to`` is a table with a key that goes on from load to load (``KeyedTable``): rows without an id, or two
    with one id, are refused.
    """
    raw = _as_text(SALES_RAW) if text else SALES_RAW
    split = read_parquet(spark, sales, T.StructType([*raw, T.StructField(STATUS, T.StringType())]))
    rows = with_status(split, CLEAN)
    write_json(lost_values(rows), f"{to.rstrip('/')}_lost")
    typed = assert_schema(to_schema(rows), SALES_TYPED)
    if upsert:
        target = KeyedTable(spark, to, SALES_TYPED, KEY, width=width)
        target.merge(typed)
        table = target.read()
    else:
        table = hand_off(typed, "sales", to)
    if database is not None:
        save_jdbc(table, database, "sales_data", schema=SALES_TYPED, column_types=SALES_DDL)
    return table


def aggregates(
    spark: SparkSession,
    sales: str,
    to: str,
    times_quantity: bool = False,
    database: Connection = None,
    *,
    upsert: bool = False,
    width: int = WIDTH,
) -> DataFrame:
    """``upsert``: ``sales`` is the table that ``load`` fills with that option."""
    amount = line_amount() if times_quantity else "price"
    rows = KeyedTable(spark, sales, SALES_TYPED, KEY, width=width).read() if upsert else read_parquet(spark, sales, SALES_TYPED)
    table = hand_off(assert_schema(aggregate(rows, amount=amount), AGGREGATED), "aggregated", to)
    if database is not None:
        save_jdbc(table, database, "aggregated_sales_data", schema=AGGREGATED, column_types=AGGREGATED_DDL)
    return table


def snapshot(
    spark: SparkSession,
    aggregated: str,
    to: str,
    import_ts: datetime,
    database: Connection = None,
    first: bool = False,
    versioned: bool = False,
) -> None:
    """``versioned``: ``to`` is a ``SnapshotLog``, whose imports are atomic."""
    table = read_parquet(spark, aggregated, AGGREGATED)
    if versioned:
        SnapshotLog(spark, to).add(table, import_ts)
    else:
        append_snapshot(table, to, import_ts)
    if database is not None:
        append_snapshot_jdbc(table, database, "aggregated_sales_snapshots", import_ts, first)


def chain(
    spark: SparkSession,
    sales: str,
    to: str,
    as_of: date,
    import_ts: datetime,
    kind: str = "parquet",
    *,
    text: bool = False,
    duplicates: str = "quarantine",
    times_quantity: bool = False,
    **bounds: object,
) -> dict[str, DataFrame]:
    """The whole chain; stages that an earlier call has finished on the same files and settings are not run again."""
    config = ChainConfig(rules_for(as_of, text, **bounds), to, import_ts, duplicates, times_quantity)
    return run_chain(read_sales(spark, sales, kind, text), config, f"{kind} {text}")


def _pair(kind: type) -> Callable[[str], tuple]:
    def parse(given: str) -> tuple:
        low, high = given.split(":")
        return kind(low), kind(high)

    return parse


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="run_job.py")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for path in (*paths, "to"):
            sub.add_argument(f"--{path}", required=True)
        return sub

    dated = (job("generate"), job("validate", "sales"), job("chain", "sales"))
    for sub in dated:
        sub.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    for sub in dated[1:]:
        sub.add_argument("--regions", type=lambda given: given.split(","), default=argparse.SUPPRESS)
        sub.add_argument("--quantity", type=_pair(int), default=argparse.SUPPRESS, help="LOW:HIGH")
        sub.add_argument("--price", type=_pair(Decimal), default=argparse.SUPPRESS, help="LOW:HIGH")
    dated[1].add_argument("--state")
    dated[1].add_argument("--batch")
    job("rejects", "sales")
    dated[0].add_argument("--rows", type=int, default=1_000_000)
    dated[0].add_argument("--seed", type=int, default=0)
    cleaning = job("clean", "sales", "checks")
    cleaning.add_argument("--csv")
    for sub in (*dated, cleaning):
        sub.add_argument("--kind", choices=("parquet", "csv"), default="parquet")
    for sub in (*dated[1:], cleaning):
        sub.add_argument("--duplicates", choices=POLICIES, default="quarantine")
        sub.add_argument("--text", action="store_true")
    loading = (job("load", "sales"), job("aggregate", "sales"), job("snapshot", "aggregated"))
    for sub in loading:
        sub.add_argument("--database")
    loading[0].add_argument("--text", action="store_true")
    for sub in loading[:2]:
        sub.add_argument("--upsert", action="store_true")
    for sub in (loading[1], dated[2]):
        sub.add_argument("--times-quantity", action="store_true")
    loading[2].add_argument("--import-ts", type=datetime.fromisoformat, default=None)
    # which import the chain is about must not change when it is run again
    dated[2].add_argument("--import-ts", type=datetime.fromisoformat, required=True)
    loading[2].add_argument("--first", action="store_true")
    loading[2].add_argument("--versioned", action="store_true")
    return parser


def main(spark: SparkSession, argv: Sequence[str]) -> None:
    given = vars(arguments().parse_args(argv))
    name = given.pop("job")
    if given.get("database"):
        with open(given["database"], encoding="utf-8") as file:
            given["database"] = json.load(file)
    if name == "generate":
        generate(spark, **given)
    elif name == "validate":
        validate(spark, **given).show(truncate=False)
    elif name == "rejects":
        rejects(spark, **given).groupBy("reason").count().show()
    elif name == "chain":
        chain(spark, **given)["report"].show(truncate=False)
    elif name == "clean":
        clean(spark, **given).groupBy(STATUS).count().show()
    elif name == "load":
        load(spark, **given).printSchema()
    elif name == "aggregate":
        preview(aggregates(spark, **given)).show()
    else:
        given["import_ts"] = given["import_ts"] or datetime.now().replace(microsecond=0)
        snapshot(spark, **given)
