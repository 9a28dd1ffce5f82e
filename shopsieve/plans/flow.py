"""The whole chain on one table: check, split, load, aggregate, add a snapshot."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsieve.functions.casts import to_schema
from shopsieve.operators.analytics import aggregate
from shopsieve.operators.clean import CLEAN, QUARANTINE, STATUS, resolve, with_status
from shopsieve.operators.quality import BROKEN, N_ROWS, id_samples, report, violations
from shopsieve.operators.rules import RuleSet
from shopsieve.schema import AGGREGATED, AGGREGATED_DDL, SALES_DDL, SALES_TYPED, assert_schema
from shopsieve.sinks.files import write_json
from shopsieve.sinks.jdbc import save_jdbc
from shopsieve.sinks.scratch import hand_off
from shopsieve.sinks.snapshot import append_snapshot, read_snapshots


@dataclass(frozen=True)
class FlowConfig:
    """``folder`` holds all tables of the flow; its snapshot table grows with each run.

    ``database`` is a JDBC connection (url, user, password, driver) to load the sales and
    their aggregate into as well.
    """

    rules: RuleSet
    folder: str
    import_ts: datetime | None = None
    duplicates: str = "quarantine"
    amount: str | Column = "price"
    samples: int = 3
    database: Mapping[str, str] | None = None


def run(raw: DataFrame, config: FlowConfig) -> dict[str, DataFrame]:
    """Run the chain and return its tables.

    The raw table is read once and shuffled once, by id. Its verdicts are written with one
    folder per side of the split, so report, samples, both sides and the load only read
    what they need of that table and do not shuffle rows again.
    """
    rules, folder = config.rules, config.folder
    resolved = hand_off(
        resolve(raw, rules, config.duplicates), "resolved", f"{folder}/resolved", partition_by=(STATUS,)
    )
    per_id = resolved.select(rules.key, N_ROWS, BROKEN)
    quality_report = report(per_id, rules, config.duplicates)
    write_json(quality_report, f"{folder}/report")
    repeated = per_id.filter(F.col(N_ROWS) > 1).select(rules.key, F.col(N_ROWS).alias("count"))
    duplicates = hand_off(repeated, "duplicates", f"{folder}/duplicates")
    broken = hand_off(violations(per_id, rules), "violations", f"{folder}/violations")

    clean = with_status(resolved, CLEAN)
    sales = hand_off(assert_schema(to_schema(clean), SALES_TYPED), "sales", f"{folder}/sales_data")
    aggregated = hand_off(aggregate(sales, amount=config.amount), "aggregated", f"{folder}/aggregated_sales_data")
    if config.database is not None:
        save_jdbc(sales, config.database, "sales_data", schema=SALES_TYPED, column_types=SALES_DDL)
        save_jdbc(
            aggregated, config.database, "aggregated_sales_data", schema=AGGREGATED, column_types=AGGREGATED_DDL
        )
    append_snapshot(aggregated, f"{folder}/snapshots", config.import_ts)
    return {
        "report": quality_report,
        "duplicates": duplicates,
        "violations": broken,
        "samples": id_samples(per_id, rules, config.samples),
        "clean": clean,
        "quarantine": with_status(resolved, QUARANTINE),
        "sales": sales,
        "aggregated": aggregated,
        "snapshots": read_snapshots(raw.sparkSession, f"{folder}/snapshots"),
    }
