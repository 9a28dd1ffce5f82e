"""Database sinks: every partition is inserted by its own task and transaction.

A lost task is rolled back and run again. Two copies of a task would both insert: keep
``spark.speculation`` off for these jobs.
"""

from __future__ import annotations

from collections.abc import Mapping

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.schema import SNAPSHOT, SNAPSHOT_DDL, assert_schema
from shopsieve.sinks.snapshot import import_date, snapshot_rows
from shopsieve.sources.jdbc import read_jdbc


def write_options(
    connection: Mapping[str, str],
    table: str,
    column_types: str | None = None,
    connections: int = 16,
    batch_rows: int = 10_000,
) -> dict[str, str]:
    """``connection`` is the caller's: url, user, password, driver.

    ``column_types`` are the declared types, used if the table has to be created. An
    overwrite empties the table and keeps its declaration and keys. ``connections`` bounds
    the load on the database, not the data.
    """
    options = {
        **connection,
        "dbtable": table,
        "truncate": "true",
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }
    if column_types:
        options["createTableColumnTypes"] = column_types
    return options


def save_jdbc(
    df: DataFrame,
    connection: Mapping[str, str],
    table: str,
    mode: str = "overwrite",
    schema: T.StructType | None = None,
    column_types: str | None = None,
    connections: int = 16,
    batch_rows: int = 10_000,
) -> None:
    """``mode`` is ``overwrite`` or ``append``; for the rest see ``write_options``."""
    if schema is not None:
        assert_schema(df, schema)
    options = write_options(connection, table, column_types, connections, batch_rows)
    df.write.format("jdbc").options(**options).mode(mode).save()


def not_yet_loaded(rows: DataFrame, table: DataFrame, import_ts: datetime) -> DataFrame:
    """The snapshot rows that ``table`` does not hold for this import."""
    loaded = table.filter(F.col("import_date") == import_date(import_ts)).select("region", "product_id")
    loaded = loaded.withColumnsRenamed({"region": "__region", "product_id": "__product_id"})
    same = (F.col("region") == F.col("__region")) & F.col("product_id").eqNullSafe(F.col("__product_id"))
    return rows.join(loaded, same, "left_anti")


def append_snapshot_jdbc(
    aggregated: DataFrame,
    connection: Mapping[str, str],
    table: str,
    import_ts: datetime,
    first: bool = False,
) -> None:
    """Add one snapshot to a database table; ``first`` if the table does not exist yet.

    An import that broke off can be run again: groups already loaded for it are left out.
    """
    rows = snapshot_rows(aggregated, import_ts)
    if not first:
        # import dates have no zone; read as instants they would shift with the session's
        loaded = read_jdbc(aggregated.sparkSession, {**connection, "preferTimestampNTZ": "true"}, table)
        rows = not_yet_loaded(rows, loaded, import_ts)
    save_jdbc(rows, connection, table, "append", SNAPSHOT, SNAPSHOT_DDL)
