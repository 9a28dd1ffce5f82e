"""Database tables, read by many tasks at once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class KeyRange:
    """How to cut a table into slices by a numeric or date column.

    The bounds only place the cuts: rows outside them fall into the first and last slice.
    """

    column: str
    lower: int | str
    upper: int | str
    slices: int


def read_options(
    connection: Mapping[str, str], table: str, key_range: KeyRange | None = None, fetch_rows: int = 10_000
) -> dict[str, str]:
    """``connection`` is the caller's: url, user, password, driver."""
    options = {**connection, "dbtable": table, "fetchsize": str(fetch_rows)}
    if key_range is not None:
        options |= {
            "partitionColumn": key_range.column,
            "lowerBound": str(key_range.lower),
            "upperBound": str(key_range.upper),
            "numPartitions": str(key_range.slices),
        }
    return options


def read_jdbc(
    spark: SparkSession, connection: Mapping[str, str], table: str, key_range: KeyRange | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(connection, table, key_range)).load()


def even_predicates(keys: DataFrame, column: str, slices: int, accuracy: int = 100_000) -> list[str]:
    """Conditions that cut a table into slices of about equal numbers of rows, by one pass over its keys.

    ``KeyRange`` cuts at equal widths, so that skewed keys leave most slices empty. The bounds here are quantiles of
    ``keys`` (a frame with the column, such as a read of it alone), off by at most one in ``accuracy`` of the rows. Each row
    meets exactly one condition, missing keys that of the first slice; a key that would fill several slices leaves fewer.
    """
    kind = keys.schema[column].dataType
    if not isinstance(kind, T.IntegralType | T.DateType):
        raise TypeError(f"{column} must hold whole numbers or dates, not {kind.simpleString()}")
    if slices < 2:
        return ["1 = 1"]
    shares = F.array(*(F.lit(k / slices) for k in range(1, slices)))
    found = keys.agg(F.percentile_approx(column, shares, F.lit(accuracy)).alias("cuts"), F.min(column).alias("least")).first()
    # nothing lies below the least key, so a cut there would leave an empty slice
    cuts = [c for c in sorted(set(found["cuts"] or [])) if c > found["least"]]
    written = [f"DATE '{c.isoformat()}'" if isinstance(c, date) else str(c) for c in cuts]
    if not written:
        return ["1 = 1"]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(written, written[1:], strict=False)]
    return [f"{column} < {written[0]} OR {column} IS NULL", *between, f"{column} >= {written[-1]}"]


def read_jdbc_evenly(
    spark: SparkSession, connection: Mapping[str, str], table: str, key_range: KeyRange, fetch_rows: int = 10_000
) -> DataFrame:
    """The table in ``key_range.slices`` slices of even size: a first read fetches the key column alone, in equal
    widths, for its quantiles."""
    keys = read_jdbc(spark, connection, table, key_range).select(key_range.column)
    options = {k: v for k, v in connection.items() if k != "url"} | {"fetchsize": str(fetch_rows)}
    return spark.read.jdbc(connection["url"], table, predicates=even_predicates(keys, key_range.column, key_range.slices), properties=options)
