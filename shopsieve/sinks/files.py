"""File sinks. A sink always replaces its target, with an empty table if need be: no output
of an earlier run survives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shopsieve.schema import assert_schema


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """With ``schema``, refuse a frame that is not laid out as declared."""
    if schema is not None:
        assert_schema(df, schema)
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
