"""Text to declared types. What does not parse becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.schema import SALES_TYPED

DAY_FORMAT = "yyyy-MM-dd"


def coerce(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        # A plain cast would also take '2026-1-5' and '2026-01-01 10:00:00'.
        return F.try_to_date(column.cast("string"), DAY_FORMAT)
    return column.try_cast(kind)


def to_schema(df: DataFrame, schema: T.StructType = SALES_TYPED) -> DataFrame:
    """Select and cast the columns of ``schema``, in its order."""
    return df.select([coerce(F.col(f.name), f.dataType).alias(f.name) for f in schema])


def lost_values(df: DataFrame, schema: T.StructType = SALES_TYPED) -> DataFrame:
    """One row: for each column of ``schema``, how many values are there but become NULL in ``to_schema``."""
    lost = [(F.col(f.name).isNotNull() & coerce(F.col(f.name), f.dataType).isNull(), f.name) for f in schema]
    return df.agg(*[F.count_if(condition).alias(name) for condition, name in lost])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, as a file without types would give it."""
    return df.select([F.col(name).cast("string").alias(name) for name in df.columns])
