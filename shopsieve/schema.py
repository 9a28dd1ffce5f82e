"""The table layouts of each stage, and the check made before a sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = "sale_id"
CORRUPT = "_corrupt_record"
# Fixed value: what stands in the raw table in place of a date that could not be read.
UNREADABLE_DATE = "invalid"

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(20, 2)


def _layout(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Dates are still text here: whether they are dates is what the rules find out.
SALES_RAW = _layout(
    ("sale_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("product_id", T.LongType()),
    ("quantity", T.IntegerType()),
    ("price", PRICE),
    ("region", T.StringType()),
    ("sale_date", T.StringType()),
)

SALES_TYPED = T.StructType(
    [T.StructField(f.name, T.DateType() if f.name == "sale_date" else f.dataType, True) for f in SALES_RAW]
)

AGGREGATED = _layout(
    ("region", T.StringType()),
    ("product_id", T.LongType()),
    ("total_sales", T.LongType()),
    ("total_sales_amount", AMOUNT),
    ("average_sale_amount", T.DoubleType()),
)

# The count stays 64 bits wide: a narrower one would overflow long before the table is large.
SNAPSHOT = _layout(
    ("region", T.StringType()),
    ("product_id", T.IntegerType()),
    ("total_sales", T.LongType()),
    ("total_sales_amount", T.DoubleType()),
    ("average_sale_amount", T.DoubleType()),
    ("import_date", T.TimestampNTZType()),
)

# The types a database declares, for the JDBC writer's createTableColumnTypes. They are written
# as Spark types; a column left out gets what the database's dialect makes of its Spark type.
SALES_DDL = (
    "sale_id BIGINT, customer_id BIGINT, product_id BIGINT, quantity INT, "
    "price DECIMAL(10,2), region VARCHAR(50), sale_date DATE"
)
AGGREGATED_DDL = "region VARCHAR(50), product_id BIGINT, total_sales BIGINT, total_sales_amount DECIMAL(20,2)"
SNAPSHOT_DDL = "region VARCHAR(50), product_id INT, total_sales BIGINT"


class SchemaMismatch(ValueError):
    """A frame does not have the layout its target declares."""


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Return ``df`` if names, order and types are as declared; nullability is not compared."""
    found = [(f.name, f.dataType.simpleString()) for f in df.schema]
    wanted = [(f.name, f.dataType.simpleString()) for f in expected]
    if found != wanted:
        raise SchemaMismatch(f"expected {wanted}, found {found}")
    return df
