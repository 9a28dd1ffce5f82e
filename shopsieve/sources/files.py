"""File scans. The schema is stated, so no pass over the data goes into guessing it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.schema import CORRUPT, KEY, SALES_RAW


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SALES_RAW,
    *,
    infer: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV with a header line.

    ``infer=True`` lets Spark guess the types at the cost of a second scan. ``keep_corrupt``
    adds a column with the text of lines that do not fit the schema; their other
    columns are NULL where they did not parse.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if infer:
        return reader.option("inferSchema", True).csv(path)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_csv_text(spark: SparkSession, path: str, schema: T.StructType = SALES_RAW, key: str = KEY) -> DataFrame:
    """CSV with a header line, all columns as text, so that rules see what the file says.

    Keys that are numbers are written in one way (``07`` as ``7``), so that equal ones meet.
    """
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])
    number = F.col(key).try_cast(schema[key].dataType).cast("string")
    return read_csv(spark, path, text).withColumn(key, F.coalesce(number, key))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
