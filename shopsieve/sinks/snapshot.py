"""The snapshot table: each import adds the aggregate once more, marked by its import date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.schema import SNAPSHOT, assert_schema

ORDER = ("region", "product_id")


def import_date(import_ts: datetime | None) -> Column:
    """The given time, or that of the query."""
    if import_ts is None:
        return F.current_timestamp().cast(T.TimestampNTZType())
    return F.lit(import_ts.isoformat(sep=" ")).cast(T.TimestampNTZType())


def _or_fail(ok: Column, value: Column, message: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(message)).cast("string"))


def snapshot_rows(aggregated: DataFrame, import_ts: datetime | None = None) -> DataFrame:
    """The declared columns and types.

    The target allows no missing region and narrower product ids; a row that does not fit
    stops the job, also where the session lets casts overflow.
    """
    region, product = F.col("region"), F.col("product_id")
    narrow = product.try_cast("int")
    checked = aggregated.withColumns(
        {
            "region": _or_fail(region.isNotNull(), region, "a snapshot row has no region"),
            "product_id": _or_fail(
                product.isNull() | narrow.isNotNull(), product.cast("string"), "a product id does not fit 32 bits"
            ),
            "import_date": import_date(import_ts),
        }
    )
    typed = checked.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in SNAPSHOT])
    return assert_schema(typed, SNAPSHOT)


def by_region(snapshot: DataFrame) -> DataFrame:
    """Ordered by region across files and within each. Ranges are cut by product as well, so
    that a large region spreads over several tasks."""
    return snapshot.repartitionByRange(*ORDER).sortWithinPartitions("import_date", *ORDER)


def append_snapshot(aggregated: DataFrame, path: str, import_ts: datetime | None = None) -> None:
    """Add one snapshot to the Parquet table at ``path``. Running the same import again
    replaces that snapshot and leaves the others alone."""
    rows = by_region(snapshot_rows(aggregated, import_ts))
    if import_ts is not None:
        # the one partition is overwritten as such, so that an import without rows replaces it too
        name = import_ts.isoformat(sep=" ").replace(":", "%3A")
        rows.drop("import_date").write.mode("overwrite").parquet(f"{path}/import_date={name}")
        return
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("import_date")
        .parquet(path)
    )


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots; a filter on ``import_date`` reads only the folders it needs."""
    return spark.read.schema(SNAPSHOT).parquet(path).select(SNAPSHOT.names)
