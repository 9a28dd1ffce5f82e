"""Folders for intermediate tables, shared by all machines of a cluster."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder the session names; a temporary one only if all tasks run on this machine."""
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="shopsieve-")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid4().hex}"


def hand_off(df: DataFrame, label: str, path: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table and read it back.

    The result has a short lineage, survives lost executors, can be read any number of
    times, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, label)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
