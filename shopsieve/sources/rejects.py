"""CSV lines that do not fit: kept with their file and text instead of turning into NULLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.schema import CORRUPT, SALES_RAW
from shopsieve.sinks.scratch import hand_off

ACCEPTED, RAGGED, UNREADABLE = "accepted", "ragged", "unreadable"
_REASON, _FILE, _FIELDS = "__reason", "__file", "__fields"


def split_csv(
    spark: SparkSession, path: str, to: str | None = None, schema: T.StructType = SALES_RAW, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``: rows of ``schema``, and ``file, line, reason, columns``.

    A line is rejected as ragged if it has more or fewer fields than the schema, else as unreadable if a field
    is there but is no value of its column's type; ``columns`` names those. The files are read once: rows and
    rejects are written side by side (below ``to`` or in the shared scratch folder) and read from there. Empty
    lines are no rows, and a quoted field may not hold a line break.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(whole)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias(_FILE))
    )
    # only rejected lines are parsed again, as text: those that then fit are unreadable, not ragged
    as_text = ", ".join(f"`{f.name}` STRING" for f in schema) + f", `{CORRUPT}` STRING"
    fields = F.from_csv(F.col(CORRUPT), as_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    judged = lines.withColumn(_FIELDS, F.when(F.col(CORRUPT).isNotNull(), fields))
    reason = F.when(F.col(CORRUPT).isNull(), ACCEPTED).when(F.col(f"{_FIELDS}.{CORRUPT}").isNotNull(), RAGGED).otherwise(UNREADABLE)
    unread = F.array_compact(
        F.array(*(F.when(F.col(f"{_FIELDS}.`{f.name}`").isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in schema))
    )
    written = hand_off(
        judged.withColumn("columns", F.when(reason == UNREADABLE, unread)).withColumn(_REASON, reason).drop(_FIELDS),
        "csv-split",
        to,
        (_REASON,),
    )
    accepted = written.filter(F.col(_REASON) == ACCEPTED).select(*schema.names)
    rejected = written.filter(F.col(_REASON) != ACCEPTED).select(
        F.col(_FILE).alias("file"), F.col(CORRUPT).alias("line"), F.col(_REASON).alias("reason"), "columns"
    )
    return accepted, rejected
