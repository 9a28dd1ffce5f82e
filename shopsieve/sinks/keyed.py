"""A table with a key: each key has one row, and a load rewrites only the buckets it touches.

A bucket is a range of keys of a fixed width, so that loads of new ids leave old files alone, or a hash of the key. A
load is merged with the buckets it touches, written as a folder of its own, and committed; all other
buckets keep their files. A load that carries a name is taken once, however often it is run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.schema import assert_schema
from shopsieve.sinks.commits import CommitLog, Storage
from shopsieve.sinks.scratch import hand_off

BUCKET = "__bucket"
NEW = "__new"
#: Ids in a bucket of a range of keys: some hundred megabytes of narrow rows.
WIDTH = 10_000_000


class OtherSettings(ValueError):
    """The table at this place was made with other settings."""


class KeyedTable:
    """``width`` cuts whole-number keys into ranges; without it the key's hash falls into one of ``buckets``.

    ``merged`` gives for the rows of one key, old and new (column ``__new``), each other column's value. The
    default takes the new row. ``settings`` are compared with those the table was made with.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        *,
        width: int | None = None,
        buckets: int = 256,
        merged: Callable[[str], Column] | None = None,
        null_key: bool = False,
        settings: str = "",
    ) -> None:
        self.spark, self.root, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.width, self.buckets, self.merged, self.null_key = width, buckets, merged, null_key
        self.settings = f"{schema.simpleString()} key={key} width={width} buckets={None if width else buckets} {settings}"
        self.storage = Storage(spark, path)
        self.log = CommitLog(self.storage)

    def _bucket(self) -> Column:
        key = F.col(self.key)
        if self.width is None:
            number = F.pmod(F.hash(key), F.lit(self.buckets)).cast("long")
        else:
            # whole numbers throughout, rounded down also below zero
            number = F.coalesce(F.expr(f"(`{self.key}` - pmod(`{self.key}`, {self.width}L)) DIV {self.width}L"), F.lit(0).cast("long"))
        if self.null_key:
            return number
        return F.when(key.isNull(), F.raise_error(F.lit(f"{self.key} is the key and must not be missing")).cast("long")).otherwise(number)

    def _state(self) -> tuple[int, dict]:
        version, state = self.log.newest()
        state = state or {"buckets": {}, "loads": [], "settings": self.settings}
        if state["settings"] != self.settings:
            raise OtherSettings(f"made with {state['settings']}, not {self.settings}")
        return version, state

    def _paths(self, state: dict, touched: Sequence[int] | None = None) -> list[str]:
        wanted = state["buckets"] if touched is None else [str(b) for b in touched if str(b) in state["buckets"]]
        return sorted(f"{self.root}/{state['buckets'][b]}/{BUCKET}={b}" for b in wanted)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths).select(self.schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The whole table as it is, or as a version left it."""
        return self._read(self._paths(self._state()[1] if version is None else self.log.at(version)))

    def read_keys(self, low: int, high: int) -> DataFrame:
        """The rows with keys from ``low`` to ``high``: only their buckets are opened, if buckets are ranges."""
        state, paths = self._state()[1], None
        if self.width is not None:
            first, last = low // self.width, high // self.width
            paths = self._paths(state, [b for b in map(int, state["buckets"]) if first <= b <= last])
        return self._read(self._paths(state) if paths is None else paths).filter(F.col(self.key).between(low, high))

    def _one_row(self, rows: DataFrame) -> DataFrame:
        """Rows of old and new keys lie by bucket already: no further shuffle."""
        others = [name for name in self.schema.names if name != self.key]
        if self.merged is not None:
            return rows.groupBy(BUCKET, self.key).agg(*(self.merged(name).alias(name) for name in others))
        newest = F.max(F.struct(NEW, *others))
        repeated = F.raise_error(F.concat(F.lit("a load holds this key twice: "), F.col(self.key).cast("string")))
        kept = rows.groupBy(BUCKET, self.key).agg(newest.alias("kept"), F.count_if(NEW).alias("given"))
        sound = F.when(F.col("given") > 1, repeated.cast(self.schema[self.key].dataType)).otherwise(F.col(self.key))
        return kept.select(BUCKET, sound.alias(self.key), *(F.col(f"kept.{name}").alias(name) for name in others))

    def merge(self, rows: DataFrame, load: str | None = None) -> int:
        """Merge a load into the table, whole or not at all, and return the table's version.

        By default a key's new row replaces its old one, and a load that holds a key twice, or a missing one, is
        refused. A load whose name was taken before changes nothing. If another writer commits meanwhile, the
        merge is done again only if it touched the same buckets.
        """
        version, base = self._state()
        if load is not None and load in base["loads"]:
            return version
        batch = hand_off(assert_schema(rows, self.schema).withColumn(BUCKET, self._bucket()), "load")
        # at most one number for each bucket
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
        folder = None
        while True:
            if touched and folder is None:
                folder = f"data/{uuid4().hex}"
                old = self._read(self._paths(base, touched)).withColumn(BUCKET, self._bucket()).withColumn(NEW, F.lit(False))
                both = old.unionByName(batch.withColumn(NEW, F.lit(True))).repartition(BUCKET)
                self._one_row(both).sortWithinPartitions(BUCKET, self.key).write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
            mapped = {str(b): folder for b in touched}
            loads = base["loads"] + ([load] if load is not None else [])
            if self.log.try_commit(version + 1, base | {"buckets": base["buckets"] | mapped, "loads": loads}):
                return version + 1
            before = base
            version, base = self._state()
            if load is not None and load in base["loads"]:
                return version
            if any(before["buckets"].get(b) != base["buckets"].get(b) for b in mapped):
                folder = None
