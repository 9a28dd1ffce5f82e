"""The snapshot table with atomic imports, older versions, and a map of where its regions lie.

Each import writes its rows, in the order of region and product, into a folder of its own; beside them a
small table says for each file the least and greatest region and product in it. A commit then makes the import part
of the table, in place of an earlier one of the same date. Readers follow the newest commit, or an older one,
and a reader that wants few regions or products opens only the files that may hold them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsieve.schema import SNAPSHOT
from shopsieve.sinks.commits import CommitLog, Storage
from shopsieve.sinks.snapshot import ORDER, snapshot_rows

ZONES = (
    "folder string, file string, n_rows long, least_region string, greatest_region string, "
    "least_product int, greatest_product int, no_product long"
)


class SnapshotLog:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.root = spark, path.rstrip("/")
        self.storage = Storage(spark, path)
        self.log = CommitLog(self.storage)

    def prepare(self, aggregated: DataFrame, import_ts: datetime, files: int | None = None) -> str:
        """Write the files of an import, which nobody sees yet, and return their folder.

        ``files`` says how many; by default Spark decides by their size.
        """
        folder = f"data/{import_ts:%Y%m%dT%H%M%S}-{uuid4().hex}"
        rows = snapshot_rows(aggregated, import_ts)
        ranged = rows.repartitionByRange(*ORDER) if files is None else rows.repartitionByRange(files, *ORDER)
        ranged.sortWithinPartitions(*ORDER).write.parquet(f"{self.root}/{folder}/rows")
        written = self.spark.read.schema(SNAPSHOT).parquet(f"{self.root}/{folder}/rows")
        zones = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.count("*").alias("n_rows"),
            F.min("region").alias("least_region"),
            F.max("region").alias("greatest_region"),
            F.min("product_id").alias("least_product"),
            F.max("product_id").alias("greatest_product"),
            F.count_if(F.col("product_id").isNull()).alias("no_product"),
        )
        zones.select(F.lit(folder).alias("folder"), "*").coalesce(1).write.parquet(f"{self.root}/{folder}/zones")
        return folder

    def publish(self, import_ts: datetime, folder: str) -> int:
        """Make a prepared import part of the table; imports of other dates keep what they have."""
        return self.log.commit(lambda state: state | {import_ts.isoformat(): folder})

    def add(self, aggregated: DataFrame, import_ts: datetime, files: int | None = None) -> int:
        """One import, whole or not at all; an import of the same date is replaced, also by one without rows.

        Returns the version of the table.
        """
        return self.publish(import_ts, self.prepare(aggregated, import_ts, files))

    def _folders(self, version: int | None, imports: Sequence[datetime] | None) -> list[str]:
        state = self.log.newest()[1] if version is None else self.log.at(version)
        wanted = state if imports is None else [ts.isoformat() for ts in imports if ts.isoformat() in state]
        return [state[ts] for ts in sorted(wanted)]

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], SNAPSHOT)
        return self.spark.read.schema(SNAPSHOT).parquet(*paths)

    def read(self, version: int | None = None, imports: Sequence[datetime] | None = None) -> DataFrame:
        """The table as it is, or as a version left it; ``imports`` names the dates to read."""
        return self._read([f"{self.root}/{folder}/rows" for folder in self._folders(version, imports)])

    def zones(self, version: int | None = None, imports: Sequence[datetime] | None = None) -> DataFrame:
        folders = self._folders(version, imports)
        if not folders:
            return self.spark.createDataFrame([], ZONES)
        return self.spark.read.schema(ZONES).parquet(*(f"{self.root}/{folder}/zones" for folder in folders))

    def read_region(
        self,
        regions: Sequence[str],
        products: tuple[int, int] | None = None,
        version: int | None = None,
        imports: Sequence[datetime] | None = None,
    ) -> DataFrame:
        """The rows of some regions, and of products from one number to another.

        Only files that may hold such rows are opened. Their names pass through the driver, as the names
        of all files do in a plain read.
        """
        near = F.lit(False)
        for region in regions:
            near |= F.lit(region).between(F.col("least_region"), F.col("greatest_region"))
        exact = F.col("region").isin(*regions)
        if products is not None:
            low, high = products
            near &= (F.col("least_product") <= high) & (F.col("greatest_product") >= low)
            exact &= F.col("product_id").between(low, high)
        found = self.zones(version, imports).filter(near).select("folder", "file").collect()
        return self._read(sorted(f"{self.root}/{r.folder}/rows/{r.file}" for r in found)).filter(exact)

    def vacuum(self, keep_versions: int = 10, untouched_seconds: float = 7 * 86_400) -> list[str]:
        """Remove older versions and the folders that no version needs any more, but none that was written
        lately: it may belong to an import that is not committed yet. Returns the folders removed."""
        versions = self.log.versions()
        if len(versions) > keep_versions:
            self.log.forget_before(versions[-keep_versions])
        needed = {folder for v in self.log.versions() for folder in self.log.at(v).values()}
        gone = [f"data/{n}" for n in self.storage.folders("data", untouched_seconds) if f"data/{n}" not in needed]
        for folder in gone:
            self.storage.delete(folder)
        return gone
