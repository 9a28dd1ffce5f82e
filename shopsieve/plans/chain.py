"""The whole chain as stages that are done once: a run that broke off goes on where it stopped.

Each stage has a fingerprint of what it starts from (the files of the raw table, or the stages before it) and of its
settings. Its table is written to a folder of its own, and then entered in a ledger; a stage that the
ledger holds is read instead of run. A change of the input or of a setting changes the fingerprints from there
on, so that only what depends on it runs again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsieve.functions.casts import lost_values, to_schema
from shopsieve.operators.analytics import aggregate, line_amount
from shopsieve.operators.clean import CLEAN, QUARANTINE, STATUS, resolve, with_status
from shopsieve.operators.incremental import rules_text
from shopsieve.operators.quality import BROKEN, N_ROWS, id_samples, report, violations
from shopsieve.operators.rules import RuleSet
from shopsieve.schema import AGGREGATED, SALES_TYPED, assert_schema
from shopsieve.sinks.commits import Storage
from shopsieve.sinks.snapshot_log import SnapshotLog


def files_fingerprint(df: DataFrame, label: str = "") -> str:
    """Digest of the names, sizes and times of the files that ``df`` reads, and of ``label``, which should
    say how the frame is made of them. Each folder is listed once."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)) for name in sorted(df.inputFiles())]
    folders: dict[str, dict[str, tuple]] = {}
    digest = hashlib.sha256(label.encode())
    for path in paths:
        parent = path.getParent()
        if parent.toString() not in folders:
            found = parent.getFileSystem(conf).listStatus(parent)
            folders[parent.toString()] = {s.getPath().getName(): (s.getLen(), s.getModificationTime()) for s in found}
        digest.update(f"\n{path} {folders[parent.toString()].get(path.getName())}".encode())
    return digest.hexdigest()


class Chain:
    """Stages below ``folder``. ``before`` is called with the name of each stage that really runs."""

    LEDGER = "_ledger"

    def __init__(self, spark: SparkSession, folder: str, source: str, before: Callable[[str], None] | None = None) -> None:
        self.spark, self.folder, self.source, self.before = spark, folder.rstrip("/"), source, before
        self.storage = Storage(spark, folder)
        self.fingerprints: dict[str, str] = {}

    def stage(self, name: str, build: Callable[[str], object], settings: str = "", after: Sequence[str] = ()) -> str:
        """The folder of the stage's result: ``build`` writes it, unless it is in the ledger.

        ``after`` names the stages it reads; one without any starts from the source. Of two runs at once
        the first to finish is entered, and both go on with its result.
        """
        begins = [self.fingerprints[other] for other in after] or [self.source]
        fingerprint = hashlib.sha256(json.dumps([name, settings, begins]).encode()).hexdigest()
        self.fingerprints[name] = fingerprint
        entry = f"{name}-{fingerprint[:20]}.json"
        if entry not in self.storage.names(self.LEDGER):
            if self.before is not None:
                self.before(name)
            place = f"tables/{name}-{uuid4().hex}"
            build(f"{self.folder}/{place}")
            said = {"stage": name, "fingerprint": fingerprint, "settings": settings, "after": list(after), "place": place}
            self.storage.create_once(f"{self.LEDGER}/{entry}", json.dumps(said))
        return f"{self.folder}/{json.loads(self.storage.read(f'{self.LEDGER}/{entry}'))['place']}"

    def table(self, name: str, frame: Callable[[], DataFrame], settings: str = "", after: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
        """A stage whose result is a Parquet table."""
        path = self.stage(name, lambda to: frame().write.partitionBy(*by).parquet(to), settings, after)
        return self.spark.read.parquet(path)


@dataclass(frozen=True)
class ChainConfig:
    """``folder`` holds the ledger, the stages' tables and the snapshot table."""

    rules: RuleSet
    folder: str
    import_ts: datetime
    duplicates: str = "quarantine"
    times_quantity: bool = False
    samples: int = 3


def run_chain(raw: DataFrame, config: ChainConfig, label: str = "", before: Callable[[str], None] | None = None) -> dict[str, DataFrame]:
    """Check, split, load, aggregate and add a snapshot; the tables by name.

    ``label`` says how ``raw`` is made of its files; it is part of the fingerprint. Beside the
    tables of ``flow.run``, ``lost`` counts the values of clean rows that the load turned into NULL.
    """
    rules, policy = config.rules, config.duplicates
    chain = Chain(raw.sparkSession, config.folder, files_fingerprint(raw, label), before)
    resolved = chain.table("split", lambda: resolve(raw, rules, policy), f"{policy}; {rules_text(rules)}", by=(STATUS,))
    layout = [*raw.columns, N_ROWS, BROKEN, STATUS]
    resolved = resolved.select(*layout)
    per_id = resolved.select(rules.key, N_ROWS, BROKEN)
    tables = {
        "report": chain.table("report", lambda: report(per_id, rules, policy), policy, ["split"]),
        "duplicates": chain.table(
            "duplicates", lambda: per_id.filter(F.col(N_ROWS) > 1).select(rules.key, F.col(N_ROWS).alias("count")), after=["split"]
        ),
        "violations": chain.table("violations", lambda: violations(per_id, rules), after=["split"]),
        "samples": chain.table("samples", lambda: id_samples(per_id, rules, config.samples), str(config.samples), ["split"]),
        "clean": with_status(resolved, CLEAN),
        "quarantine": with_status(resolved, QUARANTINE),
    }
    clean = tables["clean"]
    tables["lost"] = chain.table("lost", lambda: lost_values(clean), after=["split"])
    sales = tables["sales"] = chain.table("load", lambda: assert_schema(to_schema(clean), SALES_TYPED), after=["split"])
    amount = line_amount() if config.times_quantity else "price"
    aggregated = tables["aggregated"] = chain.table(
        "aggregate", lambda: assert_schema(aggregate(sales, amount=amount), AGGREGATED), str(config.times_quantity), ["load"]
    )
    snapshots = SnapshotLog(raw.sparkSession, f"{config.folder}/snapshots")
    # entered in the ledger after its commit: a run that broke off between them commits the same import again
    chain.stage("snapshot", lambda _: snapshots.add(aggregated, config.import_ts), config.import_ts.isoformat(), ["aggregate"])
    tables["snapshots"] = snapshots.read()
    return tables
