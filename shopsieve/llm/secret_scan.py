"""Secret scans (2): an incremental ledger of content-addressed blobs, in DataFrame functions only.

Every historical version of a path is addressed by the SHA-256 of its text. The ledger is a folder
of Parquet tables: ``scanned`` (blob, rules) says which blobs have been scanned under which version
of the rules, ``findings`` holds what was found in them. A scan takes the distinct blobs, leaves out
those that the ledger has under the present rules, scans the rest, appends to the ledger and joins
the findings back to all paths and versions that hold the blob. So a text that a thousand paths
share is scanned once, and a second run over the same history scans nothing.

Rules are regular expressions whose matches are leftmost and do not overlap, each with the group
whose length counts and the least length. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsieve.llm.common import text_or_empty


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def _any_case(word: str) -> str:
    """ASCII letters in either case, without the look-alikes that a flag would add."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The three base rules.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = f"({'|'.join(map(_any_case, KEYWORDS))})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE = (
    Rule("assign", ASSIGN, 2, 6),
    # runs of at least these lengths: the same spans as all runs with the shorter ones dropped
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Kinds that the base does not have.
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
)
RULES = (*BASE, *MORE)
FINDINGS = "kind string, order int, start int, end int"


def matches(text: Column, rule: Rule, order: int) -> Column:
    """Array of (kind, order, start, end) of the matches of one rule.

    Offsets come from the texts of the matches and of the stretches between them, laid end to end.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["between"])
        end = start + F.length(pair["found"])
        span = F.struct(F.lit(rule.kind).alias("kind"), F.lit(order).alias("order"), start.alias("start"), end.alias("end"))
        keep = F.length(pair["group"]) >= rule.least
        spans = F.when(keep, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    pairs = F.arrays_zip(found.alias("found"), groups.alias("group"), F.slice(between, 1, F.size(found)).alias("between"))
    empty = F.array().cast(f"array<struct<{FINDINGS.replace(' ', ':').replace(',:', ',')}>>")
    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)["spans"]
    return F.when(F.rlike(text, F.lit(rule.pattern)), spans).otherwise(empty)


def scan_text(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All matches, by start, then in the order of the rules."""
    every = F.concat(*(matches(text, rule, order) for order, rule in enumerate(rules)))
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def version_of(rules: tuple[Rule, ...]) -> str:
    """The rules by their content, so that blobs are scanned anew with other rules."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def blob_of(text: str = "text") -> Column:
    return F.sha2(text_or_empty(text), 256)


def _ledger(spark: SparkSession, folder: str, name: str, like: DataFrame) -> DataFrame:
    """What the ledger has; it is told by its files' absence whether it is new."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(like.schema).parquet(f"{folder}/{name}")
    return like.limit(0)


def update(history: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, version: str | None = None) -> None:
    """Scan the blobs of ``history`` (column text) that the ledger in ``folder`` lacks, and append them.

    Findings are written before the blobs are marked as scanned. A run that dies between the two is
    repeated by the next one; readers take each blob's findings once.
    """
    spark, version = history.sparkSession, version or version_of(rules)
    blobs = history.select(text_or_empty().alias("text")).withColumn("blob", F.sha2("text", 256))
    mark = F.lit(version).alias("rules")
    seen = _ledger(spark, folder, "scanned", blobs.select("blob", mark)).filter(F.col("rules") == version).select("blob")
    # combined in each task first, so that copies of a text are shuffled once a task at most
    fresh = blobs.groupBy("blob").agg(F.first("text").alias("text")).join(seen, "blob", "left_anti")
    scanned = fresh.select("blob", mark, scan_text(F.col("text"), rules).alias("spans"))
    scanned.write.mode("append").parquet(f"{folder}/findings")
    written = spark.read.parquet(f"{folder}/findings").filter(F.col("rules") == version).select("blob", "rules")
    written.join(seen, "blob", "left_anti").distinct().write.mode("append").parquet(f"{folder}/scanned")


def findings(spark: SparkSession, folder: str, rules: tuple[Rule, ...] = RULES, version: str | None = None) -> DataFrame:
    """blob and its spans, for blobs with any."""
    version = version or version_of(rules)
    every = spark.read.parquet(f"{folder}/findings").filter((F.col("rules") == version) & (F.size("spans") > 0))
    return every.groupBy("blob").agg(F.first("spans").alias("spans"))


def scan(history: DataFrame, folder: str, keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES, version: str | None = None) -> DataFrame:
    """Bring the ledger up to date and return ``keep``, blob and spans of every row of ``history``.

    A null text counts as empty; null and repeated paths stay rows of their own; other columns are
    ignored; an empty history gives an empty result and an empty ledger.
    """
    update(history, folder, rules, version)
    paths = history.select(*(F.col(c).alias(f"k_{c}") for c in keep), blob_of().alias("blob"))
    # few blobs have findings; a blob with many paths is split by adaptive execution
    joined = paths.join(findings(history.sparkSession, folder, rules, version), "blob", "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return joined.select(*(F.col(f"k_{c}").alias(c) for c in keep), "blob", F.coalesce("spans", none).alias("spans"))


def digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """doc_id, the number of spans of each base kind, the hash of the base spans, all spans as text."""
    kinds = [rule.kind for rule in base]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    based = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return scanned.select(
        F.col("doc_id").cast("long").alias("doc_id"), *map(of, kinds), F.sha2(joined(based), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
