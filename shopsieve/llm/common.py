"""What the operators share: reading the tables, shipping this package to workers, Arrow helpers."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in runs of about this many characters, whatever the size of an Arrow batch.
RUN_CHARS = 2_000_000
#: And of no more rows than this.
RUN_ROWS = 1 << 15
#: Runs after which a worker gives freed memory back, within a task too.
RUNS_KEPT = 8
#: Rows in a batch that Spark sends to Python, unless the session names a number of its own: Spark's default of 10,000
#: long texts would stand several times in the memory of an executor and its workers.
BATCH_ROWS = 1500
_BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
_ARCHIVE = "shopsieve_code"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, as ``--py-files`` would, and bound their batches."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH[0]) == _BATCH[1]:
        spark.conf.set(_BATCH[0], BATCH_ROWS)
    if any(_ARCHIVE in name for name in context._python_includes):
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="shopsieve-code-")
    shutil.copytree(package, f"{folder}/src/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/{_ARCHIVE}", "zip", f"{folder}/src"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def release() -> None:
    """Give what this process has freed back to the system.

    The C library and Arrow keep it for later use. Python workers live on from stage to stage, so what they keep
    would add up to the most that any stage needed, in each of them.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def runs(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches of about ``RUN_CHARS`` characters or ``RUN_ROWS`` rows, with their texts (null: empty)."""
    done = 0
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        begin = size = 0
        for at, text in enumerate(texts):
            size += len(text)
            if size >= RUN_CHARS or at + 1 - begin == RUN_ROWS or at + 1 == len(texts):
                yield batch.slice(begin, at + 1 - begin), texts[begin : at + 1]
                begin, size, done = at + 1, 0, done + 1
                if done % RUNS_KEPT == 0:
                    release()
    release()


def utf8(text: str) -> bytes:
    """Unpaired surrogates cannot come out of a Parquet string; a stray one becomes a question mark."""
    return text.encode("utf-8", "replace")


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8: bytes.split() splits at exactly these six characters."""
    return utf8(text).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes (SipHash with a fixed key), the same on every machine."""
    return pd.util.hash_array(np.fromiter(words, object, len(words)), categorize=False) if words else np.zeros(0, np.uint64)


def rename_apart(df: DataFrame, *names: str) -> str:
    """A column name that the frame does not have, so that extra columns cannot clash with ours."""
    taken = {c.lower() for c in df.columns}
    name = "_".join(names)
    while name.lower() in taken:
        name = f"_{name}"
    return name
