"""Token counts (10): pieces counted once per distinct pre-token, joined to per-document frequencies.

The join is done block by block inside tasks: a block's documents become (document, pre-token,
frequency) triples, which meet the table of piece counts that the worker keeps from block to block.
So nothing is shuffled and no ids are made; the work is a scan of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsieve.llm.common import runs, ship_code, utf8
from shopsieve.llm.pretokens import encoder


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty (0 tokens); null and repeated ids stay rows of their own; other
    columns of any name are ignored; an empty table gives an empty result.
    """
    ship_code(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, 1):
            sizes = [len(utf8(t)) for t in texts]
            tokens = encoder(vocabulary).count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    counted = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
