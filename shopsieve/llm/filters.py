"""Tables of bits of a fixed size that say which keys are wanted: they may let others pass, but lose none.

They spare a shuffle of all texts when few are needed: the texts that pass are then joined exactly.
Their size is proven (2^bits), so they can be sent to every task; with ever more keys they only let
more pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsieve.llm.common import ship_code

BITS = 26


class BitFilter:
    def __init__(self, words: np.ndarray, bits: int) -> None:
        self.words, self.bits = words, bits

    @staticmethod
    def key(major: np.ndarray, minor: np.ndarray | int, bits: int) -> np.ndarray:
        minor = np.broadcast_to(np.asarray(minor, np.int64), np.shape(major))
        h = (np.ascontiguousarray(major, np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.ascontiguousarray(minor).view(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return h >> np.uint64(64 - bits)

    def has(self, major: np.ndarray, minor: np.ndarray | int = 0) -> np.ndarray:
        key = self.key(major, minor, self.bits)
        return (self.words[(key >> np.uint64(6)).astype(np.int64)] >> (key & np.uint64(63)) & np.uint64(1)).astype(bool)

    @classmethod
    def of(cls, keys: DataFrame, bits: int = BITS) -> BitFilter:
        """From one or two columns of integers: combined in each task, then by word of 64 bits."""
        ship_code(keys.sparkSession)

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = np.zeros(1 << bits - 6, np.uint64)
            for batch in batches:
                key = cls.key(*(c.to_numpy(zero_copy_only=False) for c in batch.columns), *([0] * (batch.num_columns == 1)), bits)
                np.bitwise_or.at(table, (key >> np.uint64(6)).astype(np.int64), np.uint64(1) << (key & np.uint64(63)))
            found = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(table[found].view(np.int64))], ["word", "bits"])

        got = keys.mapInArrow(collect, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        table = np.zeros(1 << bits - 6, np.uint64)
        table[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
        return cls(table, bits)


def may_be_in(keys: DataFrame, column: Column, bits: int = BITS) -> Column:
    """False if the value of ``column`` (long, not null) is surely not in ``keys``."""
    table = keys.sparkSession.sparkContext.broadcast(BitFilter.of(keys, bits))

    def test(batches):
        for values in batches:
            yield pd.Series(table.value.has(values.to_numpy(np.int64)))

    # annotations are texts in this module, and pandas_udf needs types
    test.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf("boolean")(test)(column)
