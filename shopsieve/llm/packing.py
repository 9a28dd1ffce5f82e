"""Packing (7): harmonic packing of documents into sequences of fixed capacity.

Class k holds pieces of length in (C/(k+1), C/k], and a sequence of class k takes exactly k of them.
A document is cut into full sequences and a rest. The rest is placed uncut if its class wastes
little; else the largest reciprocal part floor(C/k) that fits is cut off and the remainder goes on,
like the terms of an Egyptian fraction. Each task fills the classes' open sequences by itself and
keeps at most one open per class, so its memory is bounded and nothing is shuffled. At the end of a
task the pieces in unfilled sequences are laid end to end, cut where a sequence is full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsieve.llm.common import runs, ship_code
from shopsieve.llm.pretokens import encoder

CAPACITY = 2048
#: Distinct pre-tokens a worker remembers: fewer than in other operators, as open sequences stand beside them.
REMEMBERED = 300_000
#: A rest is placed uncut if its class's sequence, full of pieces as long, has at most this share empty.
WASTE = 0.02
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Room for the sequences of one task in a sequence id.
TASK_BITS = 36


class Packer:
    """Places pieces for one task; ``rows`` are placed pieces."""

    def __init__(self, task: int, capacity: int) -> None:
        self.next = task << TASK_BITS
        self.capacity = capacity
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.rows.append((doc_id, start, len(ids), crc, total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, start, capacity = len(ids), 0, self.capacity
        while start < total:
            rest = total - start
            k = max(1, capacity // rest)
            if k > 1 or rest < capacity:
                size = rest if capacity - k * rest <= WASTE * capacity else capacity // (k + 1)
            else:
                size = capacity
            k = capacity // size
            held = self.open.setdefault(k, [])
            # a copy: a piece that waits must not keep its whole document's ids
            held.append((doc_id, start, ids[start : start + size].copy(), total))
            if len(held) == k:
                self._sequence(self.open.pop(k))
            start += size

    def finish(self) -> None:
        """Lay what stands in unfilled sequences end to end, the longest pieces first."""
        left = sorted((p for held in self.open.values() for p in held), key=lambda p: -len(p[2]))
        self.open, row, room = {}, [], self.capacity
        for doc_id, start, ids, total in left:
            while len(ids):
                row.append((doc_id, start, ids[:room], total))
                taken = len(row[-1][2])
                start, ids, room = start + taken, ids[taken:], room - taken
                if not room:
                    self._sequence(row)
                    row, room = [], self.capacity
        if row:
            self._sequence(row)

    def take(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        columns = list(zip(*self.rows, strict=True)) or [()] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece, see ``SCHEMA``; each token of each row of ``docs`` lies in exactly one piece.

    A null or empty text is a document of the end id alone. Null and repeated ids are documents of
    their own; other columns are ignored. Sequences are told apart by an id that holds the task's number.
    """
    ship_code(docs.sparkSession)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), capacity)
        for batch, texts in runs(batches, 1):
            for key, ids in zip(batch.column(0).to_pylist(), encoder(vocabulary, REMEMBERED).encode(texts), strict=True):
                packer.add(key, np.append(ids, np.int32(end_id)))
            yield packer.take()
        packer.finish()
        yield packer.take()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(place, SCHEMA)
