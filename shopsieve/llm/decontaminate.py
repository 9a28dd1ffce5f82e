"""Benchmark decontamination (1): pigeonhole edit matching.

Texts are compared lower-cased, with every run of other characters than letters and digits as one
space. An item of m characters may differ from a stretch of a document by ``budget = RATE * m``
edits. Cut into budget + 1 pieces, at least one piece then stands in that stretch unchanged. So an
Aho-Corasick search finds all exact piece hits, each gives a window around the place where the item
would lie, windows of an item that overlap are joined, and Myers' bit-parallel algorithm finds the
least distance of the item to any stretch of the window.

The items are the queries: they are taken in blocks of at most ``BLOCK_CHARS`` characters, so what a
task holds is bounded however large the benchmark, and every block meets all documents.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsieve.llm.common import runs, ship_code

RATE = 0.07
#: Shorter items (as compared) are found word for word only, from one word bound to another.
MIN_CHARS = 40
#: Items of fewer words are reported, but do not make a filter reject a document: they stand in any text.
MIN_WORDS = 5
BLOCK_CHARS = 4_000_000
OTHER = re.compile(r"[\W_]+")


def compared(text: str) -> str:
    """The text as it is compared, with a space at either end."""
    return f" {OTHER.sub(' ', text.lower()).strip()} "


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item in budget + 1 pieces of nearly equal length, with their offsets."""
    ends = [len(item) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def distance_within(item: str, window: str) -> int:
    """Least edit distance of ``item`` to any stretch of ``window`` (Myers 1999, on integers of any length)."""
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << len(item) - 1
    plus, minus, score = full, 0, len(item)
    least = score
    for c in window:
        equal = where.get(c, 0)
        vertical = equal | minus
        horizontal = ((equal & plus) + plus ^ plus) | equal
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < least:
                least = score
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
    return least


@dataclass
class Items:
    """A block of items: (item_id, text as compared, budget)."""

    rows: list[tuple[int | None, str, int]]

    def automaton(self):
        import ahocorasick

        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, item, budget) in enumerate(self.rows):
            for offset, piece in pieces(item, budget):
                places[piece].append((k, offset))
        built = ahocorasick.Automaton()
        for piece, at in places.items():
            built.add_word(piece, (len(piece), at))
        if len(built):
            built.make_automaton()
        return built

    def find(self, automaton, text: str) -> dict[int, int]:
        """Place of each item that the text holds, and its least distance."""
        if not len(automaton):
            return {}
        text = compared(text)
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (size, at) in automaton.iter(text):
            for k, offset in at:
                starts[k].add(end + 1 - size - offset)
        found = {}
        for k, diagonals in starts.items():
            _, item, budget = self.rows[k]
            least = 0 if item in text else budget + 1
            windows: list[list[int]] = []
            for start in sorted(diagonals) if least else ():
                low, high = max(0, start - budget), start + len(item) + budget
                if windows and low <= windows[-1][1]:
                    windows[-1][1] = high
                else:
                    windows.append([low, high])
            for low, high in windows:
                least = min(least, distance_within(item, text[low:high]))
                if not least:
                    break
            if least <= budget:
                found[k] = least
        return found


def blocks(items: DataFrame, rate: float = RATE, min_words: int = 1) -> Iterator[Items]:
    """The items of ``min_words`` words or more, each distinct one once, in bounded blocks."""
    distinct = items.filter("text is not null").select("item_id", "text").distinct()
    total = distinct.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n_blocks = -(-total // BLOCK_CHARS)
    for block in range(n_blocks):
        rows = []
        for item_id, text in distinct.filter(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == block).orderBy("item_id", "text").collect():
            item = compared(text)
            n = len(item) - 2
            if n > 0 and len(item.split()) >= min_words:
                rows.append((item_id, item, int(rate * n) if n >= MIN_CHARS else 0))
        if rows:
            yield Items(rows)


def contaminations(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance, budget for each item that a row of ``docs`` holds within its budget.

    Null or empty texts hold nothing, and items without a letter or digit are in no text. Null and repeated ids stay rows of their own; an item given
    twice with the same id and text counts once; other columns are ignored.
    """
    ship_code(docs.sparkSession)
    schema = "doc_id long, item_id long, distance int, budget int"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    out = rows.sparkSession.createDataFrame([], schema)
    for block in blocks(items, rate):

        def search(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            automaton = block.automaton()
            for batch, texts in runs(batches, 1):
                found = []
                for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                    found += [(doc_id, block.rows[k][0], d, block.rows[k][2]) for k, d in block.find(automaton, text).items()]
                columns = list(zip(*found, strict=True)) or [()] * 4
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "distance", "budget"])

        out = out.unionAll(rows.mapInArrow(search, schema))
    return out


def without_contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` that hold no item of ``MIN_WORDS`` words or more, with all their columns; each is judged
    where it is."""
    ship_code(docs.sparkSession)
    text = docs.columns.index("text")
    for block in blocks(items, rate, MIN_WORDS):

        def judge(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            automaton = block.automaton()
            for batch, texts in runs(batches, text):
                yield batch.filter(pa.array([not block.find(automaton, t) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(judge, docs.schema)
    return docs
