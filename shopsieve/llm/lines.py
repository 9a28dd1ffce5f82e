"""Line dedup (5): an exact set-similarity join of lines; later matches go.

A line is the set of its words (A-Z lower-cased). A line is removed if an earlier line, in the order
of doc_id (null first) and place in the text, has a Jaccard similarity of ``THRESHOLD`` or more to it,
whether that one stays or not. Only lines of fewer than ``MIN_TOKENS`` distinct words, that is without words, are left alone.

The join, with n and m the sizes of two sets:

* Order. A set's words are ordered by rarity: by the counts of ``BUCKETS`` hash buckets over all lines,
  ties by bucket, then by hash. The table of ranks has a fixed size, so every task can have it.
* Prefix filter. Similar sets share one of their first n - ceil(t n) + 1 words. Only these are
  shuffled, in packed blocks by hash of the word.
* Length and positional filters; and the parity filter: of 64 parity bits of a set, no more differ
  between two sets than words do.
* Verification. What is left is verified on all words of the lines (64-bit hashes), in two rounds.
  First each line against its earliest and its closest candidate of each block; then, for lines not
  yet decided, against all their other candidates. Groups of more than ``SMALL`` lines that share a
  word are handed to the second round as lists of members, not of pairs.

Words are known by 64-bit hashes throughout.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsieve.llm.common import rename_apart, runs, ship_code, utf8, word_hashes
from shopsieve.llm.filters import BitFilter, may_be_in
from shopsieve.sinks.scratch import hand_off

THRESHOLD = 0.9
MIN_TOKENS = 1
BUCKETS = 1 << 20
#: Buckets that are summed together.
PART = 1 << 12
#: Postings in one block on average, which bounds what a task holds.
BLOCK = 250_000
#: Lines sharing a prefix word, up to which all their pairs are compared at once.
SMALL = 32
#: Pairs of a larger group that are compared at a time.
COMPARED = 1_000_000
#: The place that stands for a whole document in a filter.
WHOLE = -1
#: Rows without a doc_id get keys from here downwards, by hash of their text.
NULL_DOC = -(1 << 62)

_FIELDS = (("doc", np.int64), ("parity", np.uint64), ("token", np.uint32), ("line", np.int32), ("size", np.int32), ("pos", np.int32), ("mark", np.uint32))


def _ceil(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.round(x, 9)).astype(np.int64)


def _required(n: np.ndarray, m: np.ndarray, t: float) -> np.ndarray:
    """Common words that sets of n and m words must have."""
    return _ceil(t / (1 + t) * (n + m))


def line_words(text: str) -> list[set[bytes]]:
    """Distinct words of each line."""
    return [set(line.split()) for line in utf8(text).lower().split(b"\n")]


class LineSets:
    """Lines of a run of texts as sorted hash sets in flat arrays: one row per line of MIN_TOKENS words or more."""

    def __init__(self, docs: list[int], texts: list[str], wanted: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> None:
        doc, line, size, flat = array("q"), array("i"), array("i"), []
        for key, text in zip(docs, texts, strict=True):
            sets = line_words(text)
            places = [i for i, s in enumerate(sets) if len(s) >= MIN_TOKENS]
            if wanted is not None and places:
                at = np.array(places, np.int32)
                places = at[wanted(np.full(len(at), key, np.int64), at)].tolist()
            doc.extend([key] * len(places))
            line.extend(places)
            for i in places:
                size.append(len(sets[i]))
                flat.extend(sets[i])
        self.doc, self.line = np.frombuffer(doc, np.int64), np.frombuffer(line, np.int32)
        self.size = np.frombuffer(size, np.int32).astype(np.int64)
        self.hashes = word_hashes(flat)
        self.starts = np.cumsum(self.size) - self.size

    def sorted_by(self, rank: np.ndarray | None = None) -> np.ndarray:
        """Word hashes, line by line, in the order of their bucket's ``rank`` if given, then of the hash."""
        owner = np.repeat(np.arange(len(self.size), dtype=np.uint64), self.size)
        place = self.hashes % np.uint64(BUCKETS)
        place = rank[place.astype(np.int64)].astype(np.uint64) if rank is not None else np.zeros(len(place), np.uint64)
        # line, rank and the first bits of the hash in one number; where that leaves a tie, or lines are many, by all in turn
        key = owner << np.uint64(44) | place << np.uint64(24) | self.hashes >> np.uint64(40)
        order = np.argsort(key)
        ordered = key[order]
        if len(self.size) >= 1 << 20 or (ordered[1:] == ordered[:-1]).any():
            order = np.lexsort((self.hashes, place, owner))
        return self.hashes[order]


def count_buckets(docs: DataFrame) -> np.ndarray:
    """Words in each hash bucket over all lines, at most ``BUCKETS`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for _, texts in runs(batches, 0):
            hashes = word_hashes(list(chain.from_iterable(utf8(t).lower().split() for t in texts)))
            total += np.bincount((hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        parts = total.reshape(-1, PART)
        used = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([p.tobytes() for p in parts[used]], pa.binary())], ["part", "counts"])

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p, np.int64) for p in parts.column("counts").to_pylist())
        return pa.table([parts.column("part")[:1], pa.array([total.tobytes()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    counted = docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    out = np.zeros((BUCKETS // PART, PART), np.int64)
    for row in counted:
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return out.reshape(-1)


def _packed(columns: dict[str, np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(columns[name].astype(kind)).tobytes() for name, kind in _FIELDS)


def _unpacked(blobs: list[bytes], counts: list[int]) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {name: [] for name, _ in _FIELDS}
    for blob, n in zip(blobs, counts, strict=True):
        at = 0
        for name, kind in _FIELDS:
            parts[name].append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(p) for name, p in parts.items()}


def postings(docs: DataFrame, counts: np.ndarray, t: float) -> DataFrame:
    """Prefix words of all lines, packed by block of words: block, n, blob."""
    blocks = max(24, int(counts.sum() * (1 - t) / BLOCK) + 1)
    rank = np.empty(BUCKETS, np.uint32)
    rank[np.argsort(counts, kind="stable")] = np.arange(BUCKETS, dtype=np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(rank)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, 1):
            own = LineSets(batch.column(0).to_pylist(), texts)
            if not len(own.size):
                continue
            hashed = own.sorted_by(shared.value)
            parity = np.bitwise_xor.reduceat(np.uint64(1) << (hashed >> np.uint64(20) & np.uint64(63)), own.starts)
            mark = np.bitwise_xor.reduceat(hashed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32), own.starts)
            prefix = own.size - _ceil(t * own.size) + 1
            owner = np.repeat(np.arange(len(own.size)), prefix)
            pos = np.arange(len(owner)) - np.repeat(np.cumsum(prefix) - prefix, prefix)
            token = hashed[own.starts[owner] + pos]
            # of equal sets in this run the earliest is enough, but for the first word, where equal sets meet
            early = np.lexsort((own.line, own.doc))
            _, first = np.unique(np.column_stack([parity, mark, own.size.astype(np.uint64)])[early], axis=0, return_index=True)
            lone = np.zeros(len(own.size), bool)
            lone[early[first]] = True
            keep = (pos == 0) | lone[owner]
            owner, pos, token = owner[keep], pos[keep], token[keep]
            block = (token >> np.uint64(32)) % np.uint64(blocks)
            order = np.argsort(block, kind="stable")
            owner, pos, token, block = owner[order], pos[order], token[order], block[order].astype(np.int64)
            found, begins = np.unique(block, return_index=True)
            ends = np.append(begins[1:], len(block))
            blobs = []
            for a, b in zip(begins, ends, strict=True):
                o = owner[a:b]
                blobs.append(_packed({"doc": own.doc[o], "line": own.line[o], "size": own.size[o], "pos": pos[a:b], "token": token[a:b] & np.uint64(0xFFFFFFFF), "parity": parity[o], "mark": mark[o]}))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(ends - begins, pa.int32()), pa.array(blobs, pa.binary())], ["block", "n", "blob"])

    return docs.mapInArrow(emit, "block int, n int, blob binary")


def _passes(n, m, i, j, parity, other, t: float) -> np.ndarray:
    """Length, positional and parity filter."""
    required = _required(n, m, t)
    small, large = np.minimum(n, m), np.maximum(n, m)
    return (small >= _ceil(t * large)) & (1 + np.minimum(n - i - 1, m - j - 1) >= required) & (np.bitwise_count(parity ^ other) <= n + m - 2 * required)


_FOUND = "kind int, doc long, line int, other_doc long, other_line int, grp long, size int, pos int, parity long"
SAME, PAIR, REST, MEMBER = 0, 1, 2, 3


def _ordered(*keys: np.ndarray) -> np.ndarray:
    """Places in the order of the keys, the first one first; the others are only looked at where it leaves ties."""
    order = np.argsort(keys[0])
    equal = np.diff(keys[0][order]) == 0
    tied = np.flatnonzero(np.append(False, equal) | np.append(equal, False)) if len(order) else order
    some = order[tied]
    order[tied] = some[np.lexsort([k[some] for k in reversed(keys)])]
    return order


def _block_candidates(blobs: list[bytes], counts: list[int], t: float) -> pd.DataFrame:
    """Of one block: copies to remove, pairs for the first round, pairs and members for the second."""
    c = _unpacked(blobs, counts)
    order = _ordered(c["token"].astype(np.uint64) << np.uint64(32) | c["mark"], c["size"], c["parity"], c["doc"], c["line"])
    c = {k: v[order] for k, v in c.items()}
    same = np.ones(len(order), bool)
    same[:1] = False
    for name in ("token", "size", "parity", "mark"):
        same[1:] &= c[name][1:] == c[name][:-1]
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    at = same & (c["pos"] == 0) & ((c["doc"] != c["doc"][head]) | (c["line"] != c["line"][head]))
    out: list[dict] = [{"kind": SAME, "doc": c["doc"][at], "line": c["line"][at]}]
    c = {k: v[~same] for k, v in c.items()}
    order = _ordered(c["token"], c["doc"], c["line"])
    c = {k: v[order] for k, v in c.items()}
    begins = np.flatnonzero(np.append(True, c["token"][1:] != c["token"][:-1])) if len(order) else np.zeros(0, int)
    sizes = np.diff(np.append(begins, len(order)))
    group = np.repeat(np.arange(len(begins)), sizes)

    def compared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return _passes(c["size"][x].astype(np.int64), c["size"][y].astype(np.int64), c["pos"][x], c["pos"][y], c["parity"][x], c["parity"][y], t)

    def pairs(kind: int, x: np.ndarray, y: np.ndarray) -> None:
        if len(x):
            out.append({"kind": kind, "doc": c["doc"][x], "line": c["line"][x], "other_doc": c["doc"][y], "other_line": c["line"][y]})

    def chosen(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of pairs sorted by x, then y: the earliest and the closest of each x."""
        first = np.append(True, x[1:] != x[:-1])
        apart = np.bitwise_count(c["parity"][x] ^ c["parity"][y])
        by = np.lexsort((np.arange(len(x)), apart, x))
        first[by[np.append(True, x[by][1:] != x[by][:-1])]] = True
        return first

    few = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    if len(few):
        found = []
        places = np.flatnonzero(np.isin(group, few))
        end = begins + sizes
        for step in range(1, int(sizes[few].max())):
            places = places[places + step < end[group[places]]]
            if not len(places):
                break
            ok = compared(places + step, places)
            found.append((places[ok] + step, places[ok]))
        x, y = (np.concatenate(z) for z in zip(*found, strict=True))
        by = np.lexsort((y, x))
        x, y = x[by], y[by]
        if len(x):
            now = chosen(x, y)
            pairs(PAIR, x[now], y[now])
            pairs(REST, x[~now], y[~now])
    for g in np.flatnonzero(sizes > SMALL):
        low, high, many = int(begins[g]), int(begins[g] + sizes[g]), False
        step = max(1, COMPARED // int(sizes[g]))
        for a in range(low, high, step):
            rows = np.arange(a, min(a + step, high))
            ys = np.arange(low, rows[-1])
            x, y = np.repeat(rows, len(ys)), np.tile(ys, len(rows))
            before = y < x
            x, y = x[before], y[before]
            ok = compared(x, y)
            x, y = x[ok], y[ok]
            if len(x):
                now = chosen(x, y)
                pairs(PAIR, x[now], y[now])
                many |= not now.all()
        if many:
            m = slice(low, high)
            name = int(c["token"][low]) << 20 ^ hash((int(c["doc"][low]), int(c["line"][low])))
            out.append({"kind": MEMBER, "doc": c["doc"][m], "line": c["line"][m], "grp": name & (1 << 62) - 1, "size": c["size"][m], "pos": c["pos"][m], "parity": c["parity"][m].view(np.int64)})
    columns = [f.split() for f in _FOUND.split(", ")]
    kinds = {"int": np.int32, "long": np.int64}
    filled = []
    for part in out:
        n = len(part["doc"])
        filled.append([np.broadcast_to(np.asarray(part.get(name, 0)).astype(kinds[kind]), n) for name, kind in columns])
    return pd.DataFrame({name: np.concatenate([f[i] for f in filled]) for i, (name, _) in enumerate(columns)})


def _similar(pairs: DataFrame, keyed: DataFrame, t: float) -> DataFrame:
    """The (doc, line) of ``pairs`` that are similar to one of their partners, once for each of these."""
    ends = pairs.select("doc", "line").unionAll(pairs.select(F.col("other_doc").alias("doc"), F.col("other_line").alias("line")))
    wanted = pairs.sparkSession.sparkContext.broadcast(BitFilter.of(ends.unionAll(ends.select("doc", F.lit(WHOLE).alias("line")))))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = (b.filter(pa.array(wanted.value.has(b.column(0).to_numpy(), WHOLE), pa.bool_())) for b in batches)
        for batch, texts in runs(some, 1):
            own = LineSets(batch.column(0).to_pylist(), texts, wanted.value.has)
            hashed = own.sorted_by().tobytes()
            words = [hashed[8 * a : 8 * (a + n)] for a, n in zip(own.starts, own.size, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(own.doc), pa.array(own.line), pa.array(words, pa.binary())], ["doc", "line", "words"])

    # written, as both ends of a pair need them: Spark would read all texts for each
    words = hand_off(keyed.mapInArrow(fetch, "doc long, line int, words binary").dropDuplicates(["doc", "line"]), "line-words")
    others = words.select(F.col("doc").alias("other_doc"), F.col("line").alias("other_line"), F.col("words").alias("other_words"))
    joined = pairs.join(words, ["doc", "line"]).join(others, ["other_doc", "other_line"]).select("doc", "line", "words", "other_words")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                n, m = len(a) // 8, len(b) // 8
                both = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
                ok.append(both >= int(_required(np.int64(n), np.int64(m), t)))
            yield batch.select(["doc", "line"]).filter(pa.array(ok, pa.bool_()))

    return joined.mapInArrow(verify, "doc long, line int")


def _key() -> Column:
    """doc_id; without one, a number below all others that depends on the text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC) - F.pmod(F.xxhash64("text"), F.lit(1 << 61)))


def removed_lines(docs: DataFrame, t: float = THRESHOLD) -> DataFrame:
    """(doc, line) of each line to remove; ``doc`` is ``_key()``.

    Rows with one doc_id are copies of one document and stand at the same place: neither removes the
    other's lines at an equal place.
    """
    spark = docs.sparkSession
    ship_code(spark)
    keyed = docs.select(_key().alias("doc"), F.col("text").alias("text"))
    counts = count_buckets(keyed.select("text"))

    def candidates(table: pa.Table) -> pa.Table:
        found = _block_candidates(table.column("blob").to_pylist(), table.column("n").to_pylist(), t)
        return pa.Table.from_pandas(found, preserve_index=False)

    found = hand_off(postings(keyed, counts, t).groupBy("block").applyInArrow(candidates, _FOUND), "line-candidates")
    ends = ("doc", "line", "other_doc", "other_line")
    later = (F.col("doc") != F.col("other_doc")) | (F.col("line") != F.col("other_line"))
    same = found.filter(F.col("kind") == SAME).select("doc", "line").distinct()
    first = found.filter((F.col("kind") == PAIR) & later).select(*ends).distinct().join(same, ["doc", "line"], "left_anti")
    done = hand_off(same.unionAll(_similar(hand_off(first, "line-pairs"), keyed, t)).distinct(), "lines-removed")

    rest = found.filter((F.col("kind") == REST) & later).select(*ends)
    members = found.filter(F.col("kind") == MEMBER).select("grp", "doc", "line", "size", "pos", "parity")
    left = members.join(done, ["doc", "line"], "left_anti")
    other = members.select("grp", *(F.col(c).alias(f"other_{c}") for c in ("doc", "line", "size", "pos", "parity")))
    small, large = F.least("size", "other_size"), F.greatest("size", "other_size")
    required = F.ceil(F.round((F.col("size") + F.col("other_size")) * (t / (1 + t)), 9))
    earlier = (F.col("other_doc") < F.col("doc")) | ((F.col("other_doc") == F.col("doc")) & (F.col("other_line") < F.col("line")))
    close = (
        (small >= F.ceil(F.round(large * t, 9)))
        & (F.least(F.col("size") - F.col("pos"), F.col("other_size") - F.col("other_pos")) >= required)
        & (F.bit_count(F.col("parity").bitwiseXOR(F.col("other_parity"))) <= F.col("size") + F.col("other_size") - 2 * required)
    )
    listed = left.join(other, "grp").filter(earlier & close).select(*ends)
    second = rest.join(done, ["doc", "line"], "left_anti").unionAll(listed).distinct().join(first, list(ends), "left_anti")
    second = hand_off(second, "line-pairs")
    if second.isEmpty():
        return done
    return hand_off(done.unionAll(_similar(second, keyed, t)).distinct(), "lines-removed")


def dedup_lines(docs: DataFrame, t: float = THRESHOLD, counts: bool = False, drop_emptied: bool = False) -> DataFrame:
    """``docs`` with its later similar lines removed from ``text``; all rows and columns stay.

    A null text stays null; a text whose lines are all removed becomes empty. ``drop_emptied`` leaves out rows that
    have no word left by it, as all they said stands in earlier documents. With ``counts``, the
    columns n_lines and n_removed are added. Rows with a null doc_id come first in the order, by hash of
    their text.
    """
    removed = removed_lines(docs, t)
    per_doc = hand_off(removed.groupBy("doc").agg(F.sort_array(F.collect_list("line")).alias("lines")), "lines-by-doc")
    key, gone, mark = (rename_apart(docs, "line", name) for name in ("doc", "gone", "mark"))

    flagged = docs.withColumn(key, _key())
    flagged = flagged.withColumn(mark, may_be_in(per_doc.select("doc"), F.col(key)))
    # the same join at every size: these lists grow with the documents, and none is sent through the driver
    lines = per_doc.select(F.col("doc").alias(key), F.col("lines").alias(gone)).hint("merge")
    # only documents that may lose lines are shuffled
    touched = flagged.filter(F.col(mark)).join(lines, key, "left")
    untouched = flagged.filter(~F.col(mark)).withColumn(gone, F.lit(None).cast("array<int>"))
    every = touched.select(*docs.columns, gone).unionAll(untouched.select(*docs.columns, gone))
    parts = rename_apart(docs, "line", "parts")
    every = every.withColumn(parts, F.split("text", "\n", -1))
    places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    kept = F.array_join(F.transform(places, lambda i: F.get(F.col(parts), i)), "\n")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)
    if drop_emptied:
        every = every.filter(F.col(gone).isNull() | (F.trim(kept, F.lit(" \t\n\x0b\x0c\r")) != ""))
    extra = [F.coalesce(F.size(parts).cast("long"), F.lit(0)).alias("n_lines"), F.coalesce(F.size(gone).cast("long"), F.lit(0)).alias("n_removed")] if counts else []
    return every.select(*(text.alias(c) if c == "text" else F.col(c) for c in docs.columns), *extra)

