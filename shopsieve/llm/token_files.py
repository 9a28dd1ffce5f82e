"""Token-ID output (4): frequency-ranked ids, byte-aligned, with separate control bytes.

File format. A folder holds two Parquet tables, so that writing follows Spark's commit rules:

* ``ranks``: (rank, id), the most frequent id first, ties by id. It covers all ids that occur.
* ``shards``: one row per document: shard, doc_id, n_tokens, start (ids before it in the shard),
  control, data. Shards are ranges of doc_id that continue one another in ascending order (nulls
  first); each lies in one file, in order.

Each rank takes 1 to 4 bytes, little-endian, in ``data``; ``control`` holds the lengths minus one,
two bits a rank, four ranks a byte, lowest bits first. A document's last control byte is filled up
with zero bits that have no data. As frequent ids have small ranks, most take one byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopsieve.llm.common import runs, ship_code
from shopsieve.llm.pretokens import encoder

#: Ids that are coded at a time.
AT_ONCE = 500_000
#: Ids in one shard on average.
SHARD = 2_000_000
#: Lengths of four ranks for each control byte.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)


def pack_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control and data bytes of each document; ``counts`` says how many of ``ranks`` each has."""
    ranks, counts = ranks.astype(np.uint32), np.asarray(counts, np.int64)
    sizes = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    quads = -(-counts // 4)
    place = np.arange(len(ranks)) + np.repeat(4 * (np.cumsum(quads) - quads) - (np.cumsum(counts) - counts), counts)
    codes = np.zeros(4 * int(quads.sum()), np.uint8)
    codes[place] = sizes - 1
    codes = codes.reshape(-1, 4)
    control = (codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6).astype(np.uint8).tobytes()
    ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
    begins = ends[:-1]
    data = np.empty(int(ends[-1]), np.uint8)
    data[begins] = ranks.astype(np.uint8)
    for byte in (1, 2, 3):
        longer = np.flatnonzero(sizes > byte)
        if not len(longer):
            break
        data[begins[longer] + byte] = (ranks[longer] >> np.uint32(8 * byte)).astype(np.uint8)
    return _cut(control, np.cumsum(quads)), _cut(data.tobytes(), ends[np.cumsum(counts)])


def _cut(whole: bytes, ends: np.ndarray) -> list[bytes]:
    ends = ends.tolist()
    if not ends:
        return []
    return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def unpack_ranks(controls: list[bytes], datas: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Ranks of the documents, one after the other: lengths by table lookup, then one gather for each byte place."""
    counts = np.asarray(counts, np.int64)
    sizes = LENGTHS[np.frombuffer(b"".join(controls), np.uint8)].reshape(-1)
    quads = np.array([len(c) for c in controls], np.int64)
    place = np.arange(int(counts.sum())) + np.repeat(4 * (np.cumsum(quads) - quads) - (np.cumsum(counts) - counts), counts)
    sizes = sizes[place].astype(np.int64)  # without the places that fill up last bytes
    raw = np.frombuffer(b"".join([*datas, b"\0\0\0"]), np.uint8)
    begins = np.cumsum(sizes) - sizes
    out = raw[begins].astype(np.uint32)
    for byte in (1, 2, 3):
        longer = np.flatnonzero(sizes > byte)
        if not len(longer):
            break
        out[longer] |= raw[begins[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return out


def encode(docs: DataFrame, vocabulary: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    """doc_id and the ids of each row, the end id included, as bytes; and one row per task with ``counts`` of its ids."""
    ship_code(docs.sparkSession)

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch, texts in runs(batches, 1):
            ids = [np.append(i, np.int32(end_id)) for i in encoder(vocabulary).encode(texts)]
            flat = np.concatenate(ids)
            found = np.bincount(flat, minlength=len(total))
            found[: len(total)] += total
            total = found
            # two bytes an id while all fit, four else; the first byte says which
            wide = flat.max() >= 1 << 16
            raw = flat.astype("<u4" if wide else "<u2").tobytes()
            ends = np.cumsum([len(i) for i in ids]) * (4 if wide else 2)
            rows = [(b"\4" if wide else b"\2") + r for r in _cut(raw, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), pa.nulls(len(rows), pa.binary())], ["doc_id", "ids", "counts"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], ["doc_id", "ids", "counts"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(ids_of, "doc_id long, ids binary, counts binary")


def _parts(sizes: np.ndarray) -> Iterator[slice]:
    """Rows in stretches of about ``AT_ONCE`` ids."""
    of = (np.cumsum(sizes) - sizes) // AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(sizes)]
    return (slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def _ids(rows: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1) for raw in rows]


def count_ids(encoded: DataFrame) -> DataFrame:
    """How often each id occurs: the sum of what the tasks counted."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                counts = np.frombuffer(raw, "<i8")
                found = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[found])], ["id", "n"])

    counts = encoded.select("counts").filter("counts is not null")
    return counts.mapInArrow(spread, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the files of ``docs`` (see the module) to ``folder``.

    A null or empty text is the end id alone. Rows with one id follow each other, fewer tokens first.
    An empty table gives empty files. The texts are encoded once; the ids wait in ``folder/encoded``.
    """
    spark = docs.sparkSession
    encode(docs, vocabulary, end_id, doc_id, text).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/encoded")
    encoded = spark.read.parquet(f"{folder}/encoded")
    # bounded by the vocabulary, not by the corpus
    counted = count_ids(encoded).orderBy(F.desc("n"), "id").collect()
    ranked = [row["id"] for row in counted]
    spark.createDataFrame([(r, i) for r, i in enumerate(ranked)], "rank long, id long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of[np.array(ranked, np.int64)] = np.arange(len(ranked), dtype=np.uint32)
    rows = encoded.filter("ids is not null").select("doc_id", "ids")
    shards = max(48, sum(row["n"] for row in counted) // SHARD)
    # one number for each shard: where it ends; nulls come first
    steps = [(k + 1) / shards for k in range(shards - 1)]
    cuts = rows.select("doc_id").agg(F.percentile_approx("doc_id", steps, 10 * shards).alias("cuts")).first()["cuts"] or []
    cuts = np.unique(np.array(cuts, np.int64))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = _ids(batch.column(1).to_pylist())
            keys = batch.column(0).to_pylist()
            for part in _parts(np.array([len(i) for i in every], np.int64)):
                ids = every[part]
                sizes = np.array([len(i) for i in ids], np.int64)
                control, data = pack_ranks(rank_of[np.concatenate(ids)], sizes)
                shard = [0 if i is None else int(np.searchsorted(cuts, i, "left")) for i in keys[part]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), batch.column(0)[part], pa.array(sizes), pa.array(control, pa.binary()), pa.array(data, pa.binary())],
                    ["shard", "doc_id", "n_tokens", "control", "data"],
                )

    coded = rows.mapInArrow(code, "shard int, doc_id long, n_tokens long, control binary, data binary")
    dealt = coded.repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", "doc_id", "n_tokens", "control", "data")
    # a shard is one task's already, in this order: the window neither shuffles nor sorts again
    before = Window.partitionBy("shard").orderBy("doc_id", "n_tokens", "control", "data").rowsBetween(Window.unboundedPreceding, -1)
    numbered = dealt.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))
    numbered.write.mode("overwrite").option("compression", "none").parquet(f"{folder}/shards")


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """What the files hold: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids (as uint32 bytes)."""
    ship_code(spark)
    ids = np.array([r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()], np.uint32)
    shards = spark.read.parquet(f"{folder}/shards")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            control, data = (batch.column(c).to_pylist() for c in ("control", "data"))
            sizes = batch.column("n_tokens").to_numpy()
            for part in _parts(sizes):
                flat = ids[unpack_ranks(control[part], data[part], sizes[part])].astype("<u4").tobytes()
                raw = _cut(flat, 4 * np.cumsum(sizes[part]))
                own = [batch.column(c)[part] for c in ("doc_id", "shard", "start", "n_tokens")]
                own += [pa.array(map(zlib.crc32, raw), pa.int64()), pa.array(raw if with_ids else [None] * len(raw), pa.binary())]
                yield pa.RecordBatch.from_arrays(own, ["doc_id", "shard", "start", "n_tokens", "ids_crc32", "ids"])

    rows = shards.select("doc_id", "shard", "start", "n_tokens", "control", "data").mapInArrow(
        decode, "doc_id long, shard int, start long, n_tokens long, ids_crc32 long, ids binary"
    )
    # one number for each shard file
    before, base = 0, []
    for row in shards.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect():
        base.append((row["shard"], before))
        before += row["n"]
    bases = spark.createDataFrame(base, "shard int, base long")
    placed = rows.join(F.broadcast(bases), "shard")
    return placed.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
