"""SentencePiece encoding and decoding (12) by a table of distinct chunks.

A chunk is a run of white space markers with the word behind it. Where no piece of the model holds a
marker after another character, no merge crosses the start of a chunk, so the ids of a text are those
of its chunks one after the other. Each task numbers the distinct chunks of a stretch of texts,
the library segments each new one once, and the ids are joined back by position with numpy. The table
goes on from stretch to stretch and starts afresh beyond a bound, so memory does not grow with the corpus.
Models for which this does not hold are given whole texts.

Decoding is the library's own, from the ids of whole documents.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsieve.llm.common import runs, ship_code
from shopsieve.llm.pretokens import _Numbering

#: The white space marker; in a text it means the same as a space.
MARKER = "▁"
#: The table starts afresh beyond so many chunks or characters.
REMEMBERED, REMEMBERED_CHARS = 600_000, 12_000_000
CHUNK = re.compile(" +[^ ]*")


def separable(path: str) -> bool:
    """Whether chunks can be segmented one by one: byte-pair merges, no normalisation but a marker in
    front, no pieces of the user's own, and none that crosses the start of a chunk."""
    try:
        from sentencepiece import sentencepiece_model_pb2 as described
    except ImportError:  # it needs the protobuf package
        return False
    model = described.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm, trained = model.normalizer_spec, model.trainer_spec
    kinds = described.ModelProto.SentencePiece
    return (
        trained.model_type == described.TrainerSpec.BPE
        and not trained.treat_whitespace_as_suffix
        and norm.add_dummy_prefix
        and not norm.remove_extra_whitespaces
        and norm.escape_whitespaces
        and not norm.precompiled_charsmap
        and all(p.type != kinds.USER_DEFINED and MARKER not in p.piece.lstrip(MARKER) for p in model.pieces)
        and any(p.piece == MARKER for p in model.pieces)
    )


class ChunkTable:
    """Encodes and decodes whole texts exactly as the sentencepiece library does, with an end id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.separable = separable(path)
        self.lone = self.library.piece_to_id(MARKER)
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbering()
        self.numbers[None] = 0  # the end id
        self.begins, self.sizes, self.ids = array("q", [0]), array("q", [1]), array("i", [self.library.eos_id()])
        self.chars = 0

    def chunks(self, text: str) -> list[str]:
        """Each without its first marker, which the library adds by itself."""
        text = text.replace(MARKER, " ")
        if not text or not self.separable:
            return [text] if text else []
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [chunk[1:] for chunk in CHUNK.findall(" " + text)]
        return text.split(" ")

    def _learn(self) -> None:
        """Segment the new chunks, each once. The empty one stands for a marker by itself."""
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if not fresh:
            return
        found = self.library.encode(fresh, num_threads=1)
        if self.separable and "" in fresh:
            found[fresh.index("")] = [self.lone]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.begins.extend((len(self.ids) + np.cumsum(sizes) - sizes).tolist())
        self.sizes.extend(sizes.tolist())
        self.ids.extend(chain.from_iterable(found))
        self.chars += sum(map(len, fresh))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text begins and ends among them."""
        if len(self.numbers) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self._forget()
        flat, upto, number = array("q"), array("q", [0]), self.numbers.__getitem__
        for text in texts:
            flat.extend(map(number, self.chunks(text)))
            flat.append(0)
            upto.append(len(flat))
        self._learn()
        numbers = np.frombuffer(flat, np.int64) if flat else np.zeros(0, np.int64)
        begins, sizes, known = np.array(self.begins), np.array(self.sizes), np.array(self.ids)
        n = sizes[numbers]
        ends = np.cumsum(n)
        ids = known[np.repeat(begins[numbers] - ends + n, n) + np.arange(int(n.sum()))]
        return ids.astype(np.int32), np.append(0, ends)[np.frombuffer(upto, np.int64)]

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> list[str]:
        if len(cuts) < 2:
            return []
        return self.library.decode([ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


_tables: dict[str, ChunkTable] = {}


def chunk_table(path: str) -> ChunkTable:
    """One for each Python worker and model, kept from task to task."""
    if path not in _tables:
        _tables[path] = ChunkTable(path)
    return _tables[path]


def encode_pieces(docs: DataFrame, model: str, decoded: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (with the end id), and with ``decoded`` the text that the
    library decodes from them.

    A null or empty text has the end id alone and decodes to an empty text. Null and repeated ids stay
    rows of their own, other columns of any name are ignored, and an empty table gives an empty result.
    ``model`` is a path that exists on every machine.
    """
    ship_code(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, 1):
            table = chunk_table(model)
            ids, cuts = table.encode(texts)
            columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))]
            if decoded:
                columns.append(pa.array(table.decode(ids, cuts), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    layout = "doc_id long, ids array<int>" + ", decoded string" * decoded
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, layout)


def digests(encoded: DataFrame) -> DataFrame:
    """The number of ids, and SHA-256 of the ids in decimal with a space between, and of the decoded text."""
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
