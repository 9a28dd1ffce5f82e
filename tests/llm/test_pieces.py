"""SentencePiece encoding by chunks against the library on whole texts."""

from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece
from conftest import SMALL, bag
from edge_rows import edge_docs, no_docs  # noqa: F401

from shopsieve.llm import pieces
from shopsieve.llm.catalog import QUERIES
from shopsieve.llm.pretokens import vocabulary_file

MODEL = vocabulary_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def whole(library, text):
    ids = library.encode(text or "") + [library.eos_id()]
    return ids, library.decode(ids)


def digest(library, text):
    ids, decoded = whole(library, text)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("alphabet", ["ab ", "the on ", "▁ a\n\t", " ", "é日 \U0001f44d\0<s></s>　\xa0", "aàá 0123.,!?\r\n"])
def test_random_texts(library, alphabet):
    rng = random.Random(alphabet)
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(3000)]
    table = pieces.ChunkTable(MODEL)
    assert table.separable
    for first in range(0, len(texts), 500):
        some = texts[first : first + 500]
        ids, cuts = table.encode(some)
        expected = [whole(library, t) for t in some]
        assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [e[0] for e in expected]
        assert table.decode(ids, cuts) == [e[1] for e in expected]


def test_table_starts_afresh_and_whole_texts(library, monkeypatch):
    texts = [f"word{k} other  {k * 7}" for k in range(300)] + ["", " ", "x" * 5000]
    expected = [whole(library, t)[0] for t in texts]
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    table = pieces.ChunkTable(MODEL)
    for _ in range(3):
        ids, cuts = table.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == expected
    assert len(table.numbers) < 2000
    monkeypatch.setattr(pieces, "separable", lambda path: False)
    ids, cuts = pieces.ChunkTable(MODEL).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == expected


def test_edges(spark, library, edge_docs, no_docs):  # noqa: F811
    got = pieces.encode_pieces(edge_docs, MODEL, decoded=True)
    want = sorted(((r.doc_id, *whole(library, r.text)) for r in edge_docs.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
    assert bag(got) == want
    assert pieces.encode_pieces(no_docs, MODEL).columns == ["doc_id", "ids"]
    assert pieces.digests(pieces.encode_pieces(no_docs, MODEL, decoded=True)).count() == 0


def test_registered(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = [(r.doc_id, *digest(library, r.text)) for r in docs.collect()]
    assert bag(QUERIES["op12_chunk_table_pieces"](spark, SMALL)) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
