from __future__ import annotations

import pytest

EXTRA = "doc_id long, text string, lang string, line_doc string, kept string, block int"

#: Null ids and texts, empty and odd texts, repeated rows, a very long text, non-ASCII letters.
EDGE = [
    (0, "one two three four five six seven eight nine ten\nA line that stands twice\nA line that stands twice", "en"),
    (1, None, None),
    (2, "", "en"),
    (3, " \n\t\n ", "de"),
    (4, "Äußerst schöne Wörter, œuvre naïve. 日本語 \U0001f44d", "de"),
    (5, "one two three four five six seven eight nine ten\nA line that stands twice\nA line that stands twice", "en"),
    (5, "one two three four five six seven eight nine ten\nA line that stands twice\nA line that stands twice", "en"),
    (None, "a text without an id, which is long enough to have a few words", "en"),
    (None, None, None),
    (6, " ".join(f"word{i % 977}" for i in range(30_000)), "en"),
    (7, "word", "en"),
    (8, 'password="abcdef123" and token: xyz and AKIA' + "A1" * 10 + " " + "0f" * 15, "en"),
]


@pytest.fixture
def edge_docs(spark):
    rows = [(i, t, lang, "x", "y", 1) for i, t, lang in EDGE]
    return spark.createDataFrame(rows, EXTRA).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], EXTRA)
