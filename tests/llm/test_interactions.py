"""The filter audit against removing documents order by order."""

from __future__ import annotations

import math
import re
from itertools import permutations

from conftest import bag
from edge_rows import EDGE

from shopsieve.llm.interactions import audit, edges


def plain(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    fails = []
    for doc_id, text, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        least = min((i for i, t, _ in docs if (t or "") == text and i is not None), default=None)
        found = {"A"} if len(words) < 50 else set()
        found |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        found |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else set()
        found |= {"D"} if re.search("[#$%&*|]", text) else set()
        found |= {"E"} if doc_id is not None and least is not None and least < doc_id else set()
        fails.append(found)
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, bad in labels if bad == 1}
    out = []
    for part in {s or "" for _, _, s in docs}:
        mine = [(d[0], f) for d, f in zip(docs, fails) if (d[2] or "") == part]
        rows, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                total[name] += len(gone)
                earlier = sum(name in f for _, f in mine) - len(gone)
                left = [(i, f) for i, f in left if name not in f]
                only = sum(f == {name} for _, f in mine)
                lost = [sum(i is not None and i in ids for i, _ in gone) for ids in (good, toxic)]
                rows.append((name, "".join(order), step, len(left), len(gone), earlier, only, *lost))
        out += [(part, *row[1:], total[row[0]]) for row in rows]
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def test_edges_of_the_lattice():
    every = edges()
    assert len(every) == 80
    for state, _, orders in every:
        assert orders == math.factorial(state.bit_count()) * math.factorial(4 - state.bit_count())
    assert sum(orders for *_, orders in every) == 5 * 120


def test_against_removal_order_by_order(spark):
    long = " ".join(f"w{k}" for k in range(60))
    docs = [(i, t, s) for (i, t, s) in EDGE]
    docs += [(20, long, "en"), (21, long, None), (22, long, "de"), (20, long, "en"), (None, long, "en"), (23, "A " * 80, ""), (24, long + " $", "x")]
    docs += [(25, "\x1f \x85" * 30, "x"), (26, " ".join(["same"] * 70), "x"), (None, None, "only")]
    labels = [(20, 1, 0), (20, 0, 1), (22, 1, 1), (None, 1, 1), (5, 1, None), (99, 1, 1), (24, None, 1)]
    frame = spark.createDataFrame([(*d, 1, "m") for d in docs], "doc_id long, text string, source string, key int, mask string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit(frame, marks).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert bag(got) == plain(docs, labels)
    assert audit(frame.limit(0), marks).count() == 0
    assert audit(frame, marks.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0
