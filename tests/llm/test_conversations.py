"""Conversation repair against a search through all edits."""

from __future__ import annotations

import hashlib
import random
import zlib
from itertools import groupby

import pytest
from conftest import SMALL, bag

from shopsieve.llm import conversations
from shopsieve.llm.catalog import QUERIES

WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows: list[tuple[str, str, bool, bool]]) -> tuple[int, str, list[tuple[str, str]]]:
    """By keeping every way that is cheapest so far, two insertions anywhere: rows are role, text, must go, truncated."""
    after_role = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def least(ways: list[tuple]) -> list[tuple]:
        low = {}
        for last, cost, *_ in ways:
            low[last] = min(cost, low.get(last, cost))
        return [w for w in ways if w[1] == low[w[0]]]

    def put(way: tuple, role: str, text: str, cost: int, letter: str) -> list[tuple]:
        last, spent, audit, out = way
        now = after_role.get((last, role[:1]))
        return [] if now is None else [(now, spent + cost, audit + letter, (*out, (role, text)))]

    def inserted(ways: list[tuple]) -> list[tuple]:
        every = list(ways)
        for _ in range(2):
            ways = [new for w in ways for role in ("user", "assistant") for new in put(w, role, "", 2, "I")]
            every += ways
        return every

    ways = [("", 0, "", ())]
    for role, text, must, cut in rows:
        new = []
        for way in inserted(ways):
            new.append((way[0], way[1] + 3, way[2] + "D", way[3]))
            if not must:
                new += put(way, role, text, int(cut), "K")
                new += [w for other in ("user", "assistant") for w in put(way, other, text, 2 + cut, "R")]
        ways = least(new)
    return min((cost, audit, list(out)) for last, cost, audit, out in inserted(ways) if last in ("", "a"))


def plain(table: list[tuple]) -> list[tuple]:
    """The contract's result in plain Python, on the damaged rows."""
    table = [r for r in table if r is not None]
    out = []
    for conv, group in groupby(sorted(table, key=lambda r: (r[0] is not None, r[0] or 0)), key=lambda r: r[0]):
        rows = []
        for _, turn, role, text in group:
            role, text = (" " if v is None else v for v in (role, text))
            fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if fate == 1 else text.translate(str.maketrans("", "", ".!?")) if fate == 2 else text
            role = "user" if fate == 4 else role
            rows += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{r[1]}\n{r[2]}".encode()).digest()))
        turns = {t for t, _, _ in rows if t is not None}
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            blank, twin = not text.strip(WHITE), (role, text) in seen
            cut = not blank and not twin and text.rstrip(WHITE)[-1] not in ".!?"
            seen.add((role, text))
            counts[0 if blank else 1 if twin else 2] += blank or twin or cut
            judged.append((role, text, blank or twin, cut))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, repaired = cheapest(judged)
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_random_conversations(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "sage", "u"]
    texts = ["Yes.", "No", " ", "", None, "Why?\n", "Yes.", "long text without end", "ü!\t"]
    rows = [
        (conv, rng.choice([turn, turn, turn, turn + 3, 0, None]), rng.choice(roles), rng.choice(texts))
        for conv in [None, *range(150)]
        for turn in range(rng.randrange(6))
    ]
    rng.shuffle(rows)
    got = conversations.repair(conversations.damaged(frame(spark, rows).repartition(5)))
    assert bag(got) == sorted(plain(rows), key=lambda r: [(v is not None, str(v)) for v in r])


def test_repair_on_all_short_role_sequences():
    from itertools import product

    cases = [(role, cut) for role in ("system", "user", "assistant", "tool") for cut in (False, True)] + [("user", None)]
    for size in range(5):
        for rows in product(cases, repeat=size):
            listed = [(role, f"{k}", cut is None, bool(cut)) for k, (role, cut) in enumerate(rows)]
            one = conversations.Repair()
            for row in listed:
                one.add(*row)
            cost, audit, out = cheapest(listed)
            assert one.finish() == (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()), rows


def test_memory_of_long_conversations_is_bounded():
    rng = random.Random(1)
    one = conversations.Repair()
    longest = 0
    for k in range(20_000):
        one.add(rng.choice(["user", "assistant", "assistant", "system"]), f"{k}.", rng.random() < 0.1, rng.random() < 0.2)
        held, todo = 0, [one.root]
        while todo:
            node = todo.pop()
            held += len(node.letters)
            todo += node.kids
        longest = max(longest, held)
    assert longest < 2_000
    assert len(one.finish()[1]) >= 20_000


def test_same_text_without_end_and_edges(spark):
    rows = [(1, t, "user", "again and again.") for t in range(3000)] + [(2, 5, "user", "a."), (2, 5, "user", "a.")]
    got = {r.conv_id: r for r in conversations.repair(conversations.damaged(frame(spark, rows))).collect()}
    kept = [t for t in range(3000) if zlib.crc32(f"1:{t}".encode()) % 20 not in (0,)]
    blank = [t for t in kept if zlib.crc32(f"1:{t}".encode()) % 20 == 1]
    assert got[1].blank == len(blank)
    assert got[1].audit.count("D") + got[1].audit.count("K") + got[1].audit.count("R") == len(kept) + sum(zlib.crc32(f"1:{t}".encode()) % 20 == 3 for t in kept)
    assert got[2].duplicate >= 1
    assert conversations.repair(conversations.damaged(frame(spark, []))).count() == 0
    wide = frame(spark, rows).selectExpr("*", "1 AS kind", "'x' AS digest", "0 AS n", "TRUE AS blank")
    assert bag(conversations.repair(conversations.damaged(wide))) == bag(conversations.repair(conversations.damaged(frame(spark, rows))))


def test_registered(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert bag(QUERIES["op11_survivor_repair"](spark, SMALL)) == sorted(plain(rows), key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("roles", ["s" * 400, "ua" * 200, "sua" * 130, "t" * 400])
def test_long_undecided_runs(roles):
    """Against a dynamic program that keeps whole strings."""
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    ways = {0: (0, ""), 1: None, 2: None, 3: None}
    one = conversations.Repair()
    for c in roles:
        one.add(names[c], "x.", False, False)
        after = {}
        for a, b, cost, letters, _, _ in conversations._MOVES["" if c == "t" else c]:
            if ways[a] is not None:
                new = (ways[a][0] + cost, ways[a][1] + letters)
                after[b] = min(after.get(b, new), new)
        ways = {k: after.get(k) for k in range(4)}
    ends = [(ways[k][0] + c, ways[k][1] + tail) for k, c, tail in ((0, 0, ""), (1, 4, "II"), (2, 2, "I"), (3, 0, "")) if ways[k]]
    assert one.finish()[:2] == min(ends)
