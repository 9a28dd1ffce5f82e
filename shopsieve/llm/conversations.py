"""Conversation structure repair (11): the cheapest edits that make the roles of a conversation regular.

Rows become light verdicts first: blank and truncated come from the text alone, and repeats from digests,
in windows that are salted by turn, so that a text repeated without end does not gather in one task. Then
the rows of each conversation stream through one Viterbi pass in the order of their turns.

The pass has four states: nothing yet, only a system row, a user row last, an assistant row last. A survivor
is the cheapest way into a state. Survivors are leaves of a backpointer tree whose nodes count their references: a node
that nobody refers to goes, a chain is one node, and as soon as all survivors share an
ancestor, the edits up to it are emitted. A survivor that can no longer be part of a cheapest path is dropped,
by what it would cost another one at most to do as it does. Ties are decided by the complete unresolved suffixes: the ranks of the
survivors order them, and a step refines the order by the letters it adds.
Texts are not held: each survivor carries a running SHA-256 of its repaired rows.

A conversation is one sequential hash by its contract, so its rows pass through one task, however many they
are; memory there is the letters not yet decided, and the audit itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsieve.llm.common import ship_code

SPACES = " \t\n\x0b\x0c\r"
LANES = 64
LEGAL = {"su", "ua", "au"}
SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
#: Costs of the edits.
REROLE, DELETE, INSERT = 2, 3, 2

START, SYSTEM, USER, ASSISTANT = range(4)
#: What it costs one survivor (first) at most to go on as another one (second) does.
_MIMIC = {
    (START, SYSTEM): 0, (START, ASSISTANT): 0, (START, USER): INSERT,
    (SYSTEM, START): 2 * INSERT, (SYSTEM, ASSISTANT): 2 * INSERT, (SYSTEM, USER): INSERT,
    (USER, ASSISTANT): INSERT, (USER, SYSTEM): INSERT, (USER, START): INSERT + DELETE,
    (ASSISTANT, USER): INSERT, (ASSISTANT, SYSTEM): 0, (ASSISTANT, START): DELETE,
}


def _moves() -> dict[str, list[tuple]]:
    """For each initial (or "" for others): state before, after, cost, letters, inserted role, new role.

    The new role is None to keep the row's own and empty for a deleted row. More than one insertion before a row, and one before a
    deleted row, never belong to the cheapest edits or to the least of them.
    """
    delete = [(state, state, DELETE, "D", "", "") for state in range(4)]
    to_user = [((START, SYSTEM, ASSISTANT), "", 0, ""), ((USER,), "I", INSERT, "assistant")]
    to_assistant = [((USER,), "", 0, ""), ((START, SYSTEM, ASSISTANT), "I", INSERT, "user")]
    table = {"required": delete}
    for initial in ("s", "u", "a", ""):
        moves = list(delete)
        if initial == "s":
            moves.append((START, SYSTEM, 0, "K", "", None))
        for after, ways, name in ((USER, to_user, "user"), (ASSISTANT, to_assistant, "assistant")):
            for states, letter, cost, inserted in ways:
                for state in states:
                    moves.append((state, after, cost + REROLE, letter + "R", inserted, name))
                    if initial == name[0]:
                        moves.append((state, after, cost, letter + "K", inserted, None))
        table[initial] = moves
    return table


_MOVES = _moves()


class _Node:
    """A stretch of edits; ``kids`` are the references to its end. A survivor refers to a node without any."""

    __slots__ = ("kids", "letters", "parent")

    def __init__(self, parent: _Node | None) -> None:
        self.parent, self.letters, self.kids = parent, bytearray(), []


class _Survivor:
    __slots__ = ("cost", "digest", "leaf", "rank", "rows")

    def __init__(self, cost: int, leaf: _Node | None, rank: int, digest, rows: int) -> None:
        self.cost, self.leaf, self.rank, self.digest, self.rows = cost, leaf, rank, digest, rows


class Repair:
    """The cheapest edits of one conversation, row by row."""

    def __init__(self) -> None:
        self.root = _Node(None)
        self.emitted = bytearray()
        self.live: list[_Survivor | None] = [_Survivor(0, self.root, 0, hashlib.sha256(), 0), None, None, None]

    def add(self, role: str, text: str, required: bool, truncated: bool) -> None:
        """One row; ``required`` says that it must be deleted."""
        live = self.live
        best: list[tuple | None] = [None] * 4
        initial, said = role[:1], text.encode("utf-8", "replace")
        for move in _MOVES["required" if required else initial if initial in ("s", "u", "a") else ""]:
            before = live[move[0]]
            if before is None:
                continue
            cost = before.cost + move[2] + (truncated and move[3] != "D")
            held = best[move[1]]
            if held is None or (cost, before.rank, move[3]) < held[:3]:
                best[move[1]] = (cost, before.rank, move[3], move)
        for state, found in enumerate(best):
            if found and any(
                other and other is not found and found[0] > other[0] + _MIMIC[at, state] for at, other in enumerate(best) if at != state
            ):
                best[state] = None
        order = sorted((state for state in range(4) if best[state]), key=lambda state: best[state][1:3])
        used: dict[int, int] = {}
        for state in order:
            source = best[state][3][0]
            used[source] = used.get(source, 0) + 1
        after: list[_Survivor | None] = [None] * 4
        for rank, state in enumerate(order):
            cost, _, letters, move = best[state]
            before = live[move[0]]
            digest, leaf = before.digest, before.leaf
            if used[move[0]] > 1:
                digest, fork = digest.copy(), leaf
                leaf = _Node(fork)
                fork.kids.append(leaf)
            survivor = after[state] = _Survivor(cost, leaf, rank, digest, before.rows)
            if move[4]:
                self._write(survivor, move[4], b"")
            if move[5] != "":
                self._write(survivor, role if move[5] is None else move[5], said)
        # only now: a leaf that goes on by itself must not grow while others fork from it
        for state in order:
            after[state].leaf.letters += best[state][2].encode()
        for state, before in enumerate(live):
            if before is not None and state not in used:
                self._prune(before.leaf)
        self.live = after
        self._coalesce()

    @staticmethod
    def _write(survivor: _Survivor, role: str, said: bytes) -> None:
        survivor.digest.update(b"%s%s:%s" % (b"\n" if survivor.rows else b"", role.encode("utf-8", "replace"), said))
        survivor.rows += 1

    def _prune(self, node: _Node) -> None:
        """Nobody refers to ``node`` any more."""
        parent = node.parent
        while parent is not None:
            parent.kids.remove(node)
            if parent.kids:
                break
            node, parent = parent, parent.parent
        if parent is not None and len(parent.kids) == 1 and parent.parent is not None:
            # a chain becomes one node: the only child takes over its parent's letters
            (kid,) = parent.kids
            kid.letters[:0] = parent.letters
            kid.parent = parent.parent
            parent.parent.kids[parent.parent.kids.index(parent)] = kid

    def _coalesce(self) -> None:
        """Emit what all survivors agree on."""
        while True:
            self.emitted += self.root.letters
            self.root.letters = bytearray()
            if len(self.root.kids) != 1:
                return
            (self.root,) = self.root.kids
            self.root.parent = None

    def finish(self) -> tuple[int, str, str]:
        """Cost, audit and hash of the repaired rows."""
        ends = ((START, 0, ()), (SYSTEM, 2 * INSERT, ("user", "assistant")), (USER, INSERT, ("assistant",)), (ASSISTANT, 0, ()))
        cost, _, state, inserted = min(
            (self.live[state].cost + more, self.live[state].rank, state, inserted) for state, more, inserted in ends if self.live[state]
        )
        survivor = self.live[state]
        for role in inserted:
            self._write(survivor, role, b"")
        parts, node = [], survivor.leaf
        while node is not None:
            parts.append(node.letters)
            node = node.parent
        audit = self.emitted + b"".join(reversed(parts)) + b"I" * len(inserted)
        return cost, audit.decode(), survivor.digest.hexdigest()


class _Conversation:
    """Counts and repair of one conversation; rows come in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.repair = conv_id, Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None
        self.initial = None
        self.seen = None

    def add(self, turn: int | None, role: str, text: str, n: int, blank: bool, cut: bool, digest: bytes, repeated: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        repeated = repeated or self.seen == (turn, digest)
        self.seen = (turn, digest)
        for _ in range(n):
            if self.initial is not None and self.initial + role[:1] not in LEGAL:
                self.illegal += 1
            self.initial = role[:1]
            self.blank += blank
            self.duplicate += repeated and not blank
            truncated = cut and not blank and not repeated
            self.truncated += truncated
            self.repair.add(role, text, blank or repeated, truncated)
            repeated = True

    def row(self) -> tuple:
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.finish())


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage: conv_id, turn, role, text, n (0: dropped, 2: repeated). Nulls count as one space."""

    def or_space(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    role, text = or_space("role"), or_space("text")
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate <= 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("n"),
    )


def _repeats(rows: DataFrame) -> DataFrame:
    """Rows whose role and text stand at a smaller turn of their conversation: conv_id, turn, role, digest.

    Each lane finds its first turn, and the firsts of all lanes meet once more: at most ``LANES`` rows.
    """
    same = ("conv_id", "role", "digest")
    distinct = rows.select(*same, "turn").distinct().withColumn("lane", F.pmod(F.xxhash64("turn"), F.lit(LANES)))

    def place(*lane: str) -> Column:
        return F.row_number().over(Window.partitionBy(*same, *lane).orderBy(F.col("turn").asc_nulls_first()))

    laned = distinct.withColumn("in_lane", place("lane")).withColumn("lane", F.when(F.col("in_lane") > 1, F.col("lane")).otherwise(-1))
    return laned.withColumn("among", place("lane")).filter("in_lane > 1 OR among > 1").select(*same, "turn")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text and n, how often the row stands): see ``SCHEMA``.

    Rows are taken by turn (nulls first), those of one turn by role and then by the digest of their text. ``n`` = 0
    only says that the conversation exists; one without other rows has zeros, an empty audit and the hash of
    nothing. Rows without a conv_id are one conversation. A role that begins with neither s, u nor a cannot be
    kept. An empty table gives an empty result.
    """
    ship_code(rows.sparkSession)
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    judged = rows.select(
        "conv_id", "turn", "role", "text", "n",
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.md5(F.concat("role", F.lit("\n"), "text"))).alias("digest"),
        F.lit(1).alias("kind"),
    )
    marks = _repeats(judged.filter("n > 0 AND NOT blank")).select(
        "conv_id", "turn", "role", F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(False).alias("blank"), F.lit(False).alias("cut"), "digest", F.lit(0).alias("kind")
    )
    # a mark comes just before the rows it is about
    streamed = judged.unionByName(marks).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "kind")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string()] * 2

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

        now, mark, done = None, None, []
        for batch in batches:
            for conv_id, turn, role, text, n, blank, cut, digest, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now, mark = _Conversation(conv_id), None
                if kind == 0:
                    mark = (turn, role, digest)
                elif n:
                    now.add(turn, role, text, n, blank, cut, digest, mark == (turn, role, digest))
            if done:
                yield batch_of(done)
                done = []
        if now is not None:
            yield batch_of([now.row()])

    return streamed.mapInArrow(stream, SCHEMA)
