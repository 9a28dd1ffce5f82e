"""Quality rules (8): an isolation forest on rule statistics, its threshold calibrated from labels.

1. Each text becomes a few rule statistics (``COUNTS``, ``FEATURES``): one scan, no shuffle.
2. The forest is fitted on at most ``SAMPLE_ROWS`` labelled rows, those with the smallest hash of
   their id. It sees by how much a statistic leaves the range of the good ones among them (all but a
   share ``EDGE`` on either side); so ordinary texts, however short, lie together at the origin.
   Each tree splits a draw of ``TREE_ROWS`` rows at random until rows stand alone.
3. A text's score is 2^(-mean path length / expected path length): anomalies are isolated early.
4. The threshold comes from all labelled rows: the score histogram of each label is a grouped count
   (at most ``BINS`` rows each). Of the thresholds that reject at most ``MAX_CLEAN_LOSS`` of the good
   rows, it has the largest share of bad rows rejected less ``CLEAN_WEIGHT`` times that of good ones.
   Without labels of both kinds nothing is rejected by the method.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsieve.llm.common import runs, ship_code, words_of
from shopsieve.llm.filters import BitFilter
from shopsieve.sinks.scratch import hand_off

SAMPLE_ROWS = 8192
TREE_ROWS = 512
TREES = 100
BINS = 4096
EDGE = 0.001
MAX_CLEAN_LOSS = 0.001
CLEAN_WEIGHT = 20
SEED = 11

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Shares in [0, 1], but for the mean word length; 0 for a text without words.
FEATURES = ("f_word_length", "f_symbols", "f_dup_lines", "f_repeats", "f_upper", "f_distinct", "f_endings", "f_lettered")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more, the first included."""
    if window != 8:
        raise ValueError("windows are built by doubling: 8 words")
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)

    def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Equal numbers for equal pairs; exact, as no product exceeds 2^63."""
        return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]

    if len(seen) < 1 << 15:  # four numbers fit into one
        span = len(seen)
        four = np.unique(((ids[:-3] * span + ids[1:-2]) * span + ids[2:-1]) * span + ids[3:], return_inverse=True)[1]
    else:
        two = pair(ids[:-1], ids[1:])
        four = pair(two[:-2], two[2:])
    _, eight, often = np.unique(four[:-4] * (int(four.max()) + 1) + four[4:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(often[eight] > 1)
    change = np.zeros(len(words) + 1, np.int64)
    change[starts] += 1
    change[starts + window] -= 1
    return int((np.cumsum(change) > 0).sum())


def statistics(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """``COUNTS`` and ``FEATURES`` of one text."""
    words = words_of(text)
    n = len(words)
    spaces = sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    chars = len(text) - spaces
    if not n:
        return (0, 0, symbols, dup_lines, 0), (0.0,) * len(FEATURES)
    lower, upper = text.lower(), text.upper()
    if len(lower) == len(upper) == len(text):
        own, low, up = (np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32) for t in (text, lower, upper))
        capitals, letters = int((own != low).sum()), int((low != up).sum())
    else:
        capitals, letters = sum(map(str.isupper, text)), sum(map(str.isalpha, text))
    endings = sum(map(b".!?,;:#*$%&|".__contains__, [w[-1] for w in words]))
    features = (
        chars / n,
        min(1.0, symbols / n),
        dup_lines / len(lines),
        repeats / n,
        capitals / max(letters, 1),
        len(set(words)) / n,
        endings / n,
        min(1.0, letters / chars),
    )
    return (n, chars, symbols, dup_lines, repeats), features


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of n rows."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2.0)
    return np.where(n > 2, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays by node; a leaf is its own child, and ``path`` is its depth plus what is expected below."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    depth: int
    rows: int

    @classmethod
    def fit(cls, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
        rng = np.random.default_rng(seed)
        tree_rows = min(tree_rows, len(rows))
        depth = max(1, int(np.ceil(np.log2(max(2, tree_rows)))) + 2)
        built = [cls._tree(rows[rng.choice(len(rows), tree_rows, replace=False)], depth, rng) for _ in range(trees)]
        size = max(len(t) for t in built)
        full = np.zeros((5, trees, size))
        for k, tree in enumerate(built):
            full[:, k, : len(tree)] = np.array(tree).T
        return cls(full[0].astype(int), full[1], full[2].astype(int), full[3].astype(int), full[4], depth, tree_rows)

    @staticmethod
    def _tree(rows: np.ndarray, most: int, rng: np.random.Generator) -> list[list[float]]:
        nodes: list[list[float]] = []

        def grow(part: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([0, np.inf, at, at, depth + float(expected_path(len(part)))])
            low, high = part.min(0), part.max(0)
            able = np.flatnonzero(high > low)
            if depth < most and len(part) > 1 and len(able):
                f = int(rng.choice(able))
                cut = rng.uniform(low[f], high[f])
                below = part[:, f] < cut
                if below.any() and not below.all():
                    nodes[at][:2] = [f, cut]
                    nodes[at][2] = grow(part[below], depth + 1)
                    nodes[at][3] = grow(part[~below], depth + 1)
            return at

        grow(rows, 0)
        return nodes

    def score(self, rows: np.ndarray) -> np.ndarray:
        """In (0, 1]; higher is more anomalous."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for k in range(len(self.path)):
            at = np.zeros(len(rows), int)
            for _ in range(self.depth):
                at = np.where(rows[every, self.feature[k, at]] < self.cut[k, at], self.left[k, at], self.right[k, at])
            total += self.path[k, at]
        return 2.0 ** (-total / len(self.path) / max(float(expected_path(self.rows)), 1e-9))


@dataclass
class Model:
    """A fitted forest, or none; texts with a score of ``threshold`` or more are rejected."""

    forest: Forest | None = None
    low: np.ndarray | float = 0.0
    high: np.ndarray | float = 0.0
    threshold: float = 2.0

    def excess(self, features: np.ndarray) -> np.ndarray:
        """How far each statistic lies above (or, negative, below) the range of good texts."""
        return np.maximum(features - self.high, 0) - np.maximum(self.low - features, 0)

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.forest is None or not len(features):
            return np.zeros(len(features))
        return self.forest.score(self.excess(features))


def base_failed(counts: tuple[int, ...]) -> bool:
    return counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PCT * counts[0]


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", among: DataFrame | None = None) -> DataFrame:
    """doc_id, counts, features and base_failed of each row (null text: empty).

    With ``among`` (a column of ids) only rows whose id may be there are measured; none that is there is left out.
    """
    ship_code(docs.sparkSession)
    wanted = None if among is None else docs.sparkSession.sparkContext.broadcast(BitFilter.of(among))
    names = ["doc_id", *COUNTS, *FEATURES, "base_failed"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if wanted is not None:
            present = (b.filter(b.column(0).is_valid()) for b in batches)
            batches = (b.filter(pa.array(wanted.value.has(b.column(0).to_numpy()))) for b in present)
        for batch, texts in runs(batches, 1):
            found = [statistics(t) for t in texts]
            columns = [pa.array([c[i] for c, _ in found], pa.int64()) for i in range(len(COUNTS))]
            columns += [pa.array([f[i] for _, f in found], pa.float64()) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array([base_failed(c) for c, _ in found], pa.bool_())], names)

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in FEATURES), "base_failed boolean"])
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(measure, schema)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit and calibrate on written statistics and ``labels`` (doc_id, quality 0 or 1).

    Only rows that pass the base rules take part. A row labelled twice counts as good if any label
    says so. Null ids and null labels are ignored.
    """
    good = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    labelled = hand_off(stats.filter("not base_failed").join(good, "doc_id").select("doc_id", "quality", *FEATURES), "quality-labelled")
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(SAMPLE_ROWS).select(*FEATURES, "quality").toArrow()
    sample = np.column_stack([chosen.column(c).to_numpy() for c in FEATURES]) if chosen.num_rows else np.zeros((0, len(FEATURES)))
    is_good = np.array(chosen.column("quality").to_pylist(), int) > 0
    if not is_good.any() or is_good.all():
        return Model()
    model = Model(None, *np.quantile(sample[is_good], (EDGE, 1 - EDGE), axis=0))
    model.forest = Forest.fit(model.excess(sample))
    scored = score(labelled.withColumn("base_failed", F.lit(False)), model, "quality")
    clean, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for row in scored.groupBy("quality", F.floor(F.col("score") * BINS).alias("bin")).count().collect():
        (clean if row["quality"] else bad)[row["bin"]] += row["count"]
    lost, caught = (np.cumsum(c[::-1])[::-1] / c.sum() for c in (clean, bad))  # share at or above each bin
    worth = np.where(lost <= MAX_CLEAN_LOSS, caught - CLEAN_WEIGHT * lost, -1.0)
    best = BINS - int(np.argmax(worth[::-1]))  # of equal ones the highest
    model.threshold = best / BINS if worth[best] > 0 else 2.0
    return model


def score(stats: DataFrame, model: Model, *keep: str) -> DataFrame:
    """doc_id, the columns ``keep``, score and kept (false if base_failed) of rows of ``with_statistics``."""
    ship_code(stats.sparkSession)
    kinds = dict(stats.dtypes)
    names = ["doc_id", *keep]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_name = dict(zip(batch.schema.names, batch.columns, strict=True))
            features = np.column_stack([by_name[c].to_numpy(zero_copy_only=False) for c in FEATURES])
            scores = model.scores(features)
            failed = by_name["base_failed"].to_numpy(zero_copy_only=False).astype(bool)
            kept = ~failed & (scores < model.threshold)
            yield pa.RecordBatch.from_arrays([*(by_name[c] for c in names), pa.array(scores), pa.array(kept)], [*names, "score", "kept"])

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in names), "score double", "kept boolean"])
    return stats.select(*dict.fromkeys([*names, *FEATURES, "base_failed"])).mapInArrow(judge, schema)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``COUNTS``, base_failed, kept, score.

    A null text counts as empty and fails the base rules; null and repeated ids stay rows of their
    own; other columns are ignored; an empty table or one without labels gives base rules alone.
    """
    stats = hand_off(with_statistics(docs), "quality-statistics")
    return score(stats, fit(stats, labels), *COUNTS, "base_failed")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The model is fitted on the labelled rows; then each row is judged where it is, without a join,
    so rows with null or repeated ids get a verdict of their own.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("__id")).filter("__id is not null").distinct()
    # texts stay where they are: only statistics of documents that may have a label are joined
    found = with_statistics(docs, among=known)
    stats = hand_off(found.join(known, found["doc_id"] == known["__id"], "left_semi"), "quality-statistics")
    model = fit(stats, labels)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, batch_column):
            found = [statistics(t) for t in texts]
            scores = model.scores(np.array([f for _, f in found], float).reshape(len(found), len(FEATURES)))
            kept = [not base_failed(c) and s < model.threshold for (c, _), s in zip(found, scores, strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    batch_column = docs.columns.index("text")
    return docs.mapInArrow(judge, docs.schema)
