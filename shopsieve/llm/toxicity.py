"""Toxicity (9): a weighted lexicon matched by Aho-Corasick on folded text, with exception phrases.

Folding lower-cases, strips accents, maps homoglyphs to Latin letters and digits or signs to the
letters they stand for. The folded words, one space between them, are searched for the lexicon's
entries: whole words (`` word ``) and stems (`` stem``). A word's weight is that of its heaviest
entry; words inside an exception phrase weigh nothing. The sums over bands of weights, divided by
``1 + log(1 + words / UNIT_WORDS)``, go through a logistic curve with a slope for each band, so that many
weak entries of a large corpus do not drown the strong ones. Where the bands begin is chosen from
``CANDIDATES`` inside the training rows: a lexicon and curve fitted on the other folds (``FOLDS``, by hash of
the text, so that copies stay together) must give the rows of one fold the least log loss.

The lexicon is learned from labels, on at most ``SAMPLE_ROWS`` labelled rows: of each label up to half as
many, those with the smallest hash of their id. The curve counts each of them for as many as its label has
altogether. All entries are counted in all rows of this sample, and those that
``MIN_TOXIC`` toxic documents or more hold are weighed. Weights are log odds less ``CAUTION`` standard
errors, that is a lower bound; kept are those above ``MIN_WEIGHT``, a test that is the same at any size,
but for entries that a stem of theirs outweighs, which never count. Exceptions are phrases of two words around an entry that
clean documents hold and toxic ones do not. Counting and calibration are grouped sums over the sample.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsieve.llm.common import runs, ship_code, utf8, word_hashes
from shopsieve.llm.filters import BitFilter
from shopsieve.sinks.scratch import hand_off

STEMS = (4, 5, 6, 7, 8)
MIN_TOXIC = 5
MIN_EXCEPTION = 3
CAUTION = 2.0
MIN_WEIGHT = 1.0
UNIT_WORDS = 100
#: Most labelled rows to learn from, half of them of each label.
SAMPLE_ROWS = 32_768
#: One fold of so many judges the candidates.
FOLDS = 4
#: Lower ends of the bands of weights to choose from, all among those of the last one; the first where rows are too few to choose.
CANDIDATES = ((0.0,), (0.0, 3.0), (0.0, 2.0, 4.0), (0.0, 2.0, 3.0, 4.0, 5.0), (0.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0))
#: Steps of a band's sum in the calibration, a power of e apart; sums beyond the last count as it.
STEPS, LAST = 16, 64

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
HOMOGLYPHS = dict(zip("абвгеорсухікмнтјѕԁӏαβεικνορτυχ", "abbreopcyxikmhtjsdiabeikvoptux", strict=True))
SUBSTITUTES = dict(zip("0134579@$", "oieastgas", strict=True))
FOLD = str.maketrans(HOMOGLYPHS | SUBSTITUTES)
MARKS = re.compile("[̀-ͯ]+")
WORD = re.compile(r"[^\W_]+")


def folded(text: str) -> list[str]:
    text = text.lower()
    if not text.isascii():
        text = MARKS.sub("", unicodedata.normalize("NFKD", text))
    return WORD.findall(text.translate(FOLD))


def entries_of(words: list[str]) -> set[str]:
    """Every whole word and stem, as patterns of the search."""
    distinct = set(words)
    return {f" {w} " for w in distinct} | {f" {w[:n]}" for w in distinct for n in STEMS if len(w) >= n}


def effective(weights: dict[str, float]) -> dict[str, float]:
    """Without entries that a stem of theirs outweighs: it is found wherever they are, so no text's weight changes."""

    def stems(entry: str) -> list[str]:
        word = entry.strip()
        return [f" {word[:n]}" for n in STEMS if n < len(word) or (n == len(word) and entry.endswith(" "))]

    return {e: w for e, w in weights.items() if all(weights.get(s, -np.inf) < w for s in stems(e))}


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    slope: float | np.ndarray = 0.0
    offset: float = -10.0
    cuts: tuple[float, ...] = CANDIDATES[0]

    def automaton(self):
        import ahocorasick

        built = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            built.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions:
            built.add_word(phrase, (len(phrase), None))
        if len(built):
            built.make_automaton()
        return built

    def hits(self, automaton, words: list[str]) -> dict[int, float]:
        """Weight of each matched word, by the place of the space before it."""
        found: dict[int, float] = {}
        if not len(automaton) or not words:
            return found
        freed: list[tuple[int, int]] = []
        for end, (size, weight) in automaton.iter(f" {' '.join(words)} "):
            start = end + 1 - size
            if weight is None:
                freed.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
        for start, end in freed:
            for at in [at for at in found if start <= at < end]:
                del found[at]
        return found

    def bands(self, automaton, text: str) -> list[float]:
        """Weights found in the text, summed by band, for its length."""
        words = folded(text)
        sums, unit = [0.0] * len(self.cuts), 1 + math.log1p(len(words) / UNIT_WORDS)
        for weight in self.hits(automaton, words).values():
            sums[bisect_right(self.cuts, weight) - 1] += weight / unit
        return sums

    def measure(self, automaton, text: str) -> float:
        return sum(self.bands(automaton, text))

    def score(self, measured: np.ndarray) -> np.ndarray:
        """Of rows of band sums."""
        return 1 / (1 + np.exp(-np.clip((measured * self.slope).sum(1) + self.offset, -30, 30)))


def _counted(rows: DataFrame, count) -> DataFrame:
    """Run ``count`` (texts and labels to a counter by (key, label)) in each task; sums by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, 0):
            found = count(texts, batch.column(1).to_pylist())
            keys = list(dict.fromkeys(k for k, _ in found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([found[k, x] for k in keys], pa.int64()) for x in (1, 0))], ["key", "toxic", "clean"]
            )

    mapped = rows.select("text", "toxic").mapInArrow(run, "key string, toxic long, clean long")
    return mapped.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = word_hashes([utf8(k) for k in batch.column(0).to_pylist()])
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["hash"])


def _totals(rows: DataFrame) -> dict[int, int]:
    return {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}


def learn(rows: DataFrame, stand_for: dict[int, int] | None = None) -> Lexicon:
    """Fit on ``rows`` (text, toxic 0 or 1), a bounded sample; without rows of both kinds every text scores near 0.

    ``stand_for`` says how many rows there are of each label altogether, if more than in the sample.
    """
    ship_code(rows.sparkSession)
    totals = _totals(rows)
    if len(totals) < 2:
        return Lexicon()
    shares = {x: (stand_for or totals)[x] / n for x, n in totals.items()}
    judge = F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == 0
    cuts = choose(rows.filter(~judge), rows.filter(judge), shares)
    lexicon = weigh(rows, totals)
    lexicon.cuts = cuts
    lexicon.slope, lexicon.offset = _logistic(*measured(rows, lexicon, shares))
    return lexicon


def choose(rows: DataFrame, judges: DataFrame, shares: dict[int, float]) -> tuple[float, ...]:
    """The candidate whose curve, with all else learned from ``rows``, gives ``judges`` the least log loss."""
    totals = _totals(rows)
    if len(totals) < 2 or len(_totals(judges)) < 2:
        return CANDIDATES[0]
    lexicon = weigh(rows, totals)
    lexicon.cuts = finest = CANDIDATES[-1]
    (x, toxic, clean), (seen, *truth) = (measured(part, lexicon, shares) for part in (rows, judges))
    losses = []
    for cuts in CANDIDATES:
        coarser = np.array([[bisect_right(cuts, low) - 1 == k for k in range(len(cuts))] for low in finest], float)
        lexicon.slope, lexicon.offset = _logistic(x @ coarser, toxic, clean)
        losses.append(log_loss(lexicon.score(seen @ coarser), *truth))
    return CANDIDATES[int(np.argmin(losses))]


def log_loss(scores: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    p = np.clip(scores, 1e-6, 1 - 1e-6)
    return float(-(toxic * np.log(p) + clean * np.log(1 - p)).sum())


def weigh(rows: DataFrame, totals: dict[int, int]) -> Lexicon:
    """Entries with their weights, and exceptions."""

    def entries(texts: list[str], labels: list[int]) -> Counter:
        return Counter((e, x) for t, x in zip(texts, labels, strict=True) for e in entries_of(folded(t)))

    often = _counted(rows.filter("toxic = 1"), entries).filter(F.col("toxic") >= MIN_TOXIC).select("key")
    # a table of a fixed size that loses no entry held by MIN_TOXIC toxic documents and spares the shuffle most others
    wanted = rows.sparkSession.sparkContext.broadcast(BitFilter.of(often.mapInArrow(_hashed, "hash long")))

    def wanted_entries(texts: list[str], labels: list[int]) -> Counter:
        found = entries(texts, labels)
        keys = list(found)
        passed = wanted.value.has(word_hashes([utf8(k) for k, _ in keys]).view(np.int64)) if keys else []
        return Counter({k: found[k] for k, ok in zip(keys, passed, strict=True) if ok})

    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(t / F.lit(totals[1] + 1.0)) - F.log(c / F.lit(totals[0] + 1.0))
    weight = odds - CAUTION * F.sqrt(1 / t + 1 / c)
    weighed = _counted(rows, wanted_entries).filter(F.col("toxic") >= MIN_TOXIC).select("key", weight.alias("weight")).filter(F.col("weight") > MIN_WEIGHT).collect()
    lexicon = Lexicon(effective({r["key"]: r["weight"] for r in weighed}))

    def phrases(texts: list[str], labels: list[int]) -> Counter:
        found: Counter = Counter()
        automaton = lexicon.automaton()
        for text, label in zip(texts, labels, strict=True):
            words = folded(text)
            places = lexicon.hits(automaton, words)
            if not places:
                continue
            starts, at = {}, 0
            for i, word in enumerate(words):
                starts[at] = i
                at += len(word) + 1
            near = set()
            for i in map(starts.__getitem__, places):
                near |= {f" {words[j]} {words[j + 1]} " for j in (i - 1, i) if 0 <= j < len(words) - 1}
            found.update((p, label) for p in near)
        return found

    excused = _counted(rows, phrases).filter((F.col("toxic") == 0) & (F.col("clean") >= MIN_EXCEPTION))
    lexicon.exceptions = frozenset(r["key"] for r in excused.select("key").collect())

    return lexicon


def measured(rows: DataFrame, lexicon: Lexicon, shares: dict[int, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band sums that occur, in steps, and how many toxic and clean rows have them: no more than there are rows."""

    def steps(texts: list[str], labels: list[int]) -> Counter:
        automaton = lexicon.automaton()
        return Counter((",".join(str(_step(v)) for v in lexicon.bands(automaton, t)), x) for t, x in zip(texts, labels, strict=True))

    counted = _counted(rows, steps).orderBy("key").collect()
    x = np.array([[_amount(int(k)) for k in r["key"].split(",")] for r in counted])
    return x, *(np.array([r[name] for r in counted]) * shares[label] for name, label in (("toxic", 1), ("clean", 0)))


def _step(amount: float) -> int:
    return min(LAST, 1 + int(STEPS * math.log1p(amount))) if amount else 0


def _amount(step: int) -> float:
    return math.expm1((step - 0.5) / STEPS) if step else 0.0


def _logistic(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Slopes (none negative) and offset of the likeliest logistic curve, by damped Newton steps."""
    scale = 2000 / max((toxic + clean).sum(), 1)
    toxic, clean = toxic * scale, clean * scale
    used = np.ones(x.shape[1], bool)
    while True:
        beta = _newton(np.column_stack([x[:, used], np.ones(len(x))]), toxic, clean, ridge)
        if (beta[:-1] >= 0).all():
            slope = np.zeros(len(used))
            slope[used] = beta[:-1]
            return slope, float(beta[-1])
        used[np.flatnonzero(used)[np.argmin(beta[:-1])]] = False


def _newton(design: np.ndarray, toxic: np.ndarray, clean: np.ndarray, ridge: float) -> np.ndarray:
    beta = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (toxic - (toxic + clean) * p) - ridge * beta
        curve = (design * ((toxic + clean) * p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return beta


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score (0 to 1, higher: toxic likelier) and predicted (1 if 0.5 or more) of each row.

    A null text counts as empty; null and repeated ids stay rows of their own; other columns are ignored.
    """
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch, texts in runs(batches, 1):
            scores = lexicon.score(np.array([lexicon.bands(automaton, t) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """The sample to learn from (text, toxic), and how many labelled ids of each label there are to draw from.

    Null ids and null labels teach nothing; an id labelled twice is toxic if any label says so, and of an id that
    several rows have the least text is read.
    """
    taught = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    rows = docs.filter(~held_out() & F.col("doc_id").cast("long").isNotNull()).select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").alias("text"))
    taught = hand_off(taught.join(rows.select("label_id").distinct(), "label_id", "left_semi"), "toxicity-labels")
    each = [taught.filter(F.col("toxic") == x).orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows // 2) for x in (1, 0)]
    # no more than sample_rows ids: texts that are not in the sample stay where they are
    drawn = F.broadcast(hand_off(each[0].unionByName(each[1]), "toxicity-drawn"))
    sample = rows.join(drawn, "label_id").groupBy("label_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    return hand_off(sample.select("text", "toxic"), "toxicity-training"), _totals(taught)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row; learned from labelled rows that are not held out (see ``training``)."""
    lexicon = learn(*training(docs, labels))
    return score(docs, lexicon).select("doc_id", held_out().alias("held_out"), "score", "predicted")
