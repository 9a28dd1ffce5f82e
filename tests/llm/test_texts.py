"""Operators that judge each text by itself, against plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shopsieve.llm import common, packing, pretokens, quality, secret_scan, token_counts, token_files, toxicity
from shopsieve.llm.pretokens import Encoder, vocabulary_file

from conftest import SMALL
from edge_rows import edge_docs, no_docs  # noqa: F401

BYTES, WORDS = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("word_bpe_49k.json")
ODD = ["", " ", "  ", "\n", " a", "a ", "a  b", "a   b", " \n x", "x\n\ny z", "don't  go", "a<|endoftext|>b c", "İ, Σς ﬁ", "a\tb\r\nc\x1cd\xa0e", "x\0y z"]


def library(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_is_the_library(path, spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    encoder, want = Encoder(path), library(path, texts)
    assert [i.tolist() for i in encoder.encode(texts)] == want
    assert encoder.count(texts).tolist() == [len(w) for w in want]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_forgets_and_stays_the_library(path, monkeypatch):
    """What is kept is laid anew, the most frequent first, in strings of their own: the lookups touch less memory."""
    monkeypatch.setattr(pretokens, "REMEMBERED", 50)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{n}" for n in rng.zipf(1.3, 60) % 500) + rng.choice(["", ".", " \n x  y", "\n", " é"]) for _ in range(60)]
    encoder = Encoder(path)
    for at in range(0, len(texts), 5):
        assert [i.tolist() for i in encoder.encode(texts[at : at + 5])] == library(path, texts[at : at + 5])
    uses, keys = encoder.uses.copy(), list(encoder.numbers)
    encoder._forget()
    kept = list(encoder.numbers)
    often = [uses[keys.index(k)] for k in kept]
    assert 2 < len(kept) <= 25 and often == sorted(often, reverse=True)
    assert [i.tolist() for i in encoder.encode(texts)] == library(path, texts)


def test_token_counts(edge_docs, no_docs):
    source = edge_docs.collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(i), len(i) > 1024) for r, i in zip(source, library(BYTES, [r.text for r in source]), strict=True)]
    assert rows(token_counts.token_counts(edge_docs, BYTES)) == sorted(want, key=str)
    assert token_counts.token_counts(no_docs, BYTES).count() == 0


def test_packing_places_each_id_once(edge_docs, no_docs):
    got = packing.pack(edge_docs, WORDS).collect()
    source = edge_docs.collect()
    whole = Counter((r.doc_id, tuple([*i, 1])) for r, i in zip(source, library(WORDS, [r.text for r in source]), strict=True))
    by_sequence: dict[int, list] = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    want = Counter()
    for (doc_id, ids), n in whole.items():
        want[doc_id, len(ids)] += n * len(ids)
    have = Counter()
    for r in got:
        have[r.doc_id, r.doc_tokens] += r.length
        assert any(d == r.doc_id and len(i) == r.doc_tokens and zlib.crc32(np.array(i[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for d, i in whole)
    assert have == want
    assert packing.pack(no_docs, WORDS).count() == 0


def test_packing_wastes_little():
    packer, rng = packing.Packer(0, 2048), np.random.default_rng(1)
    sizes = rng.integers(1, 6000, 400)
    for k, n in enumerate(sizes):
        packer.add(k, np.arange(n, dtype=np.int32))
    packer.finish()
    sequences = len({r[5] for r in packer.rows})
    assert sum(r[2] for r in packer.rows) == sizes.sum()
    assert sequences * 2048 <= 1.01 * sizes.sum() + 2048


def test_waiting_pieces_keep_no_documents():
    """Else a few ids that wait for their sequence would hold all those of their text."""
    packer = packing.Packer(0, 2048)
    for k in range(50):
        packer.add(k, np.arange(200_000 + k, dtype=np.int32))
    waiting = [p[2] for held in packer.open.values() for p in held]
    assert waiting and all(ids.base is None for ids in waiting)


def test_encoders_have_their_own_bounds(monkeypatch):
    released = []
    monkeypatch.setattr(pretokens, "release", lambda: released.append(1))
    monkeypatch.setattr(pretokens, "_encoders", {})
    texts = [f"w{n} w{n + 1} w{n % 7}" for n in range(300)]
    small, large = pretokens.encoder(WORDS, 60), pretokens.encoder(WORDS)
    assert small is pretokens.encoder(WORDS, 60) is not large and len(released) == 2
    for at in range(0, 300, 20):
        want = library(WORDS, texts[at : at + 20])
        for encoder in (small, large):
            assert [i.tolist() for i in encoder.encode(texts[at : at + 20])] == want
    assert len(small.numbers) < 120 < len(large.numbers)
    assert packing.REMEMBERED < pretokens.REMEMBERED


def test_token_file_codes():
    rng = np.random.default_rng(0)
    for _ in range(30):
        counts = rng.integers(1, 9, rng.integers(1, 6))
        ranks = rng.choice([3, 200, 300, 70_000, 1 << 25], counts.sum())
        control, data = token_files.pack_ranks(ranks, counts)
        assert (token_files.unpack_ranks(control, data, counts) == ranks).all()


def test_token_files_round_trip(spark, edge_docs, no_docs, tmp_path):
    token_files.write(edge_docs, str(tmp_path / "a"), BYTES)
    got = token_files.read(spark, str(tmp_path / "a")).orderBy("start").collect()
    source = edge_docs.collect()
    whole = [(r.doc_id, [*i, 0]) for r, i in zip(source, library(BYTES, [r.text for r in source]), strict=True)]
    whole.sort(key=lambda x: (x[0] is not None, x[0] or 0, len(x[1])))
    at = 0
    for r, (doc_id, ids) in zip(got, whole, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, at, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        at += len(ids)
    token_files.write(no_docs, str(tmp_path / "b"), BYTES)
    assert token_files.read(spark, str(tmp_path / "b")).count() == 0


def plain_spans(text):
    """Base spans by the contract's own words."""
    keys = r"((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))"
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(keys + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_secrets(spark, edge_docs, no_docs, tmp_path):
    got = secret_scan.digest(secret_scan.scan(edge_docs, str(tmp_path / "a")))
    want = [(r.doc_id, plain_spans(r.text or "")) for r in edge_docs.collect()]
    assert rows(got.select("doc_id", "spans")) == sorted(want, key=str)
    assert secret_scan.scan(no_docs, str(tmp_path / "b")).count() == 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = secret_scan.digest(secret_scan.scan(docs, str(tmp_path / "c")))
    assert rows(got.select("doc_id", "spans")) == sorted(((r.doc_id, plain_spans(r.text)) for r in docs.collect()), key=str)


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    folder = str(tmp_path)
    first = spark.createDataFrame([(1, "token=aaaaaaaa"), (2, "none")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "token=aaaaaaaa"), (4, "token=bbbbbbbb")], "doc_id long, text string")
    secret_scan.update(first, folder)
    secret_scan.update(second, folder)
    secret_scan.update(second, folder)
    assert spark.read.parquet(f"{folder}/findings").count() == 3
    found = secret_scan.scan(first.unionAll(second), folder).filter("size(spans) > 0")
    assert {r.doc_id for r in found.collect()} == {1, 3, 4}
    secret_scan.update(second, folder, version="next")
    assert spark.read.parquet(f"{folder}/findings").filter("rules = 'next'").count() == 2


def test_other_rules_scan_anew(spark, tmp_path):
    docs = spark.createDataFrame([(1, "token=aaaaaaaa XYZ-1234")], "doc_id long, text string")
    rules = (*secret_scan.RULES[:1], secret_scan.Rule("ticket", "XYZ-[0-9]+"))
    for _ in range(2):
        first = secret_scan.scan(docs, str(tmp_path)).first().spans
        second = secret_scan.scan(docs, str(tmp_path), rules=rules).first().spans
        assert [s.kind for s in first] == ["assign"] and [s.kind for s in second] == ["assign", "ticket"]
    assert spark.read.parquet(f"{tmp_path}/findings").count() == 2


def test_quality_statistics_against_plain_python(spark, edge_docs):
    import re

    docs = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()] + [r.text for r in edge_docs.collect()]
    for text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, again = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        repeats = plain_repeats(words)
        counts = dict(zip(quality.COUNTS, quality.statistics(text)[0], strict=True))
        assert counts == {
            "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": again, "n_repeat_words": repeats,
        }
        assert quality.base_failed(list(counts.values())) == (len(words) < 20 or 100 * repeats > 30 * len(words))


def test_quality_in_place_agrees_with_the_table(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in quality.quality_rules(docs, labels).filter("kept").collect()}
    assert {r.doc_id for r in quality.keep_good(docs, labels).collect()} == kept
    plan = quality.keep_good(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def plain_repeats(words):
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    return len(hit)


def test_repeated_words():
    rng = np.random.default_rng(2)
    for n, kinds in [(0, 1), (7, 1), (8, 1), (9, 1), (60, 2), (200, 3), (200, 50)]:
        words = [str(w).encode() for w in rng.integers(0, kinds, n)]
        assert quality.repeated_words(words) == plain_repeats(words)
    many = [str(i).encode() for i in range(40_000)]
    assert quality.repeated_words(many + many[:9]) == 18


def test_quality(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (None, 0, 0), (5, None, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(edge_docs, labels)
    for r in got.collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert got.count() == edge_docs.count()
    assert quality.quality_rules(no_docs, labels).count() == 0
    assert quality.keep_good(no_docs, labels).count() == 0
    kept = quality.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns


def test_isolation_forest_finds_outliers():
    rng = np.random.default_rng(3)
    rows_ = np.vstack([rng.normal(0, 1, (500, 3)), [[9, 9, 9], [-8, 0, 9]]])
    scores = quality.Forest.fit(rows_, trees=50, tree_rows=256).score(rows_)
    assert set(np.argsort(scores)[-2:]) == {500, 501}


def test_toxicity_learns_only_from_rows_that_are_not_held_out(spark, no_docs):
    rng = np.random.default_rng(4)
    plain = [f"w{i}x" for i in range(80)]
    docs, labels = [], []
    for i in range(600):
        words = [str(w) for w in rng.choice(plain, 30)]
        if i % 4 == 0:
            words[3:3] = [["m0r0n", "moron", "МОRОN".lower()][i % 3], "idiot!"]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs += [(9000, None), (None, "a moron"), (9001, "")]
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    for i in range(600):
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i].predicted == int(i % 4 == 0)
    assert got[9000].predicted == got[9001].predicted == 0
    assert toxicity.toxicity(no_docs, labels).count() == 0


def test_rarer_words_are_weighed_among_many_frequent_ones(spark):
    rng = np.random.default_rng(5)
    ordinary = " ".join("".join(rng.choice(list("abcdefgh"), 10)) for _ in range(21_000))
    rows = [(f"{ordinary} {'grubnak' if k < 10 else ''}", 1) for k in range(12)] + [(ordinary, 0) for _ in range(30)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int").repartition(8))
    automaton = lexicon.automaton()
    assert lexicon.measure(automaton, "a grubnak") > 0 and lexicon.measure(automaton, rows[-1][0]) == 0


def test_all_exception_phrases_count(spark):
    phrases = " ".join(f"vile x{chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(6_000))
    rows = [(f"so vile {'abcdefghijklmnopqrstuvwxyz'[k % 26] * 3}", 1) for k in range(30)] + [("so good", 0)] * 37 + [(phrases, 0)] * 3
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int").repartition(4))
    automaton = lexicon.automaton()
    assert lexicon.measure(automaton, "vile") > 0 and lexicon.measure(automaton, phrases) == 0


def test_weaker_entries_count_at_any_size(spark):
    """The heaviest entry's weight grows with the rows; a word of few toxic rows counts all the same."""
    for times in (1, 30):
        rows = [(f"so you grubnak {k}", 1) for k in range(400 * times)] + [(f"a plain day {k}", 0) for k in range(600 * times)]
        rows += [("such a vorwick day", 1)] * 40 + [("such a plain day", 0)] * 40
        lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"))
        automaton = lexicon.automaton()
        assert lexicon.measure(automaton, "vorwick") > 0 and lexicon.measure(automaton, "such a plain day") == 0
        weak, clean = lexicon.score(np.array([lexicon.bands(automaton, t) for t in ("such a vorwick day", "such a plain day")]))
        assert weak >= 0.5 > clean


def test_weak_bands_do_not_drown_strong_ones():
    """Rows: sums of two bands; the first is noise, the second tells."""
    x = np.array([[v, s] for v in (0.0, 4.0, 8.0) for s in (0.0, 3.0)])
    slope, offset = toxicity._logistic(x, np.array([0, 9, 0, 6, 0, 5.0]), np.array([40, 0, 60, 0, 80, 0.0]))
    predicted = x @ slope + offset >= 0
    assert (slope >= 0).all() and (predicted == (x[:, 1] > 0)).all()


def test_outweighed_entries_never_count():
    weights = {" trash ": 2.0, " tras": 2.0, " trashy": 3.0, " trashier ": 1.0, " idiot ": 3.0, " idio": 2.0, " bad ": 1.0, " moro": 1.0, " moro ": 1.5}
    few = toxicity.effective(weights)
    assert set(few) == set(weights) - {" trash ", " trashier "}
    for text in ("trash trashy trashier trasher", "idiot idiotic idio bad badly", "moro moron"):
        a, b = (toxicity.Lexicon(w) for w in (weights, few))
        assert a.hits(a.automaton(), text.split()) == b.hits(b.automaton(), text.split())


def test_exception_phrases_and_folding():
    lexicon = toxicity.Lexicon({" trash ": 5.0, " idio": 3.0}, frozenset([" trash can "]), 1.0, -2.0)
    automaton = lexicon.automaton()
    hits = lambda text: sum(lexicon.hits(automaton, toxicity.folded(text)).values())
    assert hits("what TRASH") == 5 and hits("a trash can here") == 0 and hits("trash can and trash") == 5
    assert hits("1d10tic") == 3 and hits("") == 0


def _toxic_rows(n, seed=9):
    """Texts with strong, weak and excused toxic words, and their labels."""
    rng = np.random.default_rng(seed)
    plain = [f"w{i}x" for i in range(40)]
    out = []
    for i in range(n):
        words, bad = [str(w) for w in rng.choice(plain, 12)], int(rng.random() < 0.3)
        if bad:
            words[2:2] = [["grubnak", "vorwick", "grubnaks"][i % 3]]
        elif rng.random() < 0.03:
            words[2:2] = ["vorwick", "street"]
        out.append((" ".join(words), bad))
    return out


def test_weights_exceptions_and_scores_are_the_formulas(spark):
    """Against plain counts: every entry of every row, the lower bound of its log odds, and the words around hits."""
    rows_ = _toxic_rows(400)
    totals = Counter(x for _, x in rows_)
    lexicon = toxicity.weigh(spark.createDataFrame(rows_, "text string, toxic int").repartition(5), totals)
    held = {x: Counter(e for t, y in rows_ if y == x for e in toxicity.entries_of(toxicity.folded(t))) for x in (0, 1)}
    want = {}
    for entry, n in held[1].items():
        t, c = n + 0.5, held[0][entry] + 0.5
        weight = np.log(t / (totals[1] + 1)) - np.log(c / (totals[0] + 1)) - toxicity.CAUTION * np.sqrt(1 / t + 1 / c)
        if n >= toxicity.MIN_TOXIC and weight > toxicity.MIN_WEIGHT:
            want[entry] = weight
    heaviest = lambda word: max((w for e, w in want.items() if e == f" {word} " or not e.endswith(" ") and word.startswith(e[1:])), default=0)
    assert lexicon.weights.keys() <= want.keys() and all(np.isclose(w, want[e]) for e, w in lexicon.weights.items())
    phrases = {0: Counter(), 1: Counter()}
    for text, label in rows_:
        words = toxicity.folded(text)
        pairs = zip(words, words[1:], strict=False)
        phrases[label].update({f" {a} {b} " for a, b in pairs if heaviest(a) or heaviest(b)})
    excused = {p for p, n in phrases[0].items() if n >= toxicity.MIN_EXCEPTION and p not in phrases[1]}
    assert lexicon.exceptions == excused and " vorwick street " in excused
    lexicon.cuts, lexicon.slope, lexicon.offset = (0.0, 3.0), np.array([0.5, 2.0]), -1.5
    automaton = lexicon.automaton()
    for text, _ in rows_:
        words, sums = toxicity.folded(text), [0.0, 0.0]
        free = {i + k for i in range(len(words) - 1) for k in (0, 1) if f" {words[i]} {words[i + 1]} " in excused}
        for i, word in enumerate(words):
            if i not in free and heaviest(word):
                sums[int(heaviest(word) >= 3.0)] += heaviest(word) / (1 + np.log1p(len(words) / toxicity.UNIT_WORDS))
        score = 1 / (1 + np.exp(-(0.5 * sums[0] + 2.0 * sums[1] - 1.5)))
        assert np.isclose(lexicon.score(np.array([lexicon.bands(automaton, text)]))[0], score)


def test_held_out_labels_change_no_score(spark):
    rows_ = _toxic_rows(500, 10)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows_)], "doc_id long, text string")
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    scores = []
    for flipped in (False, True):
        labels = spark.createDataFrame([(i, x ^ int(flipped and out(i))) for i, (_, x) in enumerate(rows_)], "doc_id long, toxic int")
        scores.append({r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()})
    assert scores[0] == scores[1] and len(set(scores[0].values())) > 2


def test_the_sample_is_bounded_and_stands_for_all(spark):
    """An id with a third of all rows teaches once; each label has its half of the sample."""
    rows_ = [(i, f"text {i}") for i in range(1, 1000)] + [(1, f"copy {k}") for k in range(500)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, int(i % 10 == 1)) for i in range(1, 1200)] + [(None, 1), (2, None), (1, 0)], "doc_id long, toxic int")
    taught = [i for i in range(1, 1000) if zlib.crc32(str(i).encode()) % 5]
    sample, totals = toxicity.training(docs, labels, sample_rows=100)
    assert totals == Counter(int(i % 10 == 1) for i in taught)
    assert Counter(r.toxic for r in sample.collect()) == {1: 50, 0: 50}
    everything, _ = toxicity.training(docs, labels)
    texts = [r.text for r in everything.collect()]
    assert sorted(texts) == sorted("copy 0" if i == 1 else f"text {i}" for i in taught)


def test_toxicity_of_edge_rows(spark, edge_docs):
    labels = spark.createDataFrame([(i, i % 2, "z") for i in range(9)], "doc_id long, toxic int, text string")
    for marks in (labels, labels.limit(0)):
        got = toxicity.toxicity(edge_docs, marks).collect()
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in edge_docs.collect())
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_bands_are_chosen_by_rows_that_taught_nothing(spark):
    """Weak words of either kind of text and one strong word: a slope of its own for the strong one has the smaller loss."""
    rng = np.random.default_rng(6)
    rows_ = []
    for i in range(1200):
        bad = i % 3 == 0
        weak = [f"q{k}weak" for k in range(12) if rng.random() < (0.5 if bad else 0.15)]
        rows_.append((" ".join([f"n{i}", *weak, *["grubnak"] * bad]), int(bad)))
    frame = spark.createDataFrame(rows_, "text string, toxic int")
    lexicon = toxicity.learn(frame)
    assert lexicon.cuts in toxicity.CANDIDATES and len(lexicon.cuts) > 1
    scores = lexicon.score(np.array([lexicon.bands(lexicon.automaton(), t) for t, _ in rows_]))
    assert ((scores >= 0.5) == np.array([x for _, x in rows_])).all()


def test_words_with_marks_are_laid_together(spark):
    """Before and after the word is known by itself, at starts of lines, and beside what the library cuts in another way."""
    texts = ["word. word, Über. é, x\nword. word,\n\nword.", "a. a", "b b. b,", "word.. word., .word ,", "don't. it's, 's. 1. a1, ǅ. ʰ, 日本.", "", "."]
    encoder = Encoder(BYTES)
    for order in (texts, texts[::-1], texts):
        want = library(BYTES, order)
        assert [i.tolist() for i in encoder.encode(order)] == want
        assert Encoder(BYTES).count(order).tolist() == [len(w) for w in want]


MARKED = ["{}{}".format(word, mark) for word in ("Über", "ab", "zɏ", "x×", "ɐ", "日", "a1", "it's", "'s", "l'") for mark in ["", *".,;:!?\"()-_%$|'", "%%%", ".b", "'s", "'%re", ".\n", "\n,", "\t.", "  !"]]


def test_marks_are_cut_where_the_library_cuts():
    """After Latin letters, at every mark but the apostrophe; after others, and at the edges of texts and runs, as before."""
    rng = np.random.default_rng(8)
    texts = [*MARKED, *(f" {m}" for m in MARKED), *(" ".join(rng.choice(MARKED, 12)) for _ in range(200)), "", ".", " .", "\n."]
    for path in (BYTES, WORDS):
        encoder = Encoder(path)
        for some in (texts, texts[::-1], [""], ["."], []):
            want = library(path, some)
            assert [i.tolist() for i in encoder.encode(some)] == want
            assert encoder.count(some).tolist() == [len(w) for w in want]


def test_words_are_given_to_the_library_and_looked_up_once(monkeypatch):
    """Whatever marks follow them and however often they come in the texts that are encoded together."""
    given, looked_up = Counter(), Counter()
    encoder, encoded = Encoder(BYTES), Encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda joined: (given.update(re.findall(r"wor\w+", "\n".join(joined))), encoded(encoder, joined))[1])

    class Watched(type(encoder.numbers)):
        def __getitem__(self, piece):
            looked_up[piece] += 1
            return super().__getitem__(piece)

    encoder.numbers = Watched(encoder.numbers.default_factory)
    words = [f"wor{a}{b}" for a in "abcdefgh" for b in "ijklmnop"]
    texts = [" ".join(f"{w}{mark}" for w in words) for mark in ("", ";", "!?", "%%%", ":", ")")] * 3
    assert [i.tolist() for i in encoder.encode(texts)] == library(BYTES, texts)
    assert set(words) <= set(given) and sum(given.values()) <= 2 * len(words)  # with and without a space before it at most
    assert max(looked_up.values()) == 1


def test_workers_give_freed_memory_back(monkeypatch):
    """After a number of runs and when the batches end, before the next task uses the worker."""
    released = []
    monkeypatch.setattr(common, "release", lambda: released.append(len(seen)))
    monkeypatch.setattr(common, "RUN_ROWS", 2)
    monkeypatch.setattr(common, "RUNS_KEPT", 3)
    batch, seen = pa.RecordBatch.from_pydict({"text": [*"abcde"]}), []
    for part, texts in common.runs(iter([batch] * 3), 0):
        assert part.column(0).to_pylist() == texts
        seen += texts
    assert "".join(seen) == "abcde" * 3 and released == [5, 10, 15, 15]


def test_release_shrinks_this_process():
    def resident():
        return sum(int(line.split()[1]) for line in open("/proc/self/smaps_rollup") if line.startswith("Private_Dirty"))

    held = [bytes(1000) for _ in range(100_000)]
    held[::1] = [held[-1]]  # all but the last, which keeps the heap from ending before them
    before = resident()
    common.release()
    assert resident() < before - 50_000
