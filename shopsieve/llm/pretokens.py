"""Encoding by way of pre-tokens: the tokenizers library encodes each distinct one once.

A pre-token here is a stretch between spaces, with the space before it where the vocabulary counts
that as part of the word. No merge of a byte-pair vocabulary crosses such a boundary, so the ids of a
text are those of its pre-tokens one after the other. All of the library's rules (its own finer
splits, normalisation, merges) are left to it: it encodes the pre-tokens, many at a time. Plain ones are laid
end to end as in a text, and the known lengths of tokens say where each of them ends; others are told apart by
the library's own special token between them. Where its rules cut a word from a mark after it, the two are
pre-tokens of their own, so that a word is encoded once with or without marks. Texts in which boundaries might be read differently are given to it
whole: those with strings of special tokens or with unusual white space, and all texts of a
vocabulary of an unknown kind.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections import defaultdict
from itertools import count, islice
from string import ascii_letters, punctuation
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa

from shopsieve.llm.common import release, utf8

#: Distinct pre-tokens a worker remembers; beyond that it keeps at most half, those that came more often.
REMEMBERED = 700_000
#: Pre-tokens encoded in one call of the library.
AT_ONCE = 50

#: White space that the library's regular expressions and Python may tell differently, or that is not plain.
UNUSUAL = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
UNUSUAL_ASCII = "\x0b\x0c\x1c\x1d\x1e\x1f\0"
#: Stands between pre-tokens and is in none.
BETWEEN = "\x1e"
#: Where white space comes in runs, a space does not simply lead a word: a run and what follows is a pre-token.
CHUNK = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
#: Symbols after a letter are cut from it, but an apostrophe may belong to the letters that follow it.
MARKS = np.isin(np.arange(256), [*punctuation.replace("'", "").encode()])
LETTERS = np.isin(np.arange(256), [*ascii_letters.encode()])
#: What is put between a letter and its mark: the end of a pre-token, and a zero byte that says that no space leads the next.
CUT = np.frombuffer(b"\x1e\0", np.uint8)


class _Numbering(dict):
    """Gives each new pre-token the next number and remembers it as still to be encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number


def _marks(raw: np.ndarray) -> np.ndarray:
    """Places of marks right after a letter, a Latin one (which every version of Unicode tells alike); ``raw`` is UTF-8."""
    marks = np.flatnonzero(MARKS[raw])
    first, last = raw[marks - 2], raw[marks - 1]
    # these lead two bytes: U+00C0 to U+024F, without the signs of multiplication and division
    latin = (first == 0xC3) & (last != 0x97) & (last != 0xB7) | (first > 0xC3) & (first < 0xC9) | (first == 0xC9) & (last < 0x90)
    return marks[LETTERS[last] | latin]


def _strings(pieces: pa.LargeBinaryArray) -> list[str]:
    """Pieces that each end with ``BETWEEN``, without it."""
    _, bounds, raw = pieces.buffers()
    if not len(pieces):
        return []
    end = int(np.frombuffer(bounds, np.int64)[len(pieces)])
    return str(memoryview(raw)[:end], "utf-8").split(BETWEEN)[:-1]


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, without added special tokens."""

    def __init__(self, path: str, remembered: int | None = None) -> None:
        self.remembered = remembered
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in described["added_tokens"]]
        before, normalizer = described["pre_tokenizer"] or {}, described["normalizer"]
        plain = all(not t["normalized"] and not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in described["added_tokens"])
        self.leads = before.get("type") == "ByteLevel" and normalizer is None and not before["add_prefix_space"]
        self.cuts_marks = self.leads and before.get("use_regex", True)
        drops = before.get("type") == "Sequence" and any(p["type"] == "Split" and p["behavior"] == "Removed" for p in before["pretokenizers"])
        self.known = plain and bool(self.special) and (self.leads or drops)
        if self.known:
            self.between = self.special[-1]
            self.between_id = self.library.token_to_id(self.between)
            self.lengths = self._token_lengths()
        self._start()

    def _token_lengths(self) -> np.ndarray:
        """Bytes that each id stands for: both kinds write a byte as one character, and one marks the ends of words."""
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        lengths = np.full(max(self.library.get_vocab_size(), *vocabulary.values()) + 1, 1 << 40, np.int64)
        for token, number in vocabulary.items():
            if token not in self.special:
                lengths[number] = len(token.removesuffix("</w>"))
        return lengths

    def _start(self) -> None:
        # gives each new pre-token the next number; those from len(self.sizes) on are still to be encoded
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.begins, self.sizes, self.ids = array("q"), array("q"), array("i")
        self.uses = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the pre-tokens that came more than once, at most half as many as a worker remembers.

        They are laid anew, the most frequent first: what is looked up most stands close together, and the texts that
        the old ones were cut from hold no memory.
        """
        keys, uses, most = list(self.numbers), self.uses, (self.remembered or REMEMBERED) // 2
        least = 2
        if len(uses) > most:
            least = max(least, int(np.partition(uses, -most)[-most]) + 1)
        kept = np.flatnonzero(uses >= least)
        kept = kept[np.argsort(-uses[kept], kind="stable")]
        known, begins, sizes = (np.array(a) for a in (self.ids, self.begins, self.sizes))
        joined = BETWEEN.join([keys[number] for number in kept.tolist()])
        del keys
        self._start()
        for key in joined.split(BETWEEN) if len(kept) else []:
            self.numbers[key]  # numbers it
        n = sizes[kept]
        ends = np.cumsum(n)
        self.begins.frombytes((ends - n).tobytes())
        self.sizes.frombytes(n.tobytes())
        if len(kept):
            self.ids.frombytes(known[np.repeat(begins[kept] - ends + n, n) + np.arange(int(ends[-1]))].tobytes())
        self.uses = np.ones(len(kept), np.int64)

    def _encoded(self, joined: list[str]) -> np.ndarray:
        return np.concatenate([np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(joined, add_special_tokens=False)])

    def _fresh(self, known: int) -> list[str]:
        """Pre-tokens numbered ``known`` and higher, in the order of their numbers."""
        return [*islice(reversed(self.numbers), len(self.numbers) - known)][::-1]

    def _learn(self) -> None:
        """Encode the new pre-tokens, each once."""
        known = len(self.sizes)
        fresh = self._fresh(known)
        if not fresh:
            return
        other = np.ones(len(fresh), bool)
        if self.leads:
            # one that starts with a zero byte is taken as it stands, and may be or hold any white space
            plain = [at for at, p in enumerate(fresh) if p and p[0] != "\0"]
        else:
            # not where composition or lower case changes the length
            plain = [at for at, p in enumerate(fresh) if p.isascii() or is_normalized("NFC", p) and len(utf8(p)) == len(utf8(p.lower()))]
        sizes, found = np.zeros(len(fresh), np.int64), {}
        for first in range(0, len(plain), 100 * AT_ONCE):
            places = plain[first : first + 100 * AT_ONCE]
            ids = self._laid_out([fresh[at] for at in places])
            if ids is not None:
                sizes[places], found[first] = ids[0], (places, ids[1])
                other[places] = False
        rest = np.flatnonzero(other).tolist()
        for first in range(0, len(rest), 100 * AT_ONCE):
            places = rest[first : first + 100 * AT_ONCE]
            sizes[places], own = self._told_apart([fresh[at] for at in places])
            found[-1 - first] = (places, own)
        begins, at = np.zeros(len(fresh), np.int64), len(self.ids)
        for places, own in found.values():
            n = sizes[places]
            begins[places] = at + np.cumsum(n) - n
            self.ids.frombytes(own.tobytes())
            at += len(own)
        self.begins.frombytes(begins.tobytes())
        self.sizes.frombytes(sizes.tobytes())

    def _laid_out(self, some: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Sizes and ids of plain pre-tokens encoded as one text; none unless each is found to end where a token ends."""
        lead = " " * self.leads
        ids = self._encoded([lead + " ".join(some[at : at + AT_ONCE]) for at in range(0, len(some), AT_ONCE)])
        # the bytes of each one, without spaces: none holds a space
        spaces = np.flatnonzero(np.frombuffer(utf8(" ".join([*some, ""])), np.uint8) == ord(" "))
        n_bytes = np.diff(spaces, prepend=-1) - 1 + self.leads
        ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum(n_bytes)
        last = np.searchsorted(ends, wanted)
        if len(ends) == 0 or last[-1] != len(ends) - 1 or not np.array_equal(ends[last], wanted):
            return None
        return np.diff(last, prepend=-1), ids

    def _told_apart(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for any pre-tokens, with the special token between them."""
        if self.leads:
            some = [p[1:] if p[:1] == "\0" else f" {p}" for p in some]
        ids = self._encoded([self.between.join([*some[at : at + AT_ONCE], ""]) for at in range(0, len(some), AT_ONCE)])
        ends = np.flatnonzero(ids == self.between_id)
        if len(ends) != len(some):
            raise ValueError("the library joined or split the special token between pre-tokens")
        return np.diff(ends, prepend=-1) - 1, ids[ids != self.between_id]

    def _split(self, text: str) -> str | None:
        """The text's pre-tokens, each with ``BETWEEN`` after it; none if the library should see it whole."""
        if not self.known or any(map(text.__contains__, UNUSUAL_ASCII)) or not text.isascii() and UNUSUAL.search(text):
            return None
        for string in self.special:
            if string in text:
                return None
        if not self.leads:
            return BETWEEN.join([*text.split(), ""])
        # line breaks between words are pre-tokens of their own
        broken = text.replace("\n", " \0\n \0")
        # a space before white space; a line break before it, other than at the end
        if "\t" in text or "\r" in text or "  " in broken or "\0 " in broken:
            return "".join([f"\0{chunk}{BETWEEN}" for chunk in CHUNK.findall(text)])
        pieces = f"{broken} ".replace(" ", BETWEEN)
        return pieces[1:] if pieces[0] == BETWEEN else "\0" + pieces

    def _numbered(self, texts: list[str]) -> tuple[np.ndarray, list[int], dict[int, np.ndarray]]:
        """Numbers of all pre-tokens, how many each text has, and the texts that the library did whole."""
        if len(self.numbers) > (self.remembered or REMEMBERED):
            self._forget()
        whole, split = {}, []
        for at, text in enumerate(texts):
            pieces = self._split(text)
            if pieces is None:
                whole[at] = np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)
                pieces = ""
            split.append(utf8(pieces))
        raw, upto = np.frombuffer(b"".join(split), np.uint8), np.cumsum([len(s) for s in split], dtype=np.int64)
        if self.cuts_marks:
            cuts = _marks(raw)
            raw = np.insert(raw, np.repeat(cuts, len(CUT)), np.tile(CUT, len(cuts)))
            upto += len(CUT) * np.searchsorted(cuts, upto)
        ends = np.append(0, np.flatnonzero(raw == ord(BETWEEN)) + 1).astype(np.int64)
        counts = np.diff(np.searchsorted(ends, upto, "right"), prepend=1).tolist()
        # Arrow tells the distinct ones of these texts, so that each is looked up once
        flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        found = flat.dictionary_encode()
        distinct = _strings(found.dictionary)
        numbers = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))[found.indices.to_numpy()]
        del split, raw, ends, flat, found, distinct
        self._learn()
        uses = np.bincount(numbers, minlength=len(self.numbers))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        return numbers, counts, whole

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as int32."""
        numbers, counts, whole = self._numbered(texts)
        known, begins, sizes = (np.frombuffer(a, t) for a, t in ((self.ids, np.int32), (self.begins, np.int64), (self.sizes, np.int64)))
        n = sizes[numbers] if len(numbers) else np.zeros(0, np.int64)
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = known[np.repeat(begins[numbers] - ends + n, n) + np.arange(total)] if total else np.zeros(0, np.int32)
        cuts = np.append(0, ends)[np.cumsum(counts)] if counts else []
        del known, begins, sizes  # else the arrays could not grow
        out, start = [], 0
        for k, end in enumerate(cuts):
            out.append(whole[k] if k in whole else ids[start:end])
            start = end
        return out

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text: per-document frequencies of pre-tokens times pieces of each; no ids."""
        numbers, counts, whole = self._numbered(texts)
        docs = np.repeat(np.arange(len(texts)), counts)
        span = len(self.numbers) + 1
        pairs, often = np.unique(docs * span + numbers, return_counts=True)
        pieces = np.array(self.sizes, np.int64)
        total = np.zeros(len(texts), np.int64)
        if len(pairs):
            np.add.at(total, pairs // span, often * pieces[pairs % span])
        for k, ids in whole.items():
            total[k] = len(ids)
        return total


_encoders: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """One for each Python worker, file and bound (else ``REMEMBERED``), kept from task to task."""
    if (path, remembered) not in _encoders:
        _encoders[path, remembered] = Encoder(path, remembered)
        release()  # what reading the file took
    return _encoders[path, remembered]


def vocabulary_file(name: str) -> str:
    """Place of a public vocabulary file; on a cluster every machine has the package installed."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
