"""Token ids of whole texts, with each distinct word encoded once per worker.

The byte-level and word-level tokenizers used here merge within the words that their pattern cuts from the text. The pattern is followed here by
comparing the classes of neighbouring characters, for many texts at once; the tokenizers library encodes every
distinct word, and ids are gathered by number. Strings of special tokens are ordinary text, or with ``special`` cut out
first, as the library does by default; they then get their own ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np

from tillsight.llm.common import slices
from tillsight.llm.hashing import Runs

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Code points with the property White_Space.
SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SLICE = 1_000_000
#: Words kept per worker; beyond that it starts afresh.
_KEEP = 700_000
#: New words that the library encodes in one call.
_AT_ONCE = 1_000


def _classes(size: int) -> np.ndarray:
    first = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(size)), dtype=np.uint8, count=size)
    table[SPACES] = SPACE
    return table


class Words:
    """Cuts texts into the words of a tokenizer's pattern; ``spaced``: a blank belongs to the word after it."""

    def __init__(self, spaced: bool):
        self.spaced, self.table = spaced, _classes(0x10000)

    def cut(self, cp: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words of joined texts that begin at ``firsts`` (ascending, none empty)."""
        if len(cp) and cp.max() >= len(self.table):
            self.table = _classes(0x110000)
        kind = self.table[cp]
        n = len(cp)
        before = np.empty_like(kind)
        before[0], before[1:] = OTHER, kind[:-1]
        begins = np.zeros(n, dtype=bool)
        begins[firsts] = True
        start = kind != before
        if self.spaced:
            # A blank goes to the word after it; of longer white space only the last character can.
            after = np.empty_like(kind)
            after[-1], after[:-1] = SPACE, kind[1:]
            after[firsts[1:] - 1] = SPACE
            space = kind == SPACE
            blank_before = np.empty(n, dtype=bool)
            blank_before[0], blank_before[1:] = False, cp[:-1] == 32
            start |= space & (before == SPACE) & (after != SPACE)
            start &= space | ~blank_before
        else:
            start |= kind == NUMBER
        start[firsts] = True
        self._contractions(cp, start, begins)
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], n)
        if not self.spaced:
            worded = kind[starts] != SPACE
            starts, ends = starts[worded], ends[worded]
        return starts, ends

    @staticmethod
    def _contractions(cp: np.ndarray, start: np.ndarray, begins: np.ndarray) -> None:
        """An apostrophe at a word's start keeps the letters s, t, m, d or re, ve, ll after it in one word."""
        n = len(cp)
        at = np.flatnonzero((cp == 39) & start)
        at = at[(at + 1 < n)]
        at = at[~begins[at + 1]]
        for letters in ("s", "t", "m", "d", "re", "ve", "ll"):
            size = len(letters)
            here = at[at + size < n]
            for j, c in enumerate(letters, 1):
                here = here[(cp[here + j] == ord(c)) & ~begins[here + j]]
            start[here + 1] = False
            rest = here + size + 1
            start[rest[rest < n]] = True


def _cuttable(text: str, limit: int) -> Iterator[str]:
    """Pieces of a long text, cut before a blank that follows something else: a word starts there in any case."""
    while len(text) > limit:
        at = text.find(" ", limit)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[:at]
        text = text[at:]
    yield text


class Encoder:
    """``encode(texts)`` yields the ids of each text. ``kind``: "byte" (byte-level words) or "word" (lower case, no blanks).

    ``special``: strings of added tokens become these tokens, as in the library's encode; else they are ordinary text.
    """

    def __init__(self, path: str, kind: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind, self.words = kind, Words(kind == "byte")
        self.added = self._added(path) if special else {}
        self.cuts = re.compile("(%s)" % "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self._forget()

    @staticmethod
    def _added(path: str) -> dict[str, int]:
        with open(path, encoding="utf-8") as f:
            tokens = json.load(f).get("added_tokens") or []
        if odd := [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]:
            raise ValueError(f"added tokens that are not plain strings: {odd}")
        return {t["content"]: t["id"] for t in tokens}

    def _forget(self) -> None:
        # Known words: sorted hashes with their numbers; in arrays they take a tenth of a dictionary's memory.
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.offsets, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.used = np.zeros(1 << 18, np.int32), 0

    def _normal(self, text: str) -> str:
        if self.kind == "byte":
            return text
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        k = len(self.keys)
        while k + len(words) > len(self.lengths):
            self.offsets, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.offsets, self.lengths))
        # One encoding for many words, each a sequence's piece: an encoding of its own for each word takes over a kilobyte.
        for first in range(0, len(words), _AT_ONCE):
            run = words[first: first + _AT_ONCE]
            found = self.tokenizer.encode(run, is_pretokenized=True, add_special_tokens=False)
            ids, of = np.array(found.ids, np.int32), np.array(found.word_ids, np.int64)
            at, lengths = slice(k + first, k + first + len(run)), np.bincount(of, minlength=len(run))
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.used: self.used + len(ids)] = ids
            self.lengths[at] = lengths
            self.offsets[at] = self.used + np.cumsum(lengths) - lengths
            self.used += len(ids)
        before = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, before, hashes)
        self.numbers = np.insert(self.numbers, before, np.arange(k, k + len(words), dtype=np.int32))

    def _slice(self, texts: list[str]) -> list[np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(texts)
        firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
        if not len(firsts):
            return [np.zeros(0, np.int32) for _ in texts]
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts, ends = self.words.cut(cp, firsts)
        hashes, at, which = np.unique(Runs(cp).hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(hashes) > _KEEP:
            self._forget()
        new = np.flatnonzero(~np.isin(hashes, self.keys, assume_unique=True)) if len(self.keys) else np.arange(len(hashes))
        if len(new):
            s, e = starts[at[new]].tolist(), ends[at[new]].tolist()
            self._learn([joined[a:b] for a, b in zip(s, e, strict=True)], hashes[new])
        place = self.numbers[np.searchsorted(self.keys, hashes)][which]
        lengths = self.lengths[place]
        reach = np.cumsum(lengths)
        total = int(reach[-1]) if len(reach) else 0
        ids = self.pool[np.repeat(self.offsets[place] - reach + lengths, lengths) + np.arange(total)]
        sums = np.concatenate([[0], reach])
        bounds = sums[np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """int32 ids of each text in turn; a null text has none."""
        if not self.added:
            yield from self._pieces(t or "" for t in texts)
            return
        tokens: list[list[int]] = []

        def pieces() -> Iterator[str]:
            for t in texts:
                cut = self.cuts.split(t) if t and any(a in t for a in self.added) else [t or ""]
                tokens.append([self.added[a] for a in cut[1::2]])
                yield from cut[::2]

        # What lies between two special tokens is encoded as a text of its own.
        ids = self._pieces(pieces())
        for i in range(len(texts)):
            out = [next(ids)]
            for token in tokens[i]:
                out += [np.array([token], np.int32), next(ids)]
            yield np.concatenate(out) if len(out) > 1 else out[0]

    def _pieces(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        for _, run in slices(map(self._normal, texts), _SLICE):
            if len(run) == 1 and len(run[0]) > 2 * _SLICE:
                yield np.concatenate([self._slice([p])[0] for p in _cuttable(run[0], _SLICE)])
            else:
                yield from self._slice(run)


@functools.cache
def encoder(path: str, kind: str, special: bool = False) -> Encoder:
    """The worker's own encoder: the words it knows serve its later tasks too."""
    return Encoder(path, kind, special)
