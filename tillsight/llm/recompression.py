"""Removal of repeated word windows by recompression: equal windows have a symbol of the grammar in common.

The words of all documents are compressed in rounds. A round of runs names each maximal run of one symbol; a round of pairs
deals the symbols to a left and a right class by a hash and names each neighbouring (left, right). A name is a function of what it
stands for and of the round, so it is the same in every document and every task without a table of names. In a window the symbols
at its ends may be compressed together with what lies outside; they are popped, round by round (a run at either end; a right one at the start,
a left one at the end). What remains is compressed alike wherever the window stands. Of the last round that leaves any symbol, two neighbours are chosen
(the longest pair, then by hash, then the leftmost; the symbol itself where it is alone). Their pair is the window's anchor: equal windows
have equal anchors at equal places.

Consecutive windows with one anchor form a unit, about one for six words. Spark names these globally: anchors that stand once cannot repeat; units
equal in all words repeat wholly, all but the first; only windows of unequal units of one anchor are compared one by one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import parts, slices, small, with_key
from tillsight.llm.hashing import Runs, blank_words, mix
from tillsight.session import discard, materialise

WINDOW = 20
#: One round of runs, then pairs: with windows of 20 words, anchors come to about seven words.
ROUNDS = "RPPP"
#: Words that are compressed together; longer texts are cut into overlapping blocks, which give the same anchors.
BLOCK = 1 << 20
#: Keys that are broadcast at most; more are joined by a shuffle.
FEW = 50_000

_U = np.uint64
_K1, _K2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def _runs(sym: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of maximal runs of one symbol, and the flags of their first symbols; ``fresh`` flags a document's first symbol."""
    new = fresh.copy()
    new[1:] |= sym[1:] != sym[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(sym))).astype(_U)
    return np.where(count > 1, mix(sym[at] * _K1 + count), sym[at]), new


def _pairs(sym: np.ndarray, fresh: np.ndarray, right: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names after each left symbol was joined with a right one that follows, and the flags of first symbols."""
    new = np.ones(len(sym), dtype=bool)
    new[1:] = ~(right[1:] & ~right[:-1]) | fresh[1:]
    at = np.flatnonzero(new)
    follower = np.minimum(at + 1, len(sym) - 1)
    return np.where(new[follower], sym[at], mix(mix(sym[at] + _U(level + 1)) * _K2 + sym[follower])), new


def _choose(sym: np.ndarray, length: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Of the symbols lo..hi-1 of each window: the longest, then the one of least hash, then the leftmost; the number of its first one."""
    rank = ((_U(63) - np.minimum(length, 63).astype(_U)) << _U(56)) | (mix(sym) >> _U(8))
    best, where = rank[lo], lo.copy()
    live, step = np.flatnonzero(lo + 1 < hi), 1
    while len(live):
        r = rank[lo[live] + step]
        lower = live[r < best[live]]
        best[lower] = rank[lo[lower] + step]
        where[lower] = lo[lower] + step
        step += 1
        live = live[lo[live] + step < hi[live]]
    return where


def anchors(sym: np.ndarray, fresh: np.ndarray, window: int = WINDOW, rounds: str = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, their anchors' names and first words. ``sym``: a hash per word; ``fresh``: a document's first word."""
    n = len(sym)
    ends = np.append(np.flatnonzero(fresh)[1:], n)
    starts = np.arange(n)
    starts = starts[starts + window <= ends[np.cumsum(fresh) - 1]]
    name, place = np.zeros(len(starts), _U), np.zeros(len(starts), np.int64)
    lo, hi, live, at = starts.copy(), starts + window, np.arange(len(starts)), np.arange(n)

    def settle(which):
        if not len(which):
            return
        length = np.diff(np.append(at, n))
        pair, alone = mix(mix(sym) * _K2 + np.append(sym[1:], _U(0))), hi[which] - lo[which] == 1
        chosen = _choose(pair, length + np.append(length[1:], 0), lo[which], hi[which] - ~alone)
        name[which], place[which] = np.where(alone, sym[chosen], pair[chosen]), at[chosen]

    for level, kind in enumerate(rounds):
        if not len(live):
            break
        first, last = lo[live], hi[live] - 1
        if kind == "R":
            names, new = _runs(sym, fresh)
            to = np.cumsum(new) - 1
            low, high = to[first] + 1, to[last]
        else:
            right = (mix(sym ^ _U(7919 * level + 13)) >> _U(17)) & _U(1) == 1
            names, new = _pairs(sym, fresh, right, level)
            to = np.cumsum(new) - 1
            low, high = to[first] + right[first], to[last] + right[last]
        # Windows of which nothing would be left keep the symbols of this round.
        gone = low >= high
        settle(live[gone])
        live = live[~gone]
        lo[live], hi[live] = low[~gone], high[~gone]
        sym, at, fresh = names, at[new], fresh[new]
    settle(live)
    return starts, name, place


def units(sym: np.ndarray, fresh: np.ndarray, window: int = WINDOW, rounds: str = ROUNDS) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first window, number of windows, anchor's name, hash of all words and of the anchor's place."""
    starts, name, place = anchors(sym, fresh, window, rounds)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    new = np.append(True, (np.diff(starts) != 1) | (np.diff(place) != 0) | (name[1:] != name[:-1]))
    i = np.flatnonzero(new)
    first, count = starts[i], np.diff(np.append(i, len(starts)))
    full = mix(Runs(sym).hashes(first, first + count + window - 1) + (place[i] - first).astype(_U) * _K1)
    return first, count, name[i].view(np.int64), full.view(np.int64)


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of the texts, and the number of words before each text."""
    data = [t.encode() for t in texts]
    joined = b"\n".join(data)
    begin, end = blank_words(joined)
    offsets = np.cumsum([0, *[len(d) + 1 for d in data[:-1]]])
    return Runs(np.frombuffer(joined, dtype=np.uint8)).hashes(begin, end), np.searchsorted(begin, offsets)


def _find_units(window: int, rounds: str, block: int):
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("anchor", pa.int64()), ("full", pa.int64())])

    def run(batches):
        for b in parts(batches):
            for first, texts in slices([t or "" for t in b.column("text").to_pylist()], 1 << 20):
                sym, before = _word_hashes(texts)
                fresh = np.zeros(len(sym), dtype=bool)
                fresh[before[before < len(sym)]] = True
                for at in range(0, len(sym), block):
                    piece = slice(at, at + block + window - 1)
                    start = fresh[piece].copy()
                    start[:1] = True
                    found = units(sym[piece], start, window, rounds)
                    row = np.searchsorted(before, found[0] + at, side="right") - 1
                    take = pa.array(first + row)
                    yield pa.RecordBatch.from_arrays([b.column("k1").take(take), b.column("k2").take(take), pa.array(found[0] + at - before[row]),
                                                      *[pa.array(f, pa.int64()) for f in found[1:]]], schema=schema)

    return run


def _windows(window: int):
    """Hashes of the windows of the wanted units."""
    schema = pa.schema([("anchor", pa.int64()), ("hash", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64())])

    def run(batches):
        for b in parts(batches):
            for text, k1, k2, wanted in zip(*(b.column(c).to_pylist() for c in ("text", "k1", "k2", "wanted")), strict=True):
                sym, _ = _word_hashes([text])
                runs = Runs(sym)
                n = np.array([w["n"] for w in wanted])
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(np.array([w["start"] for w in wanted]), n) + inside
                anchor = np.repeat(np.array([w["anchor"] for w in wanted], dtype=np.int64), n)
                same = lambda k: pa.array(np.full(len(start), k, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(runs.hashes(start, start + window).view(np.int64)),
                                                  same(k1), same(k2), pa.array(start)], schema=schema)

    return run


def _strip(window: int, keep: bool):
    def run(batches):
        for b in parts(batches):
            n_words, n_removed, sums, kept = [], [], [], []
            for text, ranges in zip(b.column("text").to_pylist(), b.column("ranges").to_pylist(), strict=True):
                words = (text or "").encode().split()
                out, at = [], 0
                for a, z in sorted((r["a"], r["b"] + window - 1) for r in ranges or []):
                    out += words[at: a] if a > at else []
                    at = max(at, z)
                out += words[at:]
                rest = b" ".join(out)
                n_words.append(len(words))
                n_removed.append(len(words) - len(out))
                sums.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode() if keep else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(sums, pa.string()), pa.array(kept, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def _repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the written table ``df`` whose ``keys`` stand in more than one row.

    Counted with a combination on the map side and written, so that the join has nothing but two plain inputs and the optimiser
    can split a key that holds very many rows.
    """
    often = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select(*[F.col(k).alias(f"_{k}") for k in keys])
    often = small(materialise(often, "often"), FEW)
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return df.join(often, on, "left_semi")


def _later(df: DataFrame, keys: list[str], first: DataFrame) -> DataFrame:
    """The rows of ``df`` whose (k1, k2, start) is not the ``first`` of their keys."""
    other = first.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("first").alias("_first"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    place = F.struct("k1", "k2", "start")
    return df.join(small(other, FEW), on).where(place > F.col("_first"))


def without_repeats(docs: DataFrame, window: int = WINDOW, rounds: str = ROUNDS, block: int = BLOCK, keep: bool = True) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, kept_sha256, kept (the remaining words; null unless ``keep``).

    Words are runs without blanks (space and 9 to 13). A word goes if a window of ``window`` words that covers it also starts earlier: in a document
    of smaller doc_id or before it in the same one. A null text has no words; a null doc_id counts as 0; documents with one id are ordered by a hash of
    their texts, and rows that agree in id and text are one document, so they stay or go alike. Other columns are ignored. Windows are
    equal where their anchors' 64-bit names and their own 64-bit hashes are.
    """
    keyed = with_key(docs.select("doc_id", "text"), F.col("text"))
    every = materialise(keyed.select("k1", "k2", "text").mapInArrow(
        _find_units(window, rounds, block), "k1 long, k2 long, start long, n long, anchor long, full long"), "units")
    found = materialise(_repeated(every, ["anchor"]), "repeated")
    discard(every)
    place = F.struct("k1", "k2", "start")
    kinds = materialise(found.groupBy("anchor", "full").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.first("n").alias("n")), "kinds")
    whole = _later(found, ["anchor", "full"], kinds.where("first < last")).select("k1", "k2", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))

    # What stands first of each kind, where an anchor has several kinds.
    leaders = _repeated(kinds, ["anchor"]).select("anchor", "first.*", "n")
    wanted = leaders.groupBy(F.col("k1").alias("w1"), F.col("k2").alias("w2")).agg(F.collect_list(F.struct("start", "n", "anchor")).alias("wanted"))
    wanted = materialise(wanted, "wanted")
    own = (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))
    texts = keyed.join(small(wanted.select("w1", "w2"), 1_000_000), own, "left_semi").join(wanted, own)
    windows = texts.select("text", "k1", "k2", "wanted").mapInArrow(_windows(window), "anchor long, hash long, k1 long, k2 long, start long")
    windows = materialise(windows, "windows")
    same = windows.groupBy("anchor", "hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    single = _later(windows, ["anchor", "hash"], materialise(same, "same")).select("k1", "k2", F.col("start").alias("a"), (F.col("start") + 1).alias("b"))

    ranges = whole.unionByName(single).groupBy(F.col("k1").alias("r1"), F.col("k2").alias("r2")).agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    ranges = materialise(ranges, "ranges")
    for done in (found, kinds, wanted, windows):
        discard(done)
    out = keyed.join(small(ranges, 10_000), (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")), "left").select("doc_id", "text", "ranges")
    return out.mapInArrow(_strip(window, keep), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
