"""Removal of long byte strings that occur more than once, by per-shard suffix arrays over what can repeat at all.

Every string of ``LENGTH`` bytes has an anchor, its leftmost gram of least hash, which its bytes alone decide. Consecutive starts with one anchor
form a unit. Strings can only be equal where their anchors are; so units whose anchor stands once are done, units
equal in all bytes repeat wholly, and only unequal units of one anchor need a closer look. Their bytes go, dealt by anchor, to
shards: each builds its suffix array by Larsson-Sadakane refinement and common prefixes by Kasai's rule. An anchor with too
many bytes for one shard is cut into several, which are merged by binary search of each one's strings in the other's suffix array.
Units of an anchor that has too many even for that are cut into pieces before, dealt by the bytes that all strings of a piece share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import parts, small
from tillsight.llm.hashing import Runs, mix
from tillsight.session import materialise

LENGTH, GRAM = 400, 32
#: Bytes of one suffix array: small enough for a processor's cache. One anchor's units may fill twice as much.
SHARD = 1 << 18
#: Of a unit or a piece of one: what it is dealt by, hash of its bytes, number of starts, bytes; the unit and the place of the first start there.
ROWS = "anchor long, full long, n long, data binary, of_anchor long, of_full long, at long"


def units(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Units of a text: anchor hash, hash of all bytes (and of the anchor's place), first start, number of starts, anchor's place."""
    b = np.frombuffer(data, dtype=np.uint8)
    n, width = len(b) - length + 1, length - gram + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    runs = Runs(b)
    at = np.arange(len(b) - gram + 1)
    values = runs.hashes(at, at + gram)
    # Half of the hash above, the place below: the least is the leftmost gram of least hash.
    ranked = (values & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    # Least of each window of ``width``: of the rest of the row it starts in, and of the head of the row it ends in.
    rows = -(-len(values) // width)
    grid = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[: len(values)] = ranked
    grid = grid.reshape(rows, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    rest = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(rest[:n], head[width - 1: width - 1 + n])
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    place = (least[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    count = np.append(first[1:], n) - first
    full = runs.hashes(first, first + count + length - 1) + (place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return values[place].view(np.int64), full.view(np.int64), first, count, place


def pieces(anchor: int, data: bytes, step: int, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int]]:
    """Cuts a unit's starts by their distance to its anchor, ``step`` in a bin: key, hash of all bytes, first start, number of starts.

    The strings of a bin have ``length - step + 1`` bytes in common. The key is a hash of these, the bin and ``anchor`` (that of the
    unit or the key of the piece that is cut again), so equal strings of one anchor get one key. With a step of 1 a key is a string.
    """
    place, n = int(units(data, length, gram)[4][0]), len(data) - length + 1
    bins = np.arange((place - n + 1) // step, place // step + 1)
    lowest, highest = place - (bins + 1) * step + 1, place - bins * step
    first, end = np.maximum(lowest, 0), np.minimum(highest + 1, n)
    runs = Runs(np.frombuffer(data, dtype=np.uint8))
    place_key = mix(np.uint64(anchor & 0xFFFFFFFFFFFFFFFF) + mix(bins.astype(np.uint64) + np.uint64(1)))
    key = mix(runs.hashes(highest, lowest + length) + place_key)
    full = runs.hashes(first, end + length - 1) + (place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    yield from zip(key.view(np.int64).tolist(), full.view(np.int64).tolist(), first.tolist(), (end - first).tolist(), strict=True)


def words(text: np.ndarray, pad: int = 0) -> np.ndarray:
    """The eight bytes from each place on as one number, zero bytes after the end; for ``pad`` places more."""
    n = len(text) + pad
    padded = np.zeros(n + 8, dtype=np.uint64)
    padded[: len(text)] = text
    key = padded[:n]
    for j in range(1, 8):
        key = (key << np.uint64(8)) | padded[j: j + n]
    return key


def suffix_array(text: np.ndarray, depth: int = LENGTH, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` (uint8) sorted by their first ``depth`` bytes at least, as if zero bytes followed the text.

    Starts from eight bytes; then suffixes still tied are sorted by the rank of the suffix h bytes on, h doubling. Where ``starts`` flags
    the suffixes that matter, the last rounds leave out those that no such suffix refers to; their order stays coarse. Also
    returns the ranks before the last round, by which suffixes that share less than half the rounds' reach differ.
    """
    n = len(text)
    key = words(text)[:n]
    sa = np.argsort(key)
    ordered = key[sa]
    new = np.append(True, ordered[1:] != ordered[:-1])
    rank = np.zeros(n + 1, dtype=np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(1, n + 1), 0))
    steps = [8]
    while 2 * steps[-1] < depth:
        steps.append(2 * steps[-1])
    needed = [np.ones(n, dtype=bool) if starts is None else starts]
    for h in reversed(steps[1:]):
        wide = needed[0].copy()
        wide[h:] |= needed[0][:-h] if h < n else False
        needed.insert(0, wide)
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))
    coarse = rank
    for h, wanted in zip(steps, needed, strict=True):
        slots = slots[wanted[sa[slots]]] if starts is not None else slots
        if not len(slots):
            break
        if h == steps[-1]:
            coarse = rank.copy()
        tied = sa[slots]
        group = rank[tied]
        order = np.argsort(group * (n + 1) + rank[np.minimum(tied + h, n)])
        tied, group = tied[order], group[order]
        further = rank[np.minimum(tied + h, n)]
        # The slots of a group that are left in this round, in turn.
        sa[slots] = tied
        new = np.append(True, (group[1:] != group[:-1]) | (further[1:] != further[:-1]))
        rank[tied] = np.maximum.accumulate(np.where(new, slots + 1, 0))
        slots = slots[~(new & np.append(new[1:], True))]
    return sa, coarse


def _common(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix lengths, up to about ``depth``, of suffixes i and j; a and b are ``words`` with as many places after the end."""
    out = np.zeros(len(i), dtype=np.int64)
    live, at = np.arange(len(i)), 0
    while len(live) and at < depth:
        x = a[i[live] + at] ^ b[j[live] + at]
        same = x == 0
        other = x[~same]
        out[live[~same]] = at + sum((other < np.uint64(1 << (64 - 8 * k))).astype(np.int64) for k in range(1, 8))
        live, at = live[same], at + 8
    out[live] = at
    return out


def neighbours(text: np.ndarray, sa: np.ndarray, depth: int = LENGTH, close: np.ndarray | None = None) -> np.ndarray:
    """For each place of ``sa`` but the first, the common prefix (up to ``depth``) with the suffix before it.

    Kasai's rule: one byte on, a suffix has at least the common prefix less one with its own predecessor. Where the bytes before
    the two agree it is exactly that; only the other places are compared. Places that are not ``close`` count as 0.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    if close is None:
        before[sa[1:]] = sa[:-1]
    else:
        before[sa[1:][close]] = sa[:-1][close]
    at = np.arange(n)
    kept = (before > 0) & (np.append(-1, before[:-1]) == before - 1)
    kept[1:] &= text[:-1] == text[np.maximum(before[1:] - 1, 0)]
    # Where Kasai's rule starts afresh, lengths are found to twice the depth, so that what follows from them is seldom cut short.
    limit = 2 * depth
    eights = words(text, limit + 8)
    length = np.zeros(n, dtype=np.int64)

    def compare(i: np.ndarray, most: int) -> None:
        # Past the end zero bytes agree, so lengths are capped by what is left.
        length[i] = np.minimum(_common(eights, i, eights, before[i], most), np.minimum(n - i, n - before[i]))

    compare(np.flatnonzero(~kept & (before >= 0)), limit)
    origin = np.maximum.accumulate(np.where(kept, 0, at))
    length[kept] = np.maximum(length[origin[kept]] - (at[kept] - origin[kept]), 0)
    compare(np.flatnonzero(kept & (length[origin] >= limit) & (length < depth)), depth)
    return np.minimum(length[sa[1:]], depth)


class Shard:
    """Units' bytes joined, their suffix array, and which starts repeat within."""

    def __init__(self, rows: list[tuple[int, bytes]], length: int):
        """rows: (number of starts, bytes) of units, each starts + length - 1 bytes long."""
        self.length = length
        sizes = np.array([len(d) for _, d in rows])
        self.text = np.frombuffer(b"".join(d for _, d in rows), dtype=np.uint8)
        self.begin = np.cumsum(sizes) - sizes
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(self.text))
        self.valid = left >= length
        sa, coarse = suffix_array(self.text, length, self.valid)
        # Only whole strings of one unit matter. Those that were apart before the last round share less than ``length``.
        self.sa = sa[self.valid[sa]]
        close = coarse[self.sa[1:]] == coarse[self.sa[:-1]]
        same = neighbours(self.text, self.sa, length, close) >= length
        # Suffixes of one run of full common prefixes are equal strings.
        many = np.append(same, False) | np.append(False, same)
        self.again = np.zeros(len(self.text), dtype=bool)
        self.again[self.sa[many]] = True

    def merge(self, other: "Shard") -> None:
        """Marks in both the starts whose string the other has, found by binary search in its suffix array."""
        starts = np.flatnonzero(self.valid)
        a, b = words(self.text, self.length), words(other.text, self.length)
        rows = other.sa
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(rows), np.int64)
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            i, j = starts[open_], rows[mid]
            lcp = _common(a, i, b, j, self.length)
            differ = np.minimum(lcp, self.length - 1)
            less = (lcp < self.length) & (other.text[j + differ] < self.text[i + differ])
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        inside = lo < len(rows)
        here, there = starts[inside], rows[lo[inside]]
        equal = _common(a, here, b, there, self.length) >= self.length
        self.again[here[equal]] = True
        # Equal strings of the other follow the one found; mark them from the sorted run.
        first = np.unique(lo[inside][equal])
        while len(first):
            other.again[rows[first]] = True
            nxt = first[first + 1 < len(rows)]
            nxt = nxt[_common(b, rows[nxt], b, rows[nxt + 1], self.length) >= self.length] + 1
            first = nxt[~other.again[rows[nxt]]]

    def flags(self, i: int, starts: int) -> np.ndarray:
        return self.again[self.begin[i]: self.begin[i] + starts]


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs [from, to) of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def _judge(rows: list[tuple], length: int, shard: int) -> list[tuple]:
    """rows: ``ROWS`` of whole anchors. (unit's anchor, unit's full, ranges of repeated starts there) of those that have some."""
    parts, size = [[]], 0
    for r in rows:
        if size and size + len(r[3]) > shard:
            parts.append([])
            size = 0
        parts[-1].append(r)
        size += len(r[3])
    shards = [Shard([(r[2], r[3]) for r in p], length) for p in parts if p]
    for i, s in enumerate(shards):
        for t in shards[:i]:
            s.merge(t)
    out = []
    for p, s in zip(parts, shards, strict=True):
        for i, r in enumerate(p):
            if ranges := _ranges(s.flags(i, r[2])):
                out.append((r[4], r[5], [(r[6] + a, r[6] + b) for a, b in ranges]))
    return out


def _shards(length: int, shard: int):
    """Over rows sorted by anchor: shards of whole anchors; an anchor larger than a shard makes a group of its own."""
    schema = pa.schema([("anchor", pa.int64()), ("full", pa.int64()), ("ranges", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])

    def batch(found):
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                                           pa.array([[{"a": a, "b": b} for a, b in f[2]] for f in found], schema.field(2).type)], schema=schema)

    def run(batches):
        held, size, own, own_size = [], 0, [], 0  # whole anchors, and the rows of the anchor that is being read
        for b in parts(batches):
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own and own[-1][:2] == row[:2]:
                    continue  # a repeated row of the document that stands for a unit
                if own and own[-1][0] != row[0]:
                    if held and size + own_size > shard:
                        yield batch(_judge(held, length, shard))
                        held, size = [], 0
                    held += own
                    size += own_size
                    own, own_size = [], 0
                own.append(row)
                own_size += len(row[3])
        if held and size + own_size > shard:
            yield batch(_judge(held, length, shard))
            held = []
        if held or own:
            yield batch(_judge(held + own, length, shard))

    return run


def _find_units(length: int, gram: int):
    schema = pa.schema([("tk", pa.binary()), ("anchor", pa.int64()), ("full", pa.int64()), ("pos", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for b in parts(batches):
            found = [units((t or "").encode(), length, gram) for t in b.column("text").to_pylist()]
            which = np.repeat(np.arange(b.num_rows), [len(f[0]) for f in found])
            cols = [pa.array(np.concatenate([f[k] for f in found]), pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([b.column("tk").take(pa.array(which)), *cols], schema=schema)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    """A batch of ``ROWS``."""
    kinds = {"data": pa.binary()}
    names = [c.split()[0] for c in ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds.get(c, pa.int64())) for k, c in enumerate(names)], names=names)


def _cut(length: int):
    def run(batches):
        for b in parts(batches):
            rows = []
            for text, wanted in zip(b.column("text").to_pylist(), b.column("wanted").to_pylist(), strict=True):
                data = text.encode()
                rows += [(w["anchor"], w["full"], w["n"], data[w["pos"]: w["pos"] + w["n"] + length - 1], w["anchor"], w["full"], 0) for w in wanted]
            yield _rows(rows)

    return run


def _split(step: int, length: int, gram: int):
    def run(batches):
        for b in parts(batches, 1 << 20):
            rows = []
            for anchor, _, _, data, of_anchor, of_full, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows += [(key, full, n, data[first: first + n + length - 1], of_anchor, of_full, at + first)
                         for key, full, first, n in pieces(anchor, data, step, length, gram)]
            yield _rows(rows)

    return run


def _deal(rows: DataFrame, counts: DataFrame, length: int, gram: int, many: int) -> tuple[DataFrame, list[DataFrame]]:
    """``rows`` of units (``ROWS``) with at most ``many`` different ones to an anchor; and marks (anchor, full, ranges) that cutting the others has found.

    counts: anchors with their ``kinds`` of units. Those of an anchor with more are cut into pieces of ever fewer starts. A piece whose key stands once is done,
    pieces equal in all bytes repeat wholly, and one of each kind goes on. A common passage with many surroundings leaves only the pieces that
    reach over its ends; in the last round a piece is one string, so none is left. Each round's work follows the rows that it cuts.
    """
    few, marks = [], []
    for step in sorted({length // 8, length // 64, 1} - {0}, reverse=True):
        hot = counts.where(F.col("kinds") > many).select(F.col("anchor").alias("ha"))
        if hot.isEmpty():
            break
        rows, hot, on = materialise(rows, "rows"), small(hot, 1_000_000), F.col("anchor") == F.col("ha")
        few.append(rows.join(hot, on, "left_anti"))
        # A document that stands for a unit may be there twice.
        cut = rows.join(hot, on, "left_semi").dropDuplicates(["anchor", "full"])
        cut = materialise(cut.mapInArrow(_split(step, length, gram), ROWS), "pieces")
        alike = cut.groupBy("anchor", "full").agg(F.count(F.lit(1)).alias("c"), F.first(F.struct(*cut.columns[2:])).alias("rep"))
        alike = materialise(alike, "alike")
        twice = alike.where("c > 1").select(F.col("anchor").alias("ta"), F.col("full").alias("tf"))
        marks.append(cut.join(twice, (F.col("anchor") == F.col("ta")) & (F.col("full") == F.col("tf")), "left_semi").select(
            F.col("of_anchor").alias("anchor"), F.col("of_full").alias("full"), F.array(F.struct(F.col("at").alias("a"), (F.col("at") + F.col("n")).alias("b"))).alias("ranges")))
        counts = materialise(alike.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "counts")
        rows = alike.select("anchor", "full", "rep.*").join(counts.select(F.col("anchor").alias("ca")), F.col("anchor") == F.col("ca"), "left_semi")
    for f in few:
        rows = rows.unionByName(f)
    return rows, marks


def _strip(length: int, keep: bool):
    def run(batches):
        for b in parts(batches):
            n_bytes, n_removed, n_spans, sums, kept = [], [], [], [], []
            for text, copies, spans in zip(*(b.column(c).to_pylist() for c in ("text", "copies", "spans")), strict=True):
                data = (text or "").encode()
                starts = len(data) - length + 1
                # Ranges of repeated starts -> covered bytes, joined where they touch.
                ranges = [(0, starts)] if copies > 1 and starts > 0 else sorted((s["a"], s["b"]) for s in spans or [])
                out, removed, n, at, end = [], 0, 0, 0, -1
                for a, z in ((a, b + length - 1) for a, b in ranges):
                    if a > end:
                        out.append(data[at: a])
                        n += 1
                        removed += z - a
                    elif z > end:
                        removed += z - end
                    end = max(end, z)
                    at = end
                out.append(data[at:])
                rest = b"".join(out)
                n_bytes.append(len(data))
                n_removed.append(removed)
                n_spans.append(n)
                sums.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if keep else None)
            long = lambda v: pa.array(v, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), long(n_bytes), long(n_removed), long(n_spans), pa.array(sums, pa.string()), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, keep: bool = True) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes; null unless ``keep``).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. A null text is empty; copies and repeated rows
    are each other's repeats, so all of them go; other columns are ignored. Texts are told apart by MD5, strings' equality is
    by 64-bit hashes of whole units or by their bytes.
    """
    d = docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("tk"))
    base = materialise(d.select("tk", "doc_id"), "base").groupBy("tk").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"))
    found = d.select("tk", "text").mapInArrow(_find_units(length, gram), "tk binary, anchor long, full long, pos long, n long")
    found = found.dropDuplicates(["tk", "pos"])
    # Written, so that the join has two plain inputs and the optimiser can split an anchor that very many units have.
    repeated = materialise(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("anchor").alias("ra")), "often")
    found = materialise(found.join(repeated, F.col("anchor") == F.col("ra"), "left_semi"), "units")
    kinds = found.groupBy("anchor", "full").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("tk", "pos", "n")).alias("rep"))
    kinds = materialise(kinds, "kinds")
    several = materialise(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "several")
    wanted = kinds.join(several.select(F.col("anchor").alias("sa")), F.col("anchor") == F.col("sa"), "left_semi").groupBy(F.col("rep.tk").alias("wt")).agg(
        F.collect_list(F.struct("anchor", "full", F.col("rep.pos").alias("pos"), F.col("rep.n").alias("n"))).alias("wanted"))
    owners = base.select(F.col("tk").alias("bt"), "first")
    wanted = materialise(wanted.join(owners, F.col("wt") == F.col("bt")).drop("bt"), "wanted")
    some = d.join(small(wanted.select(F.col("wt").alias("st")), 1_000_000), F.col("tk") == F.col("st"), "left_semi")
    data = some.join(wanted, (F.col("tk") == F.col("wt")) & F.col("doc_id").eqNullSafe(F.col("first")))
    data = data.select("text", "wanted").mapInArrow(_cut(length), ROWS)
    data, cut = _deal(data, several, length, gram, max(2, 2 * shard // (2 * length - gram)))
    judged = data.repartition("anchor").sortWithinPartitions("anchor", "full")
    judged = judged.mapInArrow(_shards(length, shard), "anchor long, full long, ranges array<struct<a:bigint,b:bigint>>")
    whole = kinds.where("c > 1").select("anchor", "full", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("rep.n").alias("b"))).alias("ranges"))
    once = kinds.where("c = 1").select("anchor", "full")
    for c in cut:
        judged = judged.unionByName(c)
    marks = materialise(judged.join(once, ["anchor", "full"], "left_semi").unionByName(whole), "marks").select(
        F.col("anchor").alias("ma"), F.col("full").alias("mf"), "ranges")
    spans = found.join(marks, (F.col("anchor") == F.col("ma")) & (F.col("full") == F.col("mf"))).select(
        "tk", F.explode("ranges").alias("r"), "pos").groupBy("tk").agg(F.collect_list(F.struct(
            (F.col("pos") + F.col("r.a")).alias("a"), (F.col("pos") + F.col("r.b")).alias("b"))).alias("spans"))
    facts = materialise(base.select("tk", "copies").join(spans, "tk", "left").where("copies > 1 OR spans IS NOT NULL"), "spans").withColumnRenamed("tk", "ft")
    out = d.join(facts, F.col("tk") == F.col("ft"), "left").select("doc_id", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "spans")
    return out.mapInArrow(_strip(length, keep), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
