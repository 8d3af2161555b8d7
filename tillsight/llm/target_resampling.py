"""Documents drawn by importance weights towards a target's distribution of hashed word n-grams.

Features are runs of 1 to 3 words, counted in an array of buckets by CRC-32: one array for the corpus, one for the target, from which each bucket
has a gain. A document's weight is the sum of its features' gains, read from the array; Gumbel noise by the hash of its id makes the highest
scores a draw without replacement in proportion to the weights.

The score of the last one drawn is found by weighted medians of medians: each chunk of keys names its median, the median of these (weighted by
the chunks' sizes) splits all keys, and at least a quarter of what remained is discarded, until few are left. Only the winners are sorted.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import parts, slices, small
from tillsight.session import materialise

BUCKETS = 10_000
#: Words whose features are held in arrays together.
BLOCK = 1 << 18
#: Keys of which one median is taken; so few keys that are left are ordered at once.
CHUNK, FEW = 1 << 20, 10_000
#: Longest word whose checksum is carried on by table; longer ones take the library's function one by one.
LONG = 64

# ---- Checksums of runs of words ----


def _crc_table() -> np.ndarray:
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & np.uint32(1), (row >> np.uint32(1)) ^ np.uint32(0xEDB88320), row >> np.uint32(1))
    return row


CRC = _crc_table()


def _shift_tables() -> np.ndarray:
    """[length * 1024 + 256 * k + v]: what the k-th byte v of a checksum becomes when ``length`` bytes follow (the map is linear over bits)."""
    tables = np.zeros((LONG + 2, 4, 256), dtype=np.uint32)
    images = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for length in range(LONG + 2):
        for k in range(4):
            for bit in range(8):
                has = (np.arange(256) >> bit) & 1 == 1
                tables[length, k, has] ^= images[8 * k + bit]
        images = CRC[images & np.uint32(255)] ^ (images >> np.uint32(8))
    return tables.ravel()


_SHIFT = _shift_tables()


def _shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of texts as parts of longer ones that ``length`` (at most LONG + 1) more bytes follow."""
    base = np.minimum(length, LONG + 1) << 10
    out = _SHIFT[base + (crc & np.uint32(255))]
    for k in (1, 2, 3):
        out ^= _SHIFT[base + (256 * k) + ((crc >> np.uint32(8 * k)) & np.uint32(255))]
    return out


def _word_crcs(b: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    crc = np.full(len(begin), 0xFFFFFFFF, dtype=np.uint32)
    live, j = np.flatnonzero(length <= LONG), 0
    while len(live := live[length[live] > j]):
        c = crc[live]
        crc[live] = CRC[(c ^ b[begin[live] + j]) & np.uint32(255)] ^ (c >> np.uint32(8))
        j += 1
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > LONG):
        crc[i] = zlib.crc32(b[begin[i]: begin[i] + length[i]])
    return crc


def _run_crcs(b: np.ndarray, begin: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """Checksums of the runs of one, two and three words (joined by a blank) from each word on that has as many."""
    one = _word_crcs(b, begin, length)
    blank = np.uint32(zlib.crc32(b" "))
    spaced = _shifted(np.full(len(one), blank), length) ^ one
    out = [one]
    far = np.flatnonzero(length > LONG)
    for k in (1, 2):
        longer = _shifted(out[-1][:-1], length[k:] + 1) ^ spaced[k:] if len(one) > k else np.zeros(0, np.uint32)
        for j in far[far >= k]:
            longer[j - k] = zlib.crc32(b" " + b[begin[j]: begin[j] + length[j]].tobytes(), int(out[-1][j - k]))
        out.append(longer)
    return out


#: Bytes of words once A-Z are lower: digits, a-z and everything outside ASCII.
_INSIDE = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)


def features(texts: list[str], buckets: int = BUCKETS):
    """Yields (row, bucket) arrays of all features of the texts, block by block, and a flag telling the single words."""
    data = [t.encode() for t in texts]
    b = _LOWER[np.frombuffer(b"\n".join(data), dtype=np.uint8)]
    offsets = np.cumsum([0, *[len(d) + 1 for d in data[:-1]]])
    edge = np.diff(np.concatenate([[False], _INSIDE[b], [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(offsets, begin, side="right") - 1
    for at in range(0, len(begin), BLOCK):
        here = slice(at, at + BLOCK + 2)
        first, of = begin[here], row[here]
        for k, crc in enumerate(_run_crcs(b, first, end[here] - first)):
            n = min(len(crc), BLOCK)
            whole = of[:n] == of[k: k + n]
            yield of[:n][whole], (crc[:n][whole] % np.uint32(buckets)).astype(np.int64), k == 0


def _count(buckets: int):
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in parts(batches):
            for _, texts in slices([t or "" for t in b.column("text").to_pylist()], 1 << 20):
                for _, bucket, _ in features(texts, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of the features of all texts: an array for each task, added up."""
    return docs.select("text").mapInArrow(_count(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))) of every bucket; one row per bucket reaches the driver."""
    spark = corpus.sparkSession
    side = lambda df, name: bucket_counts(df, buckets).select("bucket", F.col("n").alias(name))
    both = materialise(spark.range(buckets).select(F.col("id").alias("bucket")).join(side(corpus, "s"), "bucket", "left").join(
        side(target, "t"), "bucket", "left").fillna(0), "buckets")
    total = both.agg(F.sum("s").cast("double").alias("S"), F.sum("t").cast("double").alias("T")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    gain = F.floor(1000 * F.ln((t + 1) * F.lit(total.S + buckets) / ((s + 1) * F.lit(total.T + buckets))))
    out = np.zeros(buckets, dtype=np.int64)
    for r in both.select("bucket", gain.alias("g")).collect():
        out[r.bucket] = r.g
    return out


def _weigh(gain: np.ndarray):
    def run(batches):
        for b in parts(batches):
            words, n, weight = (np.zeros(b.num_rows, dtype=np.int64) for _ in range(3))
            for first, texts in slices([t or "" for t in b.column("text").to_pylist()], 1 << 20):
                rows = slice(first, first + len(texts))
                for row, bucket, single in features(texts, len(gain)):
                    count = np.bincount(row, minlength=len(texts))
                    n[rows] += count
                    words[rows] += count if single else 0
                    weight[rows] += np.bincount(row, weights=gain[bucket], minlength=len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("t"), pa.array(words), pa.array(n), pa.array(weight)],
                                             names=["doc_id", "t", "n_words", "n_features", "weight"])

    return run


# ---- The cutoff key ----

_KEY = ["a", "b", "t", "u"]


def _nth(keys: list[np.ndarray], k: int) -> tuple[int, ...]:
    """The k-th (from 0) of distinct keys in the order of their columns."""
    at = np.arange(len(keys[0]))
    out = []
    for col in keys:
        v = col[at]
        pivot = np.partition(v, k)[k]
        k -= int((v < pivot).sum())
        at = at[v == pivot]
        out.append(int(pivot))
    return tuple(out)


def _medians(pivot: tuple[int, ...] | None, chunk: int):
    """For each chunk of keys and each side of the pivot: how many, and their (lower) median; without a pivot all are on side 1."""
    schema = pa.schema([("side", pa.int32()), ("n", pa.int64()), *[(c, pa.int64()) for c in _KEY]])

    def summary(keys):
        less = np.zeros(len(keys[0]), dtype=bool)
        more = np.ones(len(keys[0]), dtype=bool)
        if pivot is not None:
            more[:], tied = False, ~less
            for col, p in zip(keys, pivot, strict=True):
                less |= tied & (col < p)
                more |= tied & (col > p)
                tied &= col == p
        for side, mask in ((0, less), (1, more)):
            if n := int(mask.sum()):
                yield side, n, *_nth([c[mask] for c in keys], (n - 1) // 2)

    def run(batches):
        def cut():
            held, size = [], 0
            for b in batches:
                for first in range(0, b.num_rows, chunk):
                    part = b.slice(first, chunk)
                    if size and size + part.num_rows > chunk:
                        yield held
                        held, size = [], 0
                    held.append([part.column(c).to_numpy(zero_copy_only=False) for c in _KEY])
                    size += part.num_rows
            if size:
                yield held

        for held in cut():
            rows = list(summary([np.concatenate(c) for c in zip(*held, strict=True)]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(6)], schema=schema)

    return run


def _weighted_median(rows: list[tuple]) -> tuple[int, ...]:
    rows = sorted((tuple(r[1:]), r[0]) for r in rows)
    half, seen = sum(n for _, n in rows) / 2, 0
    for key, n in rows:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def _upto(key: tuple[int, ...]) -> Column:
    """Keys up to this one; the first column stands alone as well, for the scan's statistics."""
    return (F.col("a") <= key[0]) & (F.struct(*_KEY) <= F.struct(*[F.lit(k).cast("long").alias(c) for k, c in zip(key, _KEY, strict=True)]))


def _beyond(key: tuple[int, ...]) -> Column:
    return (F.col("a") >= key[0]) & ~_upto(key)


def cutoff(keys: DataFrame, k: int, chunk: int = CHUNK, few: int = FEW) -> tuple[int, ...]:
    """The k-th (from 1) key of a written table of distinct keys (a, b, t, u: longs, none null), in ascending order.

    A round is one pass over what remains and sends a row or two per chunk of keys to the driver. The median of the chunks' medians, weighted by their sizes, has
    at least a quarter of the remaining keys on either side. What remains is written anew whenever it has shrunk to an eighth.
    """
    def medians(df, pivot=None):
        return df.mapInArrow(_medians(pivot, chunk), "side int, n long, a long, b long, t long, u long").collect()

    table = keys.select(*_KEY)
    rows, low, high = medians(table), None, None
    left = written = sum(r.n for r in rows)
    if not 1 <= k <= left:
        raise ValueError(f"key {k} of {left}")
    while True:
        here = table
        if low:
            here = here.where(_beyond(low))
        if high:
            here = here.where(_upto(high))
        if left <= few:
            return tuple(here.orderBy(*_KEY).offset(k - 1).first())
        if left * 8 <= written:
            table = here = materialise(here, "remaining")
            low, high, written = None, None, left
        pivot = _weighted_median([r[1:] for r in rows])
        rows = medians(here, pivot)
        below = sum(r.n for r in rows if r.side == 0)
        if k <= below:
            # The pivot itself goes too: nothing lies between it and the largest of what is left.
            high, left, rows = pivot, below + 1, [r for r in rows if r.side == 0]
        elif k == below + 1:
            return pivot
        else:
            low, left, k, rows = pivot, left - below - 1, k - below - 1, [r for r in rows if r.side == 1]


def drawn(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = BUCKETS, seed: int = 42,
          chunk: int = CHUNK, few: int = FEW) -> DataFrame:
    """Per document row: doc_id, n_words, n_features, weight, score, rank (1, 2, ... by descending score of those drawn; else null).

    Of the N rows with at least ``least_words`` words, floor(percent * N / 100) are drawn; ties go to the smaller doc_id, then by a hash of the
    text; rows that agree in both are drawn in any order. A null text has no words, weight 0 and the noise alone; a null doc_id has the noise
    of ``<seed>:`` and comes last in ties. Other columns are ignored. An empty table draws nothing; an empty target has equal counts of 0.
    """
    gain = gains(docs, target, buckets)
    weighed = docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(
        _weigh(gain), "doc_id long, t long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score", F.col("weight") + noise).withColumns({
        "a": -F.col("score"), "b": F.coalesce("doc_id", F.lit(2 ** 63 - 1)), "u": F.monotonically_increasing_id()})
    scored = materialise(scored, "scored")
    able = F.col("n_words") >= least_words
    wanted = percent * scored.where(able).count() // 100
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select(*out, none)
    upto = _upto(cutoff(scored.where(able), wanted, chunk, few))
    # Each partition of the range-sorted winners knows its number; the partitions' sizes give where it begins.
    winners = scored.where(able & upto).repartitionByRange(*_KEY).withColumn("p", F.spark_partition_id())
    winners = materialise(winners, "winners")
    begins = winners.groupBy("p").count().select(F.col("p").alias("q"), (F.sum("count").over(Window.orderBy("p")) - F.col("count")).alias("begin"))
    place = F.row_number().over(Window.partitionBy("p").orderBy(*_KEY))
    ranked = winners.join(small(begins, 100_000), F.col("p") == F.col("q")).select(*out, (F.col("begin") + place).cast("long").alias("rank"))
    return scored.where(~(able & upto)).select(*out, none).unionByName(ranked)
