"""Packing along a space-filling curve: documents that are near each other in content share training sequences.

The counts of a document's hashed words are scaled to unit length and projected to a few dimensions by a fixed random matrix; each
coordinate is put on a grid by the normal distribution, and the grid cell's place on Hilbert's curve is the key. Documents are
range-sorted by the key (ties, such as copies, by id and a hash of the text, so that no key makes a partition large), and each partition
packs its documents in that order into sequences of a fixed length. The ids left at a partition's end become sequences whose lengths are powers
of two, which need no padding.
"""

from __future__ import annotations

import zlib
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tillsight.llm.common import parts, slices
from tillsight.llm.hashing import Runs, blank_words

BUCKETS, DIMENSIONS, BITS, SEED = 512, 4, 12, 20240611
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on Hilbert's curve of each row of grid coordinates (n x dimensions, each below 2**bits)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            on = (x[i] & q) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(on, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(texts: list[str | None]) -> np.ndarray:
    """The Hilbert key of each text; a text without words has the key of the origin."""
    matrix = np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS)).astype(np.float32)
    out = []
    for _, run in slices([t or "" for t in texts], 1_000_000):
        encoded = [t.encode() for t in run]
        data = b" ".join(encoded)
        starts, ends = blank_words(data)
        bucket = (Runs(np.frombuffer(data, dtype=np.uint8)).hashes(starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
        doc = np.searchsorted(np.cumsum([len(x) + 1 for x in encoded]), starts, side="right")
        counts = np.bincount(doc * BUCKETS + bucket, minlength=len(run) * BUCKETS).reshape(len(run), BUCKETS).astype(np.float32)
        norm = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        flat = (counts / np.maximum(norm, 1)) @ matrix
        # To six digits, so that the order of additions can't move a document.
        share = np.vectorize(lambda v: 0.5 + 0.5 * erf(v / 2**0.5), otypes=[np.float64])(np.round(flat.astype(np.float64), 6))
        out.append(hilbert(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _keyed(batches):
    for b in parts(batches):
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(curve_keys(b.column("text").to_pylist()), pa.int64())],
                                         names=["doc_id", "text", "curve"])


class Packer:
    """Cuts documents into pieces of sequences; at the end the open sequence is cut at powers of two."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.sequence, self.held = length, first_sequence, []
        self.room = length

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        """Pieces (doc_id, start, ids, doc_tokens, sequence, offset) of sequences that are now full."""
        at, done = 0, []
        while at < len(ids):
            take = min(self.room, len(ids) - at)
            self.held.append((doc_id, at, ids[at: at + take], len(ids), self.sequence, self.length - self.room))
            at += take
            self.room -= take
            if not self.room:
                done += self.held
                self.held, self.room, self.sequence = [], self.length, self.sequence + 1
        return done

    def close(self) -> list[tuple]:
        left, out = self.length - self.room, []
        size, room = 0, 0
        for doc_id, start, ids, total, _, _ in self.held:
            at = 0
            while at < len(ids):
                if not room:
                    room = size = 1 << (left.bit_length() - 1)
                take = min(room, len(ids) - at)
                out.append((doc_id, start + at, ids[at: at + take], total, self.sequence, size - room))
                at, room, left = at + take, room - take, left - take
                self.sequence += not room
        self.held, self.room = [], self.length
        return out


def _pack(path: str, kind: str, end_id: int, length: int, with_ids: bool, special: bool):
    from tillsight.llm.token_files import id_lists

    def batch(pieces):
        cols = list(zip(*pieces, strict=True))
        crcs = [zlib.crc32(x.astype("<u4").tobytes()) for x in cols[2]]
        ids = id_lists([x if with_ids else x[:0] for x in cols[2]])
        long = lambda v: pa.array(v, pa.int64())
        return pa.RecordBatch.from_arrays(
            [long(cols[0]), long(cols[1]), long([len(x) for x in cols[2]]), long(crcs), long(cols[3]), long(cols[4]), long(cols[5]), ids],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    def run(batches):
        from tillsight.llm.tokens import encoder

        words = encoder(path, kind, special)
        packer = Packer(length, TaskContext.get().partitionId() << 40)
        for b in parts(batches):
            done = []
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), words.encode(b.column("text").to_pylist()), strict=True):
                done += packer.add(doc_id, np.append(ids, np.int32(end_id)))
            if done:
                yield batch(done)
        if last := packer.close():
            yield batch(last)

    return run


def packed(docs: DataFrame, tokenizer: str, kind: str = "word", end_id: int = 1, length: int = 2048, with_ids: bool = True,
           special: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (empty if not wanted).

    A sequence is full, or its length is a power of two: nothing is padded. A null text is empty and has the end id alone;
    rows repeated are packed each; null ids are kept. The order along the curve is by key, then doc_id, then a hash of the text, which
    makes a lost task's work come out the same. An empty table gives no piece. ``special``: strings of the tokenizer's added tokens
    become these tokens, else they are ordinary text.
    """
    keyed = docs.select("doc_id", "text").mapInArrow(_keyed, "doc_id long, text string, curve long").withColumn("h", F.xxhash64("text"))
    along = keyed.repartitionByRange("curve", "doc_id", "h").sortWithinPartitions("curve", "doc_id", "h").select("doc_id", "text")
    return along.mapInArrow(_pack(tokenizer, kind, end_id, length, with_ids, special), PIECES)
