"""Language by string kernels: hashed presence of blended byte n-grams, Nystroem landmarks, one-versus-rest kernel ridge regression.

The kernel of two texts is the number of n-grams (one to four bytes of the lower-cased text, hashed to 2**16 places) that both have, over the
geometric mean of their numbers. It is fitted on a bounded sample of labelled rows, by way of landmarks among them. As the
kernel is a product of presence vectors, landmarks and regression fold into one matrix, and a batch of whole texts is
scored by products of its presence matrix with that.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import parts, slices
from tillsight.llm.hashing import VALUES

PLACES_BITS, LONGEST = 16, 4
PLACES = 1 << PLACES_BITS
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def presence(texts: list[str]) -> np.ndarray:
    """A row of PLACES flags (uint8) for each text."""
    encoded = [t.lower().encode() for t in texts]
    data = np.frombuffer(b"".join(encoded), dtype=np.uint8)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64) * PLACES, [len(x) for x in encoded])
    out = np.zeros(len(texts) * PLACES, dtype=np.uint8)
    values, h = VALUES[data] >> np.uint64(1), np.zeros(len(data), dtype=np.uint64)
    for n in range(1, min(LONGEST, len(data)) + 1):
        # Hash of the n bytes from each place on; those that would reach into the next text are left out.
        m = len(data) - n + 1
        h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + values[n - 1:]
        place = (((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - PLACES_BITS)).astype(np.int64)
        inside = doc[:m] == doc[n - 1:]
        place += doc[:m]
        out[place if inside.all() else place[inside]] = 1
    return out.reshape(len(texts), PLACES)


@dataclass
class Model:
    languages: list[str]
    matrix: np.ndarray  # places x languages
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Regression values (texts x languages), in blocks that bound the memory."""
        out = np.zeros((len(texts), len(self.languages)))
        for first, run in slices(texts, 300_000):
            for lo in range(0, len(run), 64):
                p = presence(run[lo: lo + 64]).astype(np.float32)
                size = np.maximum(p.sum(axis=1, keepdims=True), 1)
                out[first + lo: first + lo + len(p)] = (p @ self.matrix) / np.sqrt(size) + self.bias
        return out


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id's digits leaves 2 modulo 4. A null id is not held out, and not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _pack(batches):
    for b in parts(batches):
        texts = b.column("text").to_pylist()
        keep = [i for i, t in enumerate(texts) if has_letter(t)]
        bits = [np.packbits(presence([texts[i]])[0]).tobytes() for i in keep]
        yield pa.RecordBatch.from_arrays([b.column("lang").take(pa.array(keep, pa.int64())), b.column("r").take(pa.array(keep, pa.int64())), pa.array(bits, pa.binary())],
                                         names=["lang", "r", "bits"])


def fit(labelled: DataFrame, max_rows: int = 1600, landmarks: int = 240, ridge: float = 1e-2) -> Model | None:
    """Model from rows (doc_id, text, lang), at most ``max_rows``: those with the least hash of their id, as many of each language.

    Null languages, ids and texts are left out, and texts without a letter. None where nothing is left. The bound holds for languages
    too: more of them than ``max_rows`` raise an error.
    """
    rows = labelled.select("doc_id", "text", "lang").where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(max_rows + 1).collect()}
    if len(counts) > max_rows:
        raise ValueError(f"more than max_rows = {max_rows} languages")
    if not counts:
        return None
    each = max_rows // len(counts)
    # A hash below a bound that about twice as many rows as wanted pass leaves few rows to rank, whatever the size of a language.
    bounds = labelled.sparkSession.createDataFrame([(k, (2 * each + 60) / n) for k, n in counts.items()], "bl string, bound double")
    share = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    near = rows.join(F.broadcast(bounds), F.col("lang") == F.col("bl")).where(share < F.col("bound"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(share, "doc_id", F.xxhash64("text")))
    sample = near.withColumn("r", rank).where(F.col("r") <= each).mapInArrow(_pack, "lang string, r int, bits binary").collect()
    if not sample:
        return None
    sample.sort(key=lambda r: (r.r, r.lang))
    names = sorted({r.lang for r in sample})
    unpack = lambda part: np.unpackbits(np.frombuffer(b"".join(r.bits for r in part), np.uint8).reshape(len(part), -1), axis=1).astype(np.float32)
    scaled = lambda x: x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    marks = scaled(unpack(sample[:landmarks]))
    kernel = np.concatenate([scaled(unpack(sample[i: i + 100])) @ marks.T for i in range(0, len(sample), 100)]).astype(np.float64)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = kernel @ root
    y = np.array([[1.0 if r.lang == n else -1.0 for n in names] for r in sample])
    centre, mean = features.mean(axis=0), y.mean(axis=0)
    f = features - centre
    weights = np.linalg.solve(f.T @ f + ridge * len(f) * np.eye(f.shape[1]) / 10, f.T @ (y - mean))
    return Model(names, (marks.T @ (root @ weights)).astype(np.float32), mean - centre @ weights)


def _score(model: Model | None):
    def run(batches):
        for b in parts(batches):
            texts = b.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if model and has_letter(t)]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                s = model.scores([texts[i] for i in known])
                best = s.argmax(axis=1)
                value = np.clip((s[np.arange(len(s)), best] + 1) / 2, 0, 1)
                for i, k, v in zip(known, best.tolist(), value.tolist(), strict=True):
                    lang[i], score[i] = model.languages[k], v
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang), pa.array(score, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred and score (0 to 1: the winner's regression value, -1..1 put on 0..1).

    ``und`` with score 0 for a null text, one without a letter, or where there is no model. Repeated rows get a result each. Where languages
    tie, the first name in order wins.
    """
    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(
        _score(model), "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, **how) -> DataFrame:
    """Fits on the rows that are not held out and predicts for all."""
    return predicted(docs, fit(docs.where(~held_out(F.col("doc_id"))), **how))
