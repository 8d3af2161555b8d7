"""Token ids as ORC: integer run-length encoding, row indexes and Bloom filters on document ids.

Documents are dealt to files by ranges of doc_id and sorted within, so file after file they ascend. Each row keeps its
document's ids as an array of integers (ORC packs their runs to the bits they need), their number, and where they begin in the file. The
files' totals, added up, give where a document begins in the whole corpus, without reading ids. Stripes are read in parallel; a filter on
doc_id skips stripes and row groups by their ranges and Bloom filters.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillsight.llm.common import parts, small

SCHEMA = "doc_id long, begin long, n_tokens long, ids array<int>"
ORC = {
    "compression": "zstd", "orc.stripe.size": str(32 << 20), "orc.row.index.stride": "1000", "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
}


def id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))


def _encode(path: str, kind: str, end_id: int, special: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("begin", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        from tillsight.llm.tokens import encoder

        words, begin = encoder(path, kind, special), 0
        for b in parts(batches):
            ids = [np.append(x, np.int32(end_id)) for x in words.encode(b.column("text").to_pylist())]
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            begins = begin + np.cumsum(sizes) - sizes
            begin += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(begins), pa.array(sizes), id_lists(ids)], schema=schema)

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, kind: str = "byte", end_id: int = 2, special: bool = False) -> None:
    """Writes every document of ``docs`` to ORC files in ``folder``, ascending by doc_id; rows of one id by their text's hash.

    A null text is empty and has the end id alone; a null doc_id comes first. Repeated rows are written each. An empty table writes
    an empty file or none. ``tokenizer`` is a path that every executor has;
    ``special``: strings of its added tokens become these tokens, else they are ordinary text.
    """
    ordered = docs.select("doc_id", "text").withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    ordered.drop("h").mapInArrow(_encode(tokenizer, kind, end_id, special), SCHEMA).write.options(**ORC).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids. Filters on doc_id reach the files."""
    rows = spark.read.schema(SCHEMA).orc(folder).withColumn("file", F.col("_metadata.file_name"))
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col("file").alias("f"), F.coalesce(before, F.lit(0)).alias("offset"))
    return rows.join(small(offsets, 1_000_000), F.col("file") == F.col("f")).select(
        "doc_id", (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids")


def _sums(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for b in parts(batches):
        lists = b.column("ids")
        flat, bounds = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
        bounds = bounds - bounds[0]
        data = memoryview(flat.tobytes())
        crcs = [zlib.crc32(data[4 * a: 4 * z]) for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crcs, pa.int64())], schema=schema)


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids as little-endian 32-bit integers."""
    return tokens.mapInArrow(_sums, "doc_id long, start long, n_tokens long, ids_crc32 long")
