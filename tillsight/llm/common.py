"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space that separates words where a contract names it: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Arrow batches of the default size (64 MB) take several times as much in each task, in the executor and in its worker; these do.
BATCH_KEY, BATCH_DEFAULT, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 8 << 20


def _prepare(spark: SparkSession) -> None:
    """Python workers that share this machine's files find the package where the driver found it, and get texts in small batches.

    A batch size that the session sets itself stays.
    """
    if spark.conf.get(BATCH_KEY).rstrip("b") == str(BATCH_DEFAULT):
        spark.conf.set(BATCH_KEY, str(BATCH))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; text of ASCII alone takes the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def with_key(docs: DataFrame, text: Column) -> DataFrame:
    """Adds ``k1, k2``, never null: the doc_id and a hash of the text (and of the id's being null).

    Rows that agree in both are repeated rows, which every operator treats as the same document.
    """
    _prepare(docs.sparkSession)
    return docs.withColumns({
        "k1": F.coalesce(F.col("doc_id"), F.lit(0)).cast("long"), "k2": F.xxhash64(text, F.col("doc_id").isNull()),
    })


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key (see ``with_key``) is not among the distinct k1, k2 of ``keys``, with their own columns alone."""
    return _by_key(docs, keys, "left_anti")


def only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is among those of ``keys``."""
    return _by_key(docs, keys, "left_semi")


def _by_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    other = small(keys.select(F.col("k1").alias("_j1"), F.col("k2").alias("_j2")), 1_000_000)
    # The columns go into a struct, so that none of them can clash with the key's.
    rows = with_key(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")), F.col("text"))
    return rows.join(other, (F.col("k1") == F.col("_j1")) & (F.col("k2") == F.col("_j2")), how).select("_row.*")


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to have at most ``rows`` rows, else as it is (a shuffle join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ordinals(df: DataFrame, group: list[str], order: list[str], name: str, rows_each: int = 50_000) -> DataFrame:
    """Adds ``name``: the place of each row within its group, from 0 without gaps, in an order by hash.

    Rows go to buckets by a hash of ``order`` (columns that together tell rows apart); the sizes of the buckets
    are added up, which is a table of groups x buckets rows, and only rows of a bucket (about ``rows_each``) are
    sorted together. Rows that agree in all of ``order`` are interchangeable. ``df`` must be a written table, as it is read twice.
    """
    buckets = max(64, df.count() // rows_each)
    b = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = b.groupBy(*group, "_b").count()
    before = F.sum("count").over(Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*group, "_b", F.coalesce(before, F.lit(0)).alias("_start"))
    starts = starts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_b").alias("_sb"), "_start")
    on = F.col("_b") == F.col("_sb")
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    placed = b.join(small(starts, 200_000), on)
    place = F.row_number().over(Window.partitionBy(*group, "_b").orderBy(*order))
    return placed.withColumn(name, F.col("_start") + place - 1).drop("_b", "_sb", "_start", *[f"_g{i}" for i in range(len(group))])


def parts(batches: Iterable, size: int = 4 << 20) -> Iterator:
    """Arrow batches cut to about ``size`` bytes (a row at least), so that a worker unpacks little at a time."""
    for b in batches:
        step = max(1, int(b.num_rows * size / max(b.nbytes, 1)))
        for first in range(0, b.num_rows, step):
            yield b.slice(first, step)


def slices(texts: Iterable[str], limit: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters together (at least one text), with the first one's position."""
    first, size, run = 0, 0, []
    for i, t in enumerate(texts):
        if run and size + len(t) > limit:
            yield first, run
            first, size, run = i, 0, []
        run.append(t)
        size += len(t)
    if run:
        yield first, run
