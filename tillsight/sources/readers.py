"""Batch scans."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..config import CSV_SCHEMA


class EmptySource(ValueError):
    """A scan that must not be empty found no row."""


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_partition(df: DataFrame, col: str, day: str | dt.date) -> DataFrame:
    """One date; on a date partition column the literal prunes directories."""
    return df.where(F.col(col) == F.lit(str(day)).cast("date"))


def read_lookback(df: DataFrame, col: str, days: int, today: dt.date, cols: list[str] | None = None,
                  check: bool = True) -> DataFrame:
    """Complete rows of the last ``days`` days of snapshots; an empty look-back is an error."""
    cutoff = today - dt.timedelta(days=days)
    out = df.where(F.col(col) >= F.lit(str(cutoff)).cast("date"))
    if cols:
        out = out.select(*cols).dropna()
    if check and out.isEmpty():
        raise EmptySource(f"no rows in the last {days} days (cutoff={cutoff})")
    return out


def read_txn_csv(spark: SparkSession, path: str, schema: StructType = CSV_SCHEMA) -> DataFrame:
    """Transactions with a header line; the text date becomes a timestamp."""
    raw = spark.read.schema(schema).csv(path, header=True)
    return raw.withColumn("date", F.try_to_timestamp("date"))


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """Reference distributions as rows (feature, value); a missing or empty table is an error."""
    try:
        ref = spark.read.schema("feature string, value double").parquet(path)
        empty = ref.isEmpty()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise EmptySource(f"reference distributions not found at {path}") from exc
    if empty:
        raise EmptySource(f"reference distributions at {path} are empty; training must write them")
    return ref
