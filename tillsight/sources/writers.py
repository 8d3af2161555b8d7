"""Sinks."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

log = logging.getLogger(__name__)


def _balanced(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a partition together, so files are not tiny; a partition too large for one task is split at run time."""
    return df.hint("rebalance", *by) if by else df


def overwrite(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    by = list(by or [])
    _balanced(df, by).write.mode("overwrite").partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: list[str], named: list[tuple] | None = None) -> None:
    """Replace the partitions present in ``df``; running again gives the same table.

    ``named`` lists partitions (one tuple of values each) that the run stands for: those of them that ``df`` has no row of
    are emptied, so that a run without rows does not leave an older one's behind.
    """
    (
        _balanced(df, by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path)
    )
    if not named:
        return
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for values in named:
        here = F.lit(True)
        for column, value in zip(by, values, strict=True):
            here = here & F.col(column).eqNullSafe(F.lit(value))
        if df.where(here).isEmpty():
            folder = jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{c}={v}" for c, v in zip(by, values, strict=True))]))
            folder.getFileSystem(conf).delete(folder, True)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def append_audit(rows: DataFrame, path: str) -> bool:
    """Append explanation rows; an audit failure is logged and never stops scoring."""
    try:
        dated = rows.withColumn("scored_date", F.to_date("scored_at"))
        _balanced(dated, ["scored_date"]).write.mode("append").partitionBy("scored_date").parquet(path)
        return True
    except Exception:
        log.exception("explanation audit was not written")
        return False


def metrics_long(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """Wide metric columns as rows (ids..., metric, value)."""
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(ids, metrics, "metric", "value")


def log_metrics(long: DataFrame, path: str, run_id: str, tags: dict[str, str] | None = None) -> None:
    """Append one run's metric rows, with its tags as a map."""
    pairs = [F.lit(x) for kv in (tags or {}).items() for x in kv]
    tag_map = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    rows = long.withColumn("run_id", F.lit(run_id)).withColumn("ts", F.current_timestamp()).withColumn("tags", tag_map)
    rows.write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Nested rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def stage(df: DataFrame, path: str) -> int:
    """Write a hand-off table and return its row count; the count comes from the file footers, no data is read again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def register_views(spark: SparkSession, base: str) -> list[str]:
    """BI views over the gold tables."""
    names = ["customer_segments", "propensity_scores"]
    for name in names:
        spark.read.parquet(f"{base}/{name}").createOrReplaceTempView(name)
    return names
