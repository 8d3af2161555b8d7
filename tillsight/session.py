"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    # Without per-call-site bookkeeping, building large expressions is an order of magnitude faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tillsight", master: str | None = None, shuffle_partitions: int | None = None,
                  **extra: str) -> SparkSession:
    """A session with the settings the engine expects; a cluster's own settings win when given in ``extra``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a single machine (master ``local``) gets a temporary folder of its own. A cluster
    raises: a local folder would be a different one on each executor and results would be silently partial.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tillsight-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path for an intermediate table, under a folder of this application in the shared folder."""
    return f"{shared_folder(spark)}/tillsight-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a parquet table in the shared folder and read it back.

    For inputs that an operator reads several times (bounds, counts, rows): the plan is computed
    once, later passes prune columns, and a lost executor only re-reads files. The tables live until
    ``drop_intermediates`` is called.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(df: DataFrame) -> None:
    """Delete the table that ``materialise`` returned as ``df``; frames that still read it become unusable.

    For rounds in which each table replaces the one before: what is needed later must be written already.
    """
    _delete(df.sparkSession, df.written_to)


def drop_intermediates(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames that still read them become unusable."""
    _delete(spark, f"{shared_folder(spark)}/tillsight-{spark.sparkContext.applicationId}")
