"""One streaming job: read the body, parse it, add the event's date, append to bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import TRANSACTION_SCHEMA


def read_txn_stream(spark: SparkSession, path: str | None = None, max_files: int | None = None,
                    partitioned: bool = False, kafka: dict[str, str] | None = None) -> DataFrame:
    """Stream with columns body, enqueued_at, partition_id, from the first record on.

    ``path`` is a folder of text files, one JSON body a line, ``partitioned`` when they lie in
    ``partition_id=<n>`` folders; ``kafka`` holds the connector's options (servers, topic, consumer group).
    """
    if kafka is not None:
        options = {"startingOffsets": "earliest", **kafka}
        raw = spark.readStream.format("kafka").options(**options).load()
        return raw.select(
            F.col("value").alias("body"), F.col("timestamp").alias("enqueued_at"),
            F.col("partition").cast("int").alias("partition_id"),
        )
    reader = spark.readStream.schema("value string, partition_id int" if partitioned else "value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.text(path)
    return raw.select(
        F.col("value").cast("binary").alias("body"),
        F.col("_metadata.file_modification_time").alias("enqueued_at"),
        (F.col("partition_id") if partitioned else F.lit(0)).alias("partition_id"),
    )


def parse_payload(df: DataFrame, schema: StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """Fields of the JSON body as columns; a malformed body gives a row of nulls.

    ``ingest_date`` comes from the event's own timestamp, so a late event lands on its own date.
    """
    keep = [c for c in ("enqueued_at", "partition_id") if c in df.columns]
    parsed = df.select(*keep, F.from_json(F.col("body").cast("string"), schema).alias("data"))
    return parsed.select(*keep, "data.*").withColumn("ingest_date", F.to_date("timestamp"))


def start_bronze(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Checkpointed append partitioned by event date; a restart continues after the last finished batch."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).partitionBy("ingest_date")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
