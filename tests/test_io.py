import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillsight.config import TRANSACTION_SCHEMA
from tillsight.session import materialise, shared_folder
from tillsight.sources import readers, writers
from tillsight.streaming import parse_payload, read_txn_stream, start_bronze


def body(i, day, **more):
    return json.dumps({
        "transaction_id": f"TXN-{i}", "customer_id": "CUST-1", "store_id": "S", "product_id": "P", "category": "dairy", "quantity": 2,
        "unit_price": 1.5, "total_amount": 3.0, "timestamp": f"2024-01-{day:02d}T10:00:00Z", "channel": "online", **more,
    })


def test_stream_to_bronze(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "bronze", "ckpt"))
    os.makedirs(f"{src}/partition_id=3")
    with open(f"{src}/partition_id=3/a.txt", "w") as f:
        f.write("\n".join([body(1, 5), body(2, 6), "{not json"]))
    run = lambda: start_bronze(parse_payload(read_txn_stream(spark, src, partitioned=True)), out, ckpt).awaitTermination()
    run()
    first = rows(spark.read.parquet(out))
    assert len(first) == 3
    ok = {r["transaction_id"]: r for r in first}
    assert ok["TXN-1"]["ingest_date"] == dt.date(2024, 1, 5) and ok["TXN-1"]["partition_id"] == 3 and ok["TXN-1"]["enqueued_at"] is not None
    bad = ok[None]
    assert all(bad[f.name] is None for f in TRANSACTION_SCHEMA.fields) and bad["ingest_date"] is None
    run()
    assert spark.read.parquet(out).count() == 3
    with open(f"{src}/partition_id=3/b.txt", "w") as f:  # a late event goes to its own date
        f.write(body(3, 5))
    run()
    assert spark.read.parquet(out).where("ingest_date = '2024-01-05'").count() == 2
    batch = parse_payload(spark.createDataFrame([(body(1, 5),)], "body string"))
    assert rows(batch)[0]["total_amount"] == 3.0


def test_partition_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "d1", 1), ("b", "d2", 2)], "id string, run_date string, v int")
    writers.overwrite(df, path, ["run_date"])
    for _ in range(2):
        writers.replace_partitions(spark.createDataFrame([("c", "d2", 9)], df.schema), path, ["run_date"])
    got = {(r["id"], r["run_date"], r["v"]) for r in rows(spark.read.parquet(path))}
    assert got == {("a", "d1", 1), ("c", "d2", 9)}
    writers.replace_partitions(df.limit(0), path, ["run_date"], named=[("d2",)])  # a run without rows
    assert {r["id"] for r in rows(spark.read.parquet(path))} == {"a"}
    writers.overwrite(df.withColumn("extra", F.lit(1)), path)  # a new schema
    assert "extra" in spark.read.parquet(path).columns
    assert writers.stage(df, str(tmp_path / "s")) == 2


def test_pruned_scans(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(100).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("snapshot_date"))
    writers.overwrite(df, path, ["snapshot_date"])
    table = readers.read_table(spark, path)
    one = readers.read_partition(table, "snapshot_date", "2024-01-03")
    assert one.count() == 5
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().executedPlan().toString()
    assert readers.read_lookback(table, "snapshot_date", 7, dt.date(2024, 1, 20)).count() == 40
    with pytest.raises(readers.EmptySource):
        readers.read_lookback(table, "snapshot_date", 7, dt.date(2025, 1, 20))


def test_csv_and_reference(spark, tmp_path):
    (tmp_path / "t.csv").write_text("transaction_id,customer_id,persona,date,category,channel,basket_value\nT1,C1,A,2024-01-05,dairy,online,3.5\n")
    got = rows(readers.read_txn_csv(spark, str(tmp_path / "t.csv")))[0]
    assert got["date"] == dt.datetime(2024, 1, 5) and got["basket_value"] == 3.5
    with pytest.raises(readers.EmptySource):
        readers.read_reference(spark, str(tmp_path / "none"))
    empty = spark.createDataFrame([], "feature string, value double")
    empty.write.parquet(str(tmp_path / "empty"))
    with pytest.raises(readers.EmptySource):
        readers.read_reference(spark, str(tmp_path / "empty"))


def test_metrics_log_and_report(spark, tmp_path):
    wide = spark.createDataFrame([("r", 0.5, 3)], "name string, auc double, n int")
    path = str(tmp_path / "m")
    for run in ("1", "2"):
        writers.log_metrics(writers.metrics_long(wide, ["name"], ["auc", "n"]), path, run, {"model": "x"})
    got = rows(spark.read.parquet(path))
    assert {(r["run_id"], r["metric"], r["value"]) for r in got} == {("1", "auc", .5), ("1", "n", 3.0), ("2", "auc", .5), ("2", "n", 3.0)}
    assert got[0]["tags"] == {"model": "x"}
    writers.write_report(wide.select(F.struct("auc", "n").alias("score")), str(tmp_path / "r"))
    assert rows(spark.read.json(str(tmp_path / "r")))[0]["score"]["auc"] == 0.5


def test_shared_folder(spark):
    df = spark.range(5)
    back = materialise(df)
    assert back.count() == 5 and back.dtypes == df.dtypes
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")
    assert all(shared_folder(spark).removeprefix("file:") in f for f in back.inputFiles())
