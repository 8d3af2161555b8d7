"""Sources, sinks, projections, filters and joins."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..config import TRANSACTION_SCHEMA
from ..functions import exprs as fx
from ..operators import features as fe, scoring as sc
from ..session import materialise, shared_folder
from ..sources import adapters as ad, readers, writers
from ..streaming import parse_payload, read_txn_stream, start_bronze
from .registry import (
    IMPACTS, SEGMENT_MODEL, ev, feats, query, r, rounded, rt, score_log, scored, sql, names_sql, ordinal_sql,
)
from .registry import cte

TXN = "transaction_id, customer_id, category, total_amount, channel, ingest_date"


def _new_path(spark, name: str) -> str:
    return f"{shared_folder(spark)}/tillsight-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _events_with_date(spark, d):
    return ev(spark, d).select("transaction_id", "customer_id", "category", "total_amount", "channel", "ingest_date")


# ---- Sources ----

@query("s2_read_table", sql("SELECT * FROM customer"))
def _(spark, d):
    return readers.read_table(spark, f"{d}/customer.parquet")


@query("s3_read_partition", sql(f"SELECT {TXN} FROM ev WHERE ingest_date = DATE '2024-01-15'"))
def _(spark, d):
    path = _new_path(spark, "bronze")
    writers.overwrite(_events_with_date(spark, d), path, ["ingest_date"])
    return readers.read_partition(readers.read_table(spark, path), "ingest_date", "2024-01-15")


@query("s3_read_lookback", sql(f"SELECT {TXN} FROM ev WHERE ingest_date >= DATE '2024-01-24'"))
def _(spark, d):
    path = _new_path(spark, "bronze")
    writers.overwrite(_events_with_date(spark, d), path, ["ingest_date"])
    return readers.read_lookback(readers.read_table(spark, path), "ingest_date", 7, ad.EVENTS_SNAPSHOT)


@query("s4_read_txn_csv", sql("""SELECT transaction_id, customer_id, persona, CAST(ingest_date AS TIMESTAMP) AS date, category, channel,
  round(total_amount, 2) AS basket_value FROM rt LEFT JOIN cust USING (customer_id)"""))
def _(spark, d):
    path = _new_path(spark, "csv")
    txns = fe.with_persona(rt(spark, d), ad.customers(spark, d)).select(
        "transaction_id", "customer_id", "persona", F.col("ingest_date").cast("string").alias("date"), "category", "channel",
        F.col("total_amount").alias("basket_value"),
    )
    writers.export_csv(txns, path)
    return readers.read_txn_csv(spark, path).withColumn("date", F.col("date").cast("timestamp_ntz"))


@query("s6_read_reference", sql(f"""SELECT feature, count(*) AS n, {r('min(value)', 6)} AS lo, {r('max(value)', 6)} AS hi FROM (
  UNPIVOT (SELECT CAST(recency_days AS DOUBLE) AS recency_days, CAST(frequency AS DOUBLE) AS frequency, CAST(online_ratio AS DOUBLE) AS online_ratio FROM feats)
  ON recency_days, frequency, online_ratio INTO NAME feature VALUE value) GROUP BY feature"""))
def _(spark, d):
    from ..operators.drift import reference_table
    path = _new_path(spark, "reference")
    reference_table(feats(spark, d), ["recency_days", "frequency", "online_ratio"]).write.parquet(path)
    ref = readers.read_reference(spark, path)
    out = ref.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    return rounded(out, lo=6, hi=6)


# ---- Stream into bronze ----

def _bodies(spark, d):
    """Events as JSON bodies, as a producer would send them."""
    e = ev(spark, d)
    return e.select(F.to_json(F.struct(
        "transaction_id", "customer_id", "category", "total_amount",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), "channel",
    )).alias("value"))


BRONZE = sql("""SELECT transaction_id, customer_id, category, total_amount, "timestamp", channel, ingest_date FROM ev""")


def _bronze_columns(df):
    return df.select(
        "transaction_id", "customer_id", "category", "total_amount", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "channel", F.col("ingest_date").cast("date").alias("ingest_date"),
    )


@query("s1_read_txn_stream", BRONZE)
def _(spark, d):
    src, out, ckpt = (_new_path(spark, n) for n in ("stream-in", "bronze", "checkpoint"))
    _bodies(spark, d).write.text(src)
    stream = parse_payload(read_txn_stream(spark, src))
    start_bronze(stream, out, ckpt).awaitTermination()
    return _bronze_columns(spark.read.parquet(out))


@query("k1_start_bronze", sql('SELECT ingest_date, count(*) AS n, round(sum(total_amount), 2) AS amount FROM ev GROUP BY 1'))
def _(spark, d):
    """Two runs over the same folder: the second adds nothing."""
    src, out, ckpt = (_new_path(spark, n) for n in ("stream-in", "bronze", "checkpoint"))
    _bodies(spark, d).write.text(src)
    for _ in range(2):
        start_bronze(parse_payload(read_txn_stream(spark, src, max_files=4)), out, ckpt).awaitTermination()
    b = spark.read.parquet(out)
    return b.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("total_amount"), 2).alias("amount"))


@query("p1_parse_payload", sql("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"))
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", F.from_json("props", "k int").alias("data")).select("event_id", "data.*")


@query("p1_parse_bodies", BRONZE)
def _(spark, d):
    return _bronze_columns(parse_payload(_bodies(spark, d).withColumnRenamed("value", "body"), TRANSACTION_SCHEMA))


# ---- Sinks ----

@query("k2_overwrite", sql(f"SELECT {TXN} FROM ev"))
def _(spark, d):
    path = _new_path(spark, "table")
    for _ in range(2):
        writers.overwrite(_events_with_date(spark, d), path, ["ingest_date"])
    return spark.read.parquet(path).select(*TXN.split(", "))


@query("k3_replace_partitions", sql(f"""SELECT {TXN.replace('total_amount', "CASE WHEN ingest_date = DATE '2024-01-10' THEN -total_amount ELSE total_amount END AS total_amount")} FROM ev"""))
def _(spark, d):
    path = _new_path(spark, "table")
    e = _events_with_date(spark, d)
    writers.overwrite(e, path, ["ingest_date"])
    changed = e.where(F.col("ingest_date") == F.lit("2024-01-10").cast("date")).withColumn("total_amount", -F.col("total_amount"))
    for _ in range(2):
        writers.replace_partitions(changed, path, ["ingest_date"])
    return spark.read.parquet(path).select(*TXN.split(", "))


@query("k4_export_csv", sql("SELECT customer_id, persona, market_segment FROM cust"))
def _(spark, d):
    path = _new_path(spark, "csv")
    writers.export_csv(ad.customers(spark, d), path)
    return spark.read.schema("customer_id string, persona string, market_segment string").csv(path, header=True)


@query("k5_append_audit", sql("""SELECT i.customer_id, '1.0.0' AS model_version, round(least(greatest(1e0 / (1e0 + distance), 0), 1), 6) AS propensity_score,
  feature AS top_feature, impact AS top_feature_impact, DATE '2001-08-02' AS scored_date FROM impacts i JOIN scored s USING (customer_id) WHERE place = 1""", impacts=IMPACTS))
def _(spark, d):
    path = _new_path(spark, "audit")
    s = sc.confidence(materialise(feats(spark, d), "features"), SEGMENT_MODEL)
    s = fe.stamp(sc.explain(s, SEGMENT_MODEL), model_version="1.0.0").withColumn("scored_at", F.lit("2001-08-02").cast("timestamp"))
    writers.append_audit(sc.audit_rows(s), path)
    return spark.read.parquet(path).drop("scored_at")


METRICS = """SELECT category, metric, value FROM (UNPIVOT (SELECT category, CAST(count(*) AS DOUBLE) AS n, round(sum(total_amount), 2) AS amount,
  CAST(count(DISTINCT customer_id) AS DOUBLE) AS customers FROM ev GROUP BY category) ON n, amount, customers INTO NAME metric VALUE value)"""


@query("k6_log_metrics", sql(METRICS))
def _(spark, d):
    path = _new_path(spark, "metrics")
    wide = ev(spark, d).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("total_amount"), 2).alias("amount"), F.countDistinct("customer_id").alias("customers")
    )
    writers.log_metrics(writers.metrics_long(wide, ["category"], ["n", "amount", "customers"]), path, "run-1", {"source": "events"})
    return spark.read.parquet(path).select("category", "metric", "value")


@query("f15_utc_now", sql("SELECT category, count(*) AS n, true AS stamped FROM (SELECT DISTINCT category FROM ev) GROUP BY 1"))
def _(spark, d):
    """Logged metric rows carry the moment of the run, in UTC."""
    import datetime as dt

    path = _new_path(spark, "metrics")
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(seconds=1)
    wide = ev(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    writers.log_metrics(writers.metrics_long(wide, ["category"], ["n"]), path, "run-1")
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(seconds=1)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    micros = lambda t: int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    return spark.read.parquet(path).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.min(at.between(micros(before), micros(after))).alias("stamped"))


_TEN = lambda way: f"SELECT string_agg(customer_id, '|' ORDER BY propensity_score {way}, customer_id) FROM (SELECT * FROM scored ORDER BY propensity_score {way}, customer_id LIMIT 10)"


@query("k7_write_report", sql(f"""SELECT count(*) AS n_customers, round(avg(propensity_score), 6) AS mean, round(quantile_cont(propensity_score, 0.9), 6) AS p90, round(max(propensity_score), 6) AS max,
  ({_TEN('DESC')}) AS top_ten, ({_TEN('ASC')}) AS bottom_ten, (SELECT string_agg(segment_id || ':' || n, '|' ORDER BY segment_id) FROM (SELECT segment_id, count(*) AS n FROM scored GROUP BY 1)) AS segments FROM scored"""))
def _(spark, d):
    path = _new_path(spark, "report")
    report = sc.score_report(scored(spark, d), "propensity", "Production", "2001-08-02T00:00:00Z")
    writers.write_report(report, path)
    back = spark.read.json(path, schema=report.schema)
    ids = lambda c: F.array_join(F.transform(c, lambda x: x["customer_id"]), "|")
    return back.select(
        "n_customers", "score_distribution.mean", "score_distribution.p90", "score_distribution.max",
        ids("top_10_customers").alias("top_ten"), ids("bottom_10_customers").alias("bottom_ten"),
        F.expr("array_join(transform(segment_distribution, s -> concat(s.segment_id, ':', s.n)), '|')").alias("segments"),
    )


@query("k8_register_views", sql("SELECT segment_id, count(*) AS n, round(sum(propensity_score), 4) AS score FROM scored GROUP BY 1"))
def _(spark, d):
    base = _new_path(spark, "gold")
    s = scored(spark, d)
    writers.overwrite(s.select("customer_id", "segment_id", "recency_days", "monetary", "snapshot_date"), f"{base}/customer_segments")
    writers.overwrite(s.select("customer_id", F.lit("promo").alias("target_category"), "propensity_score"), f"{base}/propensity_scores", ["target_category"])
    writers.register_views(spark, base)
    return spark.sql("""SELECT s.segment_id, count(*) AS n, round(sum(p.propensity_score), 4) AS score
      FROM customer_segments s JOIN propensity_scores p ON s.customer_id = p.customer_id GROUP BY s.segment_id""")


@query("k9_stage", sql("SELECT count(*) AS staged, count(*) AS read_back, round(sum(total_amount), 2) AS amount FROM ev"))
def _(spark, d):
    path = _new_path(spark, "stage")
    n = writers.stage(_events_with_date(spark, d), path)
    back = spark.read.parquet(path)
    return back.agg(F.lit(n).cast("bigint").alias("staged"), F.count(F.lit(1)).alias("read_back"), F.round(F.sum("total_amount"), 2).alias("amount"))


# ---- Projections, filters, predicates ----

@query("p2_ingest_date", sql("SELECT transaction_id, ingest_date FROM ev"))
def _(spark, d):
    return ev(spark, d).select("transaction_id", "ingest_date")


@query("p3_scored_between", sql("""SELECT * FROM score_log WHERE CAST(scored_at AS DATE) BETWEEN DATE '2001-01-01' AND DATE '2001-01-08'"""))
def _(spark, d):
    return fe.scored_between(score_log(spark, d), "scored_at", dt.date(2001, 1, 1), dt.date(2001, 1, 8))


@query("p4_since", sql("""SELECT transaction_id, customer_id FROM ev WHERE "timestamp" >= DATE '2024-01-17'"""))
def _(spark, d):
    return fe.since(ev(spark, d), "timestamp", dt.date(2024, 1, 17)).select("transaction_id", "customer_id")


@query("p5_window_slices", sql("""SELECT transaction_id, CAST(date_diff('day', (SELECT min(ingest_date) FROM ev), ingest_date) AS INTEGER) AS day,
  date_diff('day', (SELECT min(ingest_date) FROM ev), ingest_date) <= 19 AS in_train_features,
  date_diff('day', (SELECT min(ingest_date) FROM ev), ingest_date) BETWEEN 20 AND 24 AS in_train_labels,
  date_diff('day', (SELECT min(ingest_date) FROM ev), ingest_date) <= 24 AS in_test_features,
  date_diff('day', (SELECT min(ingest_date) FROM ev), ingest_date) >= 25 AS in_test_labels FROM ev"""))
def _(spark, d):
    out = fe.window_slices(ev(spark, d), **ad.EVENTS_BOUNDS)
    return out.select("transaction_id", "day", "in_train_features", "in_train_labels", "in_test_features", "in_test_labels")


@query("p6_promoted_only", sql(f"SELECT transaction_id, category FROM rt WHERE category IN ({names_sql(ad.RETAIL_PROMOTED)})"))
def _(spark, d):
    return fe.promoted_only(rt(spark, d), ad.RETAIL_PROMOTED).select("transaction_id", "category")


# Every fifth event's amount and every seventh event's type read as missing: the tables hold no nulls.
cte("holes", """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type, user_id FROM events""")


def _holes(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select(
        "event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"), "user_id",
    )


@query("p7_complete", sql("SELECT * FROM holes WHERE value IS NOT NULL AND event_type IS NOT NULL"))
def _(spark, d):
    return fe.complete(_holes(spark, d), ["value", "event_type"])


@query("p8_fill", sql("SELECT event_id, coalesce(value, 0) AS value, coalesce(event_type, 'none') AS event_type, user_id FROM holes"))
def _(spark, d):
    return fe.fill(_holes(spark, d), {"value": 0.0, "event_type": "none"})


@query("p9_stamp", sql("SELECT customer_id, persona, '1.0.0' AS model_version, 'promo' AS target_category, DATE '2001-08-02' AS run_date FROM cust"))
def _(spark, d):
    out = fe.stamp(ad.customers(spark, d), model_version="1.0.0", full_name="propensity-promo", run_date=ad.RETAIL_SNAPSHOT)
    return out.withColumn("target_category", fx.strip_prefix("full_name", "propensity-")).select(
        "customer_id", "persona", "model_version", "target_category", "run_date"
    )


@query("p10_conform", sql("""SELECT CAST(user_id AS VARCHAR) AS customer_id, greatest(coalesce(min(value), 0), 0.01) AS monetary,
  CAST(count(*) AS DOUBLE) AS frequency, 0.0::DOUBLE AS basket_std FROM holes GROUP BY user_id"""))
def _(spark, d):
    base = _holes(spark, d).groupBy(F.col("user_id").alias("customer_id")).agg(F.min("value").alias("monetary"), F.count(F.lit(1)).alias("frequency"))
    return fe.conform(base, ["monetary", "frequency", "basket_std"])


@query("p11_clip", sql("SELECT event_id, CASE WHEN value IS NULL THEN NULL ELSE least(greatest(value, 10), 100) END AS value FROM holes"))
def _(spark, d):
    return _holes(spark, d).select("event_id", fx.clip("value", 10.0, 100.0).alias("value"))


@query("p12_out_of_range", sql("SELECT event_id, value / 100e0 - 0.2e0 AS propensity_score FROM events WHERE value / 100e0 - 0.2e0 < 0 OR value / 100e0 - 0.2e0 > 1"))
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", (F.col("value") / 100.0 - 0.2).alias("propensity_score"))
    return fe.out_of_range(e)


@query("p13_rename", sql("SELECT customer_id, segment_id AS segment FROM scored"))
def _(spark, d):
    return scored(spark, d).select("customer_id", F.col("segment_id").alias("segment"))


# ---- Joins ----

FEATURE_COLUMNS = f"""customer_id, recency_days, frequency, {r('monetary', 2)} AS monetary, active_days, {r('avg_basket_size', 6)} AS avg_basket_size,
  {r('basket_std', 6)} AS basket_std, top_categories, online_txns, instore_txns, {r('online_ratio', 6)} AS online_ratio"""


@query("silver_features", sql(f"SELECT {FEATURE_COLUMNS}, top_category, has_promoted_category, DATE '2001-08-02' AS snapshot_date FROM feats"))
def silver(spark, d):
    """Flagship: bronze to silver in one pass."""
    out = feats(spark, d).withColumn("top_categories", F.array_join("top_categories", "|"))
    return rounded(out, monetary=2, avg_basket_size=6, basket_std=6, online_ratio=6)


@query("j1_assemble", sql(f"SELECT {FEATURE_COLUMNS} FROM feats"))
def _(spark, d):
    t = rt(spark, d)
    out = fe.assemble(fe.rfm(t, ad.RETAIL_SNAPSHOT), fe.top_categories(t), fe.channel_mix(t))
    out = out.withColumn("top_categories", F.array_join("top_categories", "|"))
    return rounded(out, monetary=2, avg_basket_size=6, basket_std=6, online_ratio=6)


@query("j2_with_segments", sql(f"""SELECT c.customer_id, c.persona, s.segment_id FROM cust c LEFT JOIN
  (SELECT customer_id, segment_id FROM scored WHERE segment_id < 2) s USING (customer_id)"""))
def _(spark, d):
    seg = scored(spark, d).where("segment_id < 2").select("customer_id", "segment_id")
    return fe.with_segments(ad.customers(spark, d).select("customer_id", "persona"), seg)


OUTCOMES = """SELECT l.log_id, l.customer_id, l.propensity_score, l.segment_id, CASE WHEN p.customer_id IS NULL THEN 0 ELSE 1 END AS purchased
  FROM (SELECT * FROM score_log WHERE scored_at >= TIMESTAMP '2000-07-01' AND scored_at < TIMESTAMP '2001-04-01') l
  LEFT JOIN (SELECT DISTINCT customer_id FROM rt WHERE category = 'PROMO' AND "timestamp" >= DATE '2000-07-01') p USING (customer_id)"""
cte("outcomes", OUTCOMES)


def outcomes(spark, d):
    """Past scores of a window with what the customers bought since its start."""
    lo, hi = dt.date(2000, 7, 1), dt.date(2001, 3, 31)
    log = fe.scored_between(score_log(spark, d), "scored_at", lo, hi).drop("scored_at", "model_version")
    bought = fe.purchasers(fe.since(rt(spark, d), "timestamp", lo).where("category = 'PROMO'"))
    return fe.with_outcome(log, bought).select("log_id", "customer_id", "propensity_score", "segment_id", "purchased")


@query("j3_with_outcome", sql("SELECT * FROM outcomes"))
def _(spark, d):
    return outcomes(spark, d)


@query("j4_with_persona", sql("""SELECT u.customer_id, coalesce(c.persona, 'C') AS persona FROM (SELECT DISTINCT 'CUST-' || (o_custkey * 2) AS customer_id FROM orders) u
  LEFT JOIN cust c USING (customer_id)"""))
def _(spark, d):
    ids = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(F.lit("CUST-"), (F.col("o_custkey") * 2).cast("string")).alias("customer_id")).distinct()
    return fe.with_persona(ids, ad.customers(spark, d))


@query("j6_overlap_share", sql(f"""SELECT count(*) AS n_members, count(t.customer_id) AS n_inside, {r('count(t.customer_id) / count(*)', 6)} AS share
  FROM (SELECT customer_id FROM cust WHERE persona = 'A') m LEFT JOIN (SELECT customer_id FROM (
    {ordinal_sql('scored', 'propensity_score', 'customer_id')}) WHERE ordinal <= greatest(n_rows // 10, 1)) t USING (customer_id)"""))
def _(spark, d):
    from ..operators.metrics import top_fraction
    loyal = ad.customers(spark, d).where("persona = 'A'")
    return rounded(fe.overlap_share(loyal, top_fraction(scored(spark, d), "propensity_score")), share=6)


@query("u1_union_all", sql("SELECT customer_id, persona FROM cust WHERE persona = 'A' UNION ALL SELECT customer_id, persona FROM cust WHERE persona <> 'C'"))
def _(spark, d):
    c = ad.customers(spark, d).select("customer_id", "persona")
    return c.where("persona = 'A'").unionByName(c.where("persona <> 'C'"))


@query("f1_text_functions", sql("""SELECT DISTINCT lower(replace(p_name, ' ', '_')) AS slug, p_type,
  upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS title FROM part"""))
def _(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet")
    return p.select(fx.slug("p_name").alias("slug"), "p_type", fx.title("p_type").alias("title")).distinct()
