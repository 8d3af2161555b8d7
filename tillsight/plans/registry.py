"""Registration of queries, shared inputs on the Spark side, shared CTEs on the SQL side."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.exprs import half_up
from ..operators import features as fe
from ..operators.segments import SegmentModel, assign
from ..session import materialise
from ..sources import adapters as ad

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return keep


def cte(name: str, body: str) -> None:
    CTES[name] = body


def sql(body: str, **local: str) -> str:
    """``body`` with the WITH clause of every named CTE it uses, in order of need."""
    known = {**CTES, **local}
    done: list[str] = []

    def need(text: str, seen: tuple[str, ...] = ()) -> None:
        for name in known:
            if name not in seen and name not in done and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                need(known[name], (*seen, name))
                done.append(name)

    need(body)
    parts = ",\n".join(f"{n} AS ({known[n]})" for n in done)
    return (f"WITH {parts}\n" if parts else "") + body


def r(expr: str, digits: int) -> str:
    """SQL twin of :func:`rounded`."""
    return f"round({expr} + 1e-{digits + 3}, {digits})"


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.expr(f"round(CAST(`{c}` AS DOUBLE) + 1e-{d + 3}D, {d})") for c, d in digits.items()})


def u_sql(key: str, seed: str) -> str:
    """SQL twin of ``hash_uniform``."""
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT) / 4294967296e0)"


# ---- Spark inputs ----

def ev(spark: SparkSession, d: str) -> DataFrame:
    return ad.event_transactions(spark, d)


def rt(spark: SparkSession, d: str) -> DataFrame:
    return ad.retail_transactions(spark, d)


def feats(spark: SparkSession, d: str) -> DataFrame:
    return fe.silver_features(rt(spark, d), ad.RETAIL_SNAPSHOT, promoted=ad.RETAIL_PROMOTED)


# Fixed example model on nine features: scaler and three centroids, and a weight table.
SEGMENT_MODEL = SegmentModel(
    features=("recency_days", "frequency", "monetary", "avg_basket_size", "basket_std",
              "online_ratio", "online_txns", "instore_txns", "active_days"),
    means=(240.0, 40.0, 2000000.0, 52000.0, 29000.0, 0.5, 20.0, 20.0, 10.0),
    scales=(230.0, 14.0, 800000.0, 5000.0, 3000.0, 0.08, 8.0, 8.0, 3.0),
    centroids=(
        (-0.5, 0.8, 0.8, 0.1, 0.0, 0.0, 0.7, 0.7, 0.8),
        (0.2, -0.2, -0.2, 0.5, 0.3, 0.3, 0.0, -0.3, -0.2),
        (0.8, -0.9, -0.9, -0.4, -0.2, -0.2, -0.8, -0.7, -0.9),
    ),
)
WEIGHTS = {"recency_days": -0.002, "frequency": 0.03, "monetary": 4e-7, "online_ratio": 1.5}
INTERCEPT = -2.5


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Features with segment and score from the fixed model, written once for operators that pass over it."""
    from ..operators.scoring import linear_score

    f = assign(feats(spark, d), SEGMENT_MODEL)
    f = linear_score(f, WEIGHTS, INTERCEPT, digits=None)
    return materialise(rounded(f, propensity_score=6), "scored")


def score_log(spark: SparkSession, d: str) -> DataFrame:
    """A log of past scores: one entry for each order."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select(
        F.col("o_orderkey").alias("log_id"),
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        half_up(F.lit(1.0) - F.exp(-F.col("o_totalprice") / 200000.0), 6).alias("propensity_score"),
        (F.col("o_orderkey") % 3).cast("int").alias("segment_id"),
        F.col("o_orderdate").alias("scored_at"),
        F.lit("1.0.0").alias("model_version"),
    )


# ---- SQL inputs ----

cte("ev", """SELECT 'TXN-' || event_id AS transaction_id, 'CUST-' || user_id AS customer_id, event_type AS category,
  value AS total_amount, ts AS "timestamp",
  CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) % 2 = 0 THEN 'online' ELSE 'in-store' END AS channel,
  CAST(ts AS DATE) AS ingest_date FROM events""")
cte("rt", """SELECT concat_ws('-', 'TXN', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS transaction_id,
  'CUST-' || o_custkey AS customer_id, 'STORE-' || l_suppkey AS store_id, 'PROD-' || l_partkey AS product_id,
  p_type AS category, CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice / l_quantity AS unit_price,
  l_extendedprice AS total_amount, o_orderdate AS "timestamp",
  CASE WHEN l_linestatus = 'O' THEN 'online' ELSE 'in-store' END AS channel, CAST(o_orderdate AS DATE) AS ingest_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")
cte("cust", """SELECT 'CUST-' || c_custkey AS customer_id,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A' WHEN 'BUILDING' THEN 'B' ELSE 'C' END AS persona,
  c_mktsegment AS market_segment FROM customer""")


def names_sql(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def features_sql(src: str, snapshot: str, promoted) -> str:
    """One row per customer, arrays joined to text."""
    return f"""SELECT b.*, t.top_categories, t.top_category FROM (
    SELECT customer_id, CAST(date_diff('day', CAST(max("timestamp") AS DATE), DATE '{snapshot}') AS INTEGER) AS recency_days,
      count(transaction_id) AS frequency, sum(total_amount) AS monetary, count(DISTINCT ingest_date) AS active_days,
      avg(total_amount) AS avg_basket_size, coalesce(stddev_samp(total_amount), 0) AS basket_std,
      max(CASE WHEN category IN ({names_sql(promoted)}) THEN 1 ELSE 0 END) AS has_promoted_category,
      count(*) FILTER (WHERE channel = 'online') AS online_txns, count(*) FILTER (WHERE channel = 'in-store') AS instore_txns,
      coalesce(count(*) FILTER (WHERE channel = 'online') / nullif(count(*) FILTER (WHERE channel IN ('online', 'in-store')), 0), 0) AS online_ratio
    FROM {src} GROUP BY customer_id) b JOIN (
    SELECT customer_id, string_agg(category, '|' ORDER BY spend DESC, category) FILTER (WHERE place <= 3) AS top_categories,
      first(category ORDER BY spend DESC, category) AS top_category
    FROM (SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY spend DESC) AS place FROM (
      SELECT customer_id, category, sum(total_amount) AS spend FROM {src} GROUP BY ALL)) GROUP BY customer_id) t USING (customer_id)"""


cte("feats", features_sql("rt", "2001-08-02", ad.RETAIL_PROMOTED))

_Z = " + ".join([f"({INTERCEPT!r})::DOUBLE"] + [f"({w!r})::DOUBLE * {c}" for c, w in WEIGHTS.items()])


def z_sql(i: int) -> str:
    m = SEGMENT_MODEL
    return f"(({m.features[i]} - {m.means[i]!r}::DOUBLE) / {m.scales[i]!r}::DOUBLE)"


def dist_sql(k: int, skip: int | None = None) -> str:
    """Distance to centroid k; feature ``skip`` set to the mean."""
    c = SEGMENT_MODEL.centroids[k]
    terms = [
        f"pow({'0e0' if i == skip else z_sql(i)} - ({c[i]!r})::DOUBLE, 2)" for i in range(len(c))
    ]
    return f"sqrt({' + '.join(terms)})"


cte("segd", f"SELECT *, {', '.join(f'{dist_sql(k)} AS d{k}' for k in range(3))} FROM feats")
cte("scored", f"""SELECT * EXCLUDE (d0, d1, d2), CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS segment_id,
  least(d0, d1, d2) AS distance, {r(f'1e0 / (1e0 + exp(-({_Z})))', 6)} AS propensity_score FROM segd""")
_IMPACT = lambda i: f"round(abs(1e0 / (1e0 + distance) - 1e0 / (1e0 + least({', '.join(dist_sql(k, i) for k in range(3))}))), 4)"
_ITEMS = " UNION ALL ".join(
    f"SELECT customer_id, {i} AS pos, '{f}' AS feature, {_IMPACT(i)} AS impact, CASE WHEN {f} > {SEGMENT_MODEL.means[i]!r}::DOUBLE THEN 'positive' ELSE 'negative' END AS direction, CAST({f} AS DOUBLE) AS value FROM scored"
    for i, f in enumerate(SEGMENT_MODEL.features)
)
IMPACTS = f"SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY impact DESC, pos) AS place FROM ({_ITEMS})"
cte("impacts", IMPACTS)
cte("score_log", f"""SELECT o_orderkey AS log_id, 'CUST-' || o_custkey AS customer_id, {r('1e0 - exp(-o_totalprice / 200000e0)', 6)} AS propensity_score,
  CAST(o_orderkey % 3 AS INTEGER) AS segment_id, o_orderdate AS scored_at, '1.0.0' AS model_version FROM orders""")
cte("rtd", """SELECT *, CAST(date_diff('day', (SELECT min(CAST("timestamp" AS DATE)) FROM rt), CAST("timestamp" AS DATE)) AS INTEGER) AS day FROM rt""")

def auc_sql(src: str, group: list[str], y: str = "label", p: str = "score") -> str:
    """Positives, negatives, AUC and average precision of each group, from counts per score."""
    g = ", ".join(group)
    sel = f"{g}, " if group else ""
    part = f"PARTITION BY {g} " if group else ""
    by = f"GROUP BY {g}" if group else ""
    return f"""SELECT {sel}CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
      coalesce(sum(neg * (pa + 0.5e0 * pos)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0), 0.5e0) AS auc,
      coalesce(sum(pos * (CAST(pa + pos AS DOUBLE) / (pa + pos + na + neg))) / nullif(sum(pos), 0), 0e0) AS average_precision
    FROM (SELECT *, sum(pos) OVER w - pos AS pa, sum(neg) OVER w - neg AS na FROM (
      SELECT {sel}{p} AS s, sum({y}) AS pos, sum(1 - {y}) AS neg FROM {src} GROUP BY ALL)
      WINDOW w AS ({part}ORDER BY s DESC ROWS UNBOUNDED PRECEDING)) {by}"""


def ordinal_sql(src: str, order: str, tie: str, group: str = "", direction: str = "DESC") -> str:
    """``src`` with ordinal and n_rows, ties by md5 of the id."""
    part = f"PARTITION BY {group} " if group else ""
    return f"""SELECT *, row_number() OVER ({part}ORDER BY {order} {direction}, md5(CAST({tie} AS VARCHAR)), {tie}) AS ordinal,
      count(*) OVER ({part}) AS n_rows FROM {src}"""


def hash_ordinal_sql(src: str, key: str, seed, group: str = "") -> str:
    part = f"PARTITION BY {group} " if group else ""
    return f"""SELECT *, row_number() OVER ({part}ORDER BY md5(CAST({key} AS VARCHAR) || '|{seed}'), {key}) AS ordinal,
      count(*) OVER ({part}) AS n_rows FROM {src}"""


def lift_sql(src: str, group: list[str], y: str = "label", p: str = "score", tie: str = "customer_id", zero: str = "0e0") -> str:
    g = ", ".join(group)
    sel, by = (f"{g}, ", f"GROUP BY {g}") if group else ("", "")
    return f"""SELECT {sel}avg({y}) FILTER (WHERE ordinal <= greatest(n_rows // 10, 1)) AS top_rate, avg({y}) AS base_rate,
      CASE WHEN avg({y}) > 0 THEN avg({y}) FILTER (WHERE ordinal <= greatest(n_rows // 10, 1)) / avg({y}) ELSE {zero} END AS lift_at_decile1
    FROM ({ordinal_sql(src, p, tie, g)}) {by}"""


cte("split_auc", auc_sql("model_scores", ["experiment", "model", "split"]))
cte("fold_auc", auc_sql("model_scores", ["experiment", "model", "fold"]))
cte("test_scores", "SELECT * FROM model_scores WHERE split = 'test'")
cte("test_lift", lift_sql("test_scores", ["experiment", "model"]))
cte("metrics", f"""SELECT experiment, model, {r("max(auc) FILTER (WHERE split = 'test')", 6)} AS test_auc,
  {r("max(auc) FILTER (WHERE split = 'train')", 6)} AS train_auc, {r('any_value(lift_at_decile1)', 6)} AS lift_at_decile1,
  {r('any_value(cv_std)', 6)} AS cv_std
  FROM split_auc JOIN test_lift USING (experiment, model)
  JOIN (SELECT experiment, model, stddev_pop(auc) AS cv_std FROM fold_auc GROUP BY ALL) f USING (experiment, model) GROUP BY ALL""")


def metrics_table(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of every (experiment, model), rounded so that decisions do not hang on the last bit."""
    from ..operators.metrics import evaluate
    from .models import model_scores

    return rounded(evaluate(model_scores(spark, d)), test_auc=6, train_auc=6, lift_at_decile1=6, cv_std=6)
