"""Data-quality rules and validators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import quality as q
from .registry import cte, query, r, rounded, scored, sql

NOW = dt.datetime(2001, 6, 1)

# Retail lines with faults: some ids, amounts, categories and channels missing or wrong.
cte("faulty", """SELECT CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE 'TXN-' || l_orderkey END AS transaction_id,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN -l_extendedprice / 1000 ELSE l_extendedprice / 1000 END AS total_amount,
  CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN 'cust-' || l_partkey ELSE 'CUST-' || l_partkey END AS customer_id,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_shipdate END AS "timestamp",
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'O' THEN 'online' ELSE 'in-store' END AS channel,
  CAST(l_quantity AS INTEGER) - 1 AS quantity FROM lineitem""")


def faulty(spark, d):
    l = spark.read.parquet(f"{d}/lineitem.parquet")
    c = F.col
    price = c("l_extendedprice") / 1000
    return l.select(
        F.when(c("l_orderkey") % 11 != 0, F.concat(F.lit("TXN-"), c("l_orderkey").cast("string"))).alias("transaction_id"),
        F.when(c("l_orderkey") % 7 == 0, None).when(c("l_orderkey") % 13 == 0, -price).otherwise(price).alias("total_amount"),
        F.when(c("l_partkey") % 17 == 0, None).otherwise(F.concat(F.when(c("l_partkey") % 19 == 0, "cust-").otherwise("CUST-"), c("l_partkey").cast("string"))).alias("customer_id"),
        F.when(c("l_suppkey") % 5 != 0, c("l_shipdate")).alias("timestamp"),
        F.when(c("l_linenumber") == 7, None).when(c("l_linestatus") == "O", "online").otherwise("in-store").alias("channel"),
        (c("l_quantity").cast("int") - 1).alias("quantity"),
    )


def _one(expectation, failed: str) -> str:
    return f"SELECT '{expectation}' AS expectation, count(*) FILTER (WHERE {failed}) = 0 AS passed, count(*) FILTER (WHERE {failed}) AS failed_rows FROM faulty"


RULES = {
    "q1_not_null": (q.Expectation("not_null", "transaction_id"), "transaction_id IS NULL"),
    "q2_between": (q.Expectation("between", "total_amount", {"min_value": 0.01, "max_value": 100.0}), "NOT coalesce(total_amount >= 0.01 AND total_amount <= 100, false)"),
    "q2_between_open": (q.Expectation("between", "quantity", {"min_value": 1, "max_value": None}), "NOT coalesce(quantity >= 1, false)"),
    "q3_match_regex": (q.Expectation("regex", "customer_id", {"regex": "^CUST-[0-9]+$"}), "NOT regexp_matches(coalesce(customer_id, 'None'), '^CUST-[0-9]+$')"),
    "q4_in_set": (q.Expectation("in_set", "channel", {"value_set": ["online", "in-store"]}), "NOT coalesce(channel IN ('online', 'in-store'), false)"),
    "q5_not_future": (q.Expectation("not_future", "timestamp"), "\"timestamp\" > TIMESTAMP '2001-06-01'"),
}
for _name, (_rule, _failed) in RULES.items():
    @query(_name, sql(_one(_rule.label, _failed)))
    def _(spark, d, rule=_rule):
        return q.validate(faulty(spark, d), [rule], NOW).select("expectation", "passed", "failed_rows")


_SUITE = [
    "transaction_id IS NULL", "NOT coalesce(total_amount >= 0.01 AND total_amount <= 5000, false)",
    "NOT regexp_matches(coalesce(customer_id, 'None'), '^CUST-[0-9]+$')", "\"timestamp\" > TIMESTAMP '2001-06-01'",
    "NOT coalesce(channel IN ('online', 'in-store'), false)", "NOT coalesce(quantity >= 1, false)",
]
_SUITE_SQL = ", ".join(f"count(*) FILTER (WHERE {x}) AS f{i}" for i, x in enumerate(_SUITE))


@query("q7_validate_suite", sql(f"""SELECT CAST(substr(name, 2) AS INTEGER) AS "rule", failed_rows = 0 AS passed, failed_rows FROM (
  UNPIVOT (SELECT {_SUITE_SQL} FROM faulty) ON {', '.join(f'f{i}' for i in range(6))} INTO NAME name VALUE failed_rows)"""))
def _(spark, d):
    return q.validate(faulty(spark, d), q.transaction_suite(), NOW).select("rule", "passed", "failed_rows")


@query("q7_suite_score", sql(f"""SELECT {r('avg(CASE WHEN failed_rows = 0 THEN 1e0 ELSE 0e0 END)', 6)} AS score, avg(CASE WHEN failed_rows = 0 THEN 1e0 ELSE 0e0 END) >= 0.95 AS passed FROM (
  UNPIVOT (SELECT {_SUITE_SQL} FROM faulty) ON {', '.join(f'f{i}' for i in range(6))} INTO NAME name VALUE failed_rows)"""))
def _(spark, d):
    return rounded(q.suite_score(q.validate(faulty(spark, d), q.transaction_suite(), NOW)), score=6)


# A feature table with faults, one row per order line's part.
cte("bad_feats", """SELECT 'CUST-' || (l_partkey // 2) AS customer_id, CASE WHEN l_linenumber = 1 THEN -1e0 ELSE l_quantity END AS recency_days,
  l_quantity - 3 AS frequency, CASE WHEN l_discount > 0.09 THEN NULL ELSE l_extendedprice - 1000 END AS monetary, l_extendedprice AS avg_basket_size,
  l_tax AS basket_std, CASE WHEN l_tax > 0.07 THEN 1.5e0 ELSE l_tax END AS online_ratio, CAST(l_linenumber AS DOUBLE) AS active_days FROM lineitem""")


def bad_feats(spark, d):
    c = F.col
    return spark.read.parquet(f"{d}/lineitem.parquet").select(
        F.concat(F.lit("CUST-"), F.floor(c("l_partkey") / 2).cast("string")).alias("customer_id"),
        F.when(c("l_linenumber") == 1, -1.0).otherwise(c("l_quantity")).alias("recency_days"),
        (c("l_quantity") - 3).alias("frequency"),
        F.when(c("l_discount") > 0.09, None).otherwise(c("l_extendedprice") - 1000).alias("monetary"),
        c("l_extendedprice").alias("avg_basket_size"), c("l_tax").alias("basket_std"),
        F.when(c("l_tax") > 0.07, 1.5).otherwise(c("l_tax")).alias("online_ratio"),
        c("l_linenumber").cast("double").alias("active_days"),
    )


_REQ = ["customer_id", "recency_days", "frequency", "monetary", "avg_basket_size", "basket_std", "online_ratio", "active_days"]


@query("q9_feature_counters", sql(f"""SELECT count(*) AS n_rows, count(*) - count(DISTINCT customer_id) AS duplicate_ids,
  {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS null_{c}' for c in _REQ)}, count(*) FILTER (WHERE recency_days < 0) AS bad_recency,
  min(recency_days) FILTER (WHERE recency_days < 0) AS worst_recency, count(*) FILTER (WHERE frequency < 1) AS bad_frequency,
  count(*) FILTER (WHERE monetary <= 0) AS bad_monetary, count(*) FILTER (WHERE online_ratio < 0 OR online_ratio > 1) AS bad_online_ratio FROM bad_feats"""))
def _(spark, d):
    return q.feature_counters(bad_feats(spark, d))


@query("q11_rejected", sql("""SELECT reasons, count(*) AS n FROM (SELECT concat_ws('|',
    CASE WHEN recency_days < 0 THEN 'recency_days' END, CASE WHEN frequency < 0 THEN 'frequency' END, CASE WHEN coalesce(monetary <= 0, true) THEN 'monetary' END,
    CASE WHEN online_ratio < 0 OR online_ratio > 1 THEN 'online_ratio' END) AS reasons FROM bad_feats) WHERE reasons <> '' GROUP BY 1"""))
def _(spark, d):
    rejected = q.split_valid(bad_feats(spark, d))[1]
    return rejected.groupBy(F.array_join("reasons", "|").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@query("q11_accepted", sql("""SELECT customer_id, count(*) AS n FROM bad_feats WHERE recency_days >= 0 AND frequency >= 0 AND monetary > 0 AND online_ratio BETWEEN 0 AND 1 GROUP BY 1"""))
def _(spark, d):
    return q.split_valid(bad_feats(spark, d))[0].groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))


@query("q12_score_counters", sql("SELECT count(*) AS n_rows, count(*) FILTER (WHERE value / 100 < 0 OR value / 100 > 1) AS out_of_range FROM events"))
def _(spark, d):
    return q.score_counters(spark.read.parquet(f"{d}/events.parquet").select((F.col("value") / 100).alias("propensity_score")))


@query("q13_output_counters", sql("SELECT count(*) AS n_rows, count(*) FILTER (WHERE segment_id = 1) AS null_cells, CAST(0 AS BIGINT) AS out_of_range FROM scored"))
def _(spark, d):
    s = scored(spark, d).select(
        "customer_id", F.when(F.col("segment_id") != 1, F.col("segment_id")).alias("segment_id"), "propensity_score",
        F.lit("2001-08-02").alias("scored_at"), F.lit("propensity").alias("model_name"), F.lit("1.0.0").alias("model_version"),
    )
    return q.output_counters(s)
