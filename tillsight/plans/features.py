"""Aggregations, windows and summaries of customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe, metrics as me, splits as sp
from ..sources import adapters as ad
from .registry import (
    cte, ev, feats, hash_ordinal_sql, names_sql, ordinal_sql, query, r, rounded, rt, score_log, scored, sql, u_sql,
)

NUM = ["recency_days", "frequency", "monetary", "avg_basket_size", "basket_std", "online_ratio", "active_days"]


@query("a1_rfm", sql(f"""SELECT customer_id, recency_days, frequency, {r('monetary', 2)} AS monetary, active_days,
  {r('avg_basket_size', 6)} AS avg_basket_size, {r('basket_std', 6)} AS basket_std FROM feats"""))
def _(spark, d):
    return rounded(fe.rfm(rt(spark, d), ad.RETAIL_SNAPSHOT), monetary=2, avg_basket_size=6, basket_std=6)


@query("a2_active_days", sql("SELECT customer_id, count(DISTINCT ingest_date) AS active_days FROM ev GROUP BY 1"))
def _(spark, d):
    return fe.active_days(ev(spark, d))


@query("a3_basket_std", sql(f"SELECT customer_id, {r('coalesce(stddev_samp(total_amount), 0)', 6)} AS basket_std FROM ev GROUP BY 1"))
def _(spark, d):
    return rounded(fe.basket_std(ev(spark, d)), basket_std=6)


@query("a4_channel_mix", sql(f"""SELECT customer_id, count(*) FILTER (WHERE channel = 'online') AS online_txns,
  count(*) FILTER (WHERE channel = 'in-store') AS instore_txns, {r("count(*) FILTER (WHERE channel = 'online') / count(*)", 6)} AS online_ratio FROM ev GROUP BY 1"""))
def _(spark, d):
    return rounded(fe.channel_mix(ev(spark, d)), online_ratio=6)


@query("a5_category_spend", sql(f"SELECT customer_id, category, {r('sum(total_amount)', 2)} AS cat_spend FROM rt GROUP BY 1, 2"))
def _(spark, d):
    return rounded(fe.category_spend(rt(spark, d)), cat_spend=2)


@query("a6_top_category", sql("SELECT customer_id, top_category FROM feats"))
def _(spark, d):
    return fe.top_category(rt(spark, d))


@query("a7_promoted_flag", sql("SELECT customer_id, max(CASE WHEN category = 'signup' AND total_amount > 200 THEN 1 ELSE 0 END) AS has_promoted_category FROM ev GROUP BY 1"))
def _(spark, d):
    t = ev(spark, d).withColumn("category", F.when(F.col("total_amount") > 200, F.col("category")).otherwise("other"))
    return fe.promoted_flag(t, ["signup"])


@query("a8_purchasers", sql("""SELECT DISTINCT customer_id, 1 AS purchased FROM rt WHERE "timestamp" >= DATE '2001-05-01'"""))
def _(spark, d):
    import datetime as dt
    return fe.purchasers(fe.since(rt(spark, d), "timestamp", dt.date(2001, 5, 1)))


@query("a9_baseline", sql(f"SELECT {r('coalesce(avg(purchased), 0)', 6)} AS baseline_rate FROM outcomes"))
def _(spark, d):
    from .data import outcomes
    return rounded(fe.baseline(outcomes(spark, d)), baseline_rate=6)


_NUM_SQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM)


@query("a10_describe_features", sql(f"""SELECT feature, {r('avg(value)', 4)} AS mean, {r('stddev_samp(value)', 4)} AS std, {r('min(value)', 4)} AS min,
  {r('quantile_cont(value, 0.5)', 4)} AS median, {r('max(value)', 4)} AS max
  FROM (UNPIVOT (SELECT {_NUM_SQL} FROM feats) ON {', '.join(NUM)} INTO NAME feature VALUE value) GROUP BY feature"""))
def _(spark, d):
    return rounded(fe.describe_features(scored(spark, d), NUM), mean=4, std=4, min=4, median=4, max=4)


@query("a11_class_balance", sql(f"""SELECT split, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, {r('avg(label)', 6)} AS rate,
  CASE WHEN avg(label) < 0.02 THEN 'too weak' WHEN avg(label) > 0.5 THEN 'too strong' END AS warning FROM model_scores GROUP BY split"""))
def _(spark, d):
    from .models import model_scores
    return rounded(fe.class_balance(model_scores(spark, d)), rate=6)


@query("a12_value_counts", sql("SELECT persona, count(*) AS n FROM cust GROUP BY 1"))
def _(spark, d):
    return fe.value_counts(ad.customers(spark, d), "persona")


@query("a13_segment_sizes", sql(f"SELECT segment_id, count(*) AS n, {r('count(*) / sum(count(*)) OVER ()', 6)} AS share FROM scored GROUP BY 1"))
def _(spark, d):
    return rounded(fe.segment_sizes(scored(spark, d)), share=6)


PROFILE = ["recency_days", "frequency", "monetary", "avg_basket_size", "online_ratio"]
cte("profiles", f"SELECT segment_id, count(*) AS n, {', '.join(f'avg({c}) AS {c}' for c in PROFILE)} FROM scored GROUP BY 1")


def profiles(spark, d):
    return fe.segment_profiles(scored(spark, d), PROFILE)


@query("a14_segment_profiles", sql(f"SELECT segment_id, n, {', '.join(f'{r(c, 4)} AS {c}' for c in PROFILE)} FROM profiles"))
def _(spark, d):
    return rounded(profiles(spark, d), **{c: 4 for c in PROFILE})


@query("a15_normalised_profiles", sql("SELECT segment_id, " + ", ".join(
    r(f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) ELSE 0.5 END", 6) + f" AS {c}"
    for c in PROFILE) + " FROM profiles"))
def _(spark, d):
    return rounded(fe.normalised_profiles(profiles(spark, d), PROFILE), **{c: 6 for c in PROFILE})


_CON = ["recency_days", "frequency", "monetary"]
_DIFF = [f"abs(a.{c} - b.{c}) / greatest(a.{c}, b.{c}, 1)" for c in _CON]


@query("a16_segment_contrast", sql(f"""SELECT a.segment_id AS segment_a, b.segment_id AS segment_b,
  {', '.join(f'{r(x, 6)} AS diff_{c}' for x, c in zip(_DIFF, _CON))}, greatest({', '.join(_DIFF)}) > 0.15 AS "distinct"
  FROM profiles a JOIN profiles b ON a.segment_id < b.segment_id"""))
def _(spark, d):
    return rounded(fe.segment_contrast(profiles(spark, d), _CON), **{f"diff_{c}": 6 for c in _CON})


@query("a17_score_distribution", sql("SELECT " + ", ".join(
    [f"round({x}, 6) AS {n}" for n, x in [("mean", "avg(p)"), ("std", "stddev_pop(p)"), ("min", "min(p)")]]
    + [f"round(quantile_cont(p, {q}), 6) AS {n}" for n, q in fe.SCORE_PERCENTILES.items()] + ["round(max(p), 6) AS max"]
) + " FROM (SELECT propensity_score AS p FROM scored)"))
def _(spark, d):
    return fe.score_distribution(scored(spark, d))


@query("a18_segment_distribution", sql(f"SELECT segment_id, count(*) AS n, {r('100e0 * count(*) / sum(count(*)) OVER ()', 6)} AS percent FROM scored GROUP BY 1"))
def _(spark, d):
    return rounded(fe.segment_distribution(scored(spark, d)), percent=6)


@query("a19_persona_summary", sql(f"""SELECT persona, count(*) AS customers, {r('avg(n)', 4)} AS mean_txns, {r('avg(spend)', 2)} AS mean_spend, {r('sum(online) / sum(n)', 6)} AS online_share
  FROM (SELECT persona, customer_id, count(*) AS n, sum(total_amount) AS spend, count(*) FILTER (WHERE channel = 'online') AS online
    FROM rt JOIN cust USING (customer_id) GROUP BY 1, 2) GROUP BY persona"""))
def _(spark, d):
    return rounded(fe.persona_summary(rt(spark, d), ad.customers(spark, d)), mean_txns=4, mean_spend=2, online_share=6)


@query("j4_persona_of_transactions", sql("""SELECT persona, channel, count(*) AS n, round(sum(total_amount), 2) AS amount
  FROM rt LEFT JOIN cust USING (customer_id) GROUP BY 1, 2"""))
def _(spark, d):
    """Every raw transaction with its customer's persona; a customer of more than 60 transactions counts as heavy here."""
    t = fe.join_heavy(rt(spark, d), ad.customers(spark, d).select("customer_id", "persona"), heavy_rows=60, spread=4)
    return t.groupBy("persona", "channel").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("total_amount"), 2).alias("amount"))


@query("a20_score_by_segment", sql(f"""SELECT segment_id, count(propensity_score) AS count, {r('avg(propensity_score)', 6)} AS mean, {r('stddev_samp(propensity_score)', 6)} AS std,
  min(propensity_score) AS min, max(propensity_score) AS max, {', '.join(r(f'quantile_cont(propensity_score, {q})', 6) + f' AS {n}' for n, q in [('p25', .25), ('p50', .5), ('p75', .75)])}
  FROM score_log GROUP BY 1"""))
def _(spark, d):
    return rounded(fe.score_by_segment(score_log(spark, d)), mean=6, std=6, p25=6, p50=6, p75=6)


@query("a21_score_correlation", sql(f"""SELECT feature, {r('c', 6)} AS correlation, CAST(row_number() OVER (ORDER BY abs(c) DESC, feature) AS INTEGER) AS place FROM (
  SELECT feature, coalesce(corr(value, propensity_score), 0) AS c FROM (UNPIVOT (SELECT propensity_score, {_NUM_SQL} FROM scored)
  ON {', '.join(NUM)} INTO NAME feature VALUE value) GROUP BY feature)"""))
def _(spark, d):
    return rounded(fe.score_correlation(scored(spark, d), NUM), correlation=6)


@query("a22_null_rates", sql(f"""SELECT "column", null_rate FROM (UNPIVOT (SELECT {', '.join(r(f'avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END)', 6) + f' AS {c}' for c in ['event_id', 'value', 'event_type'])} FROM holes)
  ON event_id, value, event_type INTO NAME "column" VALUE null_rate)"""))
def _(spark, d):
    from .data import _holes
    return rounded(fe.null_rates(_holes(spark, d), ["event_id", "value", "event_type"]), null_rate=6)


@query("a23_duplicates", sql("SELECT count(*) - count(DISTINCT user_id) AS duplicates FROM events"))
def _(spark, d):
    return fe.duplicates(spark.read.parquet(f"{d}/events.parquet"), "user_id")


# ---- Windows ----

@query("w1_top_categories", sql("SELECT customer_id, top_categories FROM feats"))
def _(spark, d):
    return fe.top_categories(rt(spark, d)).withColumn("top_categories", F.array_join("top_categories", "|"))


@query("w1_top_categories_ties", sql("""SELECT customer_id, string_agg(category, '|' ORDER BY n DESC, category) AS top_categories FROM (
  SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY n DESC) AS place FROM (
    SELECT customer_id, category, CAST(count(*) AS DOUBLE) AS n FROM rt GROUP BY 1, 2)) WHERE place <= 3 GROUP BY 1"""))
def _(spark, d):
    """Counting transactions instead of spend gives real ties: more than three may stay."""
    t = rt(spark, d).withColumn("total_amount", F.lit(1.0))
    return fe.top_categories(t).withColumn("top_categories", F.array_join("top_categories", "|"))


@query("w2_top_categories_first", sql("""SELECT customer_id, string_agg(category, '|' ORDER BY n DESC, category) AS top_categories FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, category) AS place FROM (
    SELECT customer_id, category, CAST(count(*) AS DOUBLE) AS n FROM rt GROUP BY 1, 2)) WHERE place <= 3 GROUP BY 1"""))
def _(spark, d):
    t = rt(spark, d).withColumn("total_amount", F.lit(1.0))
    return fe.top_categories(t, ties="first").withColumn("top_categories", F.array_join("top_categories", "|"))


@query("w3_deciles", sql("""SELECT log_id, propensity_score, CAST(ntile(10) OVER (ORDER BY propensity_score DESC, md5(CAST(log_id AS VARCHAR)), log_id) AS INTEGER) AS decile FROM score_log"""))
def _(spark, d):
    return me.deciles(score_log(spark, d), tie="log_id").select("log_id", "propensity_score", "decile")


@query("w3_deciles_hot_score", sql("""SELECT log_id, p AS propensity_score, CAST(ntile(10) OVER (ORDER BY p DESC, md5(CAST(log_id AS VARCHAR)), log_id) AS INTEGER) AS decile
  FROM (SELECT log_id, CASE WHEN log_id % 3 = 0 THEN 0.5e0 ELSE propensity_score END AS p FROM score_log)"""))
def _(spark, d):
    """One score holds a third of all rows."""
    hot = score_log(spark, d).withColumn("propensity_score", F.when(F.col("log_id") % 3 == 0, F.lit(0.5)).otherwise(F.col("propensity_score")))
    return me.deciles(hot, tie="log_id").select("log_id", "propensity_score", "decile")


@query("w4_slice_deciles", sql(f"SELECT log_id, CAST((10 * ordinal - 1) // n_rows + 1 AS INTEGER) AS decile FROM ({ordinal_sql('score_log', 'propensity_score', 'log_id')})"))
def _(spark, d):
    return me.slice_deciles(score_log(spark, d), tie="log_id").select("log_id", "decile")


@query("w4_slice_lift", sql(f"""SELECT decile, count(*) AS n, {r('avg(purchased)', 6)} AS actual_rate, {r('any_value(base)', 6)} AS baseline_rate, {r('avg(purchased) / any_value(base)', 6)} AS lift
  FROM (SELECT CAST((10 * ordinal - 1) // n_rows + 1 AS INTEGER) AS decile, purchased, avg(purchased) OVER () AS base FROM ({ordinal_sql('outcomes', 'propensity_score', 'log_id')})) GROUP BY decile"""))
def _(spark, d):
    from ..session import materialise
    from .data import outcomes
    return rounded(me.slice_lift(materialise(outcomes(spark, d)), "purchased", tie="log_id"), actual_rate=6, baseline_rate=6, lift=6)


# ---- Top-k ----

@query("o2_top_n", sql("SELECT customer_id, propensity_score, segment_id FROM scored ORDER BY propensity_score DESC, customer_id LIMIT 10"))
def _(spark, d):
    return fe.top_n(scored(spark, d), 10).select("customer_id", "propensity_score", "segment_id")


@query("o2_bottom_n", sql("SELECT customer_id, propensity_score, segment_id FROM scored ORDER BY propensity_score, customer_id LIMIT 10"))
def _(spark, d):
    return fe.top_n(scored(spark, d), 10, ascending=True).select("customer_id", "propensity_score", "segment_id")


@query("o3_top_fraction", sql(f"SELECT log_id, propensity_score FROM ({ordinal_sql('score_log', 'propensity_score', 'log_id')}) WHERE ordinal <= greatest(n_rows // 10, 1)"))
def _(spark, d):
    return me.top_fraction(score_log(spark, d), "propensity_score", "log_id").select("log_id", "propensity_score")


@query("o3_bottom_half", sql(f"SELECT log_id, propensity_score FROM ({ordinal_sql('score_log', 'propensity_score', 'log_id')}) WHERE ordinal > n_rows // 2"))
def _(spark, d):
    return me.bottom_half(score_log(spark, d), "propensity_score", "log_id").select("log_id", "propensity_score")


@query("o6_hash_order", sql(f"SELECT event_id, ordinal, n_rows FROM ({hash_ordinal_sql('events', 'event_id', 42)})"))
def _(spark, d):
    from ..operators.ordinal import hash_ordinal
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id")
    return hash_ordinal(e, "event_id", 42).withColumn("ordinal", F.col("ordinal").cast("bigint"))


@query("o7_resample_down", sql(f"SELECT event_id, user_id FROM ({hash_ordinal_sql('events', 'event_id', 7)}) WHERE ordinal <= (SELECT count(*) FROM orders) // 2"))
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id")
    n = spark.read.parquet(f"{d}/orders.parquet").count() // 2
    return sp.resample(e, n, 7, "event_id")


@query("o7_resample_up", sql(f"""SELECT event_id, user_id FROM events UNION ALL
  SELECT p.event_id, p.user_id FROM ({hash_ordinal_sql('events', 'event_id', 7)}) p JOIN (
    SELECT CAST(floor({u_sql('id', '7|draw')} * n) AS BIGINT) + 1 AS ordinal FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS id), (SELECT count(*) AS n FROM events)
    WHERE id < (SELECT count(*) FROM orders) - n) USING (ordinal)"""))
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id")
    return sp.resample(e, spark.read.parquet(f"{d}/orders.parquet").count(), 7, "event_id")


# ---- Splits, labels, folds ----

cte("last_order", """SELECT customer_id, max("timestamp") AS last_transaction_date, count(*) AS n FROM rt GROUP BY 1""")


def last_order(spark, d):
    return rt(spark, d).groupBy("customer_id").agg(F.max("timestamp").alias("last_transaction_date"), F.count(F.lit(1)).alias("n"))


@query("l1_temporal_split", sql("""SELECT customer_id, last_transaction_date, CASE WHEN last_transaction_date <= TIMESTAMP '1995-01-01' + INTERVAL 2235 DAY THEN 'train'
  WHEN last_transaction_date <= TIMESTAMP '1995-01-01' + INTERVAL 2351 DAY THEN 'val' ELSE 'test' END AS split FROM last_order"""))
def _(spark, d):
    import datetime as dt
    s = sp.TemporalSplitter(2235, 2351, 2404, dt.date(1995, 1, 1))
    return s.split(last_order(spark, d)).select("customer_id", "last_transaction_date", "split")


def _split_sql(cuts, last) -> str:
    return "CASE " + " ".join(f"WHEN ordinal <= floor(n_rows * {f!r}::DOUBLE) THEN '{n}'" for n, f in cuts.items()) + f" ELSE '{last}' END"


for _name, _cuts in {
    "l2_random_split": {"train": 0.6, "val": 0.8},
    "l2_random_split_70_15": {"train": 0.7, "val": 0.85},
    "l2_random_split_80_20": {"train": 0.8},
}.items():
    _last = "test" if len(_cuts) > 1 else "val"

    @query(_name, sql(f"SELECT customer_id, persona, {_split_sql(_cuts, _last)} AS split FROM ({hash_ordinal_sql('cust', 'customer_id', 42)})"))
    def _(spark, d, cuts=_cuts, last=_last):
        return sp.random_split(ad.customers(spark, d).select("customer_id", "persona"), cuts, last)


def labelled(spark, d):
    t = fe.window_slices(rt(spark, d), **ad.RETAIL_BOUNDS)
    ids = t.where("in_train_features").select("customer_id").distinct()
    return sp.label_forward(ids, t.where("in_train_labels"), ad.RETAIL_PROMOTED)


@query("l3_stratified_split", sql(f"SELECT customer_id, label, {_split_sql({'train': 0.8}, 'val')} AS split FROM ({hash_ordinal_sql('labelled', 'customer_id', 42, 'label')})"))
def _(spark, d):
    from ..session import materialise
    return sp.stratified_split(materialise(labelled(spark, d)), "label")


@query("l4_label_category", sql("SELECT customer_id, CASE WHEN list_contains(string_split(top_categories, '|'), 'PROMO') THEN 1 ELSE 0 END AS label FROM feats"))
def _(spark, d):
    return sp.label_category(fe.top_categories(rt(spark, d)), "PROMO").select("customer_id", "label")


@query("l5_label_forward", sql("SELECT customer_id, label FROM labelled"))
def _(spark, d):
    return labelled(spark, d)


@query("l6_label_by_rate", sql(f"""SELECT customer_id, persona, CASE WHEN {u_sql('customer_id', '42')} < CASE persona WHEN 'A' THEN 0.7e0 WHEN 'B' THEN 0.35e0 ELSE 0.08e0 END THEN 1 ELSE 0 END AS label FROM cust"""))
def _(spark, d):
    return sp.label_by_rate(ad.customers(spark, d)).select("customer_id", "persona", "label")


cte("rule_scored", """SELECT customer_id, 0.60e0 * CASE WHEN frequency > (SELECT quantile_cont(frequency, 0.55) FROM feats) AND monetary > (SELECT quantile_cont(monetary, 0.55) FROM feats)
    AND online_ratio < 0.45e0 THEN 1e0 ELSE 0e0 END + 0.25e0 * (frequency / ((SELECT max(frequency) FROM feats) + 1e-8)) + 0.15e0 * (monetary / ((SELECT max(monetary) FROM feats) + 1e-8)) AS s FROM feats""")


@query("l7_label_percentile", sql(f"SELECT customer_id, {r('s', 6)} AS rule_score, CASE WHEN s >= (SELECT quantile_cont(s, 0.72) FROM rule_scored) THEN 1 ELSE 0 END AS label FROM rule_scored"))
def _(spark, d):
    return rounded(sp.label_percentile(scored(spark, d)), rule_score=6).select("customer_id", "rule_score", "label")


_unit = lambda c, s: f"least(greatest({c} / {s}, 0), 1)"
_STABLE = f"0.50e0 * (1e0 - {_unit('recency_days', '180e0')}) + 0.35e0 * {_unit('frequency', '50e0')} + 0.15e0 * {_unit('monetary', '2000e0')}"
_SHIFTED = f"0.50e0 * {_unit('online_ratio', '1e0')} + 0.30e0 * {_unit('monetary', '2000e0')} + 0.20e0 * {_unit('avg_basket_size', '80e0')}"
# The concepts' scales fit small baskets: amounts in thousands.
cte("small_feats", "SELECT customer_id, recency_days, frequency, monetary / 1000e0 AS monetary, avg_basket_size / 1000e0 AS avg_basket_size, online_ratio FROM feats")


def small_feats(spark, d):
    s = scored(spark, d)
    return s.withColumns({"monetary": F.col("monetary") / 1000.0, "avg_basket_size": F.col("avg_basket_size") / 1000.0})


for _concept, _expr in {"stable": _STABLE, "drifted": _SHIFTED}.items():
    @query(f"l8_label_concept_{_concept}", sql(
        f"SELECT customer_id, {r('s', 6)} AS concept_score, CASE WHEN s >= (SELECT quantile_cont(s, 0.72) FROM concept_scored) THEN 1 ELSE 0 END AS label FROM concept_scored",
        concept_scored=f"SELECT customer_id, round({_expr}, 9) AS s FROM small_feats"))
    def _(spark, d, concept=_concept):
        f = small_feats(spark, d)
        # Nine digits settle ties at the cut.
        labelled_ = sp._top_share(f.withColumn("concept_score", F.round(sp.concept_score(concept), 9)), "concept_score", 0.72)
        return rounded(labelled_, concept_score=6).select("customer_id", "concept_score", "label")


@query("l9_time_folds", sql(f"""SELECT customer_id, fold, CASE WHEN ordinal - 1 < start THEN 'train' ELSE 'test' END AS role FROM (
  SELECT customer_id, ordinal, CAST(k AS INTEGER) AS fold, n_rows - (6 - k) * (n_rows // 6) AS start, n_rows // 6 AS block
  FROM ({ordinal_sql('last_order', 'epoch_us(last_transaction_date)', 'customer_id', '', 'ASC')}), (SELECT unnest(range(1, 6)) AS k))
  WHERE ordinal - 1 < start - 7 OR (ordinal - 1 >= start AND ordinal - 1 < start + block)"""))
def _(spark, d):
    from ..session import materialise
    return sp.time_folds(materialise(last_order(spark, d)), "last_transaction_date").select("customer_id", "fold", "role")
