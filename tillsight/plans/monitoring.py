"""Drift, realised lift, retraining decisions and BI tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window, functions as F

from ..config import SEG5
from ..operators import drift as dr, features as fe, metrics as me, outcome as oc
from ..session import materialise
from ..sources import adapters as ad
from .data import outcomes
from .models import TRAIN_DAY, model_scores, phase_scores
from .registry import auc_sql, cte, ev, lift_sql, query, r, rounded, rt, scored, sql

_SEG = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SEG5)
_LIST = ", ".join(SEG5)

cte("exp_long", f"SELECT feature, value FROM (UNPIVOT (SELECT {_SEG} FROM train_feats) ON {_LIST} INTO NAME feature VALUE value)")
cte("act_long", f"SELECT feature, value FROM (UNPIVOT (SELECT {_SEG} FROM feats) ON {_LIST} INTO NAME feature VALUE value)")


def two_periods(spark, d):
    """Features as training saw them and features now, each written once: drift reads them twice."""
    t = rt(spark, d)
    past = fe.silver_features(t.where(F.col("ingest_date") <= F.lit(TRAIN_DAY)), TRAIN_DAY, promoted=ad.RETAIL_PROMOTED)
    now = fe.silver_features(t, ad.RETAIL_SNAPSHOT, promoted=ad.RETAIL_PROMOTED)
    return materialise(past.select(*SEG5), "past"), materialise(now.select(*SEG5), "now")


def bin_sql(x: str = "value") -> str:
    return " + ".join(f"CASE WHEN {x} >= lo + {i}e0 * ((hi - lo) / 10e0) THEN 1 ELSE 0 END" for i in range(1, 10))


def psi_sql(expected: str, actual: str, limits: str, floor: str, keys: str = "", inside: bool = False, flat: str = "") -> str:
    """PSI of each feature from long tables; ``limits`` gives lo and hi per (keys, feature)."""
    k = f"{keys}, " if keys else ""
    using = f"({k}feature)"
    where = "WHERE value >= lo - 1e-6 AND value <= hi + 1e-6" if inside else ""
    ekey = "(feature)"
    return f"""SELECT {k}feature, {flat} sum((pa - pe) * ln(pa / pe)) {'END' if flat else ''} AS psi FROM (
      SELECT {k}feature, any_value(lo) AS lo, any_value(hi) AS hi, bin,
        greatest(CAST(sum(e) AS DOUBLE) / sum(sum(e)) OVER (PARTITION BY {k}feature), {floor}) AS pe,
        greatest(CAST(sum(a) AS DOUBLE) / sum(sum(a)) OVER (PARTITION BY {k}feature), {floor}) AS pa
      FROM (SELECT {k}feature, lo, hi, bin, 1 AS e, 0 AS a FROM (SELECT *, {bin_sql()} AS bin FROM {expected} JOIN {limits} USING {ekey} {where})
        UNION ALL SELECT {k}feature, lo, hi, bin, 0, 1 FROM (SELECT *, {bin_sql()} AS bin FROM {actual} JOIN {limits} USING {using} {where})
        UNION ALL SELECT {k}feature, lo, hi, unnest(range(10)), 0, 0 FROM {limits}) GROUP BY {k}feature, bin)
      GROUP BY {k}feature{', lo, hi' if flat else ''}"""


cte("ref_limits", "SELECT feature, min(value) AS lo, max(value) AS hi FROM exp_long GROUP BY 1")
cte("joint_limits", "SELECT feature, min(value) AS lo, max(value) AS hi FROM (SELECT * FROM exp_long UNION ALL SELECT * FROM act_long) GROUP BY 1")
cte("psi_ref", f"SELECT feature, {r('psi', 6)} AS psi FROM ({psi_sql('exp_long', 'act_long', 'ref_limits', '1e-4', inside=True)})")
cte("psi_jnt", f"SELECT feature, {r('psi', 6)} AS psi FROM ({psi_sql('exp_long', 'act_long', 'joint_limits', '1e-6')})")


def psi_ref(spark, d):
    return rounded(dr.psi_reference(*two_periods(spark, d), SEG5), psi=6)


def psi_jnt(spark, d):
    return rounded(dr.psi_joint(*two_periods(spark, d), SEG5), psi=6)


@query("d1_psi_reference", sql("SELECT * FROM psi_ref"))
def _(spark, d):
    return psi_ref(spark, d)


@query("d2_psi_joint", sql("SELECT * FROM psi_jnt"))
def _(spark, d):
    return psi_jnt(spark, d)


@query("d3_classify_psi", sql("""SELECT feature, psi, CASE WHEN psi >= 0.2 THEN 'RED' WHEN psi >= 0.1 THEN 'YELLOW' ELSE 'GREEN' END AS status,
  CASE WHEN psi >= 0.2 THEN 'RETRAIN' WHEN psi >= 0.1 THEN 'MONITOR' ELSE 'STABLE' END AS action FROM psi_ref"""))
def _(spark, d):
    return dr.classify_psi(psi_ref(spark, d))


_AGG = lambda cond: f"coalesce(string_agg(feature, '|' ORDER BY feature) FILTER (WHERE {cond}), '')"
_SUMMARY = f"""SELECT max(psi) AS psi_max, {_AGG('psi >= 0.1 AND psi < 0.2')} AS yellow, {_AGG('psi >= 0.2')} AS red, {_AGG('psi > 0.2')} AS above_threshold, max(psi) > 0.2 AS drift_detected FROM psi_jnt"""


@query("d4_drift_summary", sql(_SUMMARY))
def _(spark, d):
    s = dr.drift_summary(psi_jnt(spark, d))
    return s.withColumns({c: F.array_join(c, "|") for c in ("yellow", "red", "above_threshold")})


@query("r4_drift_decision", sql("""SELECT max(psi) AS psi_max, CASE WHEN max(psi) >= 0.2 THEN 'DRIFT_DETECTED' ELSE 'OK' END AS decision, CASE WHEN max(psi) >= 0.2 THEN 'retrain' ELSE 'stable' END AS route FROM psi_ref"""))
def _(spark, d):
    return dr.drift_decision(dr.drift_summary(psi_ref(spark, d))).select("psi_max", "decision", "route")


# Snapshots: user features of every three days of events; the first two are the reference.
_SNAP_COLS = ["frequency", "monetary", "avg_basket_size", "online_ratio"]
cte("snaps", """SELECT DATE '2024-01-01' + CAST(date_diff('day', DATE '2024-01-01', ingest_date) // 3 * 3 AS INTEGER) AS snapshot_date, customer_id, CAST(count(*) AS DOUBLE) AS frequency,
  round(sum(total_amount), 2) AS monetary, round(avg(total_amount), 6) AS avg_basket_size, count(*) FILTER (WHERE channel = 'online') / count(*) AS online_ratio FROM ev GROUP BY 1, 2""")
cte("snap_long", f"SELECT CAST(snapshot_date AS DATE) AS snapshot_date, feature, value FROM (UNPIVOT (SELECT snapshot_date, {', '.join(_SNAP_COLS)} FROM snaps) ON {', '.join(_SNAP_COLS)} INTO NAME feature VALUE value)")
cte("ref_long", "SELECT feature, value FROM snap_long WHERE snapshot_date < DATE '2024-01-07'")
cte("ref_lim", "SELECT feature, min(value) AS elo, max(value) AS ehi FROM ref_long GROUP BY 1")
cte("snap_limits", """SELECT snapshot_date, feature, least(min(value), any_value(elo)) AS lo, greatest(max(value), any_value(ehi)) AS hi
  FROM snap_long JOIN ref_lim USING (feature) GROUP BY 1, 2""")
cte("psi_hist", f"SELECT snapshot_date, feature, {r('psi', 6)} AS psi FROM ({psi_sql('ref_long', 'snap_long', 'snap_limits', '1e-6', keys='snapshot_date')})")


def snapshots(spark, d):
    day = F.floor(F.datediff("ingest_date", F.lit("2024-01-01").cast("date")) / 3) * 3
    s = ev(spark, d).groupBy(F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).alias("snapshot_date"), "customer_id").agg(
        F.count(F.lit(1)).cast("double").alias("frequency"), F.round(F.sum("total_amount"), 2).alias("monetary"),
        F.round(F.avg("total_amount"), 6).alias("avg_basket_size"),
        (F.count_if(F.col("channel") == "online") / F.count(F.lit(1))).alias("online_ratio"),
    )
    return materialise(s, "snapshots")


def psi_hist(spark, d):
    s = snapshots(spark, d)
    ref = s.where(F.col("snapshot_date") < F.lit("2024-01-07").cast("date"))
    return rounded(dr.psi_history(s, ref, _SNAP_COLS), psi=6)


@query("d5_psi_history", sql("SELECT * FROM psi_hist"))
def _(spark, d):
    return psi_hist(spark, d)


@query("d5_psi_mean", sql(f"SELECT feature, {r('avg(psi)', 6)} AS psi_mean FROM psi_hist GROUP BY 1"))
def _(spark, d):
    return rounded(dr.psi_mean(psi_hist(spark, d)), psi_mean=6)


cte("recent", "SELECT * FROM psi_hist WHERE snapshot_date IN (SELECT DISTINCT snapshot_date FROM psi_hist ORDER BY 1 DESC LIMIT 8)")


@query("w8_last_n", sql("SELECT * FROM recent"))
def _(spark, d):
    return dr.last_n(psi_hist(spark, d))


@query("d6_psi_matrix", sql(f"""SELECT feature, {', '.join(f'coalesce(max(psi) FILTER (WHERE i = {i}), 0) AS d{i}' for i in range(1, 9))}
  FROM (SELECT *, dense_rank() OVER (ORDER BY snapshot_date) AS i FROM recent) GROUP BY feature"""))
def _(spark, d):
    return dr.psi_matrix(psi_hist(spark, d))


cte("phase_test", "SELECT * FROM phase_scores WHERE split = 'test'")
cte("phase_auc", auc_sql("phase_test", ["phase", "model"]))
cte("phase_lift", lift_sql("phase_test", ["phase", "model"]))
cte("phase_metrics", f"SELECT phase, model, {r('auc', 6)} AS test_auc, {r('lift_at_decile1', 6)} AS lift_d1 FROM phase_auc JOIN phase_lift USING (phase, model)")
_P = lambda phase, c: f"max({c}) FILTER (WHERE phase = '{phase}')"


@query("d7_compare_phases", sql(f"""SELECT model, round({_P('baseline', 'test_auc')} - {_P('stale', 'test_auc')}, 4) AS auc_degradation, round({_P('retrained', 'test_auc')} - {_P('stale', 'test_auc')}, 4) AS auc_recovery,
  round({_P('baseline', 'lift_d1')} - {_P('stale', 'lift_d1')}, 4) AS lift_degradation, round({_P('retrained', 'lift_d1')} - {_P('stale', 'lift_d1')}, 4) AS lift_recovery,
  {_P('retrained', 'test_auc')} >= {_P('baseline', 'test_auc')} - 0.02e0 AS full_recovery FROM phase_metrics GROUP BY 1"""))
def _(spark, d):
    """A model fitted on the old concept loses on the new one; fitted on the new one it recovers."""
    m = me.evaluate(phase_scores(spark, d), group=["phase", "model"], fold=None)
    m = rounded(m, test_auc=6, lift_at_decile1=6).withColumnRenamed("lift_at_decile1", "lift_d1")
    return dr.compare_phases(m, ["model"])


# ---- Realised lift ----

cte("lift_rows", f"""SELECT decile, count(*) AS n_customers, round(avg(propensity_score), 4) AS predicted_positive_rate, round(avg(purchased), 4) AS actual_positive_rate,
  round(any_value(base), 4) AS baseline_rate, CASE WHEN any_value(base) > 0 THEN round(round(avg(purchased), 4) / any_value(base), 4) ELSE 0 END AS realised_lift
  FROM (SELECT *, avg(purchased) OVER () AS base, CAST(ntile(10) OVER (ORDER BY propensity_score DESC, md5(CAST(log_id AS VARCHAR)), log_id) AS INTEGER) AS decile FROM outcomes) GROUP BY decile""")


def lift_rows(spark, d):
    return oc.lift_table(materialise(outcomes(spark, d), "outcomes"), tie="log_id")


@query("r1_lift_table", sql("SELECT * FROM lift_rows"))
def _(spark, d):
    return lift_rows(spark, d)


@query("r2_lift_status", sql("SELECT decile, realised_lift, CASE WHEN realised_lift >= 2 THEN 'GOOD' WHEN realised_lift >= 1 THEN 'WARN' ELSE 'POOR' END AS status FROM lift_rows"))
def _(spark, d):
    return oc.lift_status(lift_rows(spark, d)).select("decile", "realised_lift", "status")


@query("r3_retrain_decision", sql("""SELECT l AS lift_d1, 41 AS age_days, CASE WHEN l < 1.5 OR 41 > 30 THEN 'RETRAIN_REQUIRED' ELSE 'OK' END AS decision, CASE WHEN l < 1.5 THEN 'lift' ELSE 'age' END AS reason
  FROM (SELECT coalesce(max(realised_lift) FILTER (WHERE decile = 1), 0) AS l FROM lift_rows)"""))
def _(spark, d):
    created = F.lit(int(dt.datetime(2001, 3, 1, 12, tzinfo=dt.timezone.utc).timestamp() * 1000))
    age = oc.model_age_days(created, dt.date(2001, 4, 11))
    return oc.retrain_decision(lift_rows(spark, d), age)


@query("o1_lift_ordered", sql("SELECT decile, realised_lift FROM lift_rows ORDER BY decile"))
def _(spark, d):
    return lift_rows(spark, d).select("decile", "realised_lift").orderBy("decile")


# ---- BI ----

@query("b1_bi_segments", sql(f"SELECT segment_id, count(*) AS customers, {r('sum(monetary)', 2)} AS revenue, {r('sum(monetary) / sum(sum(monetary)) OVER ()', 6)} AS revenue_share FROM scored GROUP BY 1"))
def _(spark, d):
    g = scored(spark, d).groupBy("segment_id").agg(F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("revenue"))
    out = g.withColumn("revenue_share", F.col("revenue") / F.sum("revenue").over(Window.partitionBy()))  # one row a segment
    return rounded(out, revenue=2, revenue_share=6)


@query("b2_bi_propensity", sql("""SELECT experiment AS category, customer_id, score AS propensity_score, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY score DESC, customer_id) AS place FROM model_scores WHERE model = 'lightgbm') WHERE place <= 20"""))
def _(spark, d):
    w = Window.partitionBy("experiment").orderBy(F.desc("score"), "customer_id")
    s = model_scores(spark, d).where("model = 'lightgbm'").withColumn("place", F.row_number().over(w)).where("place <= 20")
    return s.select(F.col("experiment").alias("category"), "customer_id", F.col("score").alias("propensity_score"), "place")


@query("b3_bi_drift", sql("SELECT snapshot_date, feature, psi, psi > 0.2 AS retrain FROM psi_hist"))
def _(spark, d):
    return psi_hist(spark, d).withColumn("retrain", F.col("psi") > 0.2)
