"""Evaluation, gates, selection and curves over many (experiment, model) pairs."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..config import COMPLEXITY_ORDER, ENSEMBLES
from ..operators import metrics as me, selection as se
from .models import curve_scores, model_scores
from .registry import auc_sql, cte, metrics_table, names_sql, query, r, rounded, sql


@query("v1_auc", sql(f"SELECT experiment, model, split, positives, negatives, {r('auc', 6)} AS auc FROM split_auc"))
def _(spark, d):
    return rounded(me.auc(model_scores(spark, d), group=["experiment", "model", "split"]), auc=6)


cte("half_outcomes", "SELECT log_id, purchased, round(propensity_score, 2) AS p2 FROM outcomes")


@query("v1_auc_tied", sql(f"SELECT positives, negatives, {r('auc', 6)} AS auc FROM ({auc_sql('half_outcomes', [], 'purchased', 'p2')})"))
def _(spark, d):
    """Scores of two digits: most rows are tied."""
    from .data import outcomes
    o = outcomes(spark, d).withColumn("p2", F.round("propensity_score", 2))
    return rounded(me.auc(o, "purchased", "p2"), auc=6)


@query("v2_average_precision", sql(f"SELECT experiment, model, split, positives, negatives, {r('average_precision', 6)} AS average_precision FROM split_auc"))
def _(spark, d):
    return rounded(me.average_precision(model_scores(spark, d), group=["experiment", "model", "split"]), average_precision=6)


@query("v3_lift_d1", sql(f"SELECT experiment, model, {r('top_rate', 6)} AS top_rate, {r('base_rate', 6)} AS base_rate, {r('lift_at_decile1', 6)} AS lift_at_decile1 FROM test_lift"))
def _(spark, d):
    s = model_scores(spark, d).where("split = 'test'")
    return rounded(me.lift_d1(s, group=["experiment", "model"]), top_rate=6, base_rate=6, lift_at_decile1=6)


@query("v4_evaluate", sql("SELECT * FROM metrics"))
def _(spark, d):
    return metrics_table(spark, d)


_K = "greatest(3, least(10, (SELECT count(*) FROM outcomes) // 20))"


@query("v6_calibration_bins", sql(f"""SELECT bin, count(*) AS n, {r('avg(propensity_score)', 6)} AS mean_predicted, {r('avg(purchased)', 6)} AS fraction_positive FROM (
  SELECT *, CAST({' + '.join(f"CASE WHEN {i} < k AND propensity_score > {i}e0 * (1e0 / k) THEN 1 ELSE 0 END" for i in range(1, 10))} AS INTEGER) AS bin
  FROM (SELECT *, {_K} AS k FROM outcomes)) GROUP BY bin"""))
def _(spark, d):
    from ..session import materialise
    from .data import outcomes
    return rounded(me.calibration_bins(materialise(outcomes(spark, d)), "purchased", "propensity_score"), mean_predicted=6, fraction_positive=6)


@query("v7_diagnose", sql("""SELECT experiment, model, CASE WHEN train_auc - test_auc > 0.08 THEN 'high variance' WHEN test_auc < 0.70 THEN 'high bias'
  WHEN train_auc - test_auc < 0.02 THEN 'well balanced' ELSE 'moderate variance' END AS diagnosis FROM metrics"""))
def _(spark, d):
    return me.diagnose(metrics_table(spark, d)).select("experiment", "model", "diagnosis")


@query("t6_vote", sql(f"SELECT experiment, customer_id, {r('avg(score)', 6)} AS score FROM model_scores WHERE model IN ('logistic_regression', 'random_forest', 'xgboost') GROUP BY 1, 2"))
def _(spark, d):
    s = model_scores(spark, d).where(F.col("model").isin("logistic_regression", "random_forest", "xgboost"))
    return rounded(me.vote(s, ["experiment", "customer_id"]), score=6)


# ---- Gates and selection ----

cte("gate_input", """SELECT *, max(test_auc) OVER (PARTITION BY experiment) - 0.01e0 AS production_auc FROM metrics""")
_CASES = [
    ("test_auc", "test_auc < 0.7e0", "test_auc", "0.7e0"),
    ("auc_regression", "round(production_auc - test_auc, 4) > 0.05e0", "production_auc - test_auc", "0.05e0"),
    ("overfitting", "round(train_auc - test_auc, 4) > 0.08e0", "train_auc - test_auc", "0.08e0"),
    ("lift_at_decile1", "lift_at_decile1 < 2.5e0", "lift_at_decile1", "2.5e0"),
]


def _case(i: int) -> str:
    return "CASE " + " ".join(f"WHEN {c[1]} THEN " + (f"'{c[0]}'" if i == 0 else f"round({c[2]}, 4)" if i == 1 else c[3]) for c in _CASES) + " END"


@query("g1_propensity_gates", sql(f"SELECT experiment, model, {_case(0)} AS gate_name, {_case(1)} AS actual_value, {_case(2)} AS threshold, {_case(0)} IS NULL AS passed FROM gate_input"))
def _(spark, d):
    m = metrics_table(spark, d)
    m = m.withColumn("production_auc", F.max("test_auc").over(Window.partitionBy("experiment")) - 0.01)
    g = se.propensity_gates(m)
    return g.select("experiment", "model", "failure.gate_name", "failure.actual_value", "failure.threshold", "passed")


cte("gated", f"""SELECT *, CASE WHEN model <> 'logistic_regression' AND round(test_auc - lr, 4) < 0.03e0
    THEN printf('baseline gate: %.4f more AUC than logistic_regression, 0.03 asked for', round(test_auc - lr, 4))
  WHEN round(train_auc - test_auc, 4) >= 0.08e0 THEN printf('overfit gate: training AUC %.3f above test AUC, limit 0.08', round(train_auc - test_auc, 4))
  WHEN lift_at_decile1 < 2.5e0 THEN printf('lift gate: top decile lift %.2f, 2.5 asked for', lift_at_decile1)
  WHEN cv_std >= 0.03e0 THEN printf('stability gate: fold deviation %.3f, limit 0.030', cv_std)
  WHEN model IN ({names_sql(ENSEMBLES)}) AND round(test_auc - single, 4) < 0.015e0
    THEN printf('ensemble gate: %.4f more AUC than the best single model, 0.015 asked for', round(test_auc - single, 4)) ELSE '' END AS reason
  FROM (SELECT *, coalesce(max(test_auc) FILTER (WHERE model = 'logistic_regression') OVER p, 0) AS lr,
    max(test_auc) FILTER (WHERE model NOT IN ({names_sql(ENSEMBLES)})) OVER p AS single FROM metrics WINDOW p AS (PARTITION BY experiment))""")
_ORDER = "CASE model " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(COMPLEXITY_ORDER)) + " ELSE 99 END"
cte("chosen", f"""SELECT experiment, arg_min(model, c) AS selected_model, arg_min(test_auc, c) AS selected_auc FROM (
  SELECT *, {_ORDER} AS c, max(test_auc) OVER (PARTITION BY experiment) AS best FROM gated WHERE reason = '') WHERE test_auc >= best - 0.01e0 GROUP BY 1""")


def gated(spark, d):
    return se.selection_gates(metrics_table(spark, d))


@query("g2_selection_gates", sql("SELECT experiment, model, reason, reason = '' AS approved FROM gated"))
def _(spark, d):
    return gated(spark, d).select("experiment", "model", "reason", "approved")


@query("g3_select_model", sql("SELECT * FROM chosen"))
def _(spark, d):
    return se.select_model(gated(spark, d))


@query("g4_selection_report", sql("""SELECT g.experiment, g.n_approved, c.selected_model, g.rejected,
  CASE WHEN g.n_approved = 0 THEN NULL WHEN g.n_approved = 1 THEN 'One model passed every gate.'
   WHEN round(g.best - c.selected_auc, 4) <= 0.01e0 THEN printf('Occam: %s is the simplest model within 0.01 of the best AUC, %.4f below it', c.selected_model, round(g.best - c.selected_auc, 4))
   ELSE printf('Best test AUC of the approved models: %.4f', c.selected_auc) END AS selection_reason,
  CASE WHEN g.n_approved = 0 THEN 'no model passed: ' || g.rejected END AS error
  FROM (SELECT experiment, count(*) FILTER (WHERE reason = '') AS n_approved, max(test_auc) FILTER (WHERE reason = '') AS best,
    coalesce(string_agg(model || ': ' || reason, '; ' ORDER BY model) FILTER (WHERE reason <> ''), '') AS rejected FROM gated GROUP BY 1) g LEFT JOIN chosen c USING (experiment)"""))
def _(spark, d):
    rep = se.selection_report(gated(spark, d))
    listed = F.array_join(F.transform("rejected_models", lambda x: F.concat(x["model_name"], F.lit(": "), x["reason"])), "; ")
    return rep.select("experiment", "n_approved", "selected_model", listed.alias("rejected"), "selection_reason", "error")


@query("g5_select_or_best", sql("""SELECT m.experiment, coalesce(c.selected_model, m.best_model) AS selected_model, coalesce(c.selected_auc, m.best_auc) AS selected_auc, c.selected_model IS NULL AS fallback
  FROM (SELECT experiment, first(model ORDER BY test_auc DESC, model) AS best_model, max(test_auc) AS best_auc FROM gated GROUP BY 1) m LEFT JOIN chosen c USING (experiment)"""))
def _(spark, d):
    return se.select_or_best(gated(spark, d))


# ---- Curves: mean daily amount of each category stands in for a metric over steps ----

cte("curve", """SELECT category, CAST(date_diff('day', DATE '2024-01-01', ingest_date) AS INTEGER) AS step, round(avg(total_amount), 6) AS value FROM ev GROUP BY 1, 2""")


def curve(spark, d):
    from .registry import ev
    return ev(spark, d).groupBy("category", F.datediff("ingest_date", F.lit("2024-01-01").cast("date")).alias("step")).agg(
        F.round(F.avg("total_amount"), 6).alias("value")
    )


@query("w5_best_so_far", sql("SELECT *, max(value) OVER (PARTITION BY category ORDER BY step ROWS UNBOUNDED PRECEDING) AS best_so_far FROM curve"))
def _(spark, d):
    return me.best_so_far(curve(spark, d), ["category"], "step", "value")


@query("w6_plateau", sql("""SELECT category, min(step) AS step, arg_min(value, step) AS value FROM (
  SELECT *, value - lag(value) OVER w AS gain, greatest(abs(last_value(value) OVER f - first_value(value) OVER f), 1e-6) AS total, step = max(step) OVER f AS is_last
  FROM curve WINDOW w AS (PARTITION BY category ORDER BY step), f AS (PARTITION BY category ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  WHERE gain < total * 0.05e0 OR is_last GROUP BY category"""))
def _(spark, d):
    return me.plateau(curve(spark, d), ["category"], "step", "value")


@query("w7_arg_best", sql("""SELECT category, 'max' AS how, first(step ORDER BY value DESC, step) AS step, max(value) AS value FROM curve GROUP BY 1
  UNION ALL SELECT category, 'min', first(step ORDER BY value, step), min(value) FROM curve GROUP BY 1"""))
def _(spark, d):
    c = curve(spark, d)
    best = lambda how: me.arg_best(c, ["category"], "step", "value", how).withColumn("how", F.lit(how))
    return best("max").unionByName(best("min")).select("category", "how", "step", "value")


cte("curve_auc", auc_sql("curve_scores", ["model", "size", "held", "role"]))
cte("curve_points", """SELECT a.model, a.size, a.held, max(auc) FILTER (WHERE role = 'train') AS train_auc, max(auc) FILTER (WHERE role = 'val') AS val_auc, max(n) AS train_size
  FROM curve_auc a JOIN (SELECT size, held, count(*) FILTER (WHERE role = 'train') AS n FROM curve_members GROUP BY 1, 2) USING (size, held) GROUP BY 1, 2, 3""")


def curve_points(spark, d):
    """Points of the learning curves: (model, size, held, train_auc, val_auc, rows trained on)."""
    a = me.auc(curve_scores(spark, d), group=["model", "size", "held", "role"])
    of = lambda role, c: F.max(F.when(F.col("role") == role, F.col(c)))
    rows = of("train", "n")
    return a.withColumn("n", F.col("positives") + F.col("negatives")).groupBy("model", "size", "held").agg(
        of("train", "auc").alias("train_auc"), of("val", "auc").alias("val_auc"), rows.alias("train_size"))


@query("t8_curve_points", sql(f"SELECT model, size, held, {r('train_auc', 6)} AS train_auc, {r('val_auc', 6)} AS val_auc, train_size FROM curve_points"))
def _(spark, d):
    return rounded(curve_points(spark, d), train_auc=6, val_auc=6)


@query("t8_curve_summary", sql(f"""SELECT model, size AS train_size, {r('avg(train_auc)', 6)} AS train_mean, {r('stddev_pop(train_auc)', 6)} AS train_std,
  {r('avg(val_auc)', 6)} AS val_mean, {r('stddev_pop(val_auc)', 6)} AS val_std FROM curve_points GROUP BY 1, 2"""))
def _(spark, d):
    """Mean and deviation over the held-out folds; sizes by number, as the folds' rows differ a little."""
    pts = curve_points(spark, d).withColumn("train_size", F.col("size"))
    return rounded(me.curve_summary(pts), train_mean=6, train_std=6, val_mean=6, val_std=6)


@query("t8_curve_diagnosis", sql("""SELECT model, CASE WHEN va < 0.7 AND tr < 0.7 THEN 'underfit' WHEN tr - va > 0.08 THEN 'overfit' WHEN tr - va < 0.03 THEN 'converged' ELSE 'moderate' END AS diagnosis
  FROM (SELECT model, avg(train_auc) AS tr, avg(val_auc) AS va FROM curve_points WHERE size = (SELECT max(size) FROM curve_points) GROUP BY 1)"""))
def _(spark, d):
    pts = curve_points(spark, d).withColumn("train_size", F.col("size"))
    return me.curve_diagnosis(me.curve_summary(pts)).select("model", "diagnosis")
