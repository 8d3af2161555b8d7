"""The whole batch run as one query: fit, evaluate, gate, select, calibrate, score all customers, replace partitions, reconcile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import PROP10
from ..operators import isotonic as iso, metrics as me, quality as ql, scoring as sc, segments as sg, selection as se, splits as sp, training as tr
from ..session import materialise, new_folder
from ..sources import writers
from .models import EXPERIMENTS, model_scores
from .registry import SEGMENT_MODEL, cte, feats, query, r, rounded, sql

#: Calibration fits on these folds; its points are scores of two digits.
HELD_FOLDS, DIGITS = 2, 2

cte("chain_choice", """SELECT m.experiment, coalesce(c.selected_model, m.best_model) AS model, c.selected_model IS NULL AS fallback
  FROM (SELECT experiment, first(model ORDER BY test_auc DESC, model) AS best_model FROM gated GROUP BY 1) m LEFT JOIN chosen c USING (experiment)""")
cte("chain_scores", f"SELECT experiment, model, fallback, customer_id, label, fold, round(score, {DIGITS}) AS x FROM model_scores JOIN chain_choice USING (experiment, model)")
cte("chain_points", f"""SELECT experiment, x, s, n, row_number() OVER w AS i, sum(s) OVER w AS cs, sum(n) OVER w AS cn
  FROM (SELECT experiment, x, sum(label) AS s, count(*) AS n FROM chain_scores WHERE fold < {HELD_FOLDS} GROUP BY 1, 2) WINDOW w AS (PARTITION BY experiment ORDER BY x)""")
cte("chain_fit", """SELECT experiment, any_value(x) AS x, max(low) AS v FROM (
  SELECT p.experiment, p.i, any_value(p.x) AS x, a.i AS start, min((b.cs - a.cs + a.s)::DOUBLE / (b.cn - a.cn + a.n)) AS low FROM chain_points p
  JOIN chain_points a ON a.experiment = p.experiment AND a.i <= p.i JOIN chain_points b ON b.experiment = p.experiment AND b.i >= p.i GROUP BY p.experiment, p.i, a.i) GROUP BY experiment, i""")
cte("chain_line", "SELECT experiment, x, v, lead(x) OVER w AS nx, lead(v) OVER w AS nv, min(v) OVER (PARTITION BY experiment) AS least FROM chain_fit WINDOW w AS (PARTITION BY experiment ORDER BY x)")
cte("chain_least", "SELECT experiment, min(v) AS least FROM chain_fit GROUP BY 1")
_LINE = "CASE WHEN l.x IS NULL THEN q.least WHEN nx IS NULL OR t.x = l.x THEN l.v ELSE l.v + (nv - l.v) * (t.x - l.x) / (nx - l.x) END"
cte("chain_calibrated", f"""SELECT t.experiment, model, fallback, customer_id, label, {r(_LINE, 6)} AS propensity_score
  FROM chain_scores t ASOF LEFT JOIN chain_line l ON t.experiment = l.experiment AND t.x >= l.x JOIN chain_least q ON q.experiment = t.experiment""")


@query("chain_batch_scoring", sql(f"""SELECT experiment, any_value(model) AS selected_model, any_value(fallback) AS fallback, count(*) AS n_scored, {r('avg(propensity_score)', 5)} AS mean_score,
  {r('max(propensity_score)', 5)} AS max_score, CAST(sum(label) AS BIGINT) AS positives, true AS reconciled FROM chain_calibrated GROUP BY 1"""))
def _(spark, d):
    scores = model_scores(spark, d)
    metrics = rounded(me.evaluate(scores), test_auc=6, train_auc=6, lift_at_decile1=6, cv_std=6)
    choice = materialise(se.select_or_best(se.selection_gates(materialise(metrics, "metrics"))), "choice")
    # One row an experiment.
    mine = scores.join(F.broadcast(choice.select("experiment", F.col("selected_model").alias("model"), "fallback")), ["experiment", "model"])
    mine = materialise(mine.withColumn("score", F.round("score", DIGITS)), "selected-scores")
    gold = new_folder(spark, "propensity")
    written = 0
    for e in EXPERIMENTS:
        rows = mine.where(F.col("experiment") == e)
        blocks = iso.fit_blocks(rows.where(F.col("fold") < HELD_FOLDS))
        out = rounded(iso.apply_blocks(rows, blocks, out="propensity_score"), propensity_score=6)
        # A run replaces its experiment's partition, so that running it again gives the same table.
        writers.replace_partitions(out.select("customer_id", "model", "fallback", "label", "propensity_score", "experiment"), gold, ["experiment"], [(e,)])
        written += 1
    table = spark.read.parquet(gold)
    seen = ql.validate_scores(table, mine.count())
    done = table.groupBy("experiment").agg(
        F.first("model").alias("selected_model"), F.first("fallback").alias("fallback"), F.count(F.lit(1)).alias("n_scored"),
        F.avg("propensity_score").alias("mean_score"), F.max("propensity_score").alias("max_score"), F.sum("label").alias("positives"))
    return rounded(done, mean_score=5, max_score=5).withColumn("reconciled", F.lit(seen > 0 and written == len(EXPERIMENTS)))


@query("chain_fit_with_segment", sql("""SELECT count(*) AS n, CAST(sum(CASE WHEN list_contains(string_split(top_categories, '|'), 'PROMO') THEN 1 ELSE 0 END) AS BIGINT) AS positives, true AS residuals_zero, true AS in_range FROM scored"""))
def _(spark, d):
    """The ten propensity features, the segment among them, against the category label; every customer is scored and the residuals add up to 0."""
    rows = sp.label_category(sg.assign(feats(spark, d), SEGMENT_MODEL), "PROMO")
    rows = materialise(rows.select("customer_id", "label", *PROP10), "propensity-features")
    scored = sc.score_all(rows, tr.fit_lr(rows, PROP10))
    off = F.col("label") - F.col("propensity_score")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("positives"), (F.abs(F.avg(off)) < 1e-4).alias("residuals_zero"),
                      F.min(F.col("propensity_score").between(0, 1)).alias("in_range"))
