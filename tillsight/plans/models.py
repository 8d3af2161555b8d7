"""Scores of seven models for each customer and experiment: fitted on the training split, applied to all.

Features are those of the days before the label window. The experiments are the labels: buying a promoted category in the window, the rule
label, and the two concepts. Five models are linear on different bases of the five segmentation features; one votes, one is stacked on three of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import SEG5
from ..functions.exprs import half_up, hash_uniform
from ..operators import features as fe, linear_models as lm, splits as sp
from ..operators.ordinal import exact_quantiles
from ..session import materialise
from ..sources import adapters as ad
from .registry import cte, features_sql, names_sql, r, rt, u_sql

FIRST_DAY = dt.date(1995, 1, 1)
TRAIN_DAY = FIRST_DAY + dt.timedelta(days=ad.RETAIL_BOUNDS["features_end"])
EXPERIMENTS = ["promoted", "rule", "stable", "drifted"]
TOP_SHARE = 0.72

_N = range(len(SEG5))
KINDS = {"z": [f"z{i}" for i in _N], "h": [f"h{i}" for i in _N], "p": [f"p{j}{i}" for i in _N for j in range(i)], "q": [f"q{i}" for i in _N]}
BASES = {
    "logistic_regression": KINDS["z"],
    "decision_tree": KINDS["h"],
    "random_forest": KINDS["p"],
    "xgboost": KINDS["z"] + KINDS["p"],
    "lightgbm": KINDS["z"] + KINDS["h"] + KINDS["q"],
}
MEMBERS = ["logistic_regression", "random_forest", "xgboost"]
ALL = [f for fs in KINDS.values() for f in fs]
SPLIT_SHARE, FOLDS = 0.7, 5


def labelled_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per customer and experiment: label, split, fold and the features' basis, which is written once."""
    sliced = fe.window_slices(rt(spark, d), **ad.RETAIL_BOUNDS, start=FIRST_DAY)
    past = sliced.where("in_train_features")
    f = fe.rfm(past, TRAIN_DAY).join(fe.channel_mix(past), "customer_id")  # both are hashed by customer
    f = sp.label_forward(f, sliced.where("in_train_labels"), ad.RETAIL_PROMOTED)
    f = materialise(f.select("customer_id", *SEG5, F.col("label").alias("promoted")), "train-features")
    # The concepts' scales fit small baskets: amounts in thousands.
    small = sp.rule_score(f).withColumns({"_monetary": F.col("monetary"), "_basket": F.col("avg_basket_size")}).withColumns(
        {"monetary": F.col("monetary") / 1000.0, "avg_basket_size": F.col("avg_basket_size") / 1000.0})
    scored = small.withColumns({"rule": F.round("rule_score", 9), **{c: F.round(sp.concept_score(c), 9) for c in ("stable", "drifted")}})
    scored = scored.withColumns({"monetary": F.col("_monetary"), "avg_basket_size": F.col("_basket")})
    wide, _ = lm.basis(scored, SEG5)
    wide = materialise(wide.select("customer_id", *EXPERIMENTS, *ALL), "basis")
    # One cut for each score: the top share is positive.
    scores = wide.select("rule", "stable", "drifted").unpivot([], ["rule", "stable", "drifted"], "experiment", "s")
    cuts = exact_quantiles(scores, "s", {"cut": TOP_SHARE}, ["experiment"])
    at = {c.experiment: c.cut for c in cuts.select("experiment", "cut").collect()}  # three rows
    top = lambda e: (F.col(e) >= F.lit(at.get(e))).cast("int")
    labels = F.array(*[F.struct(F.lit(e).alias("experiment"), (F.col(e) if e == "promoted" else top(e)).alias("label")) for e in EXPERIMENTS])
    rows = wide.withColumns({
        "split": F.when(hash_uniform("customer_id", "split") < SPLIT_SHARE, "train").otherwise("test"),
        "fold": F.floor(hash_uniform("customer_id", "fold") * FOLDS).cast("int"),
    })
    return rows.select("customer_id", "split", "fold", *ALL, F.inline(labels))


def _six(df: DataFrame, models) -> DataFrame:
    return df.withColumns({f"s_{m}": half_up(f"s_{m}", 6) for m in models})


def _long(df: DataFrame, models, *keys: str) -> DataFrame:
    return df.select(*keys, F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"s_{m}").alias("score")) for m in models])))


def model_scores(spark: SparkSession, d: str) -> DataFrame:
    """(customer_id, experiment, label, model, split, fold, score) of all seven models."""
    rows = labelled_rows(spark, d)
    weights = lm.fit_weights(rows.where("split = 'train'"), ["experiment"], ALL)
    base = _six(lm.apply_weights(rows, weights, ["experiment"], BASES), BASES)
    members = [f"s_{m}" for m in MEMBERS]
    base = materialise(base.select("customer_id", "experiment", "label", "split", "fold", *[f"s_{m}" for m in BASES]), "base-scores")
    second = lm.fit_weights(base.where("split = 'train'"), ["experiment"], members)
    full = lm.apply_weights(base, second, ["experiment"], {"stacking_ensemble": members})
    full = full.withColumn("s_voting_ensemble", sum(F.col(m) for m in members) / float(len(members)))
    full = _six(full, ["voting_ensemble", "stacking_ensemble"])
    return materialise(_long(full, [*BASES, "voting_ensemble", "stacking_ensemble"], "customer_id", "experiment", "label", "split", "fold"), "model-scores")


PHASES = {"baseline": ("stable", "stable"), "stale": ("stable", "drifted"), "retrained": ("drifted", "drifted")}


def phase_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the five linear models in three phases: (fitted on, judged by) stable and stable, stable and drifted, drifted and drifted."""
    rows = labelled_rows(spark, d)
    weights = lm.fit_weights(rows.where("split = 'train'"), ["experiment"], ALL)
    pairs = F.array(*[F.struct(F.lit(p).alias("phase"), F.lit(fit).alias("fit"), F.lit(by).alias("by")) for p, (fit, by) in PHASES.items()])
    each = rows.select("*", F.inline(pairs)).where("by = experiment").drop("experiment").withColumnRenamed("fit", "experiment")
    scored = _six(lm.apply_weights(each, weights, ["experiment"], BASES), BASES)
    return materialise(_long(scored, BASES, "customer_id", "phase", "label", "split"), "phase-scores")


SIZES = [0.1, 0.2, 0.4, 0.7, 1.0]
CURVE_MODELS = ["logistic_regression", "lightgbm"]


def curve_scores(spark: SparkSession, d: str, experiment: str = "drifted", folds: int = 3) -> DataFrame:
    """A learning curve's scores: for each size and fold a fit on that share of the other folds, judged on its own rows and on the fold.

    All fits come out of one aggregate, for which a row stands once in each size and fold that trains on it.
    """
    rows = labelled_rows(spark, d).where(F.col("experiment") == experiment).withColumns({
        "k": F.floor(hash_uniform("customer_id", "curve") * folds).cast("int"), "u": hash_uniform("customer_id", "size")})
    fits = F.array(*[F.struct(F.lit(i).alias("size"), F.lit(k).alias("held"), F.lit(s).alias("share")) for i, s in enumerate(SIZES) for k in range(folds)])
    spread = rows.select("customer_id", "label", "k", "u", *ALL, F.inline(fits))
    spread = spread.withColumn("role", F.when(F.col("k") == F.col("held"), "val").when(F.col("u") < F.col("share"), "train")).where("role IS NOT NULL")
    used = sorted({f for m in CURVE_MODELS for f in BASES[m]})
    weights = lm.fit_weights(spread.where("role = 'train'"), ["size", "held"], used)
    scored = _six(lm.apply_weights(spread, weights, ["size", "held"], {m: BASES[m] for m in CURVE_MODELS}), CURVE_MODELS)
    return materialise(_long(scored, CURVE_MODELS, "customer_id", "size", "held", "role", "label"), "curve-scores")


# ---- SQL twins ----

cte("train_rt", f"""SELECT * FROM rt WHERE "timestamp" < TIMESTAMP '{TRAIN_DAY + dt.timedelta(days=1)}'""")
cte("train_feats", features_sql("train_rt", str(TRAIN_DAY), ad.RETAIL_PROMOTED))
cte("labelled", f"""SELECT c.customer_id, CASE WHEN b.customer_id IS NULL THEN 0 ELSE 1 END AS label FROM (SELECT DISTINCT customer_id FROM rtd WHERE day <= {ad.RETAIL_BOUNDS['features_end']}) c
  LEFT JOIN (SELECT DISTINCT customer_id FROM rtd WHERE day > {ad.RETAIL_BOUNDS['features_end']} AND day <= {ad.RETAIL_BOUNDS['labels_end']} AND category IN ({names_sql(ad.RETAIL_PROMOTED)})) b USING (customer_id)""")
_unit = lambda c, s: f"least(greatest({c} / {s}, 0), 1)"
cte("train_marks", f"""SELECT quantile_cont(frequency, 0.55) AS f55, quantile_cont(monetary, 0.55) AS m55, max(frequency) + 1e-8 AS fm, max(monetary) + 1e-8 AS mm,
  {', '.join(f'avg(CAST({x} AS DOUBLE)) AS a{i}, stddev_pop(CAST({x} AS DOUBLE)) AS s{i}' for i, x in enumerate(SEG5))} FROM train_feats""")
cte("train_scored", f"""SELECT customer_id, coalesce(b.label, 0) AS promoted,
  round(0.60e0 * CASE WHEN frequency > f55 AND monetary > m55 AND online_ratio < 0.45e0 THEN 1e0 ELSE 0e0 END + 0.25e0 * (frequency / fm) + 0.15e0 * (monetary / mm), 9) AS rule,
  round(0.50e0 * (1e0 - {_unit('recency_days', '180e0')}) + 0.35e0 * {_unit('frequency', '50e0')} + 0.15e0 * {_unit('(monetary / 1000e0)', '2000e0')}, 9) AS stable,
  round(0.50e0 * {_unit('online_ratio', '1e0')} + 0.30e0 * {_unit('(monetary / 1000e0)', '2000e0')} + 0.20e0 * {_unit('(avg_basket_size / 1000e0)', '80e0')}, 9) AS drifted,
  {', '.join(f'coalesce((CAST({x} AS DOUBLE) - a{i}) / nullif(s{i}, 0), 0e0) AS z{i}' for i, x in enumerate(SEG5))}
  FROM train_feats CROSS JOIN train_marks LEFT JOIN (SELECT customer_id, label FROM labelled) b USING (customer_id)""")
cte("model_rows", f"""SELECT s.*, {', '.join(f'CASE WHEN z{i} > 0 THEN 1e0 ELSE 0e0 END AS h{i}' for i in _N)}, {', '.join(f'z{i} * z{i} AS q{i}' for i in _N)},
  {', '.join(f'CASE WHEN z{j} > 0 AND z{i} > 0 THEN 1e0 ELSE 0e0 END AS p{j}{i}' for i in _N for j in range(i))},
  CASE WHEN {u_sql('customer_id', 'split')} < {SPLIT_SHARE!r} THEN 'train' ELSE 'test' END AS split, CAST(floor({u_sql('customer_id', 'fold')} * {FOLDS}) AS INTEGER) AS fold
  FROM train_scored s""")
cte("label_rows", "SELECT customer_id, split, fold, experiment, label FROM (" + " UNION ALL ".join(
    f"SELECT customer_id, split, fold, '{e}' AS experiment, " + ("promoted" if e == "promoted" else f"CASE WHEN {e} >= (SELECT quantile_cont({e}, {TOP_SHARE}) FROM train_scored) THEN 1 ELSE 0 END") + " AS label FROM model_rows"
    for e in EXPERIMENTS) + ")")
cte("basis_long", f"SELECT customer_id, feature, x FROM (UNPIVOT (SELECT customer_id, {', '.join(ALL)} FROM model_rows) ON {', '.join(ALL)} INTO NAME feature VALUE x)")


def fit_sql(rows: str, by: str) -> str:
    """``rows`` has by, label, feature and x: weight, middle and prior of each feature."""
    return f"""SELECT {by}, feature, ln((n1 + 0.5e0) / (n0 + 0.5e0)) AS prior, coalesce((m1 + m0) / 2e0, 0e0) AS middle,
      coalesce(CASE WHEN (n1 * v1 + n0 * v0) / (n1 + n0) > 1e-12 THEN (m1 - m0) / ((n1 * v1 + n0 * v0) / (n1 + n0)) END, 0e0) AS weight FROM (
      SELECT {by}, feature, {', '.join(f'count(*) FILTER (WHERE label = {y}) AS n{y}, avg(x) FILTER (WHERE label = {y}) AS m{y}, var_pop(x) FILTER (WHERE label = {y}) AS v{y}' for y in (0, 1))}
      FROM {rows} GROUP BY {by}, feature)"""


def apply_sql(rows: str, weights: str, by: str, keep: str) -> str:
    """``rows`` has keep, by, model, feature and x: the probability of each (keep, model)."""
    return f"""SELECT {keep}, model, {r('1e0 / (1e0 + exp(-(any_value(prior) + sum(weight * (x - middle)) / count(*))))', 6)} AS score
      FROM {rows} JOIN {weights} USING ({by}, feature) GROUP BY {keep}, model"""


def lists_sql(models: dict) -> str:
    return "(VALUES " + ", ".join(f"('{m}', '{f}')" for m, fs in models.items() for f in fs) + ") AS lists(model, feature)"


cte("fit_rows", "SELECT experiment, label, feature, x FROM label_rows JOIN basis_long USING (customer_id) WHERE split = 'train'")
cte("fit_weights", fit_sql("fit_rows", "experiment"))
cte("apply_rows", f"SELECT customer_id, experiment, label, split, fold, model, feature, x FROM label_rows JOIN basis_long USING (customer_id) JOIN {lists_sql(BASES)} USING (feature)")
cte("base_scores", apply_sql("apply_rows", "fit_weights", "experiment", "customer_id, experiment, label, split, fold"))
cte("member_rows", f"SELECT customer_id, experiment, label, split, fold, 'stacking_ensemble' AS model, model AS feature, score AS x FROM base_scores WHERE model IN ({', '.join(repr(m) for m in MEMBERS)})")
cte("member_train", "SELECT * FROM member_rows WHERE split = 'train'")
cte("member_weights", fit_sql("member_train", "experiment"))
cte("stacked", apply_sql("member_rows", "member_weights", "experiment", "customer_id, experiment, label, split, fold"))
cte("model_scores", f"""SELECT * FROM base_scores UNION ALL SELECT * FROM stacked
  UNION ALL SELECT customer_id, experiment, label, split, fold, 'voting_ensemble', {r('avg(x)', 6)} FROM member_rows GROUP BY ALL""")
cte("phase_rows", f"""SELECT customer_id, phase, ph.fit AS experiment, label, split, model, feature, x FROM label_rows l
  JOIN (VALUES {', '.join(f"('{p}', '{fit}', '{by}')" for p, (fit, by) in PHASES.items())}) AS ph(phase, fit, judged) ON l.experiment = ph.judged
  JOIN basis_long USING (customer_id) JOIN {lists_sql(BASES)} USING (feature)""")
cte("phase_scores", apply_sql("phase_rows", "fit_weights", "experiment", "customer_id, phase, label, split"))
cte("curve_members", f"""SELECT customer_id, label, size, held, CASE WHEN k = held THEN 'val' WHEN u < share THEN 'train' END AS role FROM (
  SELECT customer_id, label, CAST(floor({u_sql('customer_id', 'curve')} * 3) AS INTEGER) AS k, {u_sql('customer_id', 'size')} AS u FROM label_rows WHERE experiment = 'drifted')
  CROSS JOIN (VALUES {', '.join(f'({i}, {k}, {s!r}::DOUBLE)' for i, s in enumerate(SIZES) for k in range(3))}) AS c(size, held, share) WHERE k = held OR u < share""")
cte("curve_train", "SELECT size, held, label, feature, x FROM curve_members JOIN basis_long USING (customer_id) WHERE role = 'train'")
cte("curve_weights", fit_sql("curve_train", "size, held"))
cte("curve_apply", f"SELECT customer_id, size, held, role, label, model, feature, x FROM curve_members JOIN basis_long USING (customer_id) JOIN {lists_sql({m: BASES[m] for m in CURVE_MODELS})} USING (feature)")
cte("curve_scores", apply_sql("curve_apply", "curve_weights", "size, held", "customer_id, size, held, role, label"))
