"""Model fitting on features and labels of the tables.

What a fit gives cannot be said in SQL; its exact properties can: trees rebuilt from their nodes, score equations, centroids as
means, isotonic values by the min-max formula. Their queries have SQL twins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import LOCAL8, SEG5
from ..operators import features as fe, isotonic as iso, metrics as me, segments as sg, splits as sp, training as tr, trees as tt
from ..session import materialise
from .models import model_scores
from .registry import cte, feats, hash_ordinal_sql, query, r, rounded, sql, u_sql


def training_set(spark, d):
    """Features of all customers with the rule label, a split and the last order date; written once."""
    t = spark.read.parquet(f"{d}/orders.parquet").select(
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"), F.col("o_orderdate").cast("timestamp").alias("timestamp"))
    f = materialise(feats(spark, d).drop("top_categories"), "features")
    lab = sp.label_percentile(f, noise=0.12)
    last = t.groupBy("customer_id").agg(F.max("timestamp").alias("last_transaction_date"))
    full = sp.random_split(lab.join(last, "customer_id"), {"train": 0.6, "val": 0.8}, "test")
    return materialise(full, "training")


def _parts(df):
    return [df.where(F.col("split") == s) for s in ("train", "val", "test")]


def _fit_query(name, fit):
    @query(name)
    def _(spark, d):
        train, val, test = _parts(training_set(spark, d))
        model = fit(train, val)
        scored = tr.apply_model(test, model, "score").select("customer_id", "label", "score")
        return me.rank_metrics(materialise(scored, "scores"))


_fit_query("t1_fit_lr", lambda train, val: tr.fit_lr(train, LOCAL8, balanced=True, reg=0.001))
_fit_query("t2_fit_dt", lambda train, val: tr.fit_dt(train, LOCAL8, max_depth=5, min_leaf=5))
_fit_query("t3_fit_rf", lambda train, val: tr.fit_rf(train, LOCAL8, n_trees=40, max_depth=6, min_leaf=3))
_fit_query("t4_fit_gbt", lambda train, val: tr.fit_gbt(train, val, LOCAL8, n_rounds=50, max_depth=3, rate=0.1))


@query("t5_random_search")
def _(spark, d):
    train = _parts(training_set(spark, d))[0]
    model, table = tr.random_search(tr.dt, train, LOCAL8, "last_transaction_date", tr.SPACES["dt"], n=10, n_folds=5)
    return table.withColumn("params", F.to_json("params"))


@query("t7_stack")
def _(spark, d):
    train, _, test = _parts(training_set(spark, d))
    score = tr.stack(train, LOCAL8, {"lr": (tr.lr, {"reg": 0.001}), "rf": (tr.rf, {"n_trees": 40, "max_depth": 6}), "gbt": (tr.gbt, tr.GBT_PRESETS["xgboost"])})
    return me.rank_metrics(materialise(score(test).select("customer_id", "label", F.col("propensity_score").alias("score")), "scores"))


@query("t8_learning_curve")
def _(spark, d):
    train = _parts(training_set(spark, d))[0]
    return tr.curve_summary(tr.learning_curve(tr.lr, train, LOCAL8, [0.2, 0.4, 0.6, 0.8, 1.0], 3, model_name="logistic_regression"))


@query("t9_sweep")
def _(spark, d):
    train, val, _ = _parts(training_set(spark, d))
    return tr.sweep(tr.dt, train, val, LOCAL8, "max_depth", list(range(2, 13)))


@query("t10_loss_curve")
def _(spark, d):
    train, val, _ = _parts(training_set(spark, d))
    return tr.loss_curve(train, val, LOCAL8, n_rounds=50, max_depth=3)


@query("v5_calibrate")
def _(spark, d):
    train, val, test = _parts(training_set(spark, d))
    model = tr.fit_lr(train, LOCAL8)
    iso = tr.calibrate(tr.apply_model(val, model))
    out = tr.apply_calibration(tr.apply_model(test, model), iso).select("customer_id", "label", "propensity_score")
    return me.calibration_bins(materialise(out, "calibrated"), "label", "propensity_score")


@query("m2_fit_segments")
def _(spark, d):
    f = materialise(feats(spark, d), "features")
    model = sg.fit_segments(f, LOCAL8, k=3, restarts=10, max_iter=50)
    return fe.segment_profiles(sg.assign(f, model), ["recency_days", "frequency", "monetary"])


@query("m2_fit_segments_published")
def _(spark, d):
    """Five segments on the five segmentation features."""
    f = materialise(feats(spark, d), "features")
    model = sg.fit_segments(f, SEG5, k=5, restarts=10, max_iter=50)
    return fe.segment_profiles(sg.assign(f, model), SEG5)


# ---- Exact properties of fits ----

_GAUSS = f"0.12e0 * sqrt(-2e0 * ln(greatest({u_sql('customer_id', '42|u')}, 1e-12))) * cos(2e0 * pi() * {u_sql('customer_id', '42|v')})"
cte("noisy", f"SELECT customer_id, s + {_GAUSS} AS s FROM rule_scored")
cte("training", f"""SELECT customer_id, label, CASE WHEN ordinal <= floor(n_rows * 0.6e0) THEN 'train' WHEN ordinal <= floor(n_rows * 0.8e0) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT customer_id, CASE WHEN s >= (SELECT quantile_cont(s, 0.72) FROM noisy) THEN 1 ELSE 0 END AS label FROM noisy)
  JOIN (SELECT customer_id, ordinal, n_rows FROM ({hash_ordinal_sql('noisy', 'customer_id', 42)})) USING (customer_id)""")


@query("training_set", sql("SELECT customer_id, label, split FROM training"))
def _(spark, d):
    return training_set(spark, d).select("customer_id", "label", "split")


def _tree_query(name, fit, probability, leaves=True):
    """Rows and positives of each split, and of the tree's leaves; whether the walked probability is the model's for every row."""
    count = "(SELECT CAST(count(*) AS BIGINT) FROM training WHERE split = 'train')" if leaves else "NULL::BIGINT"
    positive = "(SELECT CAST(sum(label) AS BIGINT) FROM training WHERE split = 'train')" if leaves else "NULL::BIGINT"

    @query(name, sql(f"SELECT split, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, {count} AS leaf_rows, {positive} AS leaf_positives, true AS agrees FROM training GROUP BY split"))
    def _(spark, d):
        rows = training_set(spark, d)
        train, val, _ = _parts(rows)
        model = fit(train, val)
        nodes = tt.node_table(spark, model)
        both = tt.walk(tr.apply_model(rows, model, "p"), nodes, LOCAL8).withColumn("gap", F.abs(F.col("p") - probability("values")))
        leaf = nodes.where("left IS NULL").agg(F.struct(F.sum("rows").cast("bigint").alias("n"), F.sum("positives").cast("bigint").alias("p")).alias("l")).scalar()
        out = both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("positives"), F.max("gap").alias("gap")).withColumn("l", leaf)
        none = F.lit(None).cast("bigint")
        return out.select("split", "n", "positives", (F.col("l.n") if leaves else none).alias("leaf_rows"), (F.col("l.p") if leaves else none).alias("leaf_positives"),
                          (F.col("gap") < 1e-9).alias("agrees"))


_tree_query("t2_tree_walk", lambda train, val: tr.fit_dt(train, LOCAL8, max_depth=5, min_leaf=5), tt.forest_probability)
_tree_query("t3_forest_walk", lambda train, val: tr.fit_rf(train, LOCAL8, n_trees=40, max_depth=6, min_leaf=3), tt.forest_probability, leaves=False)
_tree_query("t4_boosting_walk", lambda train, val: tr.fit(tr.gbt, train, LOCAL8, n_rounds=30, max_depth=3, rate=0.1, columns=0.8, subsample=0.8), tt.boosted_probability, leaves=False)


@query("t1_score_equations", sql(f"""SELECT feature, (SELECT count(*) FROM training WHERE split = 'train') AS n, true AS zero
  FROM (VALUES ('intercept'), {', '.join(f"('{c}')" for c in LOCAL8)}) AS f(feature)"""))
def _(spark, d):
    """At the maximum of the likelihood the residuals add up to 0, alone and with each standardised feature."""
    train, _, _ = _parts(training_set(spark, d))
    scored = sg.standardise(tr.apply_model(train, tr.fit_lr(train, LOCAL8), "p"), LOCAL8)
    off = F.col("label") - F.col("p")
    sums = scored.agg(F.count(F.lit(1)).alias("n"), F.avg(off).alias("intercept"), *[F.avg(off * F.col(c)).alias(c) for c in LOCAL8])
    return sums.unpivot(["n"], ["intercept", *LOCAL8], "feature", "sum").select("feature", "n", (F.abs("sum") < 1e-4).alias("zero"))


@query("t10_loss_walk", sql("SELECT CAST(unnest(range(20)) AS INTEGER) AS round, true AS agrees"))
def _(spark, d):
    """Log-loss after each round, from the rounds' trees and from the library."""
    train, val, _ = _parts(training_set(spark, d))
    params = {"n_rounds": 20, "max_depth": 3}
    curve = tr.loss_curve(train, val, LOCAL8, **params)
    walked = tt.walk(val, tt.node_table(spark, tr.fit(tr.gbt, train, LOCAL8, **params)), LOCAL8)
    p = tt.prefix_scores(walked, list(range(1, 21)), ["label"], boosted=True)
    loss = F.avg(-F.ln(F.when(F.col("label") == 1, F.col("score")).otherwise(1.0 - F.col("score"))))
    mine = p.groupBy((F.col("n_trees") - 1).alias("round")).agg(loss.alias("loss"))
    return curve.join(F.broadcast(mine), "round").select("round", (F.abs(F.col("loss") - F.col("val_loss")) < 1e-9).alias("agrees"))  # one row a round


TREE_COUNTS = list(range(10, 211, 20))


@query("t9_tree_counts")
def _(spark, d):
    """Forests of 10 to 210 trees from one fit, and where the validation curve reaches its plateau."""
    train, val, _ = _parts(training_set(spark, d))
    curve = materialise(tr.forest_curve(train, {"train": train, "val": val}, LOCAL8, TREE_COUNTS, max_depth=6, min_leaf=3), "tree-counts")
    at = me.plateau(curve.where("side = 'val'"), ["side"], "n_trees", "auc").select(F.col("n_trees").alias("stop"))
    return curve.withColumn("plateau", F.col("n_trees") == at.scalar())


@query("t5_boosting_search", sql("SELECT 2 AS trials, true AS in_range, true AS best_first, (SELECT count(*) FROM training WHERE split = 'test') AS n_test, true AS auc_again"))
def _(spark, d):
    """Two trials over forward folds, with few rounds and little patience; the refitted model's AUC by the library and by counts per score."""
    train, _, test = _parts(training_set(spark, d))
    space = {**tr.SPACES["xgboost"], "n_rounds": (10, 20), "max_depth": (3, 4)}
    model, table = tr.random_search(tr.gbt, train, LOCAL8, "last_transaction_date", space, n=2, n_folds=2, idle=5)
    known = tr.model_auc(model, test)
    exact = me.rank_metrics(tr.apply_model(test, model, "score").select("label", "score"))
    seen = table.agg(F.count(F.lit(1)).cast("int").alias("trials"), F.min((F.col("mean_auc") > 0) & (F.col("mean_auc") <= 1) & (F.col("cv_std") >= 0)).alias("in_range"),
                     F.max("mean_auc").alias("top"), F.max_by("mean_auc", F.struct("mean_auc", -F.col("trial"))).alias("best"))
    auc = exact.select(F.struct((F.col("positives") + F.col("negatives")).alias("n"), "auc").alias("a")).scalar()
    return seen.withColumn("_a", auc).select("trials", "in_range", (F.col("top") == F.col("best")).alias("best_first"), F.col("_a.n").alias("n_test"),
                                             (F.abs(F.col("_a.auc") - known) < 1e-9).alias("auc_again"))


@query("m2_centroids", sql("SELECT count(*) AS n, 3 AS segments, true AS centroid_is_mean, true AS cost_is_inertia FROM feats"))
def _(spark, d):
    """The fitted centroids are the means of their rows, and the reported cost is the inertia of the assignment."""
    f = materialise(feats(spark, d), "features")
    model = sg.fit_segments(f, LOCAL8, k=3, restarts=10)
    rows = sg.with_scaled(sg.assign(f, model), model)
    z = [f"_z{i}" for i in range(len(LOCAL8))]
    centre = F.array(*[F.array(*[F.lit(x) for x in c]) for c in model.centroids])
    means = rows.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("distance") * F.col("distance")).alias("cost"), *[F.avg(c).alias(c) for c in z])
    own = F.element_at(centre, F.col("segment_id") + 1)
    near = F.greatest(*[F.abs(F.col(c) - own[i]) for i, c in enumerate(z)]) < 1e-9
    return means.agg(F.sum("n").alias("n"), F.count(F.lit(1)).cast("int").alias("segments"), F.min(near).alias("centroid_is_mean"),
                     (F.abs(F.sum("cost") - model.cost) < 1e-6 * F.greatest(F.lit(1.0), F.sum("cost"))).alias("cost_is_inertia"))


cte("iso_points", """SELECT row_number() OVER (ORDER BY x) AS i, x, s, n, sum(s) OVER (ORDER BY x) AS cs, sum(n) OVER (ORDER BY x) AS cn FROM (
  SELECT round(score, 3) AS x, sum(label) AS s, count(*) AS n FROM model_scores WHERE experiment = 'stable' AND model = 'lightgbm' AND fold < 2 GROUP BY 1)""")
# The fit at a point is the largest, over starts up to it, of the smallest, over ends from it on, mean between the two.
cte("iso_fit", """SELECT i, any_value(x) AS x, max(low) AS v FROM (
  SELECT p.i, any_value(p.x) AS x, a.i AS start, min((b.cs - a.cs + a.s)::DOUBLE / (b.cn - a.cn + a.n)) AS low
  FROM iso_points p JOIN iso_points a ON a.i <= p.i JOIN iso_points b ON b.i >= p.i GROUP BY p.i, a.i) GROUP BY i""")
cte("iso_line", "SELECT x, v, lead(x) OVER (ORDER BY x) AS nx, lead(v) OVER (ORDER BY x) AS nv FROM iso_fit")
_LINE = """CASE WHEN l.x IS NULL THEN (SELECT min(v) FROM iso_line) WHEN nx IS NULL OR t.x = l.x THEN l.v ELSE l.v + (nv - l.v) * (t.x - l.x) / (nx - l.x) END"""


def _stable_scores(spark, d):
    s = model_scores(spark, d).where("experiment = 'stable' AND model = 'lightgbm'")
    return s.withColumn("score", F.round("score", 3))


@query("v5_isotonic_blocks", sql(f"""SELECT min(x) AS lo, max(x) AS hi, {r('avg(v)', 6)} AS value FROM (SELECT x, v, sum(new) OVER (ORDER BY x) AS b FROM (
  SELECT *, CASE WHEN v > lag(v) OVER (ORDER BY x) + 1e-12 THEN 1 ELSE 0 END AS new FROM iso_fit)) GROUP BY b"""))
def _(spark, d):
    blocks = iso.fit_blocks(_stable_scores(spark, d).where("fold < 2"))
    return rounded(blocks.select("lo", "hi", (F.col("s") / F.col("n")).alias("value")), value=6)


@query("v5_isotonic_applied", sql(f"""SELECT customer_id, {r(_LINE, 6)} AS calibrated
  FROM (SELECT customer_id, round(score, 3) AS x FROM model_scores WHERE experiment = 'stable' AND model = 'lightgbm' AND fold >= 2) t ASOF LEFT JOIN iso_line l ON t.x >= l.x"""))
def _(spark, d):
    s = _stable_scores(spark, d)
    blocks = iso.fit_blocks(s.where("fold < 2"))
    return rounded(iso.apply_blocks(s.where("fold >= 2"), blocks).select("customer_id", "calibrated"), calibrated=6)
