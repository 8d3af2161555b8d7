"""Fitting, searching, combining and calibrating propensity models with Spark ML."""

from __future__ import annotations

import functools
import math
import random
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import discard, materialise
from .features import KEY, fill
from .metrics import curve_summary
from .ordinal import hash_ordinal
from .splits import time_folds

Builder = Callable[..., Pipeline]
#: Fits that run at a time where they do not depend on each other.
PARALLEL = 4


def together(spark: SparkSession, tasks: Sequence[Callable[[], Any]]) -> list[Any]:
    """The results of independent ``tasks`` in their order, some run at a time, as Spark's CrossValidator runs its fits.

    A fit is a chain of small jobs, most of whose time goes by while executors wait for the next one.
    """
    with ThreadPool(processes=max(1, min(PARALLEL, len(tasks)))) as pool:
        return pool.map(lambda f: f(), [inheritable_thread_target(spark)(t) for t in tasks], chunksize=1)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``_w`` = n / (2 * rows of the class), the balanced class weight."""
    row = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("p")).alias("s")).scalar()
    out = df.withColumn("_s", row)
    own = F.when(F.col(label) == 1, F.col("_s.p")).otherwise(F.col("_s.n") - F.col("_s.p"))
    return out.withColumn("_w", F.col("_s.n") / (2.0 * own)).drop("_s")


def _assembler(cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="_x")


def lr(cols: Sequence[str], label: str = "label", reg: float = 0.0, balanced: bool = False, max_iter: int = 100, **_) -> Pipeline:
    """Logistic regression on standardised features."""
    model = LogisticRegression(featuresCol="_z", labelCol=label, regParam=reg, maxIter=max_iter, standardization=False)
    if balanced:
        model.setWeightCol("_w")
    return Pipeline(stages=[_assembler(cols), StandardScaler(inputCol="_x", outputCol="_z", withMean=True, withStd=True), model])


def dt(cols: Sequence[str], label: str = "label", max_depth: int = 5, min_leaf: int = 1, balanced: bool = False, seed: int = 42, **_) -> Pipeline:
    model = DecisionTreeClassifier(featuresCol="_x", labelCol=label, maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=seed)
    if balanced:
        model.setWeightCol("_w")
    return Pipeline(stages=[_assembler(cols), model])


def rf(cols: Sequence[str], label: str = "label", n_trees: int = 50, max_depth: int = 5, min_leaf: int = 1,
       subset: str = "sqrt", balanced: bool = False, seed: int = 42, **_) -> Pipeline:
    model = RandomForestClassifier(featuresCol="_x", labelCol=label, numTrees=n_trees, maxDepth=max_depth,
                                   minInstancesPerNode=min_leaf, featureSubsetStrategy=subset, seed=seed)
    if balanced:
        model.setWeightCol("_w")
    return Pipeline(stages=[_assembler(cols), model])


def gbt(cols: Sequence[str], label: str = "label", n_rounds: int = 50, max_depth: int = 5, rate: float = 0.1,
        subsample: float = 1.0, columns: float = 1.0, min_leaf: int = 1, validation: str | None = None, tolerance: float = 0.001, seed: int = 42, **_) -> Pipeline:
    """Gradient boosting on a share of the rows and of the columns per tree; with a validation flag column it stops when the validation loss stops improving."""
    model = GBTClassifier(featuresCol="_x", labelCol=label, maxIter=n_rounds, maxDepth=max_depth, stepSize=rate, minInstancesPerNode=min_leaf,
                          subsamplingRate=subsample, featureSubsetStrategy="all" if columns >= 1 else str(columns), seed=seed, validationTol=tolerance)
    if validation:
        model.setValidationIndicatorCol(validation)
    return Pipeline(stages=[_assembler(cols), model])


# Two presets of boosting: shallow trees with a larger step, deeper trees with a smaller one.
GBT_PRESETS = {
    "xgboost": {"n_rounds": 60, "max_depth": 3, "rate": 0.1, "subsample": 0.8},
    "lightgbm": {"n_rounds": 80, "max_depth": 5, "rate": 0.05, "subsample": 0.8},
}


def fit(builder: Builder, df: DataFrame, cols: Sequence[str], label: str = "label", **params: Any) -> PipelineModel:
    ready = fill(df, {c: 0 for c in cols}).withColumn(label, F.col(label).cast("double"))
    if params.get("balanced"):
        ready = class_weights(ready, label)
    return builder(cols, label, **params).fit(ready)


def fit_lr(df, cols, label="label", **params):
    return fit(lr, df, cols, label, **params)


def fit_dt(df, cols, label="label", **params):
    return fit(dt, df, cols, label, **params)


def fit_rf(df, cols, label="label", **params):
    return fit(rf, df, cols, label, **params)


def fit_gbt(train: DataFrame, val: DataFrame | None, cols: Sequence[str], label: str = "label", **params):
    """Boosting with early stopping on ``val`` when it is given."""
    if val is None:
        return fit(gbt, train, cols, label, **params)
    both = train.withColumn("_val", F.lit(False)).unionByName(val.withColumn("_val", F.lit(True)), allowMissingColumns=True)
    return fit(gbt, both, cols, label, validation="_val", **params)


def fit_patient(train: DataFrame, val: DataFrame, cols: Sequence[str], label: str = "label", n_rounds: int = 400, idle: int = 20,
                first: int = 40, **params) -> tuple[PipelineModel, int]:
    """Boosting that ends after ``idle`` rounds without a lower validation loss; returns the model of the best number of rounds and that number.

    Rounds depend on those before alone, so a longer fit repeats a shorter one: the fit is doubled until the rounds after its best are idle.
    """
    ready = fill(val, {c: 0 for c in cols}).withColumn(label, F.col(label).cast("double"))
    rounds = min(first, n_rounds)
    while True:
        model = fit(gbt, train, cols, label, n_rounds=rounds, **params)
        losses = model.stages[-1].evaluateEachIteration(model.stages[0].transform(ready))
        best, at = losses[0], 0
        for i, x in enumerate(losses):
            if i - at >= idle:
                break
            if x < best:
                best, at = x, i
        if len(losses) - 1 - at >= idle or rounds == n_rounds:
            break
        rounds = min(2 * rounds, n_rounds)
    return (model if at + 1 == rounds else fit(gbt, train, cols, label, n_rounds=at + 1, **params)), at + 1


def apply_model(df: DataFrame, model, out: str = "propensity_score") -> DataFrame:
    """Probability of the positive class; missing features count as 0 for the model only."""
    cols = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    ready = df.withColumns({f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})
    stages = [s.copy().setInputCols([f"_in_{c}" for c in cols]) if isinstance(s, VectorAssembler) else s for s in model.stages]
    scored = PipelineModel(stages).transform(ready)
    return scored.select(*[F.col(c) for c in df.columns if c != out], vector_to_array("probability")[1].alias(out))


def model_auc(model, df: DataFrame, label: str = "label") -> float:
    """AUC for the loops below; the evaluator is exact with no bins and works on sorted partitions."""
    scored = apply_model(df, model, "_p").select(F.col("_p"), F.col(label).cast("double").alias("_y"))
    return BinaryClassificationEvaluator(rawPredictionCol="_p", labelCol="_y", numBins=0).evaluate(scored)


def _draw(space: dict[str, Any], rng: random.Random) -> dict[str, Any]:
    """One point of a search space: a list is a choice, (lo, hi) integers a range, ("log", lo, hi) log-uniform."""
    point = {}
    for name, s in space.items():
        if isinstance(s, list):
            point[name] = rng.choice(s)
        elif s[0] == "log":
            point[name] = math.exp(rng.uniform(math.log(s[1]), math.log(s[2])))
        elif isinstance(s[0], int):
            point[name] = rng.randint(*s)
        else:
            point[name] = rng.uniform(*s)
    return point


# Search spaces. Fixed values; a depth without bound is Spark's largest, 30. ``c`` is the inverse penalty per row.
SPACES = {
    "lr": {"c": ("log", 1e-3, 1e2), "balanced": [True, False]},
    "dt": {"max_depth": (2, 7), "min_leaf": (2, 19), "balanced": [True, False]},
    "rf": {"n_trees": (50, 199), "max_depth": [5, 8, 30], "min_leaf": (1, 14), "subset": ["sqrt", "log2"], "balanced": [True, False]},
    "xgboost": {"n_rounds": (50, 400), "max_depth": (3, 8), "rate": ("log", 0.01, 0.3), "subsample": (0.6, 1.0), "columns": (0.6, 1.0)},
    # 20 to 100 leaves are depths of 5 to 7.
    "lightgbm": {"n_rounds": (50, 800), "max_depth": (5, 7), "rate": ("log", 0.01, 0.3), "subsample": (0.6, 1.0), "columns": (0.6, 1.0), "min_leaf": (5, 30)},
}


def _with_penalty(params: dict[str, Any], n: int) -> dict[str, Any]:
    """Turns ``c`` into the penalty ``reg`` = 1 / (c * rows) that Spark's averaged loss takes."""
    return {**{k: v for k, v in params.items() if k != "c"}, **({"reg": 1.0 / (params["c"] * n)} if "c" in params else {})}


def _fold_auc(builder: Builder, train: DataFrame, test: DataFrame, cols: Sequence[str], label: str, params: dict[str, Any], idle: int | None = None) -> float:
    """AUC on the test part; 0 where the training part has one class only (or no row) or the test part has no row."""
    n, low, high = train.agg(F.count(label), F.min(label), F.max(label)).first()
    if low == high or test.isEmpty():
        return 0.0
    if builder is gbt and idle:
        return model_auc(fit_patient(train, test, cols, label, idle=idle, **params)[0], test, label)
    return model_auc(fit(builder, train, cols, label, **_with_penalty(params, n)), test, label)


def random_search(builder: Builder, df: DataFrame, cols: Sequence[str], date_col: str, space: dict[str, Any],
                  n: int = 10, n_folds: int = 5, gap: int = 7, label: str = "label", seed: int = 42, idle: int = 20):
    """Randomised search on forward-chaining folds. Boosting ends after ``idle`` rounds without gain on the fold's test part.

    Returns (model refitted on all rows with the best parameters, table of trials). The folds are
    computed and written once; each fit reads its part of them.
    """
    rng = random.Random(seed)
    folds = materialise(time_folds(df.select(KEY, date_col, label, *cols), date_col, n_folds, gap), "folds")
    drawn = [_draw(space, rng) for _ in range(n)]

    def run(params: dict[str, Any], k: int) -> float:
        part = folds.where(F.col("fold") == k)
        return _fold_auc(builder, part.where("role = 'train'"), part.where("role = 'test'"), cols, label, params, idle)

    found = together(df.sparkSession, [functools.partial(run, params, k) for params in drawn for k in range(1, n_folds + 1)])
    trials = []
    for trial, params in enumerate(drawn):
        aucs = found[trial * n_folds: (trial + 1) * n_folds]
        mean = sum(aucs) / len(aucs)
        std = math.sqrt(sum((a - mean) ** 2 for a in aucs) / len(aucs))
        trials.append((trial, mean, std, {k: str(v) for k, v in params.items()}, params))
    discard(folds)
    best = max(trials, key=lambda t: (t[1], -t[0]))
    model = fit(builder, df, cols, label, **_with_penalty(best[4], df.count()))
    table = df.sparkSession.createDataFrame(
        [t[:4] for t in trials], "trial int, mean_auc double, cv_std double, params map<string,string>"
    )
    return model, table


def stack(train: DataFrame, cols: Sequence[str], members: dict[str, tuple[Builder, dict]], label: str = "label",
          folds: int = 3, c: float = 0.1, seed: int = 42):
    """Out-of-fold member scores, then a logistic regression on them.

    Returns a function that scores a DataFrame. Members are refitted on all rows for scoring.
    """
    # Members of folds need no order: the hash's remainder deals them without a sort.
    placed = train.select(KEY, label, *cols).withColumn("_fold", F.pmod(F.xxhash64(F.col(KEY), F.lit(seed)), F.lit(folds)).cast("int"))
    placed = materialise(placed, "stacking")
    # All fits at once, alike ones side by side: those without each fold, and at the end without none.
    jobs = [(name, f) for name in members for f in [*range(folds), None]]

    def run(name: str, f: int | None) -> PipelineModel:
        builder, params = members[name]
        return fit(builder, placed if f is None else placed.where(F.col("_fold") != f), cols, label, **params)

    models = dict(zip(jobs, together(train.sparkSession, [functools.partial(run, *job) for job in jobs]), strict=True))
    parts = []
    for f in range(folds):
        held = placed.where(F.col("_fold") == f)
        for name in members:
            held = apply_model(held, models[name, f], f"m_{name}")
        parts.append(held)
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    names = [f"m_{n}" for n in members]
    n = placed.count()
    final = fit(lr, materialise(oof, "out-of-fold"), names, label, reg=1.0 / (c * n))
    fitted = {name: models[name, None] for name in members}

    def score(df: DataFrame, out: str = "propensity_score") -> DataFrame:
        wide = df
        for name, model in fitted.items():
            wide = apply_model(wide, model, f"m_{name}")
        return apply_model(wide, final, out).drop(*names)

    return score


def learning_curve(builder: Builder, df: DataFrame, cols: Sequence[str], shares: Sequence[float], folds: int = 3,
                   label: str = "label", model_name: str = "model", seed: int = 42, **params) -> DataFrame:
    """Train and validation AUC for growing training sizes: rows (model, train_size, fold, train_auc, val_auc)."""
    placed = materialise(hash_ordinal(df.select(KEY, label, *cols), KEY, seed), "curve")
    n = placed.count()

    def run(f: int, share: float) -> tuple:
        val = placed.where(F.col("ordinal") % folds == f)
        train = placed.where((F.col("ordinal") % folds != f) & (F.col("ordinal") <= F.lit(int(n * share))))
        model = fit(builder, train, cols, label, **params)
        return model_name, train.count(), f, model_auc(model, train, label), model_auc(model, val, label)

    rows = together(df.sparkSession, [functools.partial(run, f, share) for f in range(folds) for share in shares])
    return df.sparkSession.createDataFrame(rows, "model string, train_size int, fold int, train_auc double, val_auc double")


def sweep(builder: Builder, train: DataFrame, val: DataFrame, cols: Sequence[str], param: str, values: Sequence[Any],
          label: str = "label", **params) -> DataFrame:
    """AUC for each value of one parameter: rows (param, value, train_auc, val_auc)."""
    rows = []
    for v in values:
        model = fit(builder, train, cols, label, **{**params, param: v})
        rows.append((param, int(v), model_auc(model, train, label), model_auc(model, val, label)))
    return train.sparkSession.createDataFrame(rows, "param string, value int, train_auc double, val_auc double")


def forest_curve(train: DataFrame, sides: dict[str, DataFrame], cols: Sequence[str], counts: Sequence[int], label: str = "label", **params) -> DataFrame:
    """(side, n_trees, auc) of forests of growing size from one fit: the mean over its first trees is the smaller forest."""
    from .metrics import rank_metrics
    from .trees import node_table, prefix_scores, walk

    nodes = node_table(train.sparkSession, fit(rf, train, cols, label, n_trees=max(counts), **params))
    both = None
    for name, df in sides.items():
        part = df.select(label, *cols).withColumn("side", F.lit(name))
        both = part if both is None else both.unionByName(part)
    scored = prefix_scores(walk(both, nodes, cols), counts, ["side", label])
    return rank_metrics(scored, label, group=["side", "n_trees"]).select("side", "n_trees", "auc")


def loss_curve(train: DataFrame, val: DataFrame, cols: Sequence[str], label: str = "label", **params) -> DataFrame:
    """Log-loss per boosting round on both sides: rows (round, train_loss, val_loss).

    The library's loss is 2 * log(1 + exp(-2yF)); half of it is the log-loss of its probabilities.
    """
    model = fit(gbt, train, cols, label, **params)
    assemble = lambda df: model.stages[0].transform(fill(df, {c: 0 for c in cols}).withColumn(label, F.col(label).cast("double")))
    a = model.stages[-1].evaluateEachIteration(assemble(train))
    b = model.stages[-1].evaluateEachIteration(assemble(val))
    rows = [(i, x / 2.0, y / 2.0) for i, (x, y) in enumerate(zip(a, b))]
    return train.sparkSession.createDataFrame(rows, "round int, train_loss double, val_loss double")


def calibrate(val: DataFrame, score: str = "propensity_score", label: str = "label", digits: int | None = None) -> IsotonicRegressionModel:
    """Isotonic regression of the label on the score.

    Rows with exactly the same score are one weighted point, which changes nothing. ``digits`` rounds the scores first: a coarser fit
    for scores with very many distinct values, off unless asked for.
    """
    points = val.groupBy((F.col(score).cast("double") if digits is None else F.round(score, digits)).alias("features")).agg(
        F.avg(F.col(label).cast("double")).alias("label"), F.count(F.lit(1)).cast("double").alias("weight")
    )
    return IsotonicRegression(weightCol="weight").fit(points)


def apply_calibration(df: DataFrame, model: IsotonicRegressionModel, score: str = "propensity_score") -> DataFrame:
    """Calibrated score; beyond the fitted range the end values hold, and the result stays in [0, 1]."""
    out = model.copy().setFeaturesCol("_raw").setPredictionCol("_cal").transform(df.withColumn("_raw", F.col(score)))
    return out.withColumn(score, F.least(F.greatest(F.col("_cal"), F.lit(0.0)), F.lit(1.0))).drop("_raw", "_cal")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


__all__ = [
    "Builder", "GBT_PRESETS", "SPACES", "apply_calibration", "apply_model", "calibrate", "class_weights",
    "curve_summary", "dt", "fit", "fit_dt", "fit_gbt", "fit_lr", "fit_patient", "fit_rf", "forest_curve", "gbt", "learning_curve", "load_model",
    "loss_curve", "lr", "model_auc", "random_search", "rf", "save_model", "stack", "sweep", "together",
]
