"""Evaluation of scores against labels, for many models and splits in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exprs import ratio_or_zero
from .features import KEY
from .ordinal import buckets_for, cut_by_value, join_null_safe, prefix_sums
from ..session import materialise


def rank_metrics(df: DataFrame, y: str = "label", p: str = "score", group: Sequence[str] = (),
                 one_class: float | None = 0.5) -> DataFrame:
    """Exact ROC AUC (ties at half weight) and average precision, from counts per distinct score.

    Counting first turns a score shared by very many rows into one row before anything is ordered.
    With one class only the AUC is ``one_class``.
    """
    group = list(group)
    counts = df.groupBy(*group, p).agg(
        F.sum(F.col(y).cast("bigint")).alias("_pos"), F.sum((1 - F.col(y)).cast("bigint")).alias("_neg")
    )
    counts = materialise(counts, "counts")
    placed = prefix_sums(counts, p, {"_pa": F.col("_pos"), "_na": F.col("_neg")}, group, buckets=buckets_for(counts, group))
    upto = F.col("_pa") + F.col("_pos")
    precision = upto / (upto + F.col("_na") + F.col("_neg"))
    out = placed.groupBy(*group).agg(
        F.sum(F.col("_pos")).alias("positives"),
        F.sum(F.col("_neg")).alias("negatives"),
        F.sum(F.col("_neg") * (F.col("_pa") + F.lit(0.5) * F.col("_pos"))).alias("_wins"),
        F.sum(F.col("_pos") * precision).alias("_ap"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return out.select(
        *group, "positives", "negatives",
        F.coalesce(F.try_divide(F.col("_wins"), pairs), F.lit(one_class)).alias("auc"),
        ratio_or_zero("_ap", "positives").alias("average_precision"),
    )


def auc(df: DataFrame, y: str = "label", p: str = "score", group: Sequence[str] = ()) -> DataFrame:
    return rank_metrics(df, y, p, group).drop("average_precision")


def average_precision(df: DataFrame, y: str = "label", p: str = "score", group: Sequence[str] = ()) -> DataFrame:
    return rank_metrics(df, y, p, group).drop("auc")


def _top(den: int):
    return lambda n: [F.greatest(F.floor(n / den), F.lit(1))]


def top_fraction(df: DataFrame, order: str, tie: str = KEY, den: int = 10, group: Sequence[str] = ()) -> DataFrame:
    """The first ``max(1, n // den)`` rows by score."""
    return cut_by_value(df, order, tie, _top(den), group, out="_part").where(F.col("_part") == 0).drop("_part")


def bottom_half(df: DataFrame, order: str, tie: str = KEY) -> DataFrame:
    halves = cut_by_value(df, order, tie, lambda n: [F.floor(n / 2)], out="_part")
    return halves.where(F.col("_part") == 1).drop("_part")


def lift_d1(df: DataFrame, y: str = "label", p: str = "score", tie: str = KEY, group: Sequence[str] = (),
            base_zero: float = 0.0) -> DataFrame:
    """Positive rate of the top decile over the base rate; ``base_zero`` where nobody is positive."""
    group = list(group)
    marked = cut_by_value(df.select(*group, tie, p, y), p, tie, _top(10), group, out="_part")
    rates = marked.groupBy(*group).agg(
        F.avg(F.when(F.col("_part") == 0, F.col(y))).alias("top_rate"), F.avg(y).alias("base_rate")
    )
    lift = F.when(F.col("base_rate") > 0, F.try_divide(F.col("top_rate"), F.col("base_rate"))).otherwise(F.lit(base_zero))
    return rates.withColumn("lift_at_decile1", lift)


def evaluate(scores: DataFrame, y: str = "label", p: str = "score", tie: str = KEY,
             group: Sequence[str] = ("experiment", "model"), fold: str | None = "fold") -> DataFrame:
    """Metrics table of many models: test and train AUC, lift of the test top decile, deviation of the AUC over folds (``cv_std``).

    ``scores`` has one row per (group, split, customer) with splits 'train' and 'test' and, unless ``fold`` is None, a fold. One pass counts both classes per
    score in each split and each fold; everything comes from prefix sums over these counts. Where the top decile ends inside a score
    that several rows share, only these rows are read again, in the order of the md5 of their ids.
    """
    group = list(group)
    parts = [F.struct(F.lit("split").alias("_kind"), F.col("split").cast("string").alias("_part"))]
    if fold:
        parts.append(F.struct(F.lit("fold").alias("_kind"), F.col(fold).cast("string").alias("_part")))
    counts = scores.select(*group, p, y, F.inline(F.array(*parts))).groupBy(*group, "_kind", "_part", p).agg(
        F.sum(F.col(y).cast("bigint")).alias("_pos"), F.sum((1 - F.col(y)).cast("bigint")).alias("_neg"))
    counts = materialise(counts, "counts")
    keys = [*group, "_kind", "_part"]
    placed = prefix_sums(counts, p, {"_pa": F.col("_pos"), "_na": F.col("_neg")}, keys, buckets=buckets_for(counts, keys))
    before, here = F.col("_pa") + F.col("_na"), F.col("_pos") + F.col("_neg")
    top = F.greatest(F.floor((F.col("_pa_total") + F.col("_na_total")) / 10), F.lit(1))
    cut = (before < top) & (before + here >= top)
    sums = placed.groupBy(*group, "_kind", "_part").agg(
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"),
        F.sum(F.col("_neg") * (F.col("_pa") + F.lit(0.5) * F.col("_pos"))).alias("_wins"),
        # The score that the top decile ends in: positives before it, rows still needed of it, its rows and positives.
        F.max(F.when(cut, F.struct(F.col(p).alias("at"), F.col("_pa").alias("before"), (top - before).alias("need"), here.alias("rows"), F.col("_pos").alias("pos")))).alias("_cut"))
    sums = materialise(sums.withColumn("_auc", F.coalesce(F.try_divide("_wins", F.col("_p").cast("double") * F.col("_n")), F.lit(0.5))), "auc")
    of = lambda kind, part, c: F.max(F.when((F.col("_kind") == kind) & (F.col("_part") == part), F.col(c)))
    table = sums.groupBy(*group).agg(
        of("split", "test", "_auc").alias("test_auc"), of("split", "train", "_auc").alias("train_auc"),
        of("split", "test", "_cut").alias("_cut"), of("split", "test", "_p").alias("_p"), of("split", "test", "_n").alias("_n"),
        F.stddev_pop(F.when(F.col("_kind") == "fold", F.col("_auc"))).alias("cv_std"))
    # One row per model from here on, but for the rows that share the score of a cut.
    cuts = table.where("_cut.need < _cut.rows").select(*group, F.col("_cut.at").alias(p), F.col("_cut.need").alias("_need"))
    tied = join_null_safe(scores.where(F.col("split") == "test").select(*group, p, y, tie), cuts, [*group, p])
    first = cut_by_value(materialise(tied, "tied"), p, tie, lambda n: [F.col("_need")], group, out="_part").where(F.col("_part") == 0)
    taken = first.groupBy(*group).agg(F.sum(F.col(y).cast("bigint")).alias("_taken"))
    joined = join_null_safe(table, taken, group, "left")
    within = F.when(F.col("_cut.need") < F.col("_cut.rows"), F.coalesce("_taken", F.lit(0))).otherwise(F.col("_cut.pos"))
    rows = F.col("_p") + F.col("_n")
    share = (F.col("_cut.before") + within) / F.greatest(F.floor(rows / 10), F.lit(1))
    lift = F.when(F.col("_p") > 0, F.try_divide(share, F.col("_p") / rows)).otherwise(F.lit(0.0))
    out = [*group, "test_auc", "train_auc", lift.alias("lift_at_decile1")]
    return joined.select(*out, "cv_std") if fold else joined.select(*out)


def cv_std(scores: DataFrame, y: str = "label", p: str = "score",
           group: Sequence[str] = ("experiment", "model"), fold: str = "fold") -> DataFrame:
    """Population deviation of the AUC over folds."""
    group = list(group)
    return rank_metrics(scores, y, p, [*group, fold]).groupBy(*group).agg(F.stddev_pop("auc").alias("cv_std"))


def deciles(df: DataFrame, score: str = "propensity_score", tie: str = KEY, k: int = 10) -> DataFrame:
    """``ntile(k)`` over all rows, 1 = highest score: the first n mod k groups hold one row more."""
    ends = lambda n: [F.floor(n / k) * j + F.least(F.lit(j), n % k) for j in range(1, k)]
    return cut_by_value(df, score, tie, ends, out="_part").withColumn("decile", F.col("_part") + 1).drop("_part")


def slice_deciles(df: DataFrame, score: str = "propensity_score", tie: str = KEY) -> DataFrame:
    """Decile i holds the positions from i*n//10 up to (i+1)*n//10."""
    ends = lambda n: [F.floor(n * j / 10) for j in range(1, 10)]
    return cut_by_value(df, score, tie, ends, out="_part").withColumn("decile", F.col("_part") + 1).drop("_part")


def slice_lift(df: DataFrame, y: str = "label", score: str = "propensity_score", tie: str = KEY) -> DataFrame:
    """Rate and lift of each slice decile."""
    rates = slice_deciles(df, score, tie).groupBy("decile").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("bigint")).alias("_p")
    )
    whole = Window.partitionBy()  # ten rows
    base = F.sum("_p").over(whole) / F.sum("n").over(whole)
    out = rates.withColumn("actual_rate", F.col("_p") / F.col("n")).withColumn("baseline_rate", base)
    return out.withColumn("lift", F.when(F.col("baseline_rate") > 0, F.try_divide("actual_rate", "baseline_rate")).otherwise(0.0)).drop("_p")


def calibration_bins(df: DataFrame, y: str = "label", p: str = "score", bins: int | None = None) -> DataFrame:
    """Reliability curve: mean prediction and positive share of equal-width bins, empty bins left out.

    The number of bins follows the number of rows: max(3, min(10, n // 20)). A score on an inner
    edge belongs to the lower bin.
    """
    if bins is None:
        n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        k, most = F.greatest(F.lit(3), F.least(F.lit(10), F.floor(n / 20))).cast("int"), 10
    else:
        k, most = F.lit(bins), bins
    numbered = df.withColumn("_k", k)
    at = F.lit(0)
    for i in range(1, most):
        edge = F.lit(float(i)) * (F.lit(1.0) / F.col("_k"))
        at = at + ((F.lit(i) < F.col("_k")) & (F.col(p) > edge)).cast("int")
    return numbered.withColumn("bin", at).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_predicted"), F.avg(y).alias("fraction_positive")
    )


def vote(member_scores: DataFrame, group: Sequence[str] = (KEY,), p: str = "score") -> DataFrame:
    """Soft vote: the mean of the members' probabilities."""
    return member_scores.groupBy(*group).agg(F.avg(p).alias("score"))


# ---- Curves: a few points for each curve, many curves at once ----

def best_so_far(trials: DataFrame, curve: Sequence[str], step: str, value: str) -> DataFrame:
    w = Window.partitionBy(*curve).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumn("best_so_far", F.max(value).over(w))


def plateau(points: DataFrame, curve: Sequence[str], step: str, value: str, share: float = 0.05) -> DataFrame:
    """First point whose gain is below a share of the whole gain; else the last; the first of one or two points."""
    by = Window.partitionBy(*curve).orderBy(step)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = points.select(
        *curve, step, value,
        (F.col(value) - F.lag(value).over(by)).alias("_gain"),
        F.greatest(F.abs(F.last(value).over(whole) - F.first(value).over(whole)), F.lit(1e-6)).alias("_total"),
        F.count(F.lit(1)).over(whole).alias("_n"),
        F.row_number().over(by).alias("_i"),
    )
    flat = F.col("_gain") < F.col("_total") * share
    last = F.col("_i") == F.col("_n")
    wanted = F.when(F.col("_n") <= 2, F.col("_i") == 1).otherwise(F.coalesce(flat, F.lit(False)) | last)
    return marked.where(wanted).groupBy(*curve).agg(
        F.min_by(step, "_i").alias(step), F.min_by(value, "_i").alias(value)
    )


def arg_best(points: DataFrame, curve: Sequence[str], step: str, value: str, how: str = "max") -> DataFrame:
    """Point with the largest (or smallest) value of each curve; the first one on ties."""
    key = -F.col(value) if how == "max" else F.col(value)
    order = F.struct(key, F.col(step))
    return points.groupBy(*curve).agg(F.min_by(step, order).alias(step), F.min_by(value, order).alias(value))


def curve_summary(points: DataFrame) -> DataFrame:
    """Mean and population deviation over folds per (model, train_size)."""
    return points.groupBy("model", "train_size").agg(
        F.avg("train_auc").alias("train_mean"), F.stddev_pop("train_auc").alias("train_std"),
        F.avg("val_auc").alias("val_mean"), F.stddev_pop("val_auc").alias("val_std"),
    )


def curve_diagnosis(summary: DataFrame) -> DataFrame:
    """Reading of a learning curve at its largest size."""
    last = F.struct(-F.col("train_size"))
    end = summary.groupBy("model").agg(
        F.min_by("train_mean", last).alias("train_mean"), F.min_by("val_mean", last).alias("val_mean")
    )
    gap = F.col("train_mean") - F.col("val_mean")
    low = (F.col("val_mean") < 0.70) & (F.col("train_mean") < 0.70)
    return end.withColumn(
        "diagnosis",
        F.when(low, "underfit").when(gap > 0.08, "overfit").when(gap < 0.03, "converged").otherwise("moderate"),
    )


def diagnose(metrics: DataFrame) -> DataFrame:
    gap = F.col("train_auc") - F.col("test_auc")
    return metrics.withColumn(
        "diagnosis",
        F.when(gap > 0.08, "high variance").when(F.col("test_auc") < 0.70, "high bias")
        .when(gap < 0.02, "well balanced").otherwise("moderate variance"),
    )
