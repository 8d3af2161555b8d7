"""Many linear models at once: fitted in one aggregate, kept as a table of weights, applied as a matrix product.

A weight is the difference of the class means over the pooled variance (a discriminant with independent features), so all fits of
all experiments, folds and sizes come out of the same pass over the rows, and any engine can repeat them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .ordinal import join_null_safe
from ..functions.exprs import num, scalar_of
from ..session import materialise

#: Fits whose weights are broadcast at most; more are joined by a shuffle.
FEW_FITS = 10_000


def basis(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, list[str]]]:
    """Columns for linear models, by kind: standardised ``z``, above the mean ``h``, both above ``p``, squared ``q``.

    Means and deviations are those of all rows, from one aggregate. Missing values count as the mean.
    """
    at = df.agg(F.struct(*[c for i, x in enumerate(cols) for c in (
        F.avg(F.col(x).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(x).cast("double")).alias(f"s{i}"))]).alias("at"))
    z, h, p, q = {}, {}, {}, {}
    for i, x in enumerate(cols):
        off = F.col(x).cast("double") - F.col(f"_at.m{i}")
        z[f"z{i}"] = F.coalesce(F.try_divide(off, F.col(f"_at.s{i}")), F.lit(0.0))
        h[f"h{i}"] = F.when(off > 0, 1.0).otherwise(0.0)
        q[f"q{i}"] = F.col(f"z{i}") * F.col(f"z{i}")
        p.update({f"p{j}{i}": F.col(f"h{j}") * F.col(f"h{i}") for j in range(i)})
    wide = df.withColumn("_at", scalar_of(at)).withColumns({**z, **h}).withColumns({**p, **q}).drop("_at")
    return wide, {"z": list(z), "h": list(h), "p": list(p), "q": list(q)}


def fit_weights(rows: DataFrame, by: Sequence[str], features: Sequence[str], label: str = "label") -> DataFrame:
    """(by..., prior, feature, weight, middle) for each group: log odds of the classes, and per feature the weight and the middle of the class means.

    The rows are aggregated once, by group and class, with a combination on the map side. A feature that does not vary, or a group
    of one class, has weight 0.
    """
    side = rows.where(F.col(label).isNotNull()).groupBy(*by, F.col(label).cast("int").alias("_y")).agg(
        F.count(F.lit(1)).alias("n"), *[c for f in features for c in (F.avg(f).alias(f"m_{f}"), F.var_pop(f).alias(f"v_{f}"))])
    pick = lambda y, c: F.max(F.when(F.col("_y") == y, F.col(c)))
    both = side.groupBy(*by).agg(
        F.coalesce(pick(1, "n"), F.lit(0)).alias("n1"), F.coalesce(pick(0, "n"), F.lit(0)).alias("n0"),
        *[pick(y, f"{k}_{f}").alias(f"{k}{y}_{f}") for f in features for k in "mv" for y in (0, 1)])

    def one(f: str) -> Column:
        pooled = (F.col("n1") * F.col(f"v1_{f}") + F.col("n0") * F.col(f"v0_{f}")) / (F.col("n1") + F.col("n0"))
        weight = F.when(pooled > 1e-12, (F.col(f"m1_{f}") - F.col(f"m0_{f}")) / pooled)
        middle = (F.col(f"m1_{f}") + F.col(f"m0_{f}")) / 2.0
        return F.struct(F.lit(f).alias("feature"), F.coalesce(weight, F.lit(0.0)).alias("weight"), F.coalesce(middle, F.lit(0.0)).alias("middle"))

    prior = F.ln((F.col("n1") + 0.5) / (F.col("n0") + 0.5)).alias("prior")
    return both.select(*by, prior, F.inline(F.array(*[one(f) for f in features])))


def apply_weights(rows: DataFrame, weights: DataFrame, by: Sequence[str], models: dict[str, Sequence[str]]) -> DataFrame:
    """Adds ``s_<model>``: the probability by each model, whose evidence is the mean over its features of weight * (value - middle).

    ``weights`` (see :func:`fit_weights`) becomes one row per group with a matrix, models by features; each row of
    the data meets its group's matrix once.
    """
    features = sorted({f for fs in models.values() for f in fs})
    place = {f: i for i, f in enumerate(features)}
    pick = lambda c, f: F.coalesce(F.max(F.when(F.col("feature") == f, F.col(c))), F.lit(0.0))
    table = weights.where(F.col("feature").isin(features)).groupBy(*by).agg(
        F.first("prior").alias("_prior"), F.array(*[pick("weight", f) for f in features]).alias("_w"),
        F.array(*[pick("middle", f) for f in features]).alias("_m"))
    table = materialise(table, "weights")
    if table.limit(FEW_FITS + 1).count() <= FEW_FITS:
        table = F.broadcast(table)
    joined = join_null_safe(rows, table, by)

    def score(fs: Sequence[str]) -> Column:
        evidence = " + ".join(f"_w[{place[f]}] * (`{f}` - _m[{place[f]}])" for f in fs)
        return F.expr(f"1D / (1D + exp(-(_prior + ({evidence}) / {num(len(fs))})))")

    return joined.withColumns({f"s_{m}": score(fs) for m, fs in models.items()}).drop("_prior", "_w", "_m")
