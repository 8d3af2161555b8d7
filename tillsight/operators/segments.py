"""Standardising, clustering and judging customer segments."""

from __future__ import annotations

import math
from dataclasses import dataclass
from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import num, scalar_of
from ..session import discard, materialise
from .features import KEY
from .ordinal import hash_ordinal


@dataclass(frozen=True)
class SegmentModel:
    """Scaler and centroids together with the feature list they were fitted on."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    centroids: tuple[tuple[float, ...], ...]
    cost: float | None = None


def scaler_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population deviation of every column as one row; a constant column has scale 1."""
    aggs = []
    for c in cols:
        sd = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"{c}_mean"), F.when(sd > 0, sd).otherwise(F.lit(1.0)).alias(f"{c}_scale")]
    return df.agg(*aggs)


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / population deviation. One struct-valued scalar subquery carries all statistics."""
    stats = scaler_stats(df, cols)
    row = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    ready = df.withColumn("_s", row)
    return ready.withColumns({
        c: (F.col(c) - F.col(f"_s.{c}_mean")) / F.col(f"_s.{c}_scale") for c in cols
    }).drop("_s")


def fit_scaler(df: DataFrame, cols: list[str]) -> tuple[list[float], list[float]]:
    row = scaler_stats(df, cols).first()
    return [row[f"{c}_mean"] for c in cols], [row[f"{c}_scale"] for c in cols]


def _seed(points, k: int, rng):
    """k-means++ over the rows of a bounded sample: each next centre is drawn in proportion to the squared distance from those before."""
    import numpy as np

    centres = [points[rng.integers(len(points))]]
    for _ in range(k - 1):
        d = np.min([((points - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(points[rng.choice(len(points), p=d / d.sum())] if d.sum() > 0 else points[rng.integers(len(points))])
    return np.array(centres)


def _partial_sums(cols: list[str], centres):
    """Per task, restart and cluster: rows, sum of each column and squared distances to the nearest centre."""
    import numpy as np
    import pyarrow as pa

    restarts, k, _ = centres.shape

    def run(batches):
        total = np.zeros((restarts, k, len(cols) + 2))
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols], axis=1)
            full = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            for r in range(restarts):
                d = ((x[:, None, :] - centres[r][None, :, :]) ** 2).sum(axis=2)
                near = d.argmin(axis=1)
                member = np.zeros((len(x), k))
                member[np.arange(len(x)), near] = 1.0
                total[r, :, :-1] += member.T @ full
                total[r, :, -1] += member.T @ d[np.arange(len(x)), near]
        at = [(r, c) for r in range(restarts) for c in range(k)]
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in at], pa.int32()), pa.array([c for _, c in at], pa.int32()),
                                          *[pa.array([total[r, c, i] for r, c in at]) for i in range(len(cols) + 2)]],
                                         names=["restart", "cluster", "n", *[f"s{i}" for i in range(len(cols))], "cost"])

    return run


def fit_segments(df: DataFrame, cols: list[str], k: int = 3, restarts: int = 10, seed: int = 42,
                 max_iter: int = 100, seed_rows: int = 2_000) -> SegmentModel:
    """K-means on standardised features, the best of several restarts by cost.

    All restarts move together: one pass over the points assigns each to the centres of every restart and adds up rows, sums and costs per
    task, so an iteration is one scan and its result restarts x k rows. The first centres come from the ``seed_rows`` rows of least hash. A centre
    without rows stays; iterations end when no centre of any restart moves.
    """
    import numpy as np

    means, scales = fit_scaler(df, cols)
    points = materialise(df.select(*[
        ((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(m)) / F.lit(s)).alias(c) for c, m, s in zip(cols, means, scales)
    ]), "points")
    first = points.orderBy(F.xxhash64(*cols, F.lit(seed)), *cols).limit(seed_rows).toPandas()[cols].to_numpy(dtype=float)
    if not len(first):
        raise ValueError("no rows to fit segments on")
    rng = np.random.default_rng(seed)
    centres = np.array([_seed(first, k, rng) for _ in range(restarts)])
    schema = "restart int, cluster int, n double, " + "".join(f"s{i} double, " for i in range(len(cols))) + "cost double"
    for step in range(max_iter + 1):
        sums = points.mapInArrow(_partial_sums(cols, centres), schema).groupBy("restart", "cluster").sum(*["n", *[f"s{i}" for i in range(len(cols))], "cost"])
        after, cost = centres.copy(), np.zeros(restarts)
        for r in sums.collect():  # restarts x k rows
            cost[r["restart"]] += r["sum(cost)"]
            if r["sum(n)"]:
                after[r["restart"], r["cluster"]] = [r[f"sum(s{i})"] / r["sum(n)"] for i in range(len(cols))]
        if step == max_iter or np.abs(after - centres).max() < 1e-12:
            break
        centres = after
    best = int(cost.argmin())
    discard(points)
    centroids = sorted(tuple(float(x) for x in c) for c in centres[best])
    return SegmentModel(tuple(cols), tuple(means), tuple(scales), tuple(centroids), float(cost[best]))


def scaled_expr(model: SegmentModel, i: int) -> str:
    return f"(coalesce(CAST({model.features[i]} AS DOUBLE), 0D) - {num(model.means[i])}) / {num(model.scales[i])}"


def with_scaled(df: DataFrame, model: SegmentModel) -> DataFrame:
    """Add the scaled features _z0.._zn of the model."""
    return df.withColumns({f"_z{i}": F.expr(scaled_expr(model, i)) for i in range(len(model.features))})


def squared_term(i: int, centre: float) -> str:
    return f"(_z{i} - {num(centre)}) * (_z{i} - {num(centre)})"


def distance_expr(centre: tuple[float, ...]) -> str:
    return "sqrt(" + " + ".join(squared_term(i, c) for i, c in enumerate(centre)) + ")"


def assign(df: DataFrame, model: SegmentModel) -> DataFrame:
    """Add ``segment_id`` and ``distance`` of the nearest centroid: a plain projection, nothing is shuffled.

    The model is a few numbers, so it is part of the expression.
    """
    options = ", ".join(
        f"named_struct('d', {distance_expr(centre)}, 'k', {k})" for k, centre in enumerate(model.centroids)
    )
    near = with_scaled(df, model).withColumn("_near", F.expr(f"array_min(array({options}))"))
    kept = [F.col(c) for c in df.columns if c not in ("segment_id", "distance")]
    return near.select(*kept, F.col("_near.k").alias("segment_id"), F.col("_near.d").alias("distance"))


def inertia(assigned: DataFrame) -> DataFrame:
    """Sum of squared distances to the own centroid."""
    return assigned.agg(F.sum(F.col("distance") * F.col("distance")).alias("inertia"))


def silhouette(df: DataFrame, cols: list[str], segment: str = "segment_id", sample: int = 10_000, seed: int = 42,
               key: str = KEY, scaled: bool = True) -> DataFrame:
    """Mean silhouette (Euclidean) of a reproducible sample, as one row (n_sample, silhouette).

    The sample is the operator's own feature and bounds what is broadcast: at most ``sample`` points.
    Each task compares its share of the points with all of them in vector arithmetic; no pair of
    points is ever a row. A point alone in its segment counts as 0.
    """
    import numpy as np
    import pandas as pd

    rows = standardise(df, cols) if scaled else df
    placed = hash_ordinal(rows, key, seed, first=sample)
    points = placed.select(F.col(segment).cast("int").alias("s"), *[F.col(c).cast("double").alias(c) for c in cols])
    points = materialise(points, "silhouette-sample")
    spark = df.sparkSession
    held = points.toPandas()  # at most ``sample`` rows
    matrix, seg = held[cols].to_numpy(dtype=float), held["s"].to_numpy()
    shared = spark.sparkContext.broadcast((matrix, seg))

    def per_point(batches):
        all_points, all_segments = shared.value
        names, index, sizes = np.unique(all_segments, return_inverse=True, return_counts=True)
        member = np.zeros((len(all_segments), len(names)))
        member[np.arange(len(all_segments)), index] = 1.0
        for pdf in batches:
            x, own = pdf[cols].to_numpy(dtype=float), np.searchsorted(names, pdf["s"].to_numpy())
            out = np.empty(len(x))
            for at in range(0, len(x), 64):
                block, mine = x[at:at + 64], own[at:at + 64]
                dist = np.sqrt(((block[:, None, :] - all_points[None, :, :]) ** 2).sum(axis=2))
                total = dist @ member
                here = np.arange(len(block))
                n_own = sizes[mine]
                a = total[here, mine] / np.maximum(n_own - 1, 1)
                mean = total / sizes
                mean[here, mine] = np.inf
                b = mean.min(axis=1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    s = (b - a) / np.maximum(a, b)
                out[at:at + 64] = np.where(n_own == 1, 0.0, np.nan_to_num(s))
            yield pd.DataFrame({"value": out})

    parts = max(1, math.ceil(len(held) / 1000))
    per = points.repartition(parts).mapInPandas(per_point, "value double")
    return per.agg(F.count(F.lit(1)).alias("n_sample"), F.avg("value").alias("silhouette"))


def silhouette_squared(df: DataFrame, cols: list[str], segment: str = "segment_id") -> DataFrame:
    """Mean silhouette with squared distances over all rows, as one row (n_points, silhouette).

    A point's mean squared distance to a segment follows from the segment's count, sums and sum of squares, so two passes
    do, however many rows there are; what is sent to every task is one row a segment. A point alone in its segment counts as 0.
    Its values differ from :func:`silhouette`, which takes plain distances.
    """
    square = sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0))
    totals = df.groupBy(F.col(segment).alias("k")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(square).alias("q"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)])
    every = totals.agg(F.collect_list(F.struct("*")).alias("t"))
    rows = df.withColumns({"_t": scalar_of(every), "_x2": square, "_own": F.col(segment)})
    dot = " + ".join(f"{c} * t.s{i}" for i, c in enumerate(cols))
    sum_to = f"greatest(t.q + t.n * _x2 - 2 * ({dot}), 0D)"
    rows = rows.select(
        F.expr("filter(_t, t -> t.k <=> _own)[0].n").alias("n_own"),
        F.expr(f"array_max(transform(filter(_t, t -> t.k <=> _own), t -> {sum_to} / greatest(t.n - 1, 1D)))").alias("a"),
        F.expr(f"array_min(transform(filter(_t, t -> NOT (t.k <=> _own)), t -> {sum_to} / t.n))").alias("b"))
    value = F.expr("CASE WHEN n_own = 1 THEN 0D ELSE coalesce(try_divide(b - a, greatest(a, b)), 0D) END")
    return rows.agg(F.count(F.lit(1)).alias("n_points"), F.avg(value).alias("silhouette"))


def segmentation_summary(sil: DataFrame, sizes: DataFrame) -> DataFrame:
    """Input row of the segmentation gates from the silhouette and the sizes (both tiny)."""
    shares = sizes.agg(F.max("share").alias("max_share"), F.min("share").alias("min_share"))
    return shares.withColumn("silhouette", sil.select("silhouette").scalar())

