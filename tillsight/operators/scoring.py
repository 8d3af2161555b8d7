"""Bulk scoring and explanation of every customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .features import KEY, score_distribution, segment_distribution, top_n
from ..functions.exprs import fixed, num
from .segments import SegmentModel, assign, scaled_expr


def linear_score(df: DataFrame, weights: dict[str, float], intercept: float = 0.0, digits: int | None = 6,
                 out: str = "propensity_score") -> DataFrame:
    """Logistic score from a weight table."""
    z = F.lit(float(intercept))
    for name, w in weights.items():
        z = z + F.lit(float(w)) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return df.withColumn(out, F.round(p, digits) if digits is not None else p)


def score_all(features: DataFrame, model, segments: SegmentModel | None = None, calibrator=None,
              constants: dict | None = None) -> DataFrame:
    """Features to segment, calibrated propensity and audit columns, for all customers, without leaving Spark.

    ``model`` is a fitted Spark ML model (any with a probability column) or a function of a DataFrame
    that adds ``propensity_score``.
    """
    from .training import apply_calibration, apply_model

    df = assign(features, segments).drop("distance") if segments is not None else features
    scored = model(df) if callable(model) and not hasattr(model, "transform") else apply_model(df, model)
    if calibrator is not None:
        scored = apply_calibration(scored, calibrator)
    return scored.withColumns({k: F.lit(v) for k, v in (constants or {}).items()})


def confidence(df: DataFrame, model: SegmentModel | None) -> DataFrame:
    """Score 1 / (1 + distance to the nearest centroid), to 6 digits; 0.5 without a model."""
    if model is None:
        return df.withColumn("propensity_score", F.lit(0.5))
    near = assign(df, model)
    p = F.least(F.greatest(F.lit(1.0) / (F.lit(1.0) + F.col("distance")), F.lit(0.0)), F.lit(1.0))
    return near.withColumn("propensity_score", F.round(p, 6))


def explain(df: DataFrame, model: SegmentModel | None, features: list[str] | None = None) -> DataFrame:
    """Add ``top_features``: per feature the score change when it is set to the population mean.

    Each centroid's squared distance is computed once; setting a feature to its mean exchanges one
    term of it. It is a projection: customers are not multiplied by features.
    """
    names = list(model.features) if model is not None else list(features or [])
    if model is None:
        same = F.round(F.lit(1.0 / max(len(names), 1)), 4)
        items = [F.struct(F.lit(n).alias("feature"), same.alias("impact"), F.lit("positive").alias("direction")) for n in names]
        return df.withColumn("top_features", F.array(*items))
    scaled = F.expr("array(" + ", ".join(scaled_expr(model, i) for i in range(len(names))) + ")")
    centres = [f"array({', '.join(num(x) for x in c)})" for c in model.centroids]
    least = lambda parts: f"least({', '.join(parts)})" if len(parts) > 1 else parts[0]
    # Loops over arrays keep the expression small; written out it would outgrow what the JVM compiles.
    z = df.withColumn("_z", scaled).withColumns({
        f"_t{k}": F.expr(f"aggregate(zip_with(_z, {c}, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x)")
        for k, c in enumerate(centres)
    })
    base = f"1D / (1D + sqrt({least([f'_t{k}' for k in range(len(centres))])}))"
    dist = least([f"_t{k} - pow(v - get({c}, i), 2) + pow(get({c}, i), 2)" for k, c in enumerate(centres)])
    z = z.withColumn("_base", F.expr(base)).withColumn(
        "_impact", F.expr(f"transform(_z, (v, i) -> round(abs(_base - 1D / (1D + sqrt(greatest({dist}, 0D)))), 4))")
    )
    listed = "array(" + ", ".join(f"'{name}'" for name in names) + ")"
    # The field order is the sort order: larger impact first, then the order of the feature list.
    items = (
        f"transform(_impact, (m, i) -> named_struct('m', -m, 'p', i, 'feature', get({listed}, i), 'impact', m, "
        "'direction', CASE WHEN get(_z, i) > 0D THEN 'positive' ELSE 'negative' END))"
    )
    ordered = F.expr(
        f"transform(sort_array({items}), s -> named_struct('feature', s.feature, 'impact', s.impact, 'direction', s.direction))"
    )
    return z.select(*df.columns, ordered.alias("top_features"))


# What a feature is called in a sentence, and how its value is written.
PHRASES = [
    ("recency_days", "days since last purchase", "count"),
    ("frequency", "visits", "count"),
    ("monetary", "spend", "money"),
    ("avg_basket_size", "mean basket", "money"),
    ("basket_std", "basket spread", "money"),
    ("online_ratio", "online share", "percent"),
    ("online_txns", "online orders", "count"),
    ("instore_txns", "store orders", "count"),
    ("active_days", "days with a purchase", "count"),
]
_WRITTEN = {
    "count": lambda v: v.cast("bigint").cast("string"),
    "money": lambda v: F.concat(F.lit("£"), fixed(v, 2)),
    "percent": lambda v: F.concat(fixed(v * 100, 0), F.lit("%")),
}


def _phrase(feature: Column, value: Column, direction: Column) -> Column:
    """One feature in words: its name, its value, and on which side of the average it lies; unknown ones by their own name."""
    known = [F.when(feature == f, F.concat(F.lit(label + " "), _WRITTEN[kind](value))) for f, label, kind in PHRASES]
    other = F.concat(F.translate(feature, "_", " "), F.lit(" "), fixed(value, 2))
    return F.concat(F.coalesce(*known, other), F.when(direction == "positive", F.lit(" (above average)")).otherwise(F.lit(" (below average)")))


def explanation_text(df: DataFrame, features: list[str]) -> DataFrame:
    """Add ``explanation``: the score and its two strongest features in words."""
    values = F.create_map(*[x for f in features for x in (F.lit(f), F.coalesce(F.col(f).cast("double"), F.lit(0.0)))])
    with_values = df.withColumn("_v", values)

    def part(i: int) -> Column:
        item = F.get("top_features", i)
        return _phrase(item["feature"], F.try_element_at("_v", item["feature"]), item["direction"])

    start = F.format_string("Score %s", fixed("propensity_score", 2))
    count = F.size("top_features")
    out = (
        F.when(count >= 2, F.concat(start, F.lit(": "), part(0), F.lit(", "), part(1), F.lit(".")))
        .when(count == 1, F.concat(start, F.lit(": "), part(0), F.lit(".")))
        .otherwise(F.concat(start, F.lit(".")))
    )
    return with_values.withColumn("explanation", out).drop("_v")


def audit_rows(explained: DataFrame) -> DataFrame:
    """Rows of the explanation log: needs scored_at and model_version beside the explanation."""
    first = F.get("top_features", 0)
    return explained.select(
        KEY, "scored_at", "model_version", "propensity_score",
        F.coalesce(first["feature"], F.lit("")).alias("top_feature"),
        F.coalesce(first["impact"], F.lit(0.0)).alias("top_feature_impact"),
    )


def score_report(df: DataFrame, model_name: str, model_stage: str, scored_at: str) -> DataFrame:
    """One nested row: size, distribution, segments, top and bottom ten. The full scores stay a table."""
    dist = score_distribution(df)
    dist_row = dist.select(F.struct(*dist.columns).alias("x")).scalar()
    seg_row = segment_distribution(df).agg(
        F.sort_array(F.collect_list(F.struct("segment_id", "n", "percent"))).alias("x")
    ).scalar()

    def ten(ascending: bool) -> Column:
        rows = top_n(df, 10, "propensity_score", ascending).select(KEY, "propensity_score", "segment_id")
        sign = F.col("propensity_score") if ascending else -F.col("propensity_score")
        ordered = F.sort_array(F.collect_list(F.struct(sign.alias("o"), KEY, "propensity_score", "segment_id")))
        clean = F.transform(ordered, lambda s: F.struct(s[KEY].alias(KEY), s["propensity_score"].alias("propensity_score"), s["segment_id"].alias("segment_id")))
        return rows.agg(clean.alias("x")).scalar()

    return df.agg(F.count(F.lit(1)).alias("n_customers")).withColumns({
        "scored_at": F.lit(scored_at), "model_name": F.lit(model_name), "model_stage": F.lit(model_stage),
        "score_distribution": dist_row, "segment_distribution": seg_row,
        "top_10_customers": ten(False), "bottom_10_customers": ten(True),
    })
