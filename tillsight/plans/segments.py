"""Segmentation, scoring and explanation with fixed models, so that SQL can check them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import API9
from ..operators import features as fe, scoring as sc, segments as sg, selection as se
from ..session import materialise
from .registry import (
    INTERCEPT, SEGMENT_MODEL, WEIGHTS, cte, feats, hash_ordinal_sql, query, r, rounded, scored, sql,
)

SCALED = ["recency_days", "frequency", "online_ratio"]
cte("stats", "SELECT " + ", ".join(f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS {c}_s" for c in API9) + " FROM scored")
cte("standardised", "SELECT customer_id, segment_id, " + ", ".join(f"({c} - {c}_m) / {c}_s AS {c}" for c in API9) + " FROM scored, stats".replace("FROM scored, stats", "FROM scored CROSS JOIN stats"))


@query("m1_standardise", sql("SELECT customer_id, " + ", ".join(f"{r(c, 6)} AS {c}" for c in API9) + " FROM standardised"))
def _(spark, d):
    return rounded(sg.standardise(scored(spark, d), API9), **{c: 6 for c in API9}).select("customer_id", *API9)


@query("m3_assign", sql(f"SELECT customer_id, segment_id, {r('distance', 6)} AS distance FROM scored"))
def _(spark, d):
    return rounded(sg.assign(feats(spark, d), SEGMENT_MODEL), distance=6).select("customer_id", "segment_id", "distance")


@query("m5_inertia", sql(f"SELECT {r('sum(distance * distance)', 4)} AS inertia FROM scored"))
def _(spark, d):
    return rounded(sg.inertia(sg.assign(feats(spark, d), SEGMENT_MODEL)), inertia=4)


_D2 = " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in API9)
cte("sil_sample", f"SELECT * FROM ({hash_ordinal_sql('standardised', 'customer_id', 42)}) WHERE ordinal <= 10000")
cte("sil", f"""SELECT count(*) AS n_sample, avg(CASE WHEN own_n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS silhouette FROM (
  SELECT customer_id, any_value(own_n) AS own_n, max(total / greatest(n - 1, 1)) FILTER (WHERE seg = own) AS a, min(total / n) FILTER (WHERE seg <> own) AS b FROM (
    SELECT a.customer_id, a.segment_id AS own, b.segment_id AS seg, sum(sqrt({_D2})) AS total, count(*) AS n, max(CASE WHEN a.segment_id = b.segment_id THEN 1 ELSE 0 END) AS same
    FROM sil_sample a CROSS JOIN sil_sample b GROUP BY 1, 2, 3) x JOIN (SELECT segment_id AS own, count(*) AS own_n FROM sil_sample GROUP BY 1) s USING (own) GROUP BY customer_id)""")


@query("m4_silhouette", sql(f"SELECT n_sample, {r('silhouette', 6)} AS silhouette FROM sil"))
def _(spark, d):
    return rounded(sg.silhouette(scored(spark, d), API9), silhouette=6)


_X2 = " + ".join(f"{c} * {c}" for c in API9)
_DOT = " + ".join(f"p.{c} * t.s_{c}" for c in API9)
cte("sil_totals", f"SELECT segment_id AS k, count(*) AS n, sum({_X2}) AS q, {', '.join(f'sum({c}) AS s_{c}' for c in API9)} FROM standardised GROUP BY 1")
cte("sil_squared", f"""SELECT count(*) AS n_points, avg(CASE WHEN own_n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS silhouette FROM (
  SELECT customer_id, max(n) FILTER (WHERE k = segment_id) AS own_n, max(total / greatest(n - 1, 1)) FILTER (WHERE k = segment_id) AS a, min(total / n) FILTER (WHERE k <> segment_id) AS b
  FROM (SELECT p.customer_id, p.segment_id, t.k, t.n, greatest(t.q + t.n * ({_X2}) - 2 * ({_DOT}), 0) AS total FROM standardised p CROSS JOIN sil_totals t) GROUP BY customer_id)""")


def _silhouette(spark, d):
    return sg.silhouette_squared(sg.standardise(scored(spark, d), API9), API9)


@query("m4_silhouette_squared", sql(f"SELECT n_points, {r('silhouette', 6)} AS silhouette FROM sil_squared"))
def _(spark, d):
    return rounded(_silhouette(spark, d), silhouette=6)


cte("sizes", "SELECT max(n) / sum(n) AS max_share, min(n) / sum(n) AS min_share FROM (SELECT count(*) AS n FROM scored GROUP BY segment_id)")


@query("m6_segmentation_gates", sql("""SELECT CASE WHEN round(silhouette, 6) < 0.25 THEN 'silhouette_score' WHEN max_share > 0.6 THEN 'dominant_cluster' WHEN min_share <= 0.01 THEN 'tiny_cluster' END AS gate_name,
  CASE WHEN round(silhouette, 6) < 0.25 THEN round(silhouette, 4) WHEN max_share > 0.6 THEN round(max_share, 4) WHEN min_share <= 0.01 THEN round(min_share, 4) END AS actual_value,
  NOT (round(silhouette, 6) < 0.25 OR max_share > 0.6 OR min_share <= 0.01) AS passed FROM sil_squared CROSS JOIN sizes"""))
def _(spark, d):
    s = scored(spark, d)
    row = sg.segmentation_summary(_silhouette(spark, d), fe.segment_sizes(s))
    return se.segmentation_gates(row).select("failure.gate_name", "failure.actual_value", "passed")


# ---- Scoring and explanation ----

@query("e1_score_all", sql("SELECT customer_id, segment_id, propensity_score, 'propensity' AS model_name, '1.0.0' AS model_version, DATE '2001-08-02' AS run_date FROM scored"))
def _(spark, d):
    import datetime as dt
    model = lambda df: rounded(sc.linear_score(df, WEIGHTS, INTERCEPT, digits=None), propensity_score=6)
    out = sc.score_all(feats(spark, d), model, SEGMENT_MODEL, constants={"model_name": "propensity", "model_version": "1.0.0", "run_date": dt.date(2001, 8, 2)})
    return out.select("customer_id", "segment_id", "propensity_score", "model_name", "model_version", "run_date")


@query("e2_confidence", sql("SELECT customer_id, segment_id, round(least(greatest(1e0 / (1e0 + distance), 0), 1), 6) AS propensity_score FROM scored"))
def _(spark, d):
    return sc.confidence(feats(spark, d), SEGMENT_MODEL).select("customer_id", "segment_id", "propensity_score")


def explained(spark, d):
    f = sc.confidence(materialise(feats(spark, d), "features"), SEGMENT_MODEL)
    return sc.explain(f, SEGMENT_MODEL)


@query("e3_explain", sql("SELECT customer_id, CAST(place AS INTEGER) AS place, feature, impact, direction FROM impacts"))
def _(spark, d):
    e = explained(spark, d).select("customer_id", F.posexplode("top_features").alias("place", "t"))
    return e.select("customer_id", (F.col("place") + 1).alias("place"), "t.feature", "t.impact", "t.direction")


_REL = "CASE WHEN direction = 'positive' THEN ' (above average)' ELSE ' (below average)' END"
_WRITTEN = {"count": "CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR)", "money": "printf('£%.2f', value)", "percent": "printf('%.0f%%', value * 100)"}
_PH = f"CASE feature {' '.join(f"WHEN '{f}' THEN '{label} ' || {_WRITTEN[kind]}" for f, label, kind in sc.PHRASES)} END || {_REL}"


# Two-digit amounts may sit on an exact half, which printers round differently; the text query rounds them first.
_PH2 = _PH.replace("%.2f', value)", "%.2f', round(value + 1e-5, 2))").replace("value * 100)", "round(value * 100 + 1e-5, 0))")


@query("e4_explanation_text", sql(f"""SELECT i.customer_id, printf('Score %.2f', round(any_value(s.score) + 1e-5, 2)) || ': ' || max(ph) FILTER (WHERE place = 1) || ', ' || max(ph) FILTER (WHERE place = 2) || '.' AS explanation
  FROM (SELECT customer_id, place, {_PH2} AS ph FROM impacts WHERE place <= 2) i JOIN (SELECT customer_id, round(least(greatest(1e0 / (1e0 + distance), 0), 1), 6) AS score FROM scored) s USING (customer_id) GROUP BY i.customer_id"""))
def _(spark, d):
    e = explained(spark, d)
    tidy = rounded(e, monetary=2, avg_basket_size=2, basket_std=2, online_ratio=2, propensity_score=2)
    return sc.explanation_text(tidy, list(SEGMENT_MODEL.features)).select("customer_id", "explanation")


@query("e5_audit_rows", sql("""SELECT i.customer_id, TIMESTAMP '2001-08-02 00:00:00' AS scored_at, '1.0.0' AS model_version, round(least(greatest(1e0 / (1e0 + distance), 0), 1), 6) AS propensity_score,
  feature AS top_feature, impact AS top_feature_impact FROM impacts i JOIN scored s USING (customer_id) WHERE place = 1"""))
def _(spark, d):
    e = fe.stamp(explained(spark, d), model_version="1.0.0").withColumn("scored_at", F.lit("2001-08-02").cast("timestamp_ntz"))
    return sc.audit_rows(e)


@query("e6_score_report")
def _(spark, d):
    return sc.score_report(scored(spark, d), "propensity", "Production", "2001-08-02T00:00:00Z")


_PCT = [f"SELECT 'distribution' AS section, '{n}' AS name, round(quantile_cont(propensity_score, {q}), 6) AS value FROM scored" for n, q in fe.SCORE_PERCENTILES.items()]
_ENDS = [f"SELECT '{section}' AS section, customer_id AS name, propensity_score AS value FROM (SELECT * FROM scored ORDER BY propensity_score {way}, customer_id LIMIT 10)"
         for section, way in (("top", "DESC"), ("bottom", "ASC"))]


@query("e6_report_rows", sql(" UNION ALL ".join([
    *_PCT, *_ENDS, "SELECT 'distribution', 'mean', round(avg(propensity_score), 6) FROM scored", "SELECT 'distribution', 'std', round(stddev_pop(propensity_score), 6) FROM scored",
    "SELECT 'distribution', 'min', round(min(propensity_score), 6) FROM scored", "SELECT 'distribution', 'max', round(max(propensity_score), 6) FROM scored",
    "SELECT 'size', 'customers', CAST(count(*) AS DOUBLE) FROM scored",
    "SELECT 'segments', CAST(segment_id AS VARCHAR), round(100e0 * count(*) / (SELECT count(*) FROM scored), 6) FROM scored GROUP BY segment_id"])))
def _(spark, d):
    """The nested report, taken apart into rows (section, name, value)."""
    rep = sc.score_report(scored(spark, d), "propensity", "Production", "2001-08-02T00:00:00Z")
    row = lambda section, name, value: F.struct(F.lit(section).alias("section"), name.cast("string").alias("name"), value.cast("double").alias("value"))
    dist = F.array(*[row("distribution", F.lit(n), F.col(f"score_distribution.{n}")) for n in ("mean", "std", "min", *fe.SCORE_PERCENTILES, "max")])
    customer = lambda section: lambda x: row(section, x["customer_id"], x["propensity_score"])
    ends = [F.transform(f"{s}_10_customers", customer(s)) for s in ("top", "bottom")]
    seg = F.transform("segment_distribution", lambda x: row("segments", x["segment_id"], F.round(x["percent"], 6)))
    return rep.select(F.inline(F.concat(F.array(row("size", F.lit("customers"), F.col("n_customers"))), dist, seg, *ends)))
