import datetime as dt

import numpy as np
import pytest
from conftest import by, rows
from pyspark.sql import functions as F

from tillsight.config import API9
from tillsight.operators import scoring as sc, segments as sg
from tillsight.sources import writers


@pytest.fixture(scope="module")
def setup(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([
        rng.integers(0, 90, 300), rng.integers(1, 50, 300), rng.uniform(10, 2000, 300), rng.uniform(5, 80, 300), rng.uniform(0, 20, 300),
        rng.random(300), rng.integers(0, 30, 300), rng.integers(0, 30, 300), rng.integers(1, 30, 300),
    ]).astype(float)
    mean, scale = x.mean(0), x.std(0)
    centres = rng.normal(0, 1, (3, 9))
    model = sg.SegmentModel(tuple(API9), tuple(mean), tuple(scale), tuple(map(tuple, centres.tolist())))
    df = spark.createDataFrame([(f"CUST-{i:04d}", *r) for i, r in enumerate(x.tolist())], "customer_id string, " + ", ".join(f"{c} double" for c in API9))
    return x, (x - mean) / scale, centres, model, df


def distances(z, centres):
    return np.sqrt(((z[:, None, :] - centres[None]) ** 2).sum(2))


def test_assign_and_confidence(setup):
    x, z, centres, model, df = setup
    d = distances(z, centres)
    got = by(sc.confidence(df, model))
    for i in range(300):
        g = got[f"CUST-{i:04d}"]
        assert g["segment_id"] == d[i].argmin()
        assert g["propensity_score"] == pytest.approx(1 / (1 + d[i].min()), abs=6e-7)
    assert {r["propensity_score"] for r in rows(sc.confidence(df, None))} == {0.5}
    total = rows(sg.inertia(sg.assign(df, model)))[0]["inertia"]
    assert total == pytest.approx((d.min(1) ** 2).sum())


def test_explanation_equals_perturbation(setup):
    x, z, centres, model, df = setup
    got = by(sc.explain(df, model))
    base = 1 / (1 + distances(z, centres).min(1))
    impact = np.empty_like(z)
    for i in range(9):
        p = z.copy()
        p[:, i] = 0
        impact[:, i] = np.abs(base - 1 / (1 + distances(p, centres).min(1)))
    for r in range(300):
        tops = got[f"CUST-{r:04d}"]["top_features"]
        assert len(tops) == 9 and [t["impact"] for t in tops] == sorted((t["impact"] for t in tops), reverse=True)
        for t in tops:
            i = API9.index(t["feature"])
            assert t["impact"] == pytest.approx(impact[r, i], abs=6e-5)
            assert t["direction"] == ("positive" if x[r, i] > model.means[i] else "negative")
        for a, b in zip(tops, tops[1:]):
            if a["impact"] == b["impact"]:
                assert API9.index(a["feature"]) < API9.index(b["feature"])


def test_no_model_is_uniform(setup):
    df = setup[-1]
    tops = rows(sc.explain(df.limit(1), None, API9))[0]["top_features"]
    assert {(t["impact"], t["direction"]) for t in tops} == {(0.1111, "positive")} and [t["feature"] for t in tops] == API9


def test_text(spark):
    schema = "customer_id string, propensity_score double, frequency double, recency_days double, monetary double, online_ratio double, top_features array<struct<feature:string,impact:double,direction:string>>"
    f = lambda n, d: (n, 0.1, d)
    df = spark.createDataFrame([
        ("a", 0.421, 25.7, 10.0, 350.5, 0.6, [f("frequency", "positive"), f("recency_days", "negative")]),
        ("b", 0.5, 1.0, 99.0, 350.5, 0.6, [f("recency_days", "positive"), f("online_ratio", "negative")]),
        ("c", 0.5, 1.0, 99.0, 350.5, 0.6, [f("monetary", "negative")]), ("d", 0.5, 1.0, 99.0, 350.5, 0.6, []),
    ], schema)
    got = {k: r["explanation"] for k, r in by(sc.explanation_text(df, ["frequency", "recency_days", "monetary", "online_ratio"])).items()}
    start = "Score "
    assert got["a"] == start + "0.42: visits 25 (above average), days since last purchase 10 (below average)."
    assert got["b"] == start + "0.50: days since last purchase 99 (above average), online share 60% (below average)."
    assert got["c"] == start + "0.50: spend £350.50 (below average)."
    assert got["d"] == start + "0.50."


def test_audit_log(setup, tmp_path, spark):
    model, df = setup[3], setup[4]
    e = sc.explain(sc.confidence(df.limit(5), model), model).withColumn("scored_at", F.lit(dt.datetime(2024, 1, 1))).withColumn("model_version", F.lit("1"))
    path = str(tmp_path / "audit")
    assert writers.append_audit(sc.audit_rows(e), path) and writers.append_audit(sc.audit_rows(e), path)
    assert spark.read.parquet(path).count() == 10
    (tmp_path / "file").write_text("x")
    assert writers.append_audit(sc.audit_rows(e), str(tmp_path / "file" / "below")) is False


def test_report(setup):
    x, z, centres, model, df = setup
    scored = sc.confidence(df, model).cache()
    p = np.array([r["propensity_score"] for r in rows(scored)])
    rep = rows(sc.score_report(scored, "m", "Production", "t"))[0]
    dist = rep["score_distribution"]
    assert dist["mean"] == pytest.approx(p.mean(), abs=1e-6) and dist["std"] == pytest.approx(p.std(), abs=1e-6)
    for q in (10, 25, 50, 75, 90, 95, 99):
        assert dist[f"p{q}"] == pytest.approx(np.percentile(p, q), abs=1e-6)
    assert [t["propensity_score"] for t in rep["top_10_customers"]] == sorted(p)[::-1][:10]
    assert [t["propensity_score"] for t in rep["bottom_10_customers"]] == sorted(p)[:10]
    assert sum(s["n"] for s in rep["segment_distribution"]) == rep["n_customers"] == 300


def test_standardise(setup):
    x, z, _, _, df = setup
    got = by(sg.standardise(df.withColumn("flat", F.lit(4.0)), [*API9, "flat"]))
    assert [got["CUST-0007"][c] for c in API9] == pytest.approx(z[7].tolist())
    assert got["CUST-0007"]["flat"] == 0.0


def test_silhouette_equals_brute_force(setup):
    x, z, centres, model, df = setup
    assigned = sg.assign(df, model)
    seg = np.array([r["segment_id"] for r in sorted(rows(assigned), key=lambda r: r["customer_id"])])
    d = np.sqrt(((z[:, None, :] - z[None]) ** 2).sum(2))
    s = []
    for i in range(300):
        own = seg == seg[i]
        a = d[i, own].sum() / max(own.sum() - 1, 1)
        b = min(d[i, seg == k].mean() for k in set(seg) - {seg[i]})
        s.append(0.0 if own.sum() == 1 else (b - a) / max(a, b))
    got = rows(sg.silhouette(assigned, API9))[0]
    assert (got["n_sample"], got["silhouette"]) == (300, pytest.approx(np.mean(s)))
    assert rows(sg.silhouette(assigned, API9, sample=100))[0]["n_sample"] == 100
    z = rows(sg.standardise(assigned, API9))
    whole = rows(sg.silhouette_squared(sg.standardise(assigned, API9), API9))[0]
    x = np.array([[r[c] for c in API9] for r in z], dtype=float)
    seg = np.array([r["segment_id"] for r in z])
    d2 = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    each = []
    for i in range(len(x)):
        own = seg == seg[i]
        near = min(d2[i, seg == k].mean() for k in set(seg) - {seg[i]})
        within = d2[i, own].sum() / max(own.sum() - 1, 1)
        each.append(0.0 if own.sum() == 1 else (near - within) / max(near, within))
    assert (whole["n_points"], whole["silhouette"]) == (300, pytest.approx(np.mean(each)))


def test_kmeans_finds_blobs_and_repeats(spark):
    rng = np.random.default_rng(4)
    pts = np.concatenate([rng.normal(c, 0.2, (60, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    df = spark.createDataFrame([(f"c{i}", *p) for i, p in enumerate(pts.tolist())], "customer_id string, a double, b double")
    one, two = (sg.fit_segments(df, ["a", "b"], 3, restarts=3) for _ in range(2))
    assert np.allclose(one.centroids, two.centroids) and one.cost == pytest.approx(two.cost)
    seg = by(sg.assign(df, one))
    groups = [{seg[f"c{i}"]["segment_id"] for i in range(60 * g, 60 * g + 60)} for g in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
