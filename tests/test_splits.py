import datetime as dt

import numpy as np
import pytest
from conftest import by, rows
from pyspark.sql import functions as F

from tillsight.operators import splits as sp

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(1)
    offs = rng.integers(0, 180, 1000)
    data = [(f"CUST-{i:05d}", START + dt.timedelta(days=int(o)), int(179 - o), int(rng.random() < 0.25)) for i, o in enumerate(offs)]
    return spark.createDataFrame(data, "customer_id string, last_transaction_date timestamp, recency_days int, label int").cache()


def test_temporal_split(people):
    s = sp.TemporalSplitter(119, 149, 179, START)
    out = s.split(people)
    sizes = s.check(out)
    assert sum(sizes.values()) == 1000 and min(sizes.values()) >= 100
    edge = by(out.groupBy("split").agg(F.min("last_transaction_date").alias("lo"), F.max("last_transaction_date").alias("hi")), "split")
    assert edge["train"]["hi"] == START + dt.timedelta(days=119) < edge["val"]["lo"]
    assert edge["val"]["hi"] < edge["test"]["lo"]
    # The start is inferred from the data when it is not given.
    same = sp.TemporalSplitter(119, 149, 179).split(people)
    assert same.join(out, ["customer_id", "split"]).count() == 1000


def test_temporal_errors(people):
    for bad in ((149, 119, 179), (119, 179, 149), (119, 119, 179)):
        with pytest.raises(ValueError, match="overlap"):
            sp.TemporalSplitter(*bad)
    s = sp.TemporalSplitter(119, 149, 179, START)
    with pytest.raises(ValueError, match="insufficient"):
        s.check(s.split(people.limit(1)))
    with pytest.raises(ValueError, match="insufficient"):
        s.check(s.split(people.where("recency_days > 100")))


def test_random_split_sizes_and_repeat(people):
    cuts = {"train": 0.6, "val": 0.8}
    a = by(sp.random_split(people, cuts, "test"))
    b = by(sp.random_split(people.repartition(9), cuts, "test"))
    assert a == b
    assert [sum(r["split"] == s for r in a.values()) for s in ("train", "val", "test")] == [600, 200, 200]
    other = by(sp.random_split(people, cuts, "test", seed=43))
    assert other != a


def test_stratified_split(people):
    got = sp.stratified_split(people, "label").groupBy("label").agg(F.avg((F.col("split") == "train").cast("int")).alias("r"))
    assert all(abs(r["r"] - 0.8) < 0.01 for r in rows(got))


def test_time_folds_equal_brute_force(spark):
    n, gap, k = 103, 7, 5
    data = [(f"c{i:03d}", START + dt.timedelta(hours=i)) for i in range(n)]
    df = spark.createDataFrame(data, "customer_id string, at timestamp").repartition(5)
    got = {(r["fold"], r["role"], r["customer_id"]) for r in rows(sp.time_folds(df, "at", k, gap))}
    want, size = set(), n // (k + 1)
    for fold, start in enumerate(range(n - k * size, n, size), 1):
        want |= {(fold, "train", f"c{i:03d}") for i in range(start - gap)}
        want |= {(fold, "test", f"c{i:03d}") for i in range(start, start + size)}
    assert got == want


@pytest.mark.parametrize("n", [10, 50, 120])
def test_resample(spark, n):
    df = spark.createDataFrame([(f"t{i}",) for i in range(50)], "transaction_id string")
    got = [r["transaction_id"] for r in rows(sp.resample(df, n))]
    assert len(got) == n
    assert len(set(got)) == min(n, 50)
    assert sorted(got) == sorted(r["transaction_id"] for r in rows(sp.resample(df.repartition(6), n)))


def test_labels(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", None), ("c", [])], "customer_id string, top_categories array<string>")
    assert {k: r["label"] for k, r in by(sp.label_category(df, "x")).items()} == {"a": 1, "b": 0, "c": 0}
    t = spark.createDataFrame([("a", "bakery"), ("b", "dairy")], "customer_id string, category string")
    assert {k: r["label"] for k, r in by(sp.label_forward(df.select("customer_id"), t, ["bakery"])).items()} == {"a": 1, "b": 0, "c": 0}


def test_label_rates(spark):
    df = spark.range(6000).select(F.concat(F.lit("c"), F.col("id")).alias("customer_id"), F.element_at(F.array(*[F.lit(x) for x in ("A", "B", "C", "?")]), (F.col("id") % 4 + 1).cast("int")).alias("persona"))
    got = {r["persona"]: r["r"] for r in rows(sp.label_by_rate(df).groupBy("persona").agg(F.avg("label").alias("r")))}
    for persona, rate in {"A": 0.70, "B": 0.35, "C": 0.08, "?": 0.08}.items():
        assert got[persona] == pytest.approx(rate, abs=0.05)


def test_percentile_labels(spark):
    rng = np.random.default_rng(5)
    data = [(f"c{i}", int(rng.integers(0, 180)), int(rng.integers(1, 50)), float(rng.lognormal(5, 1)), float(rng.uniform(5, 80)), float(rng.random())) for i in range(500)]
    df = spark.createDataFrame(data, "customer_id string, recency_days int, frequency int, monetary double, avg_basket_size double, online_ratio double")
    a = np.array([r[1:] for r in data])
    f, m, o = a[:, 1], a[:, 2], a[:, 4]
    gate = (f > np.quantile(f, .55)) & (m > np.quantile(m, .55)) & (o < .45)
    score = .6 * gate + .25 * f / (f.max() + 1e-8) + .15 * m / (m.max() + 1e-8)
    want = (score >= np.percentile(score, 72)).astype(int)
    got = by(sp.label_percentile(df))
    assert [got[f"c{i}"]["label"] for i in range(500)] == want.tolist()
    noisy = by(sp.label_percentile(df, noise=0.12))
    assert sum(r["label"] for r in noisy.values()) == pytest.approx(140, abs=2)
    r = 1 - np.clip(a[:, 0] / 180, 0, 1)
    score = .5 * r + .35 * np.clip(f / 50, 0, 1) + .15 * np.clip(m / 2000, 0, 1)
    got = by(sp.label_concept(df, "stable"))
    assert [got[f"c{i}"]["concept_score"] for i in range(500)] == pytest.approx(score.tolist())
