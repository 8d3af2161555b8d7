import math

import numpy as np
import pytest
from conftest import by, rows
from pyspark.sql import functions as F

from tillsight.operators import linear_models as lm, metrics as me, segments as sg, training as tr, trees as tt


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, 2))
    y = (x[:, 0] > rng.normal(0, 0.8, 400)).astype(int)
    return x, y, spark.createDataFrame(
        [(f"c{i}", *map(float, r), int(t), "a" if i % 2 else None) for i, (r, t) in enumerate(zip(x, y))], "customer_id string, u double, v double, label int, g string")


def test_weights_and_scores_by_hand(table):
    x, y, df = table
    odd = np.arange(400) % 2 == 1
    weights = lm.fit_weights(df, ["g"], ["u", "v"])
    got = {(r["g"], r["feature"]): r for r in rows(weights)}
    for g, mask in (("a", odd), (None, ~odd)):
        for j, f in enumerate("uv"):
            one, none = x[mask & (y == 1), j], x[mask & (y == 0), j]
            pooled = (len(one) * one.var() + len(none) * none.var()) / mask.sum()
            assert got[g, f]["weight"] == pytest.approx((one.mean() - none.mean()) / pooled)
            assert got[g, f]["middle"] == pytest.approx((one.mean() + none.mean()) / 2)
            assert got[g, f]["prior"] == pytest.approx(math.log((len(one) + 0.5) / (len(none) + 0.5)))
    scored = by(lm.apply_weights(df, weights, ["g"], {"both": ["u", "v"], "first": ["u"]}))
    for i in (0, 1, 250, 399):
        w = [got["a" if i % 2 else None, f] for f in "uv"]
        e = [w[j]["weight"] * (x[i, j] - w[j]["middle"]) for j in range(2)]
        assert scored[f"c{i}"]["s_both"] == pytest.approx(1 / (1 + math.exp(-(w[0]["prior"] + sum(e) / 2))))
        assert scored[f"c{i}"]["s_first"] == pytest.approx(1 / (1 + math.exp(-(w[0]["prior"] + e[0]))))


def test_one_class_and_constant_feature_have_no_weight(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1), (2.0, 5.0, 1)], "u double, k double, label int")
    assert {r["weight"] for r in rows(lm.fit_weights(df, [], ["u", "k"]))} == {0.0}
    two = df.unionByName(spark.createDataFrame([(0.0, 5.0, 0)], df.schema))
    got = {r["feature"]: r["weight"] for r in rows(lm.fit_weights(two, [], ["u", "k"]))}
    assert got["k"] == 0.0 and got["u"] > 0


def test_basis(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (None, 1.0)], "x double, k double")
    wide, kinds = lm.basis(df, ["x", "k"])
    got = sorted(rows(wide), key=lambda r: (r["x"] is None, r["x"]))
    assert kinds == {"z": ["z0", "z1"], "h": ["h0", "h1"], "p": ["p01"], "q": ["q0", "q1"]}
    assert [r["z0"] for r in got] == [-1.0, 1.0, 0.0] and {r["z1"] for r in got} == {0.0}
    assert [r["h0"] for r in got] == [0.0, 1.0, 0.0] and [r["q0"] for r in got] == [1.0, 1.0, 0.0]


def test_evaluate_equals_single_metrics(spark):
    rng = np.random.default_rng(8)
    data = [("e", m, "train" if rng.random() < 0.6 else "test", int(rng.integers(3)), f"c{i}", round(float(rng.random()), 1 if m == "tied" else 6), int(rng.random() < 0.3))
            for m in ("tied", "fine") for i in range(500)] + [("e", "none", "test", 0, "c1", 0.5, 0)]
    df = spark.createDataFrame(data, "experiment string, model string, split string, fold int, customer_id string, score double, label int")
    got = {r["model"]: r for r in rows(me.evaluate(df))}
    aucs = {(r["model"], r["split"]): r["auc"] for r in rows(me.auc(df, group=["model", "split"]))}
    lifts = by(me.lift_d1(df.where("split = 'test'"), group=["model"]), "model")
    folds = by(me.cv_std(df, group=["model"]), "model")
    for m in ("tied", "fine", "none"):
        assert got[m]["test_auc"] == pytest.approx(aucs[m, "test"])
        assert got[m]["lift_at_decile1"] == pytest.approx(lifts[m]["lift_at_decile1"])
        assert got[m]["cv_std"] == pytest.approx(folds[m]["cv_std"])
    assert got["fine"]["train_auc"] == pytest.approx(aucs["fine", "train"]) and got["none"]["train_auc"] is None


def test_forest_of_fewer_trees_is_a_prefix(spark, table):
    _, _, df = table
    counts = [1, 3, 5]
    curve = {r["n_trees"]: r["auc"] for r in rows(tr.forest_curve(df, {"train": df}, ["u", "v"], counts, max_depth=3))}
    nodes = tt.node_table(spark, tr.fit(tr.rf, df, ["u", "v"], n_trees=5, max_depth=3))
    first = nodes.where("tree = 0")
    scored = tt.walk(df, first, ["u", "v"]).select("label", tt.forest_probability("values").alias("score"))
    assert curve[1] == pytest.approx(rows(me.rank_metrics(scored))[0]["auc"])
    assert set(curve) == set(counts)


def test_patience_stops_and_keeps_the_best_round(table):
    _, _, df = table
    train, val = df.where("g IS NULL"), df.where("g = 'a'")
    model, best = tr.fit_patient(train, val, ["u", "v"], n_rounds=30, idle=3, first=8, max_depth=3, rate=0.3, columns=0.6)
    assert model.stages[-1].getNumTrees == best <= 30
    losses = model.stages[-1].evaluateEachIteration(model.stages[0].transform(val.withColumn("label", F.col("label").cast("double"))))
    assert min(losses) == losses[best - 1]


def test_segments_of_clear_groups(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.1, (60, 2)) for c in ((0, 0), (5, 0), (0, 5))])
    df = spark.createDataFrame([(f"c{i}", *map(float, p)) for i, p in enumerate(points)], "customer_id string, x double, y double").repartition(4)
    one, two = (sg.fit_segments(df, ["x", "y"], k=3, restarts=5) for _ in range(2))
    assert np.allclose(one.centroids, two.centroids) and one.cost == pytest.approx(two.cost)
    placed = rows(sg.assign(df, one))
    assert sorted(len({r["segment_id"] for r in placed if int(r["customer_id"][1:]) // 60 == g}) for g in range(3)) == [1, 1, 1]
    assert one.cost == pytest.approx(sum(r["distance"] ** 2 for r in placed))
    few = sg.fit_segments(df.limit(2), ["x", "y"], k=3, restarts=2)
    assert len(few.centroids) == 3 and few.cost == pytest.approx(0)
