import numpy as np
import pytest
from conftest import by, rows
from pyspark.sql import functions as F

from tillsight.operators import metrics as me, scoring as sc, training as tr

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, (900, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.7, 900) > 0.4).astype(int)
    data = [(f"c{i}", *r, int(t), i) for i, (r, t) in enumerate(zip(x.tolist(), y))]
    df = spark.createDataFrame(data, "customer_id string, a double, b double, c double, label int, n int").withColumn(
        "at", F.timestamp_seconds(F.col("n") * 3600)).coalesce(2).cache()
    return df.where("n < 500"), df.where("n >= 500 AND n < 700"), df.where("n >= 700")


def auc(df):
    return rows(me.rank_metrics(df, p="propensity_score"))[0]["auc"]


@pytest.mark.parametrize("builder, params", [(tr.lr, {"balanced": True}), (tr.dt, {}), (tr.rf, {"n_trees": 10})])
def test_models_rank_well_and_repeat(parts, builder, params):
    train, _, test = parts
    one, two = (tr.apply_model(test, tr.fit(builder, train, COLS, **params)) for _ in range(2))
    assert auc(one) > 0.75
    assert {k: r["propensity_score"] for k, r in by(one).items()} == pytest.approx({k: r["propensity_score"] for k, r in by(two).items()})
    assert tr.model_auc(tr.fit(builder, train, COLS, **params), test) == pytest.approx(auc(one))


def test_boosting_stops_early(parts):
    train, val, test = parts
    model = tr.fit_gbt(train, val, COLS, n_rounds=25, max_depth=3, rate=0.3, tolerance=0.01)
    assert model.stages[-1].getNumTrees < 25
    assert auc(tr.apply_model(test, model)) > 0.7
    loss = sorted(rows(tr.loss_curve(train, val, COLS, n_rounds=5, max_depth=2)), key=lambda r: r["round"])
    assert len(loss) == 5 and loss[0]["train_loss"] > loss[-1]["train_loss"] > 0


def test_class_weights(parts):
    w = tr.class_weights(parts[0]).groupBy("label").agg(F.sum("_w").alias("w"))
    assert {r["label"]: r["w"] for r in rows(w)} == pytest.approx({0: 250.0, 1: 250.0})


def test_search_uses_forward_folds(parts):
    model, table = tr.random_search(tr.dt, parts[0], COLS, "at", {"max_depth": [1, 4]}, n=2, n_folds=2)
    got = rows(table)
    assert len(got) == 2 and all(0.5 < r["mean_auc"] <= 1 and r["cv_std"] >= 0 for r in got)
    assert tr.model_auc(model, parts[2]) > 0.6


def test_stack_and_vote(parts):
    train, _, test = parts
    score = tr.stack(train, COLS, {"lr": (tr.lr, {}), "dt": (tr.dt, {"max_depth": 3})})
    assert auc(score(test)) > 0.75
    lr, dt = (tr.apply_model(test, tr.fit(b, train, COLS)).select("customer_id", "label", F.col("propensity_score").alias("score")) for b in (tr.lr, tr.dt))
    both = me.vote(lr.unionByName(dt))
    assert both.count() == 200


def test_calibration(parts):
    train, val, test = parts
    model = tr.fit_lr(train, COLS)
    iso = tr.calibrate(tr.apply_model(val, model))
    raw = by(tr.apply_model(test, model))
    cal = by(tr.apply_calibration(tr.apply_model(test, model), iso))
    order = sorted(raw, key=lambda c: raw[c]["propensity_score"])
    values = [cal[c]["propensity_score"] for c in order]
    assert all(0 <= v <= 1 for v in values) and all(b >= a - 1e-12 for a, b in zip(values, values[1:]))


def test_curves(parts):
    train, val, _ = parts
    lc = tr.curve_summary(tr.learning_curve(tr.lr, train, COLS, [0.5, 1.0], 2))
    got = {r["train_size"]: r for r in rows(lc)}
    assert set(got) == {125, 250} and all(r["val_mean"] > 0.6 for r in got.values())
    sw = rows(tr.sweep(tr.dt, train, val, COLS, "max_depth", [1, 8]))
    assert sw[1]["train_auc"] > sw[0]["train_auc"]


def test_saved_model_scores_the_same(parts, tmp_path):
    train, _, test = parts
    model = tr.fit_lr(train, COLS)
    tr.save_model(model, str(tmp_path / "m"))
    a, b = (by(sc.score_all(test, m, constants={"model_version": "1"})) for m in (model, tr.load_model(str(tmp_path / "m"))))
    assert a == b and a["c700"]["model_version"] == "1"


@pytest.mark.parametrize("what", ["search", "stack", "curve"])
def test_independent_fits_run_side_by_side(spark, monkeypatch, what):
    import threading
    import time

    from pyspark.sql import functions as F

    lock, active, peak, fit_one = threading.Lock(), [0], [0], tr.fit

    def slow(*args, **params):
        with lock:
            active[0] += 1
            peak[0] = max(peak[0], active[0])
        time.sleep(0.3)
        try:
            return fit_one(*args, **params)
        finally:
            with lock:
                active[0] -= 1

    df = spark.range(120).select(
        F.col("id").cast("string").alias("customer_id"), (F.col("id") % 2).cast("int").alias("label"), (F.col("id") * 7 % 31 + F.col("id") % 2 * 9).cast("double").alias("a"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("id").cast("int"))).alias("at"))

    def run():
        if what == "search":
            return [r.asDict() for r in tr.random_search(tr.dt, df, ["a"], "at", tr.SPACES["dt"], n=2, n_folds=2)[1].orderBy("trial").collect()]
        if what == "stack":
            score = tr.stack(df, ["a"], {"dt": (tr.dt, {"max_depth": 2}), "small": (tr.dt, {"max_depth": 1})})
            return [r.asDict() for r in score(df).select("customer_id", "propensity_score").orderBy("customer_id").collect()]
        return [r.asDict() for r in tr.learning_curve(tr.dt, df, ["a"], [0.5, 1.0], 2).orderBy("train_size", "fold").collect()]

    monkeypatch.setattr(tr, "fit", slow)
    got = run()
    assert peak[0] > 1
    monkeypatch.setattr(tr, "PARALLEL", 1)
    assert run() == got


def test_prefix_scores_add_each_value_once(spark):
    import re

    from tillsight.operators import trees as tt

    walked = spark.createDataFrame([(1, [0.1, 0.7, 0.3, 0.2, 0.9, 0.4]), (2, [1.0, 0.0, 0.25, 0.5, 0.125, 0.3])], "id int, values array<double>")
    for boosted, one in ((False, tt.forest_probability), (True, tt.boosted_probability)):
        out = tt.prefix_scores(walked, [2, 5, 6, 9], ["id"], boosted=boosted)
        want = {(r.id, k): r.p for k in (2, 5, 6, 9) for r in walked.select("id", one("values", k).alias("p")).collect()}
        assert {(r.id, r.n_trees): r.score for r in out.collect()} == want
        taken = re.findall(r"slice\(values#\d+, (\d+), (\d+)\)", out._jdf.queryExecution().optimizedPlan().toString())
        assert {(int(a), int(b)) for a, b in taken} == {(1, 2), (3, 3), (6, 1), (7, 3)} and len(taken) == 4
