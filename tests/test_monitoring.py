import datetime as dt

import numpy as np
import pytest
from conftest import by, rows
from pyspark.sql import functions as F

from tillsight.operators import drift as dr, outcome as oc

COLS = ["x", "y", "k"]


def psi_reference(e, a):
    edges = np.linspace(e.min(), e.max(), 11)
    edges[0] -= 1e-6
    edges[-1] += 1e-6
    pe, pa = (np.clip(h / h.sum(), 1e-4, None) for h in (np.histogram(v, edges)[0].astype(float) for v in (e, a)))
    return float(((pa - pe) * np.log(pa / pe)).sum())


def psi_joint(e, a):
    lo, hi = min(e.min(), a.min()), max(e.max(), a.max())
    if lo == hi:
        return 0.0
    edges = np.linspace(lo, hi, 11)
    pe, pa = (np.maximum(np.histogram(v, edges)[0] / len(v), 1e-6) for v in (e, a))
    return float(((pa - pe) * np.log(pa / pe)).sum())


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(11)
    e = np.column_stack([rng.integers(0, 21, 2000), rng.lognormal(3, 1, 2000), np.full(2000, 3.0)]).astype(float)
    a = np.column_stack([np.minimum(rng.integers(0, 31, 1500), 27), rng.lognormal(3.4, 1, 1500), np.full(1500, 3.0)]).astype(float)
    make = lambda m: spark.createDataFrame(m.tolist(), "x double, y double, k double")
    return e, a, make(e), make(a)


def test_psi_reference(sides):
    e, a, de, da = sides
    got = by(dr.psi_reference(de, da, COLS), "feature")
    for i, c in enumerate(COLS):
        assert got[c]["psi"] == pytest.approx(psi_reference(e[:, i], a[:, i]), abs=1e-9)


def test_psi_joint(sides):
    e, a, de, da = sides
    got = by(dr.psi_joint(de, da, COLS), "feature")
    for i, c in enumerate(COLS):
        assert got[c]["psi"] == pytest.approx(psi_joint(e[:, i], a[:, i]), abs=1e-9)
    assert got["k"]["psi"] == 0.0
    same = by(dr.psi_joint(de, de, COLS), "feature")
    assert max(r["psi"] for r in same.values()) == pytest.approx(0.0)


def test_edges_and_out_of_range(spark):
    e = np.array([0.0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10])
    a = np.array([0.0, 1, 1, 10, 11, -1, 5])
    de, da = (spark.createDataFrame([(float(v),) for v in s], "x double") for s in (e, a))
    assert rows(dr.psi_reference(de, da, ["x"]))[0]["psi"] == pytest.approx(psi_reference(e, a))
    assert rows(dr.psi_joint(de, da, ["x"]))[0]["psi"] == pytest.approx(psi_joint(e, a))


def test_missing_feature_is_skipped(sides):
    _, _, de, da = sides
    ref = dr.reference_table(de, ["x"])
    got = rows(dr.psi_reference_long(ref, dr.reference_table(da, ["x", "y"])))
    assert [r["feature"] for r in got] == ["x"]


def test_history_equals_single_comparisons(spark, sides):
    e, a, de, da = sides
    halves = [a[:700], a[700:]]
    snaps = spark.createDataFrame(
        [(dt.date(2024, 1, 1 + 7 * i), *r) for i, h in enumerate(halves) for r in h.tolist()], "snapshot_date date, x double, y double, k double"
    )
    hist = dr.psi_history(snaps, de, COLS)
    got = {(r["snapshot_date"], r["feature"]): r["psi"] for r in rows(hist)}
    for i, h in enumerate(halves):
        for j, c in enumerate(COLS):
            assert got[(dt.date(2024, 1, 1 + 7 * i), c)] == pytest.approx(psi_joint(e[:, j], h[:, j]), abs=1e-9)
    wide = by(dr.psi_matrix(hist, 2), "feature")
    assert wide["x"]["d2"] == pytest.approx(got[(dt.date(2024, 1, 8), "x")])
    assert {r["snapshot_date"] for r in rows(dr.last_n(hist, 1))} == {dt.date(2024, 1, 8)}


def test_classes_summary_decision(spark):
    psi = spark.createDataFrame([("a", 0.05), ("b", 0.1), ("c", 0.2), ("d", 0.31)], "feature string, psi double")
    got = by(dr.classify_psi(psi), "feature")
    assert [got[f]["status"] for f in "abcd"] == ["GREEN", "YELLOW", "RED", "RED"]
    assert [got[f]["action"] for f in "abcd"] == ["STABLE", "MONITOR", "RETRAIN", "RETRAIN"]
    s = rows(dr.drift_decision(dr.drift_summary(psi)))[0]
    assert (s["yellow"], s["red"], s["above_threshold"]) == (["b"], ["c", "d"], ["d"])
    assert (s["decision"], s["route"], s["drift_detected"]) == ("DRIFT_DETECTED", "retrain", True)
    calm = rows(dr.drift_decision(dr.drift_summary(psi.where("psi < 0.2"))))[0]
    assert (calm["decision"], calm["route"]) == ("OK", "stable")


def test_compare_phases(spark):
    m = spark.createDataFrame([("baseline", .9444, 3.75), ("stale", .2821, 0.0), ("retrained", .6318, 1.4062)], "phase string, test_auc double, lift_d1 double")
    assert rows(dr.compare_phases(m))[0] == {
        "auc_degradation": .6623, "auc_recovery": .3497, "lift_degradation": 3.75, "lift_recovery": 1.4062, "full_recovery": False,
    }


def test_lift_table(spark):
    data = [(f"c{i:03d}", 1 - i / 200, int(i < 20 or i % 10 == 0)) for i in range(100)]
    df = spark.createDataFrame(data, "customer_id string, propensity_score double, purchased int")
    got = by(oc.lift_table(df), "decile")
    base = sum(r[2] for r in data) / 100
    for k in range(1, 11):
        part = data[10 * (k - 1):10 * k]
        rate = sum(r[2] for r in part) / 10
        assert got[k]["n_customers"] == 10 and got[k]["actual_positive_rate"] == rate
        assert got[k]["realised_lift"] == pytest.approx(round(rate / base, 4))
    status = by(oc.lift_status(oc.lift_table(df)), "decile")
    assert (status[1]["status"], status[3]["status"]) == ("GOOD", "POOR")
    none = oc.lift_table(df.withColumn("purchased", F.lit(0)))
    assert {r["realised_lift"] for r in rows(none)} == {0.0}


@pytest.mark.parametrize("lift, age, decision, reason", [
    (1.49, 1, "RETRAIN_REQUIRED", "lift"), (1.5, 31, "RETRAIN_REQUIRED", "age"), (1.5, 30, "OK", "none"), (None, 1, "RETRAIN_REQUIRED", "lift"),
])
def test_retrain_decision(spark, lift, age, decision, reason):
    t = spark.createDataFrame([(1 if lift is not None else 2, lift or 1.0)], "decile int, realised_lift double")
    got = rows(oc.retrain_decision(t, age))[0]
    assert (got["decision"], got["reason"], got["lift_d1"]) == (decision, reason, lift or 0.0)


def test_history_of_many_snapshots_in_blocks(spark, sides):
    e, a, de, _ = sides
    days = [None, *(dt.date(2024, 1, d) for d in range(1, 8))]
    data = [(days[i % 8], *map(float, r)) for i, r in enumerate(a.tolist())]
    long = dr.to_long(spark.createDataFrame(data, "snapshot_date date, x double, y double, k double"), COLS, ["snapshot_date"])
    for block in (10_000, 3):
        got = {(r["snapshot_date"], r["feature"]): r["psi"] for r in rows(dr.psi_joint_long(dr.to_long(de, COLS), long, ["snapshot_date"], snapshots=block))}
        assert len(got) == 8 * len(COLS)
        for i, day in enumerate(days):
            for j, c in enumerate(COLS):
                assert got[day, c] == pytest.approx(psi_joint(e[:, j], a[i::8, j]), abs=1e-9)
