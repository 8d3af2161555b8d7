import hashlib
import random

import numpy as np
import pytest
from conftest import by, rows
from pyspark.sql import functions as F

from tillsight.operators import metrics as me, ordinal as od


def md5(text):
    return hashlib.md5(str(text).encode()).hexdigest()


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    # A third of all rows share one score, some have none.
    out = []
    for i in range(3000):
        p = 0.5 if i % 3 == 0 else None if i % 97 == 0 else round(rng.random(), 3)
        out.append((f"c{i}", p, int(rng.random() < (p or 0)), "ab"[i % 5 == 0]))
    return out


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "customer_id string, score double, label int, g string").repartition(7)


def expected_order(data, reverse=True):
    low = float("-inf")
    sign = -1 if reverse else 1
    return sorted(data, key=lambda r: (sign * r[1] if r[1] is not None else float("inf"), md5(r[0]), r[0]))


@pytest.mark.parametrize("descending", [True, False])
def test_global_ordinal(frame, data, descending):
    got = {r["customer_id"]: r["ordinal"] for r in rows(od.global_ordinal(frame, "score", "customer_id", descending=descending))}
    want = {r[0]: i + 1 for i, r in enumerate(expected_order(data, descending))}
    assert got == want


def test_hot_score_is_spread_over_buckets(frame):
    """The rows of a tied score must not meet in one window partition."""
    coded, _ = od._code_by_value(frame, "score", [], "customer_id", True, 64)
    sizes = [r["count"] for r in rows(coded.groupBy("_code").count())]
    assert sum(sizes) == 3000 and max(sizes) < 150


def test_group_ordinal(frame, data):
    got = {r["customer_id"]: (r["ordinal"], r["n_rows"]) for r in rows(od.global_ordinal(frame, "score", "customer_id", ["g"]))}
    for g in "ab":
        part = expected_order([r for r in data if r[3] == g])
        for i, r in enumerate(part):
            assert got[r[0]] == (i + 1, len(part))


def test_hash_ordinal(frame, data):
    got = {r["customer_id"]: r["ordinal"] for r in rows(od.hash_ordinal(frame, "customer_id", 42))}
    want = sorted((md5(f"{r[0]}|42"), r[0]) for r in data)
    assert got == {c: i + 1 for i, (_, c) in enumerate(want)}


def test_exact_quantiles(frame, data):
    probs = {"p0": 0.0, "p10": 0.1, "p55": 0.55, "p72": 0.72, "p100": 1.0}
    got = by(od.exact_quantiles(frame, "score", probs, ["g"]), "g")
    for g in "ab":
        values = [r[1] for r in data if r[3] == g and r[1] is not None]
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(float(np.percentile(values, 100 * p)))


def test_auc_and_average_precision(frame, data):
    scored = frame.where(F.col("score").isNotNull())
    pairs = [(r[1], r[2]) for r in data if r[1] is not None]
    pos, neg = np.array([p for p, y in pairs if y]), np.array([p for p, y in pairs if not y])
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    tp = seen = 0
    ap = 0.0
    for s in sorted({p for p, _ in pairs}, reverse=True):
        here = [y for p, y in pairs if p == s]
        tp, seen = tp + sum(here), seen + len(here)
        ap += sum(here) / len(pos) * tp / seen
    got = rows(me.rank_metrics(scored))[0]
    assert got["auc"] == pytest.approx(wins / (len(pos) * len(neg)))
    assert got["average_precision"] == pytest.approx(ap)
    assert rows(me.rank_metrics(scored.where("label = 1")))[0]["auc"] == 0.5


def test_deciles(frame, data):
    got = {r["customer_id"]: r["decile"] for r in rows(me.deciles(frame.where("g = 'b'"), "score"))}
    part = expected_order([r for r in data if r[3] == "b"])
    n = len(part)
    sizes = [n // 10 + (i < n % 10) for i in range(10)]
    want, at = {}, 0
    for d, size in enumerate(sizes, 1):
        for r in part[at:at + size]:
            want[r[0]] = d
        at += size
    assert got == want


@pytest.mark.parametrize("n", [3, 10, 17, 25])
def test_small_deciles_and_slices(spark, n):
    df = spark.createDataFrame([(f"c{i}", 1.0 - i / 100, i % 2) for i in range(n)], "customer_id string, propensity_score double, label int")
    tile = [r["decile"] for r in sorted(rows(me.deciles(df)), key=lambda r: -r["propensity_score"])]
    sizes = [n // 10 + (i < n % 10) for i in range(10)]
    assert tile == [d for d, s in enumerate(sizes, 1) for _ in range(s)]
    cut = [r["decile"] for r in sorted(rows(me.slice_deciles(df)), key=lambda r: -r["propensity_score"])]
    want = [next(i + 1 for i in range(10) if i * n // 10 <= k < (i + 1) * n // 10) for k in range(n)]
    assert cut == want
    top = me.top_fraction(df, "propensity_score")
    assert top.count() == max(1, n // 10)
    assert me.bottom_half(df, "propensity_score").count() == n - n // 2


def test_lift_of_a_base_of_zero(spark):
    df = spark.createDataFrame([("a", 0.2, 0), ("b", 0.1, 0)], "customer_id string, score double, label int")
    assert rows(me.lift_d1(df))[0]["lift_at_decile1"] == 0.0
    assert rows(me.lift_d1(df, base_zero=1.0))[0]["lift_at_decile1"] == 1.0


def test_calibration_edges_belong_to_the_lower_bin(spark):
    df = spark.createDataFrame([(0.0, 0), (0.2, 1), (0.200001, 1), (1.0, 1)], "score double, label int")
    got = by(me.calibration_bins(df, bins=5), "bin")
    assert {b: r["n"] for b, r in got.items()} == {0: 2, 1: 1, 4: 1}
    assert got[0]["fraction_positive"] == 0.5


def points(spark, values):
    return spark.createDataFrame([("c", 10 * (i + 1), float(v)) for i, v in enumerate(values)], "curve string, step int, value double")


@pytest.mark.parametrize("values, at", [
    ([0.5, 0.7, 0.8, 0.805, 0.9], 40 - 0), ([0.1, 0.4, 0.9], 30), ([0.1, 0.9], 10), ([0.3], 10), ([0.5, 0.5, 0.5], 20),
])
def test_plateau(spark, values, at):
    got = rows(me.plateau(points(spark, values), ["curve"], "step", "value"))[0]
    total = max(abs(values[-1] - values[0]), 1e-6)
    if len(values) > 2:
        small = [i for i, g in enumerate(np.diff(values)) if g < total * 0.05]
        index = small[0] + 1 if small else len(values) - 1
    else:
        index = 0
    assert got["step"] == at == 10 * (index + 1)


def test_best_points(spark):
    p = points(spark, [0.5, 0.9, 0.7, 0.9])
    assert rows(me.arg_best(p, ["curve"], "step", "value"))[0]["step"] == 20
    assert rows(me.arg_best(p, ["curve"], "step", "value", "min"))[0]["step"] == 10
    run = sorted(rows(me.best_so_far(p, ["curve"], "step", "value")), key=lambda r: r["step"])
    assert [r["best_so_far"] for r in run] == [0.5, 0.9, 0.9, 0.9]


def test_curve_diagnosis_and_bias(spark):
    s = spark.createDataFrame([
        ("low", 10, 0.6, 0.6), ("wide", 10, 0.95, 0.8), ("good", 10, 0.8, 0.79), ("mid", 10, 0.85, 0.8), ("good", 5, 0.99, 0.5),
    ], "model string, train_size int, train_mean double, val_mean double")
    got = {r["model"]: r["diagnosis"] for r in rows(me.curve_diagnosis(s))}
    assert got == {"low": "underfit", "wide": "overfit", "good": "converged", "mid": "moderate"}
    m = spark.createDataFrame([("a", 0.9, 0.8), ("b", 0.7, 0.69), ("c", 0.81, 0.8), ("d", 0.85, 0.8)], "model string, train_auc double, test_auc double")
    got = {r["model"]: r["diagnosis"] for r in rows(me.diagnose(m))}
    assert got == {"a": "high variance", "b": "high bias", "c": "well balanced", "d": "moderate variance"}
