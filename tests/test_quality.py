import datetime as dt
import json

import pytest
from conftest import rows

from tillsight.operators import quality as q

SCHEMA = "transaction_id string, total_amount double, customer_id string, timestamp timestamp, channel string, quantity int"
NOW = dt.datetime(2025, 1, 1)
GOOD = dict(transaction_id="TXN-001", total_amount=9.99, customer_id="CUST-12345", timestamp=dt.datetime(2024, 6, 15, 12), channel="online", quantity=2)


def frame(spark, *changes):
    data = [{**GOOD, **c} for c in changes]
    return spark.createDataFrame([tuple(r[k] for k in GOOD) for r in data], SCHEMA)


def failures(spark, *changes):
    res = q.validate(frame(spark, *changes), q.transaction_suite(), NOW)
    return {(r["expectation"], r["column"]): r["failed_rows"] for r in rows(res) if not r["passed"]}


def test_valid_rows_score_one(spark):
    res = q.validate(frame(spark, {}, {"transaction_id": "TXN-002"}), q.transaction_suite(), NOW)
    assert q.gate(res) == 1.0
    assert rows(q.suite_score(res)) == [{"score": 1.0, "passed": True}]


@pytest.mark.parametrize("change, rule", [
    ({"transaction_id": None}, ("not_null", "transaction_id")),
    ({"total_amount": -5.0}, ("between", "total_amount")),
    ({"total_amount": None}, ("between", "total_amount")),
    ({"customer_id": None}, ("regex", "customer_id")),
    ({"customer_id": "xCUST-1"}, ("regex", "customer_id")),
    ({"channel": None}, ("in_set", "channel")),
    ({"channel": "phone"}, ("in_set", "channel")),
    ({"quantity": 0}, ("between", "quantity")),
    ({"timestamp": dt.datetime(2099, 1, 1)}, ("not_future", "timestamp")),
])
def test_one_bad_row(spark, change, rule):
    assert failures(spark, {}, change) == {rule: 1}


def test_null_time_passes_and_gate_stops(spark):
    assert failures(spark, {"timestamp": None}) == {}
    res = q.validate(frame(spark, {"total_amount": -5.0}), q.transaction_suite(), NOW)
    with pytest.raises(q.ValidationFailed, match="total_amount") as err:
        q.gate(res)
    assert err.value.failures[0]["failed_rows"] == 1


def test_suite_file_and_unknown_rule(spark, tmp_path):
    doc = {"expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "transaction_id"}},
        {"expectation_type": "expect_something_new", "kwargs": {"column": "channel"}},
    ]}
    path = tmp_path / "suite.json"
    path.write_text(json.dumps(doc, indent=1))
    suite = q.load_suite(spark, str(path))
    res = rows(q.validate(frame(spark, {"transaction_id": None}), suite))
    assert [(r["passed"], r["failed_rows"]) for r in res] == [(False, 1), (True, 0)]
    assert rows(q.suite_score(q.validate(frame(spark, {}), []))) == [{"score": 1.0, "passed": True}]


COLS = "customer_id string, recency_days double, frequency double, monetary double, avg_basket_size double, basket_std double, online_ratio double, active_days double"


def features(spark, n=20, **change):
    names = [c.split()[0] for c in COLS.split(", ")]
    data = []
    for i in range(n):
        r = dict(zip(names, (f"CUST-{i:05d}", 1.0 + i, 2.0 + i, 10.0 + i, 5.0, 1.0, 0.5, 3.0)))
        if i == 0:
            r.update(change)
        data.append(tuple(r[c] for c in names))
    return spark.createDataFrame(data, COLS)


def test_features_valid(spark):
    report = q.validate_features(features(spark))
    assert report["rows_validated"] == 20 and report["validation_passed"]
    assert set(report["null_rates"].values()) == {0.0}


@pytest.mark.parametrize("change, text", [
    ({"recency_days": -1.0}, r"negative recency_days, down to -1"),
    ({"frequency": 0.0}, "frequency"), ({"online_ratio": 1.5}, "online_ratio"), ({"online_ratio": -0.1}, "online_ratio"),
    ({"monetary": 0.0}, "monetary"), ({"monetary": -1.0}, "monetary"), ({"customer_id": "CUST-00001"}, "duplicate customer_id in 1 rows"),
])
def test_features_invalid(spark, change, text):
    with pytest.raises(q.ValidationFailed, match=text):
        q.validate_features(features(spark, **change))


def test_features_missing_empty_nulls(spark):
    with pytest.raises(q.ValidationFailed, match="missing required column: monetary, active_days"):
        q.validate_features(features(spark).drop("monetary", "active_days"))
    with pytest.raises(q.ValidationFailed, match="empty"):
        q.validate_features(features(spark).limit(0))
    with pytest.raises(q.ValidationFailed, match="null rate exceeds threshold for 'basket_std'"):
        q.validate_features(features(spark, n=10, basket_std=None))
    q.validate_features(features(spark, n=20, basket_std=None))  # exactly 5 % is allowed


def test_scoring_contract(spark):
    schema = "customer_id string, recency_days double, frequency double, monetary double, online_ratio double"
    df = spark.createDataFrame([
        ("CUST-0001", 10.0, 25.0, 350.5, 0.6), ("R", -5.0, 1.0, 1.0, 0.0), ("M", 1.0, 1.0, -100.0, 2.0),
        ("F", 1.0, None, 1.0, None), (None, 1.0, 1.0, 1.0, 0.5),
    ], schema)
    good, bad = q.split_valid(df)
    kept = rows(good)
    assert [r["customer_id"] for r in kept] == ["CUST-0001"] and kept[0]["active_days"] == 0.0
    assert {r["customer_id"]: r["reasons"] for r in rows(bad)} == {
        "R": ["recency_days"], "M": ["monetary", "online_ratio"], "F": ["frequency"], None: ["customer_id"],
    }
    assert rows(q.split_valid(df.drop("frequency"))[0]) == []


def test_reconciliation(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 1.2)], "customer_id string, propensity_score double")
    with pytest.raises(q.ValidationFailed, match="mismatch"):
        q.validate_scores(df, 3)
    with pytest.raises(q.ValidationFailed, match="outside"):
        q.validate_scores(df, 2)
    assert q.validate_scores(df.where("propensity_score < 1"), 1) == 1


def test_output_contract(spark):
    schema = "customer_id string, segment_id int, propensity_score double, scored_at string, model_name string, model_version string"
    ok = spark.createDataFrame([("a", 1, 0.5, "t", "m", "v")], schema)
    assert q.validate_output(ok) == 1
    for bad in (ok.drop("model_name"), ok.limit(0), spark.createDataFrame([("a", None, 0.5, "t", "m", "v")], schema),
                spark.createDataFrame([("a", 1, 1.5, "t", "m", "v")], schema)):
        with pytest.raises(q.ValidationFailed):
            q.validate_output(bad)
