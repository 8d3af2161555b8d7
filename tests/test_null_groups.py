"""Rows that used to get lost or bent: null groups, long keys, NaN, null ids, an unset shared folder."""

import pytest
from conftest import rows

from tillsight.operators import drift, features as fe, metrics as me, ordinal as od, quality as ql, splits as sp
from tillsight.session import shared_folder


def test_null_groups_stay(spark):
    df = spark.createDataFrame([(f"C{i}", None if i % 5 == 0 else i % 2, float(i)) for i in range(100)], "customer_id string, label int, score double")
    out = rows(od.global_ordinal(df, "score", "customer_id", ["label"]))
    assert len(out) == 100
    assert sorted(r["ordinal"] for r in out if r["label"] is None) == list(range(1, 21))
    assert sp.stratified_split(df, "label", 0.6).count() == 100
    grouped = df.select("customer_id", "score", (df.score > 50).cast("int").alias("label"), df.label.alias("g"))
    assert len(rows(me.lift_d1(grouped, group=["g"]))) == 3


def test_long_keys_keep_their_digits(spark):
    df = spark.createDataFrame([(f"C{i}", 2**60 + i) for i in range(10)], "id string, v long")
    for descending in (True, False):
        out = {r["id"]: r["ordinal"] for r in rows(od.global_ordinal(df, "v", "id", descending=descending))}
        assert [out[f"C{i}"] for i in range(10)] == [10 - i if descending else i + 1 for i in range(10)]


@pytest.mark.parametrize("buckets", [2, 64, 300])
def test_nan_nulls_and_infinities_have_their_place(spark, buckets):
    values = [float("nan"), float("inf"), 3.0, 0.0, float("-inf"), None]
    df = spark.createDataFrame([(f"{i}-{j}", v) for i, v in enumerate(values) for j in range(5)], "id string, v double")
    for descending, order in ((True, "012345"), (False, "432105")):
        out = sorted(rows(od.global_ordinal(df, "v", "id", descending=descending, buckets=buckets)), key=lambda r: r["ordinal"])
        assert "".join(r["id"][0] for r in out) == "".join(c * 5 for c in order)
        assert [r["ordinal"] for r in out] == list(range(1, 31))


def test_null_id_of_a_hot_value_stays_with_its_value(spark):
    data = [(f"C{i}", 0.9 if i < 30 else 0.5 if i < 80 else 0.1) for i in range(100)] + [(None, 0.5)]
    out = rows(od.global_ordinal(spark.createDataFrame(data, "id string, v double"), "v", "id"))
    assert 30 < next(r["ordinal"] for r in out if r["id"] is None) <= 81


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    suite = [ql.Expectation("not_null", "x"), ql.Expectation("between", "x", {"min_value": 0})]
    assert [rows(df.select(e.failed().cast("int").alias("f")).groupBy().sum("f"))[0]["sum(f)"] for e in suite] == [2, 2]
    assert rows(fe.null_rates(df, ["x"]))[0]["null_rate"] == pytest.approx(2 / 3)


def test_null_segment_and_snapshot(spark):
    df = spark.createDataFrame([(None if i % 2 else 1, i / 10) for i in range(10)], "segment_id int, propensity_score double")
    assert len(rows(fe.score_by_segment(df))) == 2
    long = spark.createDataFrame([("f", float(i)) for i in range(50)], "feature string, value double")
    snaps = spark.createDataFrame([(None if i % 2 else "a", "f", float(i)) for i in range(50)], "day string, feature string, value double")
    assert sorted(str(r["day"]) for r in rows(drift.psi_joint_long(long, snaps, ["day"]))) == ["None", "a"]


def test_unset_folder_on_a_cluster_raises():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
