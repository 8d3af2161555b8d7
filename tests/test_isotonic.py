import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillsight.operators import isotonic as iso


def min_max(points):
    """{score: value} by the min-max formula over (score, label) rows."""
    by = {}
    for x, y in points:
        s, n = by.get(x, (0, 0))
        by[x] = (s + y, n + 1)
    xs = sorted(by)
    total = lambda a, b: sum(by[x][0] for x in xs[a:b + 1]) / sum(by[x][1] for x in xs[a:b + 1])
    return {x: max(min(total(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i, x in enumerate(xs)}


@pytest.mark.parametrize("kind", ["rising", "falling", "noise", "one low end"])
def test_blocks_equal_min_max_formula(spark, kind):
    r = random.Random(kind)
    points = []
    for i in range(300):
        x = r.randrange(60) / 60
        p = {"rising": x, "falling": 1 - x, "noise": 0.5, "one low end": 0.0 if x > 0.97 else x}[kind]
        points.append((x, int(r.random() < p)))
    want = min_max(points)
    df = spark.createDataFrame([*points, (None, 1), (float("nan"), 1)], "score double, label int")
    for each in (1000, 7, 1):
        blocks = iso.fit_blocks(df, rows_each=each)
        got = iso.apply_blocks(df.where("score IS NOT NULL AND NOT isnan(score)"), blocks).groupBy("score").agg(F.max("calibrated").alias("v"))
        assert {x["score"]: x["v"] for x in rows(got)} == pytest.approx(want)
        ordered = sorted(rows(blocks), key=lambda b: b["lo"])
        values = [b["s"] / b["n"] for b in ordered]
        assert all(a < b for a, b in zip(values, values[1:])) and all(a["hi"] < b["lo"] for a, b in zip(ordered, ordered[1:]))


def test_lines_between_blocks_many_blocks_and_no_rows(spark, monkeypatch):
    points = [(i / 100, int(i >= 50 or i % 7 == 0)) for i in range(100)]
    df = spark.createDataFrame(points, "score double, label int")
    blocks = iso.fit_blocks(df, rows_each=9)
    asked = spark.createDataFrame([(x,) for x in (-1.0, 0.005, 0.333, 0.485, 0.4999, 0.99, 2.0, None)], "score double")
    few = {x["score"]: x["calibrated"] for x in rows(iso.apply_blocks(asked, blocks))}
    monkeypatch.setattr(iso, "FEW_BLOCKS", 0)
    many = {x["score"]: x["calibrated"] for x in rows(iso.apply_blocks(asked, blocks))}
    assert few == many and few[None] is None and few[2.0] == 1.0
    ordered = sorted(rows(blocks), key=lambda b: b["lo"])
    assert few[-1.0] == ordered[0]["s"] / ordered[0]["n"] and 1 / 7 < few[0.485] < 1
    none = iso.fit_blocks(df.where("false"))
    assert none.count() == 0 and [x["calibrated"] for x in rows(iso.apply_blocks(asked.limit(1), none))] == [None]
