"""Isotonic regression of labels on scores by pooling adjacent violators in ranges of the score, whatever the number of distinct scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .ordinal import buckets_for
from ..functions.exprs import scalar_of
from ..session import materialise

_BLOCK = "range int, lo double, hi double, s double, n double"
#: Distinct scores in a range, which one task pools.
RANGE = 100_000
#: Blocks that are broadcast at most when scores are calibrated; more are joined by range.
FEW_BLOCKS = 200_000


def _pooling():
    """A function of the blocks of one or two ranges, for grouped tables; it carries all it needs to the workers."""
    import pandas as pd

    def pool(pdf):
        # In the order of ``lo``, pooled until the means rise strictly; a block that spans two ranges belongs to the first.
        out: list[list[float]] = []
        for row in pdf.sort_values("lo")[["range", "lo", "hi", "s", "n"]].itertuples(index=False):
            out.append(list(row))
            while len(out) > 1 and out[-2][3] * out[-1][4] >= out[-1][3] * out[-2][4]:
                _, _, hi, s, n = out.pop()
                out[-1][2], out[-1][3], out[-1][4] = hi, out[-1][3] + s, out[-1][4] + n
        return pd.DataFrame(out, columns=["range", "lo", "hi", "s", "n"]).astype({"range": "int32", "lo": float, "hi": float, "s": float, "n": float})

    return pool


def fit_blocks(df: DataFrame, score: str = "score", label: str = "label", rows_each: int = RANGE) -> DataFrame:
    """(range, lo, hi, s, n): the blocks of the isotonic fit, each with its least and greatest score, positives and rows; its value is s / n.

    Scores are counted, dealt to ranges and pooled in each range. Then neighbouring ranges whose ends are out of order are pooled in
    pairs, alternately with the one before and the one after, until none are. A pair is as large as two ranges at most. Only one row a range
    is looked at together. Null and NaN scores are left out.
    """
    points = materialise(df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))).groupBy(F.col(score).cast("double").alias("lo")).agg(
        F.sum(F.col(label).cast("double")).alias("s"), F.count(F.lit(1)).cast("double").alias("n")), "points")
    ranges = buckets_for(points, [], rows_each)
    dealt = points.repartitionByRange(ranges, "lo").select(F.spark_partition_id().alias("range"), "lo", F.col("lo").alias("hi"), "s", "n")
    blocks = materialise(materialise(dealt, "ranges").groupBy("range").applyInPandas(_pooling(), _BLOCK), "blocks")
    parity, calm = 0, 0
    while ranges > 1:
        value = F.col("s") / F.col("n")
        ends = blocks.groupBy("range").agg(F.min_by(value, "lo").alias("first"), F.max_by(value, "lo").alias("last"))
        order = Window.orderBy("range")  # one row a range
        ends = ends.select("range", (F.row_number().over(order) + parity).alias("at"), "first", "last")
        pairs = ends.groupBy(F.floor(F.col("at") / 2).alias("pair")).agg(
            F.count(F.lit(1)).alias("c"), F.min_by("last", "range").alias("left"), F.max_by("first", "range").alias("right"), F.collect_list("range").alias("ranges"))
        wrong = pairs.where("c = 2 AND left >= right").select("pair", F.explode("ranges").alias("range"))
        wrong = materialise(wrong, "wrong")
        parity = 1 - parity
        if wrong.isEmpty():
            calm += 1
            if calm == 2:
                break
            continue
        calm = 0
        marked = blocks.join(F.broadcast(wrong), "range", "left")  # at most one row a range
        pooled = marked.where("pair IS NOT NULL").groupBy("pair").applyInPandas(_pooling(), _BLOCK)
        blocks = materialise(marked.where("pair IS NULL").drop("pair").unionByName(pooled), "blocks")
    return blocks


def apply_blocks(df: DataFrame, blocks: DataFrame, score: str = "score", out: str = "calibrated") -> DataFrame:
    """Add the calibrated score: a block's value inside it, a straight line between two blocks, the end values beyond; null for null.

    The blocks of a range are one array, searched by halving. A few blocks are one array for all rows; many are joined by range.
    """
    n = blocks.count()
    if not n:
        return df.withColumn(out, F.lit(None).cast("double"))
    rows = df.withColumn("_x", F.col(score).cast("double"))
    item = F.struct("lo", "hi", (F.col("s") / F.col("n")).alias("v"))
    if n <= FEW_BLOCKS:
        rows = rows.withColumn("_b", scalar_of(blocks.agg(F.sort_array(F.collect_list(item)).alias("b"))))
        longest = n
    else:
        by_range = blocks.groupBy("range").agg(F.sort_array(F.collect_list(item)).alias("b"))
        order = Window.orderBy("range")
        # Each range with the last block before it and the first block after it, so that lines between ranges are known.
        full = materialise(by_range.select("range", F.col("b")[0]["lo"].alias("from"), F.filter(F.concat(
            F.array(F.lag(F.element_at("b", -1)).over(order)), "b", F.array(F.lead(F.col("b")[0]).over(order))), lambda x: x.isNotNull()).alias("_b")), "by-range")
        starts = scalar_of(full.agg(F.sort_array(F.collect_list("from")).alias("f")))
        ids = scalar_of(full.agg(F.transform(F.sort_array(F.collect_list(F.struct("from", "range"))), lambda x: x["range"]).alias("r")))
        rows = rows.withColumns({"_f": starts, "_r": ids}).withColumn("_at", F.greatest(F.lit(1), F.size(F.filter("_f", lambda x: x <= F.col("_x"))))).withColumn(
            "_range", F.element_at("_r", F.col("_at"))).drop("_f", "_r", "_at").join(full.select(F.col("range").alias("_range"), "_b"), "_range").drop("_range")
        longest = full.agg(F.max(F.size("_b"))).first()[0]
    rows = rows.withColumn("_i", F.lit(0))
    for j in reversed(range(longest.bit_length())):
        rows = rows.withColumn("_i", F.expr(f"_i + IF(coalesce(get(_b, _i + {2 ** j - 1}).lo <= _x, false), {2 ** j}, 0)"))
    here, after = "get(_b, _i - 1)", "get(_b, _i)"
    value = F.expr(f"""CASE WHEN _x IS NULL THEN NULL WHEN _i = 0 THEN {after}.v WHEN _x <= {here}.hi OR {after} IS NULL THEN {here}.v
      ELSE {here}.v + ({after}.v - {here}.v) * (_x - {here}.hi) / ({after}.lo - {here}.hi) END""")
    return rows.withColumn(out, value).drop("_x", "_b", "_i")
