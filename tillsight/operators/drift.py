"""Population Stability Index of many features at once, and the decisions on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ordinal import join_null_safe
from ..config import PSI_BINS, PSI_DRIFT, PSI_WARN
from ..functions.exprs import linear_bin
from ..session import materialise


def to_long(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Wide features as rows (ids..., feature, value)."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(ids), list(cols), "feature", "value")


def reference_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Reference distributions as training writes them: (feature, value)."""
    return to_long(df, cols).where(F.col("value").isNotNull())


def _share(count: Column, total: Column, floor: float) -> Column:
    return F.greatest(F.try_divide(count.cast("double"), total), F.lit(floor))


def _index(binned: DataFrame, keys: list[str], floor: float) -> DataFrame:
    """PSI from (keys..., feature, bin, e, a): counts of both sides, ten rows a feature.

    Rows of bin -1 (out of range) keep their feature in the result, but no share counts them.
    """
    spine = (
        binned.select(*keys, "feature").distinct()
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(PSI_BINS - 1))))
    )
    # Empty bins are added as zeros and summed, so that a null key is a key like others.
    full = binned.where(F.col("bin") >= 0).select(*keys, "feature", "bin", "e", "a").unionByName(
        spine.withColumns({"e": F.lit(0), "a": F.lit(0)})).groupBy(*keys, "feature", "bin").agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    whole = Window.partitionBy(*keys, "feature")
    shares = full.select(
        *keys, "feature",
        _share(F.col("e"), F.sum("e").over(whole), floor).alias("pe"),
        _share(F.col("a"), F.sum("a").over(whole), floor).alias("pa"),
    )
    return shares.groupBy(*keys, "feature").agg(
        F.sum((F.col("pa") - F.col("pe")) * F.ln(F.col("pa") / F.col("pe"))).alias("psi")
    )


def psi_reference_long(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """PSI over ten equal-width bins of the expected range, for (feature, value) rows.

    The outer edges are widened by 1e-6, actual values beyond them are left out, and shares are of
    the values in range, at least 1e-4. Features missing on either side are left out.
    """
    limits = expected.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))

    def counted(side: DataFrame, name: str) -> DataFrame:
        # One row of limits a feature; the values are counted before anything is shuffled. Bin -1 is out of range.
        inside = (F.col("value") >= F.col("lo") - 1e-6) & (F.col("value") <= F.col("hi") + 1e-6)
        at = F.when(inside, linear_bin("value", "lo", "hi", PSI_BINS)).otherwise(-1)
        return side.join(F.broadcast(limits), "feature").groupBy("feature", at.alias("bin")).agg(
            F.count(F.lit(1)).alias(name)
        )

    e, a = counted(expected, "e"), counted(actual, "a")
    both = e.join(a, ["feature", "bin"], "full").fillna({"e": 0, "a": 0})
    known = a.select("feature").distinct()
    return _index(both, [], 1e-4).join(F.broadcast(known), "feature", "left_semi")


def psi_reference(expected: DataFrame, actual: DataFrame, cols: Sequence[str]) -> DataFrame:
    return psi_reference_long(reference_table(expected, cols), reference_table(actual, cols))


#: Snapshots whose edges are searched together; more are dealt to several indexes.
SNAPSHOTS = 10_000


def _limits(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))


def _few(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """With a broadcast hint if the table, written before, was counted to be short."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _expected_counts(expected: DataFrame, joint: DataFrame, keys: list[str], snapshots: int = SNAPSHOTS) -> DataFrame:
    """(keys..., feature, bin, e): the expected rows counted in the bins of every snapshot, though each row is placed once.

    All snapshots' inner edges of a feature are one sorted index. A value's place in it is found by binary search; the rows per
    place are added up from the top, which gives for each edge how many values are at or above it; a bin's count is the difference of two edges.
    """
    blocks = max(1, -(-joint.select(*keys).distinct().count() // snapshots))
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks)) if blocks > 1 else F.lit(0)
    inner = F.transform(F.sequence(F.lit(1), F.lit(PSI_BINS - 1)), lambda i: F.col("lo") + i * ((F.col("hi") - F.col("lo")) / F.lit(float(PSI_BINS))))
    edges = joint.select(*keys, "feature", block.alias("_block"), F.posexplode(inner).alias("_i", "_edge"))
    index = materialise(edges.groupBy("feature", "_block").agg(F.sort_array(F.collect_set("_edge")).alias("_edges")), "edges")
    longest = index.agg(F.max(F.size("_edges"))).first()[0] or 1
    steps = ", ".join(str(2 ** j) for j in reversed(range(longest.bit_length())))
    at = F.expr(f"aggregate(array({steps}), 0, (at, step) -> at + IF(get(_edges, at + step - 1) <= value, step, 0))")
    # One row per feature and block of snapshots.
    cells = expected.join(F.broadcast(index), "feature").groupBy("feature", "_block", at.alias("_at")).agg(F.count(F.lit(1)).alias("c"))
    places = index.select("feature", "_block", F.posexplode("_edges").alias("_p", "_edge")).select("feature", "_block", (F.col("_p") + 1).alias("_at"), "_edge")
    whole = Window.partitionBy("feature", "_block")
    summed = places.withColumn("c", F.lit(0)).unionByName(cells.withColumn("_edge", F.lit(None).cast("double"))).groupBy("feature", "_block", "_at").agg(
        F.max("_edge").alias("_edge"), F.sum("c").alias("c"))
    above = summed.select("feature", "_block", "_edge", F.sum("c").over(whole.orderBy(F.desc("_at"))).alias("_ge"), F.sum("c").over(whole).alias("_n")).where("_edge IS NOT NULL")
    sums = edges.join(_few(materialise(above, "above")), ["feature", "_block", "_edge"]).groupBy(*keys, "feature").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_i", "_ge"))), lambda x: x["_ge"]).alias("_ge"), F.first("_n").alias("_n"))
    bounds = F.concat(F.array("_n"), F.col("_ge"), F.array(F.lit(0).cast("long")))
    bins = F.transform(F.sequence(F.lit(0), F.lit(PSI_BINS - 1)), lambda b: F.struct(
        b.alias("bin"), (F.get("_bounds", b) - F.get("_bounds", b + 1)).alias("e")))
    return sums.withColumn("_bounds", bounds).select(*keys, "feature", F.inline(bins))


def psi_joint_long(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = (), snapshots: int = SNAPSHOTS) -> DataFrame:
    """PSI over ten equal-width bins of the joint range; shares of all rows, at least 1e-6.

    ``keys`` (e.g. a snapshot date) split the actual side; the expected side is compared with each, its rows being read once.
    A constant feature has index 0.
    """
    keys = list(keys)
    values = lambda df: df.where(F.col("value").isNotNull())
    expected, actual = values(expected), values(actual)
    e_lim = _limits(expected, ["feature"]).withColumnsRenamed({"lo": "elo", "hi": "ehi"})  # one row a feature
    joint = _limits(actual, [*keys, "feature"]).join(F.broadcast(e_lim), "feature").select(
        *keys, "feature", F.least("lo", "elo").alias("lo"), F.greatest("hi", "ehi").alias("hi")
    )
    at = linear_bin("value", "lo", "hi", PSI_BINS).alias("bin")
    if keys:
        joint = materialise(joint, "limits")
        near = _few(joint)
        e = _expected_counts(expected, joint, keys, snapshots)
    else:
        near = F.broadcast(joint)  # one row a feature
        e = expected.join(near, "feature").groupBy("feature", at).agg(F.count(F.lit(1)).alias("e"))
    a = join_null_safe(actual, near, [*keys, "feature"]).groupBy(*keys, "feature", at).agg(F.count(F.lit(1)).alias("a"))
    # Summed, not joined, so that a null key is a key like others.
    both = e.withColumn("a", F.lit(0)).unionByName(a.withColumn("e", F.lit(0))).groupBy(*keys, "feature", "bin").agg(
        F.sum("e").alias("e"), F.sum("a").alias("a"))
    psi = _index(both, keys, 1e-6)
    flat = near.select(*keys, "feature", (F.col("lo") == F.col("hi")).alias("_flat"))
    return join_null_safe(psi, flat, [*keys, "feature"]).select(
        *keys, "feature", F.when(F.col("_flat"), F.lit(0.0)).otherwise(F.col("psi")).alias("psi")
    )


def psi_joint(expected: DataFrame, actual: DataFrame, cols: Sequence[str]) -> DataFrame:
    return psi_joint_long(to_long(expected, cols), to_long(actual, cols))


def classify_psi(psi: DataFrame) -> DataFrame:
    p = F.col("psi")
    return psi.withColumns({
        "status": F.when(p >= PSI_DRIFT, "RED").when(p >= PSI_WARN, "YELLOW").otherwise("GREEN"),
        "action": F.when(p >= PSI_DRIFT, "RETRAIN").when(p >= PSI_WARN, "MONITOR").otherwise("STABLE"),
    })


def drift_summary(psi: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Largest index, features by status, features above (not at) the drift bound, and the drift flag."""
    marked = classify_psi(psi)
    names = lambda cond: F.sort_array(F.collect_list(F.when(cond, F.col("feature"))))
    return marked.groupBy(*by).agg(
        F.max("psi").alias("psi_max"),
        names(F.col("status") == "YELLOW").alias("yellow"),
        names(F.col("status") == "RED").alias("red"),
        names(F.col("psi") > PSI_DRIFT).alias("above_threshold"),
    ).withColumn("drift_detected", F.col("psi_max") > PSI_DRIFT)


def drift_decision(summary: DataFrame) -> DataFrame:
    red = F.size("red") > 0
    return summary.withColumns({
        "decision": F.when(red, "DRIFT_DETECTED").otherwise("OK"),
        "route": F.when(red, "retrain").otherwise("stable"),
    })


def psi_history(snapshots: DataFrame, reference: DataFrame, cols: Sequence[str], date_col: str = "snapshot_date") -> DataFrame:
    """Index of each snapshot and feature against the reference, in one job."""
    return psi_joint_long(to_long(reference, cols), to_long(snapshots, cols, [date_col]), [date_col])


def psi_mean(history: DataFrame) -> DataFrame:
    return history.groupBy("feature").agg(F.avg("psi").alias("psi_mean"))


def last_n(history: DataFrame, n: int = 8, date_col: str = "snapshot_date") -> DataFrame:
    """Rows of the last n snapshot dates. The dates (few, distinct) are ranked, not the rows."""
    newest = history.select(date_col).distinct().orderBy(F.desc(date_col)).limit(n)
    return history.join(F.broadcast(newest), date_col, "left_semi")


def psi_matrix(history: DataFrame, n: int = 8, date_col: str = "snapshot_date") -> DataFrame:
    """Feature by date (the last n, as columns d1..dn from oldest to newest), missing values as 0."""
    recent = last_n(history, n, date_col)
    dates = Window.partitionBy().orderBy(date_col)
    numbered = recent.select(date_col).distinct().withColumn("_i", F.row_number().over(dates))  # at most n rows
    placed = recent.join(F.broadcast(numbered), date_col)
    wide = placed.groupBy("feature").pivot("_i", list(range(1, n + 1))).agg(F.first("psi"))
    return wide.select("feature", *[F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"d{i}") for i in range(1, n + 1)])


def compare_phases(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Loss of a stale model and gain of the retrained one, from rows (phase, test_auc, lift_d1).

    Phases are 'baseline', 'stale' and 'retrained'.
    """
    at = lambda phase, c: F.max(F.when(F.col("phase") == phase, F.col(c)))
    wide = metrics.groupBy(*by).agg(*[
        at(p, c).alias(f"{p}_{c}") for p in ("baseline", "stale", "retrained") for c in ("test_auc", "lift_d1")
    ])
    diff = lambda a, b, c: F.round(F.col(f"{a}_{c}") - F.col(f"{b}_{c}"), 4)
    return wide.select(
        *by,
        diff("baseline", "stale", "test_auc").alias("auc_degradation"),
        diff("retrained", "stale", "test_auc").alias("auc_recovery"),
        diff("baseline", "stale", "lift_d1").alias("lift_degradation"),
        diff("retrained", "stale", "lift_d1").alias("lift_recovery"),
        (F.col("retrained_test_auc") >= F.col("baseline_test_auc") - 0.02).alias("full_recovery"),
    )
