"""Splits, labels and folds. Pseudo-random choices depend on the row's id only, so they repeat."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULT_RATE, PERSONA_RATES
from ..functions.exprs import clip, hash_uniform, scalar_of
from .features import KEY, promoted_only, purchasers
from .ordinal import cut_by_hash, cut_by_value, exact_quantiles, hash_ordinal


@dataclass(frozen=True)
class TemporalSplitter:
    """Splits customers by their last transaction date, so that later data never trains earlier tests."""

    train_end_day: int
    val_end_day: int
    snapshot_day: int
    start_date: dt.datetime | dt.date | None = None

    def __post_init__(self):
        if self.train_end_day >= self.val_end_day:
            raise ValueError(f"window overlap: train_end_day {self.train_end_day} >= val_end_day {self.val_end_day}")
        if self.val_end_day >= self.snapshot_day:
            raise ValueError(f"window overlap: val_end_day {self.val_end_day} >= snapshot_day {self.snapshot_day}")

    def split(self, df: DataFrame, date_col: str = "last_transaction_date") -> DataFrame:
        """Add ``split``: one column, not three tables, so the input is read once."""
        at = F.col(date_col).cast("timestamp")
        if self.start_date is not None:
            start = F.lit(self.start_date).cast("timestamp")
        else:
            start = scalar_of(df.agg(F.min(at).alias("d")))
        day = lambda n: start + F.make_dt_interval(days=F.lit(n))
        return df.withColumn(
            "split",
            F.when(at <= day(self.train_end_day), "train").when(at <= day(self.val_end_day), "val")
            .when(at.isNotNull(), "test"),
        )

    @staticmethod
    def check(split: DataFrame) -> dict[str, int]:
        """Sizes of the splits; too few rows or an empty split is an error."""
        got = {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = sum(got.values())
        if total < 3:
            raise ValueError(f"insufficient customers to split: got {total}, need at least 3")
        sizes = {name: got.get(name, 0) for name in ("train", "val", "test")}
        if 0 in sizes.values():
            raise ValueError(f"insufficient customers to split: an empty split in {sizes}")
        return sizes


def _named_cut(df: DataFrame, key: str, seed: int, cuts: dict[str, float], last: str, group: list[str]) -> DataFrame:
    """Name by place in hash order: int(n * fraction) rows up to each cumulative fraction, the rest to ``last``."""
    ends = lambda n: [F.floor(n * F.lit(float(f))) for f in cuts.values()]
    names = F.array(*[F.lit(x) for x in [*cuts, last]])
    return cut_by_hash(df, key, seed, ends, group, "_part").withColumn("split", F.get(names, F.col("_part"))).drop("_part")


def random_split(df: DataFrame, cuts: dict[str, float], last: str, seed: int = 42, key: str = KEY) -> DataFrame:
    """Exact-size split in seeded hash order; ``cuts`` are cumulative, e.g. {"train": .6, "val": .8}."""
    return _named_cut(df, key, seed, cuts, last, [])


def stratified_split(df: DataFrame, label: str, fraction: float = 0.8, seed: int = 42, key: str = KEY) -> DataFrame:
    """Train/val split with the same share of each label."""
    return _named_cut(df, key, seed, {"train": fraction}, "val", [label])


def time_folds(df: DataFrame, date_col: str, n: int = 5, gap: int = 7, key: str = KEY) -> DataFrame:
    """Forward-chaining folds in time order: rows (row, fold, role).

    Fold k tests one block of ``rows // (n + 1)`` rows and trains on all earlier rows but the last
    ``gap``. A row takes part in at most n folds.
    """
    at = F.unix_micros(F.col(date_col).cast("timestamp"))

    def ends(rows):
        block = F.floor(rows / (n + 1))
        starts = [rows - block * (n - k) for k in range(n)]
        return [s - gap for s in starts] + starts + [s + block for s in starts]

    placed = cut_by_value(df, at, key, ends, descending=False, out="_behind", flags=True)
    entries = []
    for k in range(n):
        before_gap, begun, over = (F.get("_behind", k + i * n) for i in range(3))
        role = F.when(~before_gap, "train").when(begun & ~over, "test")
        entries.append(F.struct(F.lit(k + 1).alias("fold"), role.alias("role")))
    many = F.filter(F.array(*entries), lambda s: s["role"].isNotNull())
    exploded = placed.withColumn("_f", F.explode(many))
    return exploded.select(*df.columns, F.col("_f.fold").alias("fold"), F.col("_f.role").alias("role"))


def resample(df: DataFrame, n: int, seed: int = 42, key: str = "transaction_id") -> DataFrame:
    """Exactly ``n`` rows: a hash-ordered subset, or all rows plus as many repeats as are missing.

    Each top-up row is drawn by its position in the hash order, with replacement, by an equi-join.
    """
    total = df.count()
    if n <= total:
        return cut_by_hash(df, key, seed, lambda _: [F.lit(n)], out="_part").where(F.col("_part") == 0).drop("_part")
    draws = df.sparkSession.range(n - total).select(
        (F.floor(hash_uniform("id", f"{seed}|draw") * total) + 1).alias("ordinal")
    )
    extra = hash_ordinal(df, key, seed).join(draws, "ordinal").select(*df.columns)
    return df.unionByName(extra)


# ---- Labels ----

def label_category(df: DataFrame, category: str) -> DataFrame:
    """1 where the category is among the customer's top categories; no array counts as empty."""
    inside = F.coalesce(F.array_contains("top_categories", category), F.lit(False))
    return df.withColumn("label", inside.cast("int"))


def label_forward(customers: DataFrame, label_txns: DataFrame, promoted: list[str]) -> DataFrame:
    """1 where the customer buys a promoted category within the label window."""
    buyers = purchasers(promoted_only(label_txns, promoted)).withColumnRenamed("purchased", "label")
    return customers.join(buyers, KEY, "left").withColumn("label", F.coalesce("label", F.lit(0)))


def label_by_rate(df: DataFrame, rates: dict[str, float] = PERSONA_RATES, seed: int = 42,
                  default: float = DEFAULT_RATE) -> DataFrame:
    """Bernoulli label by persona rate; the draw is a hash of id and seed."""
    rate = F.lit(default)
    for persona, value in rates.items():
        rate = F.when(F.col("persona") == persona, F.lit(value)).otherwise(rate)
    return df.withColumn("label", (hash_uniform(KEY, seed) < rate).cast("int"))


def _gauss(seed: int | str, sigma: float) -> Column:
    """Normal noise from two hash draws (Box-Muller)."""
    u = F.greatest(hash_uniform(KEY, f"{seed}|u"), F.lit(1e-12))
    v = hash_uniform(KEY, f"{seed}|v")
    return F.lit(sigma) * F.sqrt(-2.0 * F.ln(u)) * F.cos(2.0 * F.pi() * v)


def _top_share(df: DataFrame, score: str, q: float) -> DataFrame:
    cut = scalar_of(exact_quantiles(df, score, {"cut": q}).select("cut"))
    return df.withColumn("label", (F.col(score) >= cut).cast("int"))


def rule_score(df: DataFrame, noise: float = 0.0, seed: int = 42) -> DataFrame:
    """Add ``rule_score``, high for frequent, high-spending, mostly in-store customers."""
    both = df.select(F.col("frequency").cast("double").alias("f"), F.col("monetary").cast("double").alias("m"))
    marks = exact_quantiles(both.unpivot([], ["f", "m"], "feature", "value"), "value", {"mid": 0.55, "top": 1.0}, ["feature"])
    pick = lambda feature, c: F.max(F.when(F.col("feature") == feature, F.col(c)))
    row = marks.agg(F.struct(
        pick("f", "mid").alias("f55"), pick("m", "mid").alias("m55"), pick("f", "top").alias("fmax"), pick("m", "top").alias("mmax")
    ).alias("_marks"))
    df = df.withColumn("_marks", scalar_of(row))
    f55, m55, fmax, mmax = (F.col(f"_marks.{c}") for c in ("f55", "m55", "fmax", "mmax"))
    gate = ((F.col("frequency") > f55) & (F.col("monetary") > m55) & (F.col("online_ratio") < 0.45)).cast("double")
    score = (
        F.lit(0.60) * gate + F.lit(0.25) * (F.col("frequency") / (fmax + F.lit(1e-8)))
        + F.lit(0.15) * (F.col("monetary") / (mmax + F.lit(1e-8)))
    )
    if noise:
        score = score + _gauss(seed, noise)
    return df.withColumn("rule_score", score).drop("_marks")


def label_percentile(df: DataFrame, q: float = 0.72, noise: float = 0.0, seed: int = 42) -> DataFrame:
    """Rule label: the top share of :func:`rule_score` is positive."""
    return _top_share(rule_score(df, noise, seed), "rule_score", q)


def concept_score(concept: str) -> Column:
    unit = lambda c, scale: clip(F.col(c) / F.lit(scale), 0.0, 1.0)
    if concept == "stable":
        return (
            F.lit(0.50) * (F.lit(1.0) - unit("recency_days", 180.0)) + F.lit(0.35) * unit("frequency", 50.0)
            + F.lit(0.15) * unit("monetary", 2000.0)
        )
    return (
        F.lit(0.50) * unit("online_ratio", 1.0) + F.lit(0.30) * unit("monetary", 2000.0)
        + F.lit(0.20) * unit("avg_basket_size", 80.0)
    )


def label_concept(df: DataFrame, concept: str, q: float = 0.72, noise: float = 0.0, seed: int = 42) -> DataFrame:
    """Weighted-score label under the 'stable' or the 'drifted' concept; the top share is positive."""
    score = concept_score(concept)
    if noise:
        score = score + _gauss(seed, noise)
    return _top_share(df.withColumn("concept_score", score), "concept_score", q)
