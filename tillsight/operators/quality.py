"""Data-quality rules and validators; each table is read once, whatever the number of rules."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import NULL_RATE_MAX, REQUIRED_FEATURES, SUITE_PASS_SCORE
from ..functions.exprs import missing


class ValidationFailed(ValueError):
    """A gate stopped the run; ``failures`` lists what failed."""

    def __init__(self, message: str, failures: list[dict] | None = None):
        super().__init__(message)
        self.failures = failures or []


# Rule names of a suite file -> kinds. Fixed values.
_RULE_KINDS = {
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_between": "between",
    "expect_column_values_to_match_regex": "regex",
    "expect_column_values_to_be_in_set": "in_set",
    "expect_column_values_to_not_be_in_future": "not_future",
}


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    args: dict[str, Any] = field(default_factory=dict, hash=False)
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind

    def failed(self, now: dt.datetime | None = None) -> Column:
        """True for a row that breaks the rule. Nulls break every rule with a bound, a pattern or a set."""
        c = F.col(self.column) if self.column else None
        if self.kind == "not_null":
            return missing(c)
        if self.kind == "between":
            lo, hi = self.args.get("min_value"), self.args.get("max_value")
            ok = F.lit(True) if lo is None and hi is None else ~missing(c)
            if lo is not None:
                ok = ok & F.coalesce(c >= F.lit(lo), F.lit(False))
            if hi is not None:
                ok = ok & F.coalesce(c <= F.lit(hi), F.lit(False))
            return ~ok
        if self.kind == "regex":
            # A match must begin at the start of the text; a null reads as the text "None".
            text = F.coalesce(c.cast("string"), F.lit("None"))
            return ~text.rlike("^(?:" + self.args["regex"] + ")")
        if self.kind == "in_set":
            return ~F.coalesce(c.isin(list(self.args["value_set"])), F.lit(False))
        if self.kind == "not_future":
            limit = F.lit(now) if now is not None else F.current_timestamp()
            return F.coalesce(c.cast("timestamp") > limit.cast("timestamp"), F.lit(False))
        return F.lit(False)  # an unknown rule passes, so it cannot block silently


def load_suite(spark: SparkSession, path: str) -> list[Expectation]:
    """Rules from a small JSON document on any file system Spark can read."""
    text = spark.read.text(path, wholetext=True).first()[0]
    rules = []
    for item in json.loads(text)["expectations"]:
        args = dict(item["kwargs"])
        kind = item["expectation_type"]
        rules.append(Expectation(_RULE_KINDS.get(kind, kind), args.pop("column", ""), args, kind))
    return rules


def transaction_suite() -> list[Expectation]:
    """The rules of the transaction layer. Fixed values."""
    return [
        Expectation("not_null", "transaction_id"),
        Expectation("between", "total_amount", {"min_value": 0.01, "max_value": 5000.00}),
        Expectation("regex", "customer_id", {"regex": "^CUST-[0-9]+$"}),
        Expectation("not_future", "timestamp"),
        Expectation("in_set", "channel", {"value_set": ["online", "in-store"]}),
        Expectation("between", "quantity", {"min_value": 1, "max_value": None}),
    ]


def validate(df: DataFrame, suite: list[Expectation], now: dt.datetime | None = None) -> DataFrame:
    """One row per rule: (rule, expectation, column, passed, failed_rows)."""
    if not suite:
        return df.sparkSession.createDataFrame(
            [], "rule int, expectation string, column string, passed boolean, failed_rows bigint"
        )
    counts = df.agg(F.array(*[
        F.struct(
            F.lit(i).alias("rule"), F.lit(e.label).alias("expectation"), F.lit(e.column).alias("column"),
            F.count_if(e.failed(now)).alias("failed_rows"),
        )
        for i, e in enumerate(suite)
    ]).alias("rules"))
    out = counts.select(F.inline("rules"))
    return out.select("rule", "expectation", "column", (F.col("failed_rows") == 0).alias("passed"), "failed_rows")


def suite_score(result: DataFrame, threshold: float = SUITE_PASS_SCORE) -> DataFrame:
    """Share of passed rules; no rules score 1."""
    out = result.agg(F.coalesce(F.avg(F.col("passed").cast("double")), F.lit(1.0)).alias("score"))
    return out.withColumn("passed", F.col("score") >= threshold)


def gate(result: DataFrame, threshold: float = SUITE_PASS_SCORE) -> float:
    """Return the score, or stop the run naming every failed rule. The result has one row per rule."""
    rows = [r.asDict() for r in result.orderBy("rule").collect()]
    score = sum(r["passed"] for r in rows) / len(rows) if rows else 1.0
    if score < threshold:
        bad = [r for r in rows if not r["passed"]]
        text = "; ".join(f"{r['expectation']} on '{r['column']}': {r['failed_rows']} failing rows" for r in bad)
        raise ValidationFailed(f"validation score {score:.4f} < {threshold}: {text}", bad)
    return score


# ---- Feature table ----

def feature_counters(df: DataFrame) -> DataFrame:
    """All counters of the feature validator as one row, from one pass."""
    key = REQUIRED_FEATURES[0]
    count_if = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
    c = F.col
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (
            F.count(F.lit(1)) - F.countDistinct(key) - F.coalesce(F.max(c(key).isNull().cast("int")), F.lit(0))
        ).alias("duplicate_ids"),
        *[F.count_if(missing(c(name))).alias(f"null_{name}") for name in REQUIRED_FEATURES],
        count_if(c("recency_days") < 0).alias("bad_recency"),
        F.min(F.when(c("recency_days") < 0, c("recency_days").cast("double"))).alias("worst_recency"),
        count_if(c("frequency") < 1).alias("bad_frequency"),
        count_if(c("monetary") <= 0).alias("bad_monetary"),
        count_if((c("online_ratio") < 0) | (c("online_ratio") > 1)).alias("bad_online_ratio"),
    )


def validate_features(df: DataFrame, null_rate_max: float = NULL_RATE_MAX) -> dict:
    """Check a feature table; the first broken rule raises, success returns a report."""
    absent = [c for c in REQUIRED_FEATURES if c not in df.columns]
    if absent:
        if df.isEmpty():
            raise ValidationFailed("the feature table is empty")
        raise ValidationFailed("missing required column: " + ", ".join(absent))
    seen = feature_counters(df).first().asDict()
    n = seen["n_rows"]
    if n == 0:
        raise ValidationFailed("the feature table is empty")
    if seen["duplicate_ids"] > 0:
        raise ValidationFailed(f"duplicate customer_id in {seen['duplicate_ids']} rows")
    rates = {c: seen[f"null_{c}"] / n for c in REQUIRED_FEATURES}
    for name, rate in rates.items():
        if rate > null_rate_max:
            raise ValidationFailed(
                f"null rate exceeds threshold for '{name}': {rate:.1%} (threshold={null_rate_max:.1%})"
            )
    if seen["bad_recency"]:
        raise ValidationFailed(f"negative recency_days, down to {seen['worst_recency']}")
    if seen["bad_frequency"]:
        raise ValidationFailed("frequency below 1")
    if seen["bad_monetary"]:
        raise ValidationFailed("monetary not above 0")
    if seen["bad_online_ratio"]:
        raise ValidationFailed("online_ratio outside 0 to 1")
    return {
        "rows_validated": n, "columns_checked": list(REQUIRED_FEATURES), "null_rates": rates,
        "validation_passed": True, "timestamp": dt.datetime.now(dt.timezone.utc),
    }


# ---- Scoring input and output ----

# (column, required, lower bound, lower bound excluded, upper bound). Fixed values.
_SCORING_CONTRACT = [
    ("recency_days", True, 0.0, False, None),
    ("frequency", True, 0.0, False, None),
    ("monetary", True, 0.0, True, None),
    ("avg_basket_size", False, 0.0, False, None),
    ("basket_std", False, 0.0, False, None),
    ("online_ratio", False, 0.0, False, 1.0),
    ("online_txns", False, 0.0, False, None),
    ("instore_txns", False, 0.0, False, None),
    ("active_days", False, 0.0, False, None),
]


def with_reasons(df: DataFrame) -> DataFrame:
    """Add ``reasons``: the fields of a row that break the scoring contract. Optional fields default to 0."""
    have = set(df.columns)
    if "customer_id" not in have:
        raise ValidationFailed("missing required column: customer_id")
    tests = [F.when(F.col("customer_id").isNull(), F.lit("customer_id"))]
    fills = {}
    for name, required, lo, strict, hi in _SCORING_CONTRACT:
        if name not in have:
            if required:
                tests.append(F.lit(name))
            else:
                fills[name] = F.lit(0.0)
            continue
        if not required:
            fills[name] = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        c = F.col(name)
        bad = (c <= lo) if strict else (c < lo)
        if hi is not None:
            bad = bad | (c > hi)
        tests.append(F.when(F.coalesce(bad, F.lit(required)), F.lit(name)))
    return df.withColumn("reasons", F.array_compact(F.array(*tests))).withColumns(fills)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may be scored, rejected rows with their reasons)."""
    marked = with_reasons(df)
    good = marked.where(F.size("reasons") == 0).drop("reasons")
    return good, marked.where(F.size("reasons") > 0)


def score_counters(df: DataFrame) -> DataFrame:
    p = F.col("propensity_score")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.coalesce((p < 0) | (p > 1), F.lit(False))).alias("out_of_range"),
    )


def validate_scores(written: DataFrame, expected: int) -> int:
    """After the write: the row count equals the source's and no score lies outside [0, 1]."""
    seen = score_counters(written).first()
    if seen["n_rows"] != expected:
        raise ValidationFailed(f"row count mismatch: expected {expected:,}, got {seen['n_rows']:,}")
    if seen["out_of_range"]:
        raise ValidationFailed(f"{seen['out_of_range']:,} rows have propensity scores outside [0, 1]")
    return seen["n_rows"]


OUTPUT_COLUMNS = ["customer_id", "segment_id", "propensity_score", "scored_at", "model_name", "model_version"]


def output_counters(df: DataFrame) -> DataFrame:
    """Rows, null cells over all columns and out-of-range scores of a score table."""
    p = F.col("propensity_score")
    nulls = [F.count_if(missing(F.col(c))) for c in df.columns]
    total = nulls[0]
    for x in nulls[1:]:
        total = total + x
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), total.alias("null_cells"),
        F.count_if(F.coalesce(~p.between(0.0, 1.0), F.lit(False))).alias("out_of_range"),
    )


def validate_output(df: DataFrame) -> int:
    missing = [c for c in OUTPUT_COLUMNS if c not in df.columns]
    if missing:
        raise ValidationFailed("output misses columns: " + ", ".join(missing))
    if dict(df.dtypes)["segment_id"] not in ("int", "bigint", "smallint", "tinyint"):
        raise ValidationFailed("segment_id must be an integer")
    seen = output_counters(df).first()
    if seen["n_rows"] == 0:
        raise ValidationFailed("output is empty")
    if seen["null_cells"]:
        raise ValidationFailed(f"output contains {seen['null_cells']} null values")
    if seen["out_of_range"]:
        raise ValidationFailed("propensity_score outside [0, 1]")
    return seen["n_rows"]
