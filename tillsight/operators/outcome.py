"""Realised lift of past scores and the retraining decision."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import LIFT_GOOD, LIFT_RETRAIN, LIFT_WARN, RETRAIN_MAX_AGE_DAYS
from .features import KEY
from .metrics import deciles


def lift_table(scored: DataFrame, score: str = "propensity_score", outcome: str = "purchased", tie: str = KEY) -> DataFrame:
    """Per decile: customers, mean score, purchase rate, baseline and lift.

    The baseline is the sum over the ten groups, so the table is read once for rates and baseline.
    """
    groups = deciles(scored, score, tie).groupBy("decile").agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg(score).alias("_p"),
        F.avg(outcome).alias("_r"), F.sum(F.col(outcome).cast("bigint")).alias("_y"),
    )
    whole = Window.partitionBy()  # ten rows
    base = F.coalesce(F.try_divide(F.sum("_y").over(whole), F.sum("n_customers").over(whole)), F.lit(0.0))
    out = groups.withColumn("_base", base).withColumn("actual_positive_rate", F.round("_r", 4))
    lift = F.when(F.col("_base") > 0, F.round(F.try_divide("actual_positive_rate", "_base"), 4)).otherwise(0.0)
    return out.select(
        "decile", "n_customers", F.round("_p", 4).alias("predicted_positive_rate"), "actual_positive_rate",
        F.round("_base", 4).alias("baseline_rate"), lift.alias("realised_lift"),
    )


def lift_status(table: DataFrame, lift: str = "realised_lift") -> DataFrame:
    x = F.coalesce(F.col(lift), F.lit(0.0))
    return table.withColumn("status", F.when(x >= LIFT_GOOD, "GOOD").when(x >= LIFT_WARN, "WARN").otherwise("POOR"))


def model_age_days(created_ms: Column, today: dt.date) -> Column:
    """Days since a model was registered, from epoch milliseconds."""
    return F.datediff(F.lit(today), F.to_date(F.timestamp_millis(created_ms)))


def retrain_decision(table: DataFrame, age_days: Column | int) -> DataFrame:
    """RETRAIN_REQUIRED when the top decile's lift is low or the model is old; one row."""
    age = F.lit(age_days) if isinstance(age_days, int) else age_days
    first = table.agg(
        F.coalesce(F.max(F.when(F.col("decile") == 1, F.col("realised_lift"))), F.lit(0.0)).alias("lift_d1")
    )
    return first.withColumn("age_days", age).withColumn(
        "decision",
        F.when((F.col("lift_d1") < LIFT_RETRAIN) | (F.col("age_days") > RETRAIN_MAX_AGE_DAYS), "RETRAIN_REQUIRED")
        .otherwise("OK"),
    ).withColumn(
        "reason",
        F.when(F.col("lift_d1") < LIFT_RETRAIN, "lift").when(F.col("age_days") > RETRAIN_MAX_AGE_DAYS, "age")
        .otherwise("none"),
    )
