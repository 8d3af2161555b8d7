"""Names, thresholds and schemas shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values (must equal the published ones for right results) ----

PROMOTED_CATEGORIES = ["ready_meals", "bakery", "beverages"]

PERSONA_RATES = {"A": 0.70, "B": 0.35, "C": 0.08}
DEFAULT_PERSONA = "C"
DEFAULT_RATE = 0.08

THRESHOLDS = {
    "propensity_auc_min": 0.70,
    "overfit_gap_max": 0.08,
    "lift_decile1_min": 2.5,
    "cv_std_max": 0.03,
    "silhouette_min": 0.25,
    "dominant_cluster_max": 0.60,
    "tiny_cluster_min": 0.01,
    "tiebreaker_delta": 0.01,
    "ensemble_justification_delta": 0.015,
    "baseline_gate_min_gain": 0.03,
    "auc_regression_max": 0.05,
}

# Simplest first.
COMPLEXITY_ORDER = [
    "logistic_regression",
    "decision_tree",
    "random_forest",
    "xgboost",
    "lightgbm",
    "voting_ensemble",
    "stacking_ensemble",
]
ENSEMBLES = ["voting_ensemble", "stacking_ensemble"]
BASELINE_MODEL = "logistic_regression"

PSI_BINS = 10
PSI_WARN = 0.1
PSI_DRIFT = 0.2
LIFT_RETRAIN = 1.5
RETRAIN_MAX_AGE_DAYS = 30
LIFT_GOOD = 2.0
LIFT_WARN = 1.0
SUITE_PASS_SCORE = 0.95
NULL_RATE_MAX = 0.05

# ---- Fixed values: feature lists; a model always travels with the list it was fitted on ----

SEG5 = ["recency_days", "frequency", "monetary", "avg_basket_size", "online_ratio"]
API9 = [
    "recency_days", "frequency", "monetary", "avg_basket_size", "basket_std",
    "online_ratio", "online_txns", "instore_txns", "active_days",
]
PROP10 = API9 + ["segment_id"]
LOCAL8 = [
    "recency_days", "frequency", "monetary", "avg_basket_size", "basket_std",
    "online_ratio", "active_days", "has_promoted_category",
]
REQUIRED_FEATURES = [
    "customer_id", "recency_days", "frequency", "monetary",
    "avg_basket_size", "basket_std", "online_ratio", "active_days",
]

# ---- Fixed values: layer schemas ----

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("store_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("channel", T.StringType()),
])

# Flat hand-off format of transactions as CSV.
CSV_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("persona", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("basket_value", T.DoubleType()),
])
