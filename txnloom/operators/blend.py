"""Customer profiles joined with scores, fraud history and churn alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import composite_risk
from ..params import BlendParams
from .churn import max_churn_signals


def customer_risk_blend(fraud: DataFrame, profiles: DataFrame, clv: DataFrame,
                        alerts: DataFrame | None = None, p: BlendParams = BlendParams(),
                        normalize: bool = False) -> DataFrame:
    """Customers with both a fraud summary and a profile.

    CLV and churn alerts are optional per customer. Every input has one row per
    customer before its join, so nothing fans out.
    """
    people = profiles.select("customerId", "segment", "churn_probability", "risk_score",
                             F.col("composite_risk_score").alias("profile_composite_risk"))
    value = clv.select("customerId", "clv_score", "clv_classification")
    joined = fraud.join(people, "customerId").join(value, "customerId", "left")
    if alerts is None:
        joined = joined.withColumn("churn_signal_count", F.lit(0))
    else:
        joined = joined.join(max_churn_signals(alerts), "customerId", "left").withColumn(
            "churn_signal_count", F.coalesce("churn_signal_count", F.lit(0)))
    return joined.select(
        "customerId", "segment", "total_transactions", "total_amount", "confirmed_fraud_count",
        "fraud_rate_pct", "churn_probability",
        F.when(F.col("churn_signal_count") > 0, 1).otherwise(0).alias("is_churn_flagged"),
        "churn_signal_count", "clv_score", "clv_classification", "risk_score",
        "profile_composite_risk",
        composite_risk(F.col("fraud_rate_pct"), F.col("churn_probability"), p, normalize)
        .alias("composite_risk_score"))
