"""Explicit schemas of every dataset; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _LONG, _DBL, _STR = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


TXN = _struct(
    ("step", _INT), ("type", _STR), ("amount", _DBL),
    ("nameOrig", _STR), ("oldbalanceOrg", _DBL), ("newbalanceOrig", _DBL),
    ("nameDest", _STR), ("oldbalanceDest", _DBL), ("newbalanceDest", _DBL),
    ("isFraud", _INT), ("isFlaggedFraud", _INT),
    ("txnId", _STR), ("ingest_ts", _STR),
)
TXN_COLUMNS = TXN.fieldNames()
CSV_COLUMNS = TXN_COLUMNS[:11]

INT_FIELDS = ("step", "isFraud", "isFlaggedFraud")
FLOAT_FIELDS = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
TEXT_FIELDS = ("type", "nameOrig", "nameDest")

ENVELOPE = _struct(("payload", TXN))

PROFILE = _struct(
    ("customerId", _STR), ("segment", _STR), ("country", _STR), ("age", _INT),
    ("annualIncome", _DBL), ("productCount", _INT), ("kyc_status", _STR),
    ("preferred_channel", _STR), ("email_verified", T.BooleanType()),
    ("is_active", T.BooleanType()), ("risk_score", _DBL), ("churn_probability", _DBL),
    ("composite_risk_score", _DBL), ("account_opened", _STR),
    ("last_transaction_date", _STR), ("products", T.ArrayType(_STR)),
)

BASELINE = _struct(
    ("customerId", _STR), ("all_time_txn_count", _LONG), ("all_time_avg_amount", _DBL),
    ("first_step", _INT), ("last_step", _INT), ("hist_freq_per_12", _DBL),
)

CHURN_ALERT = _struct(
    ("customerId", _STR), ("window_start", T.TimestampType()), ("window_end", T.TimestampType()),
    ("window_start_step", _INT), ("window_end_step", _INT), ("signals", T.ArrayType(_STR)),
    ("signal_count", _INT), ("window_txn_count", _LONG), ("window_avg_amount", _DBL),
    ("detected_at", _STR),
)

METRICS = _struct(
    ("batch_id", _LONG), ("batch_ts", _STR), ("total_count", _LONG), ("parsed_count", _LONG),
    ("flagged_count", _LONG), ("fraud_rate_pct", _DBL), ("app_name", _STR), ("fraud_rule", _STR),
)

FLAGGED = _struct(
    ("txnId", _STR), ("step", _INT), ("event_ts", T.TimestampType()), ("type", _STR),
    ("amount", _DBL), ("nameOrig", _STR), ("oldbalanceOrg", _DBL), ("newbalanceOrig", _DBL),
    ("nameDest", _STR), ("oldbalanceDest", _DBL), ("newbalanceDest", _DBL), ("isFraud", _INT),
    ("isFlaggedFraud", _INT), ("false_positive", _INT), ("fraud_rule", _STR),
    ("detected_at", _STR), ("bridged_at", _STR),
)

GRAPH_ACCOUNT = _struct(("accountId", _STR), ("accountType", _STR))
GRAPH_TXN = _struct(("txnId", _STR), ("step", _INT), ("type", _STR), ("amount", _DBL), ("isFraud", _INT))
GRAPH_SENT = _struct(
    ("accountId", _STR), ("txnId", _STR), ("amount", _DBL), ("step", _INT), ("transactionType", _STR),
)
GRAPH_RECEIVED = _struct(
    ("txnId", _STR), ("accountId", _STR), ("newbalanceDest", _DBL), ("isFraud", _INT),
)

# Columns that each stored dataset must offer to its readers.
CONTRACTS: dict[str, tuple[str, ...]] = {
    "transactions": tuple(TXN_COLUMNS),
    "risk_scores": ("customerId", "risk_score", "risk_tier", "frequency", "avg_transfer_amount",
                    "cashout_proportion", "unique_dest_accounts"),
    "daily_summary": ("type", "step", "transaction_volume", "total_amount", "fraud_count"),
    "clv_scores": ("customerId", "clv_score", "clv_classification", "volume_score",
                   "frequency_score", "diversity_score", "recency_score"),
    "txn_summary_mart": ("customerId", "step", "txn_count", "total_amount", "avg_amount",
                         "max_amount", "fraud_count", "txn_types", "last_balance"),
    "compliance_summary": ("transaction_type", "transaction_count", "transaction_volume",
                           "fraud_count", "fraud_rate_pct", "risk_classification"),
    "customer_fraud_summary": ("customerId", "total_transactions", "total_amount",
                               "confirmed_fraud_count", "fraud_rate_pct"),
    "dormancy_report": ("customerId", "last_active_step", "max_step", "steps_inactive",
                        "txn_history_count", "dormancy_severity"),
    "customer_baseline": ("customerId", "hist_freq_per_12", "all_time_avg_amount"),
    "churn_alerts": ("customerId", "window_start_step", "window_end_step", "signals",
                     "signal_count"),
    "flagged_transactions": tuple(FLAGGED.fieldNames()),
    "transaction_summary": ("transaction_type", "step", "total_volume", "transaction_count",
                            "avg_transaction_amount", "fraud_count"),
    "customer_risk_blend": ("customerId", "segment", "total_transactions", "total_amount",
                            "confirmed_fraud_count", "fraud_rate_pct", "churn_probability",
                            "is_churn_flagged", "churn_signal_count", "clv_score",
                            "clv_classification", "risk_score", "profile_composite_risk",
                            "composite_risk_score"),
    "dim_date": ("step", "event_ts", "date", "hour_of_day", "day_name", "iso_week", "week_start"),
    "dim_transaction_type": ("transaction_type", "type_group"),
    "dim_customer": ("customerId", "segment"),
    "customer_products": ("customerId", "product"),
    "streaming_metrics": ("batch_id", "total_count", "flagged_count", "fraud_rate_pct"),
}
