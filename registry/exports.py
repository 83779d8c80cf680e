"""Every dataset of the reporting model exported, compared by content."""

from pyspark.sql import functions as F

from txnloom.operators.dimensions import flag_fraud, flagged_transactions
from txnloom.session import scratch_path
from txnloom.sinks import tables

from .core import QUERIES, query
from .inputs import txn

#: Exported datasets: the query that makes each, and its columns; those marked ``*`` hold fractions.
DATASETS = {
    "dim_date": ("dim_date", "step event_ts date hour_of_day day_name iso_week week_start"),
    "dim_transaction_type": ("dim_transaction_type", "transaction_type type_group n"),
    "dim_customer": ("dim_customer", "customerId segment preferred_channel annualIncome* risk_score* churn_probability* "
                     "profile_composite_risk* clv_score* clv_classification model_risk_score* risk_tier churn_band risk_band "
                     "income_band clv_tier"),
    "customer_products": ("customer_products", "customerId product"),
    "streaming_metrics": ("batch_metrics", "batch_id total_count parsed_count flagged_count fraud_rate_pct*"),
    "transaction_summary": ("transaction_summary", "transaction_type step total_volume* transaction_count avg_transaction_amount* fraud_count"),
    "daily_summary": ("daily_summary", "type step transaction_volume total_amount* fraud_count"),
    "compliance_summary": ("compliance_summary", "transaction_type transaction_count transaction_volume* fraud_count fraud_rate_pct* risk_classification"),
    "dormancy_report": ("dormancy_report", "customerId last_active_step max_step steps_inactive txn_history_count dormancy_severity"),
    "customer_risk_blend": ("customer_risk_blend", "customerId segment total_transactions total_amount* confirmed_fraud_count fraud_rate_pct* "
                            "churn_probability* is_churn_flagged churn_signal_count clv_score* clv_classification risk_score* "
                            "profile_composite_risk* composite_risk_score*"),
    "flagged_transactions": ("flagged_transactions", "txnId step event_ts type amount* nameOrig nameDest newbalanceDest* isFraud isFlaggedFraud false_positive"),
}


def _content(name: str) -> str:
    source, columns = DATASETS[name]
    shown = [f"coalesce(CAST({'CAST(round(' + c[:-1] + ' * 1000000) AS HUGEINT)' if c.endswith('*') else c} AS VARCHAR), chr(0))"
             for c in columns.split()]
    return (f"SELECT '{name}' AS dataset, 'OK' AS status, count(*) AS rows, CAST(coalesce(sum(CAST('0x' || substr(md5("
            f"{(' || chr(31) || ').join(shown)}), 1, 12) AS BIGINT)), 0) AS DECIMAL(38, 0)) AS content FROM ({QUERIES[source].oracle})")


def export(spark, d):
    """Exports all datasets and one that has no input; reads the folders back."""
    root = scratch_path(spark, "exports")
    made = {name: QUERIES[source].plan(spark, d) for name, (source, _) in DATASETS.items()}
    # Their readers need more columns than the queries show.
    whole = {"flagged_transactions": flagged_transactions(
        flag_fraud(txn(spark, d, balances=True))).withColumns({c: F.lit(None).cast("string") for c in ("fraud_rule", "detected_at", "bridged_at")}), "streaming_metrics": made["streaming_metrics"].withColumns(
        {c: F.lit(None).cast("string") for c in ("batch_ts", "app_name", "fraud_rule")})}
    report = tables.export_datasets({**made, **whole, "risk_history": None}, root)
    columns = {n: c.replace("*", "").split() for n, (_, c) in DATASETS.items()}
    return tables.export_manifest(spark, report, root, {n: df.schema for n, df in (made | whole).items()}, columns)


def register() -> None:
    """After all other queries, as the oracle is put together from theirs."""
    oracle = "\nUNION ALL ".join([*map(_content, DATASETS), "SELECT 'risk_history', 'SKIP', NULL, NULL"])
    query("export_set", "K10 V18", oracle)(export)
