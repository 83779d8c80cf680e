"""Named report measures, grouped by the table they aggregate.

Every function takes the grouping columns and returns all measures of its table
at once. Distinct counts come from a first grouping by the counted key, so no
measure multiplies the rows and every aggregate combines before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import safe_ratio, total


def _pct(num: str, den: str):
    return safe_ratio(F.col(num), F.col(den), blank=True) * 100


def flagged_measures(flagged: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    per_txn = flagged.groupBy(*by, "txnId").agg(
        F.sum("amount").alias("amount"),
        F.max(F.when(F.col("isFraud") == 1, 1).otherwise(0)).alias("fraud"),
        F.max("false_positive").alias("fp"))
    return (per_txn.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("flagged_transactions"),
                 total(F.col("amount")).alias("flagged_value"),
                 F.coalesce(F.sum("fraud"), F.lit(0)).alias("confirmed_fraud"),
                 F.coalesce(F.sum("fp"), F.lit(0)).alias("false_positives"))
            .withColumn("false_positive_rate_pct", _pct("false_positives", "flagged_transactions")))


def stream_measures(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return (metrics.groupBy(*by)
            .agg(F.sum("total_count").alias("transactions_processed"),
                 F.sum("flagged_count").alias("flagged_from_metrics"))
            .withColumn("fraud_rate_pct", _pct("flagged_from_metrics", "transactions_processed")))


def fraud_rate_fallback(flagged: DataFrame, summary: DataFrame) -> DataFrame:
    """Rate from the flagged table and the summary, for when there are no stream metrics."""
    seen = summary.agg(F.sum("transaction_count").alias("n")).scalar()
    return (flagged_measures(flagged).select("flagged_transactions")
            .withColumn("transaction_count", seen)
            .withColumn("fraud_rate_pct", _pct("flagged_transactions", "transaction_count")))


def transaction_measures(summary: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``summary`` holds rounded volumes; they are added as exact cents."""
    volume = F.sum(F.col("total_volume").cast("decimal(28,2)")).cast("double")
    return (summary.groupBy(*by)
            .agg(volume.alias("total_volume"),
                 F.sum("transaction_count").alias("transaction_count"),
                 F.sum("fraud_count").alias("fraud_count"))
            .withColumn("fraud_rate_pct", _pct("fraud_count", "transaction_count"))
            .withColumn("avg_transaction_amount",
                        safe_ratio(F.col("total_volume"), F.col("transaction_count"), blank=True)))


def customer_measures(customers: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    averaged = [c for c in ("risk_score", "churn_probability", "clv_score")
                if c in customers.columns]
    flags = {"high_churn": F.col("churn_band") == "High"}
    if "clv_classification" in customers.columns:
        flags["high_value"] = F.col("clv_classification") == "High Value"
    per_customer = customers.groupBy(*by, "customerId").agg(
        *[f(c).alias(f"_{n}_{c}") for c in averaged for n, f in (("s", F.sum), ("n", F.count))],
        *[F.max(F.when(t, 1).otherwise(0)).alias(n) for n, t in flags.items()])
    out = per_customer.groupBy(*by).agg(
        F.count(F.lit(1)).alias("customers"),
        *[(F.sum(f"_s_{c}") / F.nullif(F.sum(f"_n_{c}"), F.lit(0))).alias(f"avg_{c}")
          for c in averaged],
        *[F.coalesce(F.sum(n), F.lit(0)).alias(f"{n}_customers") for n in flags])
    return out.withColumn("churn_rate_pct", _pct("high_churn_customers", "customers"))


def product_measures(products: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    per_customer = products.groupBy(*by, "customerId").agg(F.count(F.lit(1)).alias("n"))
    return per_customer.groupBy(*by).agg(
        F.count(F.lit(1)).alias("customers_holding_product"),
        F.sum("n").alias("product_holdings"))


def avg_products(products: DataFrame, customers: DataFrame) -> DataFrame:
    n = customers.select("customerId").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return (product_measures(products).withColumn("customers", n)
            .withColumn("avg_products_per_customer",
                        safe_ratio(F.col("product_holdings"), F.col("customers"), blank=True)))


def compliance_measures(compliance: DataFrame) -> DataFrame:
    """At most one row per transaction type comes in, so this is small already."""
    high = F.when(F.col("risk_classification") == "High", F.col("transaction_type"))
    return compliance.agg(
        F.round(F.avg("fraud_rate_pct"), 6).cast("double").alias("compliance_fraud_rate_pct"),
        F.count_distinct(high).alias("high_risk_types"))


def dormancy_measures(dormant: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    severity = F.col("dormancy_severity")
    return dormant.groupBy(*by).agg(
        F.count_if(severity == "Dormant").alias("dormant_accounts"),
        F.count_if(severity == "Severely Dormant").alias("severely_dormant_accounts"),
        F.count(F.lit(1)).alias("total_dormant_accounts"))


def account_measures(flagged: DataFrame) -> DataFrame:
    """Flagged count and value per sending account."""
    per_account = flagged_measures(flagged, ("nameOrig",))
    return per_account.select(F.col("nameOrig").alias("customerId"),
                              F.col("flagged_transactions").alias("account_flagged_count"),
                              F.col("flagged_value").alias("account_flagged_value"))


# Measure name -> (table it needs, column of the functions above).
MEASURES = {
    "Flagged Transactions": ("flagged", "flagged_transactions"),
    "Flagged Transaction Value": ("flagged", "flagged_value"),
    "Confirmed Fraud (flagged)": ("flagged", "confirmed_fraud"),
    "False Positives": ("flagged", "false_positives"),
    "False Positive Rate %": ("flagged", "false_positive_rate_pct"),
    "Transactions Processed": ("metrics", "transactions_processed"),
    "Flagged (from metrics)": ("metrics", "flagged_from_metrics"),
    "Fraud Rate %": ("metrics", "fraud_rate_pct"),
    "Total Transaction Volume": ("summary", "total_volume"),
    "Transaction Count": ("summary", "transaction_count"),
    "Summary Fraud Count": ("summary", "fraud_count"),
    "Summary Fraud Rate %": ("summary", "fraud_rate_pct"),
    "Avg Transaction Amount": ("summary", "avg_transaction_amount"),
    "Customers": ("customers", "customers"),
    "Avg Risk Score": ("customers", "avg_risk_score"),
    "Avg Churn Probability": ("customers", "avg_churn_probability"),
    "Avg CLV Score": ("customers", "avg_clv_score"),
    "High Churn Customers": ("customers", "high_churn_customers"),
    "Churn Rate %": ("customers", "churn_rate_pct"),
    "High Value Customers": ("customers", "high_value_customers"),
    "Customers Holding Product": ("products", "customers_holding_product"),
    "Product Holdings": ("products", "product_holdings"),
    "Dormant Accounts": ("dormant", "dormant_accounts"),
    "Severely Dormant Accounts": ("dormant", "severely_dormant_accounts"),
    "Total Dormant Accounts": ("dormant", "total_dormant_accounts"),
}

_TABLES = {"flagged": flagged_measures, "metrics": stream_measures,
           "summary": transaction_measures, "customers": customer_measures,
           "products": product_measures, "dormant": dormancy_measures}


def measure(name: str, table: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One measure of its table, in total or per group; Spark drops what it does not need."""
    source, column = MEASURES[name]
    return _TABLES[source](table, by).select(*by, F.col(column).alias(name))
