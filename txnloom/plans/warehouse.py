"""Catalog layout of the warehouse, rebuilt from landed data."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.summaries import txn_summary_mart
from ..schemas import TXN
from ..sinks import tables
from ..streaming.landing import landed_log

# Stored columns of the tables that other jobs fill.
CLV_COLUMNS = """customerId STRING, clv_score DOUBLE, clv_classification STRING, total_amount DOUBLE,
txn_count BIGINT, distinct_txn_types BIGINT, last_step INT, steps_since_last_txn INT,
volume_score DOUBLE, frequency_score DOUBLE, diversity_score DOUBLE, recency_score DOUBLE,
scored_at TIMESTAMP"""
FRAUD_SUMMARY_COLUMNS = """customerId STRING, total_transactions BIGINT, total_amount DOUBLE,
confirmed_fraud_count BIGINT, fraud_rate_pct DECIMAL(31,6)"""


def landed_parts(spark: SparkSession, raw_path: str) -> set[str | None]:
    """Names of the folder columns inside the newest landed batches."""
    return {tables.folder_column(spark, f) for f in landed_log(raw_path).folders(spark)}


def build_warehouse(spark: SparkSession, db: str, raw_path: str, clv_path: str | None = None,
                    fraud_summary_path: str | None = None, location: str | None = None,
                    statistics: bool = True) -> list[str]:
    """Create the database, its tables, the fraud view and the mart; returns their names."""
    tables.create_database(spark, db, location)
    txns, made = f"{db}.transactions", []
    if tables.folder_column(spark, raw_path) == "log":
        # Landed by the stream: the table follows its log, and a later run adds what is new.
        by = "day" if "day" in landed_parts(spark, raw_path) else "step"
        tables.batch_table(spark, txns, landed_log(raw_path, by), "landed transactions")
    else:
        tables.external_table(spark, txns, TXN.toDDL(), raw_path, "landed transactions")
    tables.fraud_view_over(spark, f"{db}.vw_fraud_transactions", txns)
    tables.overwrite_table(txn_summary_mart(spark.table(txns)), f"{db}.txn_summary_mart")
    made += [txns, f"{db}.vw_fraud_transactions", f"{db}.txn_summary_mart"]
    for name, columns, path in (("customer_clv", CLV_COLUMNS, clv_path),
                                ("customer_fraud_summary", FRAUD_SUMMARY_COLUMNS, fraud_summary_path)):
        if path:
            tables.external_table(spark, f"{db}.{name}", columns, path)
            made.append(f"{db}.{name}")
    if statistics:
        tables.analyze(spark, txns)
        tables.analyze(spark, f"{db}.txn_summary_mart", columns=True)
        if clv_path:
            tables.analyze(spark, f"{db}.customer_clv")
    return made
