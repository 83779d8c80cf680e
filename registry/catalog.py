"""Stored datasets: written by the sinks, read back by the sources."""

import uuid

from pyspark.sql import functions as F

from txnloom.operators import graph as g, ingest, summaries
from txnloom.plans.warehouse import build_warehouse
from txnloom.schemas import CSV_COLUMNS, PROFILE, TXN, TXN_COLUMNS
from txnloom.session import scratch_path
from txnloom.sinks import tables
from txnloom.sources import load_transactions, read_graph, read_profiles
from txnloom.sources.graph_files import HEADERS
from txnloom.sources.tables import read_csv_text

from .core import query
from .inputs import graph, profile, raw_rows, txn


def _stored(df):
    """Columns and types of the stored transactions."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in TXN.fields])


_PER_STEP = """
SELECT type, step, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount, CAST(sum(isFraud) AS BIGINT) AS fraud
FROM txn GROUP BY type, step"""


def _per_step(df):
    return df.groupBy("type", "step").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount"),
        F.sum("isFraud").alias("fraud"))


@query("csv_round_trip", "S3 K5", _PER_STEP)
def _(spark, d):
    path = scratch_path(spark, "csv")
    tables.write_csv(_stored(txn(spark, d, balances=True)).select(*CSV_COLUMNS), path)
    return _per_step(load_transactions(spark, "csv", path, exact_money=True))


@query("step_folders", "S4 K2", _PER_STEP + " HAVING step BETWEEN 10 AND 40")
def _(spark, d):
    path = scratch_path(spark, "steps")
    rows = _stored(txn(spark, d, balances=True))
    tables.write_parquet(rows, path, ("step",))
    return _per_step(load_transactions(spark, "parquet", path, exact_money=True).filter("step BETWEEN 10 AND 40"))


@query("catalog_mart", "S5 K8 K9", """
SELECT customerId, step, txn_count, round(total_amount, 2) AS total_amount, fraud_count, txn_types, last_balance FROM mart""")
def _(spark, d):
    root, db = scratch_path(spark, "warehouse"), f"txnloom_{uuid.uuid4().hex[:12]}"
    _stored(txn(spark, d, balances=True)).write.parquet(f"{root}/raw")
    build_warehouse(spark, db, f"{root}/raw", location=f"{root}/db")
    return spark.table(f"{db}.txn_summary_mart").select(
        "customerId", "step", "txn_count", F.round("total_amount", 2).alias("total_amount"), "fraud_count", "txn_types",
        "last_balance")


@query("landed_mart", "K7 K8", "SELECT * FROM landed_mart")
def _(spark, d):
    """Messages landed by the stream, the warehouse built on those folders."""
    from .streams import land
    root, db = scratch_path(spark, "landed"), f"txnloom_{uuid.uuid4().hex[:12]}"
    land(spark, d, root)
    build_warehouse(spark, db, f"{root}/table", location=f"{root}/db")
    return spark.table(f"{db}.txn_summary_mart").select(
        "customerId", "step", "txn_count", F.round("total_amount", 2).alias("total_amount"), "fraud_count", "last_balance")


@query("fraud_view", "P6 K8 V18", """
SELECT txnId, type, CAST(amount AS DOUBLE) AS amount FROM txn WHERE isFraud = 1""")
def _(spark, d):
    from txnloom.operators.checks import missing_columns
    from txnloom.sources import SourceError
    root, db = scratch_path(spark, "view"), f"txnloom_{uuid.uuid4().hex[:12]}"
    _stored(txn(spark, d, balances=True)).write.parquet(f"{root}/raw")
    build_warehouse(spark, db, f"{root}/raw", location=f"{root}/db", statistics=False)
    view = spark.table(f"{db}.vw_fraud_transactions")
    if missing_columns(view, "transactions"):
        raise SourceError("the view lost columns")
    return view.select("txnId", "type", "amount")


@query("profile_documents", "S7", """
SELECT customerId, segment, preferred_channel, risk_score, is_active, n_products AS held FROM profile""")
def _(spark, d):
    path = scratch_path(spark, "profiles")
    profile(spark, d).write.json(path)
    return read_profiles(spark, path).select(
        *[c for c in ("customerId", "segment", "preferred_channel", "risk_score", "is_active") if c in PROFILE.names],
        F.size("products").cast("long").alias("held"))


@query("graph_files", "S8", "SELECT * FROM ring WHERE distinct_senders > 3")
def _(spark, d):
    net, root = graph(spark, d), scratch_path(spark, "graph")
    columns = {"accounts": ("accountId", "accountType"), "transactions": ("txnId", "step", "type", "amount", "isFraud"),
               "sent": ("accountId", "txnId", "amount", "step", "transactionType"),
               "received": ("txnId", "accountId", "newbalanceDest", "isFraud")}
    for kind, names in columns.items():
        part = getattr(net, kind).select(*[F.col(c).alias(h) for c, h in zip(names, HEADERS[kind])])
        tables.write_csv(part, f"{root}/{kind}")
    return g.fraud_rings(read_graph(spark, {k: f"{root}/{k}" for k in columns}))


@query("single_csv_report", "K6", """
SELECT transaction_type, transaction_count, transaction_volume, fraud_count, fraud_rate_pct, risk_classification
FROM compliance""")
def _(spark, d):
    path = scratch_path(spark, "report") + ".csv"
    tables.write_single_csv(summaries.compliance_summary(txn(spark, d)), path)
    return spark.read.option("header", True).schema(
        "transaction_type string, transaction_count long, transaction_volume double, fraud_count long, "
        "fraud_rate_pct double, risk_classification string").csv(path)


@query("csv_ingest", "V1 V3 V4 V7 S3", """
SELECT 'TXN' || lpad(CAST(seq AS VARCHAR), 9, '0') AS txnId, step, type, CAST(amount AS DOUBLE) AS amount, nameOrig, nameDest, TRUE AS stamped
FROM (SELECT *, row_number() OVER (ORDER BY row_no) AS seq FROM raw_row) WHERE kind NOT IN (0, 1, 2, 3, 4)""")
def _(spark, d):
    """Text rows from CSV files in the order of their rows, numbered by their place, validated and stamped."""
    path = scratch_path(spark, "ingest")
    tables.write_csv(raw_rows(spark, d).repartitionByRange(8, "row_no").sortWithinPartitions("row_no").select(*CSV_COLUMNS), path)
    good, _ = ingest.validate_rows(ingest.with_txn_ids(read_csv_text(spark, path)))
    records = ingest.to_records(ingest.stamp_ingest(good)).select(*TXN_COLUMNS)
    stamped = F.col("ingest_ts").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}")
    return records.select("txnId", "step", "type", "amount", "nameOrig", "nameDest", stamped.alias("stamped"))
