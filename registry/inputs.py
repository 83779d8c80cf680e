"""Transactions, events, profiles and messages mapped from the driver's tables.

Money is DECIMAL(18,2) here, so that sums are exact in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnloom.operators.graph import graph_from_transactions
from txnloom.sources.graph_files import Graph


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# How order priorities and event types stand for transaction types.
TYPE_OF_PRIORITY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT'
  WHEN '3-MEDIUM' THEN 'PAYMENT' WHEN '4-NOT SPECIFIED' THEN 'CASH_IN' ELSE 'DEBIT' END"""
TYPE_OF_EVENT = """CASE event_type WHEN 'error' THEN 'CASH_OUT' WHEN 'click' THEN 'PAYMENT'
  WHEN 'view' THEN 'CASH_IN' WHEN 'purchase' THEN 'TRANSFER' ELSE 'DEBIT' END"""


def txn(spark: SparkSession, sf_dir: str, balances: bool = False) -> DataFrame:
    """Transactions from orders. Only ``balances`` needs the join with customer."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
        F.expr(TYPE_OF_PRIORITY).alias("type"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.floor("o_totalprice").alias("_whole"))
    if balances:
        held = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"),
            F.greatest(F.col("c_acctbal"), F.lit(0.0)).cast("decimal(18,2)").alias("_held"))
        orders = orders.join(held, "o_custkey", "left").withColumn(
            "newbalanceOrig", (F.coalesce("_held", F.lit(0)) + F.col("o_orderkey") % 1000)
            .cast("decimal(18,2)"))
    old = ["newbalanceOrig", "oldbalanceOrg"] if balances else []
    if balances:
        orders = orders.withColumn("oldbalanceOrg",
                                   (F.col("newbalanceOrig") + F.col("amount")).cast("decimal(18,2)"))
    big = F.col("type").isin("TRANSFER", "CASH_OUT") & (F.col("o_orderstatus") == "F") & (
        F.col("amount") > 300000)
    odd = (F.col("type") == "PAYMENT") & (F.col("o_orderkey") % 40 == 0)
    return orders.select(
        (F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")) % 168 + 1)
        .cast("int").alias("step"),
        "type", "amount",
        F.concat(F.when(F.col("o_custkey") % 25 == 7, "M").otherwise("C"),
                 F.col("o_custkey").cast("string")).alias("nameOrig"),
        F.concat(F.when(F.col("type").isin("PAYMENT", "DEBIT"), "M").otherwise("C"),
                 (F.col("_whole") % 4001).cast("string")).alias("nameDest"),
        *old,
        F.lit(0).cast("decimal(18,2)").alias("oldbalanceDest"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.col("amount"))
        .cast("decimal(18,2)").alias("newbalanceDest"),
        F.when(big | odd, 1).otherwise(0).alias("isFraud"),
        F.when((F.col("type") == "TRANSFER") & (F.col("amount") > 200000), 1).otherwise(0)
        .alias("isFlaggedFraud"),
        F.concat(F.lit("TXN"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("txnId"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ingest_ts"),
        F.col("o_orderkey").alias("row_no"))


def evt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account activity from events; the event id stands for the arrival offset."""
    hours = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp"))
                     - F.lit(1704067200)) / F.lit(3600))
    return table(spark, sf_dir, "events").select(
        (hours + 1).cast("int").alias("step"),
        F.expr(TYPE_OF_EVENT).alias("type"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        (F.col("value").cast("decimal(18,2)") * 10).cast("decimal(18,2)").alias("newbalanceOrig"),
        F.col("event_id").alias("kafka_offset"))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer profile documents from customer."""
    return table(spark, sf_dir, "customer").filter("c_custkey % 25 <> 7").selectExpr(
        "concat('C', cast(c_custkey as string)) AS customerId",
        """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Premium' WHEN 'BUILDING' THEN 'Standard'
           WHEN 'FURNITURE' THEN 'Basic' WHEN 'HOUSEHOLD' THEN 'Private Banking'
           ELSE 'Student' END AS segment""",
        "concat('N', cast(c_nationkey as string)) AS country",
        "cast(20 + c_custkey % 60 as int) AS age",
        "cast(c_custkey % 320 * 1000 as double) AS annualIncome",
        "cast(c_custkey % 4 as int) AS productCount",
        "CASE WHEN c_custkey % 5 = 0 THEN 'pending' ELSE 'verified' END AS kyc_status",
        """CASE c_nationkey % 3 WHEN 0 THEN 'branch' WHEN 1 THEN 'mobile' ELSE 'web' END
           AS preferred_channel""",
        "c_custkey % 3 <> 0 AS email_verified",
        "c_custkey % 10 <> 0 AS is_active",
        "cast(c_custkey % 101 as double) / 100 AS risk_score",
        "(c_acctbal + 1000) / 11000 AS churn_probability",
        "cast(c_custkey % 37 as double) / 37 AS composite_risk_score",
        "'2020-01-01' AS account_opened",
        "'2023-01-07' AS last_transaction_date",
        """slice(array('savings', 'card', 'loan', 'broker'), 1, cast(c_custkey % 4 as int))
           AS products""")


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Payment graph in which some receiving accounts are unknown."""
    g = graph_from_transactions(txn(spark, sf_dir))
    number = F.substring("accountId", 2, 20).cast("long")
    known = ~(F.col("accountId").startswith("C") & (number % 17 == 3))
    return Graph(g.accounts.filter(known), g.transactions, g.sent, g.received)


# Text of one message; every 97th is broken in one of nine ways.
_BODY = """concat(
  '{"step":', CASE WHEN kind = 1 THEN concat('"', cast(step as string), '"')
    WHEN kind = 8 THEN '5000000000' ELSE cast(step as string) END,
  ',"type":"', CASE WHEN kind = 3 THEN 'BOGUS' ELSE type END,
  '","amount":', CASE WHEN kind = 6 THEN '"much"' ELSE cast(amount as string) END,
  ',"nameOrig":"', CASE WHEN kind = 4 THEN '' ELSE nameOrig END,
  '","oldbalanceOrg":', cast(oldbalanceOrg as string),
  ',"newbalanceOrig":', cast(newbalanceOrig as string),
  ',"nameDest":"', nameDest,
  '","oldbalanceDest":', cast(oldbalanceDest as string),
  ',"newbalanceDest":', cast(newbalanceDest as string),
  ',"isFraud":', CASE WHEN kind = 5 THEN concat(cast(isFraud as string), '.0') ELSE cast(isFraud as string) END,
  ',"isFlaggedFraud":', CASE WHEN kind = 7 THEN 'true' ELSE cast(isFlaggedFraud as string) END,
  CASE WHEN kind = 2 THEN '' ELSE concat(',"txnId":"', txnId, '"') END,
  ',"ingest_ts":"', ingest_ts, CASE WHEN kind = 0 THEN '"' ELSE '"}' END)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages of the transactions: half in an envelope, a few broken."""
    rows = txn(spark, sf_dir, balances=True).withColumn(
        "kind", F.expr("CASE WHEN row_no % 97 = 0 THEN row_no div 97 % 9 ELSE -1 END"))
    return rows.withColumn("body", F.expr(_BODY)).selectExpr(
        "nameOrig AS key",
        """CASE WHEN row_no % 2 = 0 THEN concat('{"schema":{"type":"struct"},"payload":', body, '}')
           ELSE body END AS value""",
        "cast(row_no % 4 as int) AS partition", "row_no AS offset",
        "cast(null as timestamp) AS timestamp")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows as a CSV delivers them; every 97th is broken or oddly written."""
    rows = txn(spark, sf_dir, balances=True).withColumn(
        "kind", F.expr("CASE WHEN row_no % 97 = 0 THEN row_no div 97 % 7 ELSE -1 END"))
    return rows.selectExpr(
        """CASE WHEN kind = 3 THEN 'abc' WHEN kind = 5 THEN concat(' ', cast(step as string), '.0 ')
           ELSE cast(step as string) END AS step""",
        "CASE WHEN kind = 0 THEN 'BOGUS' WHEN kind = 6 THEN concat(' ', type) ELSE type END AS type",
        "CASE WHEN kind = 1 THEN '-5' ELSE cast(amount as string) END AS amount",
        "CASE WHEN kind = 4 THEN null ELSE nameOrig END AS nameOrig",
        "cast(oldbalanceOrg as string) AS oldbalanceOrg",
        "cast(newbalanceOrig as string) AS newbalanceOrig",
        "nameDest", "cast(oldbalanceDest as string) AS oldbalanceDest",
        "cast(newbalanceDest as string) AS newbalanceDest",
        "CASE WHEN kind = 2 THEN '2' ELSE cast(isFraud as string) END AS isFraud",
        "cast(isFlaggedFraud as string) AS isFlaggedFraud", "row_no")
