"""Transactions: scans, predicates, fraud rule, summaries, mart."""

from pyspark.sql import functions as F

from txnloom.functions import clock, rules
from txnloom.operators import checks, latest, summaries
from txnloom.operators.dimensions import flag_fraud, flagged_transactions

from .core import query
from .inputs import txn


def _plain(df, *money):
    """Money as double at the very end."""
    return df.withColumns({c: F.col(c).cast("double") for c in money or ("amount",)})


@query("transactions_projected", "S4 S6 P7", """
SELECT step, type, CAST(amount AS DOUBLE) AS amount, nameOrig, CAST(newbalanceOrig AS DOUBLE) AS newbalanceOrig,
  nameDest, isFraud
FROM txn WHERE nameOrig IS NOT NULL AND type IS NOT NULL""")
def _(spark, d):
    from txnloom.sources.tables import CORE_COLUMNS
    return _plain(txn(spark, d, balances=True).select(*CORE_COLUMNS).filter(rules.parsed()),
                  "amount", "newbalanceOrig")


@query("flagged_transactions", "P1 P24 P2", """
SELECT txnId, step, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts, type, CAST(amount AS DOUBLE) AS amount,
  nameOrig, nameDest, CAST(newbalanceDest AS DOUBLE) AS newbalanceDest, isFraud, isFlaggedFraud, false_positive
FROM flagged""")
def _(spark, d):
    out = flagged_transactions(flag_fraud(txn(spark, d)))
    return _plain(out.drop("oldbalanceDest"), "amount", "newbalanceDest").withColumn(
        "event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))


@query("rule_conformance", "V12", "SELECT count(*) AS flagged, CAST(0 AS BIGINT) AS violations FROM flagged")
def _(spark, d):
    return checks.rule_violations(flag_fraud(txn(spark, d)))


@query("confirmed_fraud", "P6", """
SELECT txnId, step, type, CAST(amount AS DOUBLE) AS amount, nameOrig, nameDest, isFraud FROM txn WHERE isFraud = 1""")
def _(spark, d):
    return _plain(summaries.fraud_view(txn(spark, d)).select(
        "txnId", "step", "type", "amount", "nameOrig", "nameDest", "isFraud"))


@query("step_times", "P2 P3 P27", """
SELECT txnId, step, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_ts,
  CAST((epoch(ts) - epoch(TIMESTAMP '2023-01-01')) // 3600 + 1 AS INTEGER) AS step_again,
  CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour_of_day, dayname(ts) AS day_name,
  CAST(isoyear(ts) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') AS iso_week,
  CAST(date_trunc('week', ts) AS DATE) AS week_start
FROM (SELECT txnId, step, TIMESTAMP '2023-01-01' + to_hours(step - 1) AS ts FROM txn)""")
def _(spark, d):
    ts = F.col("ts")
    out = txn(spark, d).select("txnId", "step").withColumn("ts", clock.event_ts(F.col("step")))
    return out.select("txnId", "step", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("event_ts"),
                      clock.step_of(ts).alias("step_again"),
                      *[c.alias(n) for n, c in clock.calendar_columns(ts).items()])


@query("customer_steps_in_week", "P4 P5", """
SELECT txnId, nameOrig, step FROM txn WHERE nameOrig LIKE 'C%' AND step BETWEEN 25 AND 120""")
def _(spark, d):
    return txn(spark, d).filter(rules.is_customer(F.col("nameOrig"))
                                & rules.in_step_window(F.col("step"), 25, 120)).select(
        "txnId", "nameOrig", "step")


@query("amount_bands", "P22 P23", """
SELECT type, CASE WHEN type = 'CASH_IN' THEN 'inflow' ELSE 'outflow' END AS type_group,
  CASE WHEN amount >= 1000000 THEN '1M+' WHEN amount >= 500000 THEN '500k-1M'
    WHEN amount >= 200000 THEN '200-500k' ELSE '<200k' END AS amount_band, count(*) AS n
FROM txn GROUP BY ALL""")
def _(spark, d):
    return (txn(spark, d).groupBy("type", rules.type_group(F.col("type")).alias("type_group"),
                                  rules.amount_band(F.col("amount")).alias("amount_band"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("daily_summary", "A6", """
SELECT type, step, count(*) AS transaction_volume, CAST(sum(amount) AS DOUBLE) AS total_amount,
  CAST(sum(isFraud) AS BIGINT) AS fraud_count FROM txn GROUP BY type, step""")
def _(spark, d):
    return summaries.daily_summary(txn(spark, d))


@query("compliance_summary", "A7 P13 P28", """
SELECT transaction_type, transaction_count, transaction_volume, fraud_count, fraud_rate_pct,
  risk_classification FROM compliance""")
def _(spark, d):
    return summaries.compliance_summary(txn(spark, d))


@query("compliance_report", "T1 B12", """
SELECT transaction_type, transaction_count, transaction_volume, fraud_count, fraud_rate_pct,
  risk_classification FROM compliance ORDER BY transaction_type""")
def _(spark, d):
    return summaries.report_order(summaries.compliance_summary(txn(spark, d)), "compliance_summary")


@query("customer_fraud_summary", "A8", "SELECT * FROM fraud_summary")
def _(spark, d):
    return summaries.customer_fraud_summary(txn(spark, d)).withColumn(
        "fraud_rate_pct", F.col("fraud_rate_pct").cast("double"))


@query("customer_fraud_summary_ordered", "T1", """
SELECT * FROM fraud_summary ORDER BY confirmed_fraud_count DESC, total_amount DESC, customerId""")
def _(spark, d):
    return summaries.report_order(
        summaries.customer_fraud_summary(txn(spark, d)).withColumn(
            "fraud_rate_pct", F.col("fraud_rate_pct").cast("double")), "customer_fraud_summary")


@query("dormancy_report", "A9 P14 J2", "SELECT * FROM dormant")
def _(spark, d):
    return summaries.dormancy_report(txn(spark, d))


@query("transaction_summary", "A11", "SELECT * FROM summary")
def _(spark, d):
    return summaries.transaction_summary(txn(spark, d))


@query("txn_summary_mart", "A10 J3 T5", "SELECT * FROM mart")
def _(spark, d):
    return _plain(summaries.txn_summary_mart(txn(spark, d, balances=True)), "last_balance")


@query("mart_top5", "T2", """
SELECT * FROM mart ORDER BY total_amount DESC, customerId, step LIMIT 5""")
def _(spark, d):
    return _plain(summaries.top(summaries.txn_summary_mart(txn(spark, d, balances=True)),
                                "txn_summary_mart", 5), "last_balance")


@query("latest_in_step", "W1", """
SELECT nameOrig, step, txnId, CAST(newbalanceOrig AS DOUBLE) AS last_balance FROM (
  SELECT *, row_number() OVER (PARTITION BY nameOrig, step ORDER BY ingest_ts DESC, txnId DESC) AS rn FROM txn)
WHERE rn = 1""")
def _(spark, d):
    rows = txn(spark, d, balances=True).select("nameOrig", "step", "txnId", "ingest_ts", "newbalanceOrig")
    return latest.latest_by(rows, ["nameOrig", "step"], ["ingest_ts", "txnId"]).select(
        "nameOrig", "step", "txnId", F.col("newbalanceOrig").cast("double").alias("last_balance"))


@query("latest_per_account", "W2", """
SELECT nameOrig, txnId, row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY nameOrig ORDER BY row_no DESC) AS rn FROM txn) WHERE rn = 1""")
def _(spark, d):
    return latest.latest_by(txn(spark, d).select("nameOrig", "txnId", "row_no"), ["nameOrig"], ["row_no"])


@query("rolling_flagged", "T3", """
SELECT k AS txnId, first_arrival, CAST(amount AS DOUBLE) AS amount FROM (
  SELECT *, min(row_no) OVER (PARTITION BY k) AS first_arrival,
    row_number() OVER (PARTITION BY k ORDER BY row_no DESC) AS rn
  FROM (SELECT 'K' || CAST(row_no % 4999 AS VARCHAR) AS k, * FROM flagged)) WHERE rn = 1
ORDER BY first_arrival DESC, k DESC LIMIT 500""")
def _(spark, d):
    """Keys repeat on purpose, so that updates keep their first place."""
    rows = flag_fraud(txn(spark, d)).select(
        F.concat(F.lit("K"), (F.col("row_no") % 4999).cast("string")).alias("txnId"), "row_no", "amount")
    return _plain(latest.rolling_latest(rows, "txnId", "row_no", 500))


@query("dedup_ids", "P26", """
SELECT step, CASE WHEN row_no % 3 = 0 THEN txnId WHEN row_no % 3 = 1 THEN 'B' || row_no ELSE 'C' || row_no END
  AS dedup_id
FROM txn WHERE row_no % 11 <> 0 AND row_no % 13 <> 0""")
def _(spark, d):
    """Ids spread over three spellings; some rows have none, some lack a step."""
    no = F.col("row_no")
    rows = txn(spark, d).select(
        F.when(no % 13 != 0, F.col("step")).alias("step"),
        F.when(no % 11 != 0, F.when(no % 3 == 0, F.col("txnId"))).alias("txnId"),
        F.when((no % 11 != 0) & (no % 3 == 1), F.concat(F.lit("B"), no.cast("string"))).alias("txn_id_alt"),
        F.when((no % 11 != 0) & (no % 3 == 2), F.concat(F.lit("C"), no.cast("string"))).alias("id"))
    return latest.with_dedup_id(rows, ("txnId", "txn_id_alt", "id")).select("step", "dedup_id")


@query("reconciliation", "V13", """
SELECT unnest(['mart rows are unique per customer and step', 'mart transactions equal base',
    'mart fraud equals base', 'fraud view equals base fraud', 'summary transactions equal base',
    'summary fraud equals base']) AS "check",
  unnest([m.rows_, m.txns, m.fraud, b.fraud, s.n, s.fraud]) AS actual,
  unnest([m.keys_, b.n, b.fraud, b.fraud, b.n, b.fraud]) AS expected, TRUE AS ok
FROM (SELECT count(*) AS n, count(*) FILTER (isFraud = 1) AS fraud FROM txn) b,
  (SELECT count(*) AS rows_, count(DISTINCT (customerId, step)) AS keys_, CAST(sum(txn_count) AS BIGINT) AS txns,
     CAST(sum(fraud_count) AS BIGINT) AS fraud FROM mart) m,
  (SELECT CAST(sum(transaction_count) AS BIGINT) AS n, CAST(sum(fraud_count) AS BIGINT) AS fraud FROM summary) s""")
def _(spark, d):
    t = txn(spark, d, balances=True)
    return checks.reconcile(t, summaries.txn_summary_mart(t), summaries.fraud_view(t),
                            summaries.transaction_summary(t))


@query("safe_ratios", "P21", """
SELECT type, step, CASE WHEN n = 0 THEN 0.0 ELSE CAST(fraud_volume AS DOUBLE) / n END AS avg_fraud_amount,
  CAST(fraud_volume AS DOUBLE) / nullif(n, 0) AS avg_or_blank
FROM (SELECT type, step, count(*) FILTER (isFraud = 1) AS n,
  coalesce(sum(amount) FILTER (isFraud = 1), 0) AS fraud_volume FROM txn GROUP BY type, step)""")
def _(spark, d):
    fraud = rules.confirmed_fraud()
    per = txn(spark, d).groupBy("type", "step").agg(
        F.count_if(fraud).alias("n"),
        F.coalesce(F.sum(F.when(fraud, F.col("amount"))), F.lit(0)).alias("v"))
    return per.select("type", "step",
                      rules.safe_ratio(F.col("v"), F.col("n")).alias("avg_fraud_amount"),
                      rules.safe_ratio(F.col("v"), F.col("n"), blank=True).alias("avg_or_blank"))


@query("batch_metrics", "A18 ST9", """
SELECT batch_id, total_count, total_count AS parsed_count, flagged_count,
  CAST(flagged_count AS DOUBLE) / total_count * 100 AS fraud_rate_pct FROM metric""")
def _(spark, d):
    from txnloom.streaming.fraud import batch_metrics
    return batch_metrics(txn(spark, d).withColumn("batch_id", F.col("row_no") % 8), by=("batch_id",))
