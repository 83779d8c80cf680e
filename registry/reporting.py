"""Blend, dimensions, measures and report queries."""

from pyspark.sql import functions as F

from txnloom.functions import rules
from txnloom.operators import blend, checks, dimensions, scoring, summaries
from txnloom.plans import measures, reports
from txnloom.plans.reports import Slicers

from .churning import alerts
from .core import query
from .inputs import profile, txn


def _flagged(spark, d):
    t = txn(spark, d)
    return dimensions.flagged_transactions(dimensions.flag_fraud(t))


def _summary(spark, d):
    return summaries.transaction_summary(txn(spark, d))


def _customers(spark, d):
    t = txn(spark, d)
    scores = scoring.customer_scores(t)
    return dimensions.dim_customer(profile(spark, d), scores, scores)


def _customers_clv(spark, d):
    return dimensions.dim_customer(profile(spark, d), scoring.clv_scores(txn(spark, d)))


def _customers_only(spark, d):
    return dimensions.dim_customer(profile(spark, d))


def _products(spark, d):
    return dimensions.customer_products(profile(spark, d))


def _metrics(spark, d):
    from txnloom.streaming.fraud import batch_metrics
    return batch_metrics(txn(spark, d).withColumn("batch_id", F.col("row_no") % 8), by=("batch_id",))


_BLEND = """
SELECT f.customerId, p.segment, total_transactions, f.total_amount, confirmed_fraud_count, fraud_rate_pct,
  churn_probability, CASE WHEN coalesce(a.n, 0) > 0 THEN 1 ELSE 0 END AS is_churn_flagged,
  coalesce(a.n, 0) AS churn_signal_count, clv_score, clv_classification, risk_score,
  p.composite_risk_score AS profile_composite_risk,
  round({0} * 0.6::DOUBLE + churn_probability * 0.4::DOUBLE, 6) AS composite_risk_score
FROM fraud_summary f JOIN profile p USING (customerId) LEFT JOIN clv USING (customerId)
LEFT JOIN (SELECT customerId, max(signal_count) AS n FROM alert GROUP BY customerId) a USING (customerId)"""


def _blend(spark, d, normalize=False):
    t = txn(spark, d)
    fraud = summaries.customer_fraud_summary(t)
    return blend.customer_risk_blend(fraud, profile(spark, d), scoring.clv_scores(t), alerts(spark, d),
                                     normalize=normalize).withColumn(
        "fraud_rate_pct", F.col("fraud_rate_pct").cast("double"))


@query("customer_risk_blend", "J4 J5 J6 P20", _BLEND.format("fraud_rate_pct"))
def _(spark, d):
    return _blend(spark, d)


@query("customer_risk_blend_normalised", "P20", _BLEND.format("(fraud_rate_pct / 100.0::DOUBLE)"))
def _(spark, d):
    return _blend(spark, d, normalize=True)


@query("blend_fan_out", "V17", """
SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS missing_keys, count(*) AS distinct_keys,
  CAST(0 AS BIGINT) AS repeated_keys FROM fraud_summary JOIN profile USING (customerId)""")
def _(spark, d):
    return checks.key_check(_blend(spark, d), "customerId")


# -- dimensions ---------------------------------------------------------------

_DIM_DATE = """
SELECT CAST(step AS INTEGER) AS step, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_ts, CAST(ts AS DATE) AS date,
  CAST(hour(ts) AS INTEGER) AS hour_of_day, dayname(ts) AS day_name,
  CAST(isoyear(ts) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') AS iso_week,
  CAST(date_trunc('week', ts) AS DATE) AS week_start
FROM (SELECT step, TIMESTAMP '2023-01-01' + to_hours(CAST(step - 1 AS INTEGER)) AS ts
  FROM (SELECT unnest(range(1, max(step) + 1)) AS step FROM txn))"""


@query("dim_date", "T7 P27", _DIM_DATE)
def _(spark, d):
    return dimensions.dim_date_of(txn(spark, d)).withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))


@query("dim_transaction_type", "T7 P23", """
SELECT type AS transaction_type, CASE WHEN type = 'CASH_IN' THEN 'inflow' ELSE 'outflow' END AS type_group,
  count(*) AS n FROM txn GROUP BY type""")
def _(spark, d):
    """The type dimension with the number of transactions of each type."""
    used = txn(spark, d).groupBy(F.col("type").alias("transaction_type")).agg(F.count(F.lit(1)).alias("n"))
    return dimensions.dim_transaction_type(spark).join(used, "transaction_type")


@query("dim_customer", "J5 J7 P22", """
SELECT customerId, segment, preferred_channel, annualIncome, risk_score, churn_probability,
  composite_risk_score AS profile_composite_risk, clv_score, clv_classification, model_risk_score, risk_tier,
  churn_band, risk_band, income_band, clv_tier FROM dim_customer""")
def _(spark, d):
    return _customers(spark, d).select(
        "customerId", "segment", "preferred_channel", "annualIncome", "risk_score", "churn_probability",
        "profile_composite_risk", "clv_score", "clv_classification", "model_risk_score", "risk_tier",
        "churn_band", "risk_band", "income_band", "clv_tier")


@query("customer_products", "T4", "SELECT * FROM product")
def _(spark, d):
    return _products(spark, d)


@query("star_flagged", "J10", """
SELECT txnId, type, CASE WHEN type = 'CASH_IN' THEN 'inflow' ELSE 'outflow' END AS type_group,
  CAST(event_ts AS DATE) AS date, CAST(date_trunc('week', event_ts) AS DATE) AS week_start,
  nameOrig, c.segment, c.risk_tier, CAST(amount AS DOUBLE) AS amount
FROM flagged f LEFT JOIN dim_customer c ON c.customerId = f.nameOrig""")
def _(spark, d):
    t = txn(spark, d)
    return dimensions.star(_flagged(spark, d), dimensions.dim_date_of(t), dimensions.dim_transaction_type(spark),
                           _customers(spark, d)).select(
        "txnId", "type", "type_group", "date", "week_start", "nameOrig", "segment", "risk_tier",
        F.col("amount").cast("double").alias("amount"))


@query("customers_with_product", "J11", """
SELECT customerId, segment FROM profile WHERE n_products >= 3""")
def _(spark, d):
    return dimensions.customers_with_product(_customers_only(spark, d), _products(spark, d), "loan", "broker").select(
        "customerId", "segment")


@query("orphan_facts", "J12", """
SELECT txnId, nameOrig FROM flagged WHERE nameOrig NOT IN (SELECT customerId FROM profile)""")
def _(spark, d):
    return dimensions.orphan_facts(_flagged(spark, d), profile(spark, d), "nameOrig", "customerId").select(
        "txnId", "nameOrig")


@query("dormancy_flags", "P22", """
SELECT customerId, dormancy_severity, CASE WHEN dormancy_severity = 'Severely Dormant' THEN 1 ELSE 0 END AS is_severe
FROM dormant""")
def _(spark, d):
    return summaries.dormancy_report(txn(spark, d)).select(
        "customerId", "dormancy_severity", rules.is_severe(F.col("dormancy_severity")).alias("is_severe"))


# -- measures -----------------------------------------------------------------

_FLAG_MEASURES = """count(DISTINCT txnId) AS flagged_transactions, CAST(sum(amount) AS DOUBLE) AS flagged_value,
  count(DISTINCT txnId) FILTER (isFraud = 1) AS confirmed_fraud,
  count(DISTINCT txnId) FILTER (false_positive = 1) AS false_positives,
  CAST(count(DISTINCT txnId) FILTER (false_positive = 1) AS DOUBLE) / count(DISTINCT txnId) * 100
    AS false_positive_rate_pct"""


@query("measures_flagged", "M1 M2 M3 M4 M5", f"SELECT {_FLAG_MEASURES} FROM flagged")
def _(spark, d):
    return measures.flagged_measures(_flagged(spark, d))


@query("measures_flagged_by_type", "M1 M2 M3 M4 M5", f"SELECT type, {_FLAG_MEASURES} FROM flagged GROUP BY type")
def _(spark, d):
    return measures.flagged_measures(_flagged(spark, d), ("type",))


@query("measures_stream", "M6 M7 M8", """
SELECT CAST(sum(total_count) AS BIGINT) AS transactions_processed, CAST(sum(flagged_count) AS BIGINT) AS flagged_from_metrics,
  CAST(sum(flagged_count) AS DOUBLE) / CAST(sum(total_count) AS DOUBLE) * 100 AS fraud_rate_pct FROM metric""")
def _(spark, d):
    return measures.stream_measures(_metrics(spark, d))


@query("measure_fraud_rate_fallback", "M8", """
SELECT (SELECT count(DISTINCT txnId) FROM flagged) AS flagged_transactions,
  CAST(sum(transaction_count) AS BIGINT) AS transaction_count,
  CAST((SELECT count(DISTINCT txnId) FROM flagged) AS DOUBLE) / CAST(sum(transaction_count) AS DOUBLE) * 100
    AS fraud_rate_pct FROM summary""")
def _(spark, d):
    return measures.fraud_rate_fallback(_flagged(spark, d), _summary(spark, d))


@query("measure_daily_flagged", "M9", """
SELECT CAST(event_ts AS DATE) AS date, count(DISTINCT txnId) AS "Flagged Transactions" FROM flagged GROUP BY date""")
def _(spark, d):
    days = _flagged(spark, d).withColumn("date", F.to_date("event_ts"))
    return measures.measure("Flagged Transactions", days, ("date",))


@query("measures_transactions", "M10 M11 M12 M13 M14", """
SELECT CAST(sum(amount) AS DOUBLE) AS total_volume, count(*) AS transaction_count,
  count(*) FILTER (isFraud = 1) AS fraud_count,
  CAST(count(*) FILTER (isFraud = 1) AS DOUBLE) / count(*) * 100 AS fraud_rate_pct,
  CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_amount
FROM txn WHERE step BETWEEN 1 AND 168""")
def _(spark, d):
    return measures.transaction_measures(_summary(spark, d))


@query("measures_customers", "M15 M16 M17 M18", """
SELECT segment, count(*) AS customers, round(avg(risk_score), 9) AS avg_risk_score,
  round(avg(churn_probability), 9) AS avg_churn_probability, round(avg(clv_score), 9) AS avg_clv_score,
  count(*) FILTER (churn_band = 'High') AS high_churn_customers,
  count(*) FILTER (clv_classification = 'High Value') AS high_value_customers,
  CAST(count(*) FILTER (churn_band = 'High') AS DOUBLE) / count(*) * 100 AS churn_rate_pct
FROM dim_customer GROUP BY segment""")
def _(spark, d):
    out = measures.customer_measures(_customers_clv(spark, d), ("segment",))
    return out.withColumns({c: F.round(c, 9) for c in out.columns if c.startswith("avg_")})


@query("measures_products", "M19", """
SELECT (SELECT count(DISTINCT customerId) FROM product) AS customers_holding_product,
  (SELECT count(*) FROM product) AS product_holdings, count(*) AS customers,
  CAST((SELECT count(*) FROM product) AS DOUBLE) / count(*) AS avg_products_per_customer FROM profile""")
def _(spark, d):
    return measures.avg_products(_products(spark, d), _customers_only(spark, d))


@query("measures_compliance", "M20 M21", """
SELECT round(avg(fraud_rate_pct), 6) AS compliance_fraud_rate_pct,
  count(DISTINCT transaction_type) FILTER (risk_classification = 'High') AS high_risk_types FROM compliance""")
def _(spark, d):
    return measures.compliance_measures(summaries.compliance_summary(txn(spark, d)))


@query("measures_dormancy", "M22", """
SELECT count(*) FILTER (dormancy_severity = 'Dormant') AS dormant_accounts,
  count(*) FILTER (dormancy_severity = 'Severely Dormant') AS severely_dormant_accounts,
  count(*) AS total_dormant_accounts FROM dormant""")
def _(spark, d):
    return measures.dormancy_measures(summaries.dormancy_report(txn(spark, d)))


@query("measures_accounts", "M23", """
SELECT nameOrig AS customerId, count(DISTINCT txnId) AS account_flagged_count,
  CAST(sum(amount) AS DOUBLE) AS account_flagged_value FROM flagged GROUP BY nameOrig""")
def _(spark, d):
    return measures.account_measures(_flagged(spark, d))


# -- report visuals -----------------------------------------------------------

_TREND = """
SELECT date, CAST(sum(n) AS BIGINT) AS transaction_count, CAST(sum(fr) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100 AS fraud_rate_pct,
  CAST(sum(fl) AS BIGINT) AS flagged_transactions
FROM (SELECT CAST(TIMESTAMP '2023-01-01' + to_hours(step - 1) AS DATE) AS date, 1 AS n, isFraud AS fr,
  CASE WHEN type IN ('TRANSFER', 'CASH_OUT') AND amount > 200000 AND newbalanceDest = 0 THEN 1 ELSE 0 END AS fl
  FROM txn {0}) GROUP BY date"""


@query("report_daily_fraud_trend", "B1", _TREND.format(""))
def _(spark, d):
    return reports.daily_fraud_trend(_flagged(spark, d), _summary(spark, d))


@query("report_daily_fraud_trend_sliced", "B13", _TREND.format(
    "WHERE type IN ('TRANSFER', 'PAYMENT') AND step BETWEEN 25 AND 120"))
def _(spark, d):
    s = Slicers(date_from="2023-01-02", date_to="2023-01-05", types=("TRANSFER", "PAYMENT"))
    return reports.daily_fraud_trend(_flagged(spark, d), _summary(spark, d), s)


@query("report_flagged_by_type", "B2", """
SELECT type, count(DISTINCT txnId) AS flagged_transactions FROM flagged GROUP BY type""")
def _(spark, d):
    return reports.flagged_by_type(_flagged(spark, d))


@query("report_recent_flagged", "B3 T2", """
SELECT strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts, txnId, type, CAST(amount AS DOUBLE) AS amount, nameOrig,
  nameDest, CAST(newbalanceDest AS DOUBLE) AS newbalanceDest, isFraud, false_positive
FROM flagged ORDER BY event_ts DESC, txnId DESC LIMIT 100""")
def _(spark, d):
    """The event time stands for the time of detection, which is not reproducible."""
    return reports.recent_flagged(_flagged(spark, d), newest="event_ts").withColumns({
        "event_ts": F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"),
        "amount": F.col("amount").cast("double"), "newbalanceDest": F.col("newbalanceDest").cast("double")})


@query("report_risk_vs_churn", "B4", """
SELECT segment, round(avg(risk_score), 9) AS avg_risk_score, round(avg(churn_probability), 9) AS avg_churn_probability,
  round(avg(clv_score), 9) AS avg_clv_score, count(*) AS customers FROM dim_customer GROUP BY segment""")
def _(spark, d):
    out = reports.risk_vs_churn(_customers_clv(spark, d))
    return out.withColumns({c: F.round(c, 9) for c in out.columns if c.startswith("avg_")})


@query("report_segment_share", "B5 W3", """
SELECT segment, count(*) AS customers, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS share_pct
FROM profile GROUP BY segment""")
def _(spark, d):
    return reports.segment_share(_customers_only(spark, d))


@query("report_churn_matrix", "B6", """
SELECT segment, max(r) FILTER (preferred_channel = 'branch') AS branch, max(r) FILTER (preferred_channel = 'mobile') AS mobile,
  max(r) FILTER (preferred_channel = 'web') AS web
FROM (SELECT segment, preferred_channel,
  CAST(count(*) FILTER (churn_probability >= 0.66) AS DOUBLE) / count(*) * 100 AS r
  FROM profile GROUP BY segment, preferred_channel) GROUP BY segment""")
def _(spark, d):
    return reports.churn_matrix(_customers_only(spark, d), ("branch", "mobile", "web"))


@query("report_churn_by_channel", "B6 B13", """
SELECT segment, preferred_channel, count(*) AS customers,
  CAST(count(*) FILTER (churn_probability >= 0.66) AS DOUBLE) / count(*) * 100 AS churn_rate_pct
FROM profile WHERE segment IN ('Premium', 'Student') AND preferred_channel IN ('web', 'mobile') AND is_active
  AND kyc_status = 'verified' AND n_products >= 2
GROUP BY segment, preferred_channel""")
def _(spark, d):
    s = Slicers(segments=("Premium", "Student"), channels=("web", "mobile"), is_active=True, kyc=("verified",),
                products=("card",))
    sliced = s.customers(_customers_only(spark, d), _products(spark, d))
    return reports.churn_by_channel(sliced)


@query("report_clv_tiers", "B7", "SELECT clv_tier, count(*) AS customers FROM dim_customer GROUP BY clv_tier")
def _(spark, d):
    return reports.clv_tiers(_customers_clv(spark, d))


@query("report_product_customers", "B8", """
SELECT product, count(DISTINCT customerId) AS customers_holding_product FROM product GROUP BY product""")
def _(spark, d):
    return reports.customers_per_product(_products(spark, d))


@query("report_weekly_fraud_rate", "B9", """
SELECT CAST(date_trunc('week', TIMESTAMP '2023-01-01' + to_hours(step - 1)) AS DATE) AS week_start,
  count(*) AS transaction_count, CAST(sum(isFraud) AS BIGINT) AS fraud_count,
  CAST(sum(isFraud) AS DOUBLE) / count(*) * 100 AS fraud_rate_pct FROM txn GROUP BY week_start""")
def _(spark, d):
    return reports.weekly_fraud_rate(_summary(spark, d))


@query("report_volume_by_type", "B10", """
SELECT type AS transaction_type, CAST(sum(amount) AS DOUBLE) AS total_volume FROM txn GROUP BY type""")
def _(spark, d):
    return reports.volume_by_type(_summary(spark, d))


@query("report_top_accounts", "B11 M23 T2", """
SELECT nameOrig AS customerId, count(DISTINCT txnId) AS account_flagged_count,
  CAST(sum(amount) AS DOUBLE) AS account_flagged_value, any_value(c.segment) AS segment, any_value(c.risk_tier) AS risk_tier
FROM flagged f JOIN dim_customer c ON c.customerId = f.nameOrig
GROUP BY nameOrig ORDER BY account_flagged_value DESC, customerId LIMIT 20""")
def _(spark, d):
    return reports.top_flagged_accounts(_flagged(spark, d), _customers(spark, d))


@query("report_dormancy", "B12 B13", """
SELECT customerId, last_active_step, steps_inactive, txn_history_count, dormancy_severity FROM dormant
WHERE dormancy_severity = 'Dormant' ORDER BY steps_inactive DESC, customerId""")
def _(spark, d):
    return reports.dormancy_table(summaries.dormancy_report(txn(spark, d)), Slicers(severities=("Dormant",)))


@query("report_compliance_sliced", "B13", """
SELECT transaction_type, transaction_count, transaction_volume, fraud_count, fraud_rate_pct, risk_classification
FROM compliance WHERE transaction_type IN ('TRANSFER', 'DEBIT') ORDER BY transaction_type""")
def _(spark, d):
    return reports.compliance_table(summaries.compliance_summary(txn(spark, d)), Slicers(types=("TRANSFER", "DEBIT")))
