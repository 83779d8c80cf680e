"""Risk and lifetime value scores, histograms, range checks."""

from pyspark.sql import functions as F

from txnloom.operators import checks, scoring, summaries

from .core import query
from .inputs import txn

_NORMS = "norm_frequency, norm_avg_transfer_amount, norm_cashout_proportion, norm_unique_dest_accounts"
_RAW = "frequency, avg_transfer_amount, cashout_proportion, unique_dest_accounts"


@query("risk_factors", "A1", "SELECT * FROM risk_factor")
def _(spark, d):
    return scoring.risk_factors(txn(spark, d))


@query("risk_factor_ranges", "A2", "SELECT " + ", ".join(
    f"{f}({c}) AS {c}_{f}" for c in scoring.RISK_FACTORS for f in ("min", "max")) + " FROM risk_factor")
def _(spark, d):
    return scoring.factor_ranges(scoring.risk_factors(txn(spark, d)))


@query("risk_factors_normalised", "P8", f"SELECT customerId, {_RAW}, {_NORMS} FROM risk_norm")
def _(spark, d):
    return scoring.normalise_factors(scoring.risk_factors(txn(spark, d)))


@query("risk_scores", "A3 P9 P10", f"SELECT customerId, risk_score, risk_tier, {_RAW}, {_NORMS} FROM risk")
def _(spark, d):
    return scoring.risk_scores(txn(spark, d))


@query("clv_components", "A4 P12", """
SELECT customerId, total_amount, txn_count, distinct_txn_types, last_step, steps_since_last_txn, volume_score,
  frequency_score, diversity_score, recency_score FROM clv_part""")
def _(spark, d):
    return scoring.clv_components(txn(spark, d))


@query("clv_scores", "A5 P9 P11", """
SELECT customerId, clv_score, clv_classification, total_amount, txn_count, distinct_txn_types, last_step,
  steps_since_last_txn, volume_score, frequency_score, diversity_score, recency_score FROM clv""")
def _(spark, d):
    return scoring.clv_scores(txn(spark, d))


@query("tier_histograms", "A16", """
SELECT 'risk' AS dataset, risk_tier AS tier, count(*) AS n FROM risk GROUP BY risk_tier
UNION ALL SELECT 'clv', clv_classification, count(*) FROM clv GROUP BY clv_classification
UNION ALL SELECT 'dormancy', dormancy_severity, count(*) FROM dormant GROUP BY dormancy_severity""")
def _(spark, d):
    t = txn(spark, d)
    parts = (("risk", scoring.risk_scores(t), "risk_tier"),
             ("clv", scoring.clv_scores(t), "clv_classification"),
             ("dormancy", summaries.dormancy_report(t), "dormancy_severity"))
    out = None
    for label, df, column in parts:
        one = scoring.histogram(df, column).select(F.lit(label).alias("dataset"),
                                                   F.col(column).alias("tier"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("top_risk", "T2", f"""
SELECT customerId, risk_score, risk_tier, {_RAW}, {_NORMS} FROM risk
ORDER BY risk_score DESC, customerId LIMIT 20""")
def _(spark, d):
    return summaries.top(scoring.risk_scores(txn(spark, d)), "risk_scores", 20)


@query("range_checks", "V15", """
SELECT 'risk_scores' AS dataset, 'risk_score in 0..1' AS test, count(*) FILTER (NOT risk_score BETWEEN 0 AND 1) AS failures FROM risk
UNION ALL SELECT 'risk_scores', 'risk_tier is known', count(*) FILTER (risk_tier NOT IN ('Low', 'Medium', 'High')) FROM risk
UNION ALL SELECT 'clv_scores', 'clv_score in 0..1', count(*) FILTER (NOT clv_score BETWEEN 0 AND 1) FROM clv
UNION ALL SELECT 'transactions', 'type is allowed',
  count(*) FILTER (type NOT IN ('PAYMENT', 'TRANSFER', 'CASH_IN', 'CASH_OUT')) FROM txn
UNION ALL SELECT 'transactions', 'amount above 100000', count(*) FILTER (amount < 100000) FROM txn
UNION ALL SELECT 'compliance_summary', 'fraud rate in 0..100', count(*) FILTER (NOT fraud_rate_pct BETWEEN 0 AND 100) FROM compliance""")
def _(spark, d):
    """Two of the tests are meant to fail, to show that failures are counted."""
    t = txn(spark, d)
    return (checks.violations(scoring.risk_scores(t), "risk_scores", {
                "risk_score in 0..1": checks.within("risk_score", 0, 1),
                "risk_tier is known": F.col("risk_tier").isin("Low", "Medium", "High")})
            .unionByName(checks.violations(scoring.clv_scores(t), "clv_scores", {
                "clv_score in 0..1": checks.within("clv_score", 0, 1)}))
            .unionByName(checks.violations(t, "transactions", {
                "type is allowed": F.col("type").isin("PAYMENT", "TRANSFER", "CASH_IN", "CASH_OUT"),
                "amount above 100000": F.col("amount") >= 100000}))
            .unionByName(checks.violations(summaries.compliance_summary(t), "compliance_summary", {
                "fraud rate in 0..100": checks.within("fraud_rate_pct", 0, 100)})))
