"""Business predicates, tiers and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import (
    BlendParams, ClvParams, ComplianceParams, DormancyParams, FraudParams, RiskParams,
)


# -- predicates ---------------------------------------------------------------

def is_fraud(p: FraudParams = FraudParams()) -> Column:
    """Large transfer or cash-out that leaves the destination empty.

    Strict on the amount, exact on the balance, case-sensitive on the type.
    """
    return (F.col("type").isin(*p.types)
            & (F.col("amount") > F.lit(p.amount_threshold))
            & (F.col("newbalanceDest") == F.lit(p.dest_balance)))


def is_customer(account: Column) -> Column:
    return account.startswith("C")


def in_step_window(step: Column, lo: int = 1, hi: int = 168) -> Column:
    return F.coalesce(step.between(lo, hi), F.lit(False))


def parsed() -> Column:
    """True where the message decoded to a transaction."""
    return F.col("type").isNotNull() & F.col("nameOrig").isNotNull()


def confirmed_fraud() -> Column:
    return F.col("isFraud") == 1


# -- arithmetic ---------------------------------------------------------------

def clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def min_max(c: Column, lo: Column, hi: Column) -> Column:
    """Scale to 0..1; a missing or empty range gives 0."""
    spread = (hi - lo).cast("double")
    return (F.when(hi > lo, clamp01((c - lo).cast("double") / F.nullif(spread, F.lit(0.0))))
            .otherwise(F.lit(0.0)))


def weighted_score(*terms: tuple[float, Column]) -> Column:
    weight, column = terms[0]
    acc = F.lit(weight) * column
    for weight, column in terms[1:]:
        acc = acc + F.lit(weight) * column
    return F.round(clamp01(acc), 6)


def safe_ratio(num: Column, den: Column, blank: bool = False) -> Column:
    """Quotient as double; a zero or missing divisor gives 0, or NULL if ``blank``."""
    den = den.cast("double")
    q = F.coalesce(num.cast("double"), F.lit(0.0)) if not blank else num.cast("double")
    q = q / F.nullif(den, F.lit(0.0))
    return q if blank else F.coalesce(q, F.lit(0.0))


def total(c: Column) -> Column:
    """Sum as double. A decimal input is added exactly, whatever the row order."""
    return F.sum(c).cast("double")


def mean(c: Column) -> Column:
    """Average as double, from an exact sum when the input is decimal."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


def fraud_count() -> Column:
    return F.count_if(confirmed_fraud())


# -- tiers and classes --------------------------------------------------------

def risk_tier(score: Column, p: RiskParams = RiskParams()) -> Column:
    return (F.when(score < p.tier_low_max, "Low")
            .when(score <= p.tier_medium_max, "Medium").otherwise("High"))


def clv_class(score: Column, p: ClvParams = ClvParams()) -> Column:
    return (F.when(score > p.tier_high_min, "High Value")
            .when(score >= p.tier_growth_min, "Growth Potential").otherwise("At Risk"))


def recency(gap: Column, p: ClvParams = ClvParams()) -> Column:
    fade = F.lit(1.0) - gap.cast("double") / F.lit(float(p.recency_zero_after_steps))
    return F.when(gap >= p.recency_zero_after_steps, 0.0).otherwise(fade)


def compliance_class(rate_pct: Column, p: ComplianceParams = ComplianceParams()) -> Column:
    """Takes the rate before rounding."""
    return (F.when(rate_pct >= F.lit(p.risk_high_pct), "High")
            .when(rate_pct >= F.lit(p.risk_medium_pct), "Medium").otherwise("Low"))


def dormancy_severity(gap: Column, p: DormancyParams = DormancyParams()) -> Column:
    """NULL while the gap is too short to count as dormant."""
    return (F.when(gap > p.severe_steps, "Severely Dormant")
            .when(gap > p.inactive_steps, "Dormant"))


def composite_risk(rate_pct: Column, churn: Column, p: BlendParams = BlendParams(),
                   normalize: bool = False) -> Column:
    rate = F.coalesce(rate_pct.cast("double"), F.lit(0.0))
    if normalize:
        rate = rate / F.lit(100.0)
    return F.round(rate * F.lit(p.fraud_weight)
                   + F.coalesce(churn.cast("double"), F.lit(0.0)) * F.lit(p.churn_weight), 6)


# -- reporting bands ----------------------------------------------------------

def _bands(c: Column, rows: tuple[tuple[float, str], ...], rest: str) -> Column:
    out = None
    for floor, label in rows:
        out = F.when(c >= floor, label) if out is None else out.when(c >= floor, label)
    return out.otherwise(rest)


def churn_band(c: Column) -> Column:
    return _bands(c, ((0.66, "High"), (0.33, "Medium")), "Low")


def risk_band(c: Column) -> Column:
    """Unlike :func:`risk_tier`, a score of exactly 0.60 is High here."""
    return _bands(c, ((0.60, "High"), (0.25, "Medium")), "Low")


def income_band(c: Column) -> Column:
    return _bands(c, ((250000, "250k+"), (100000, "100-250k"), (50000, "50-100k")), "<50k")


def amount_band(c: Column) -> Column:
    return _bands(c, ((1000000, "1M+"), (500000, "500k-1M"), (200000, "200-500k")), "<200k")


def clv_tier(cls: Column) -> Column:
    return F.coalesce(cls, F.lit("Unscored"))


def is_severe(severity: Column) -> Column:
    return F.when(severity == "Severely Dormant", 1).otherwise(0)


def type_group(txn_type: Column) -> Column:
    return F.when(txn_type == "CASH_IN", "inflow").otherwise("outflow")


def false_positive(is_fraud_flag: Column) -> Column:
    return F.when(F.coalesce(is_fraud_flag, F.lit(0)) == 0, 1).otherwise(0)
