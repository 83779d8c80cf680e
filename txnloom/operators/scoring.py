"""Customer risk scores and customer lifetime value.

Both scale per-customer numbers by extremes over all customers. The extremes are
a scalar subquery over the same aggregate, so Spark computes the aggregate once
and reuses its shuffle; nothing passes through the driver program.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import (
    clamp01, clv_class, is_customer, mean, min_max, recency, risk_tier, safe_ratio, total,
    weighted_score,
)
from ..params import TXN_TYPES, ClvParams, RiskParams

RISK_FACTORS = ("frequency", "avg_transfer_amount", "cashout_proportion", "unique_dest_accounts")


def risk_factors(txns: DataFrame) -> DataFrame:
    """Four raw factors per customer that sent at least one transaction."""
    kind = F.col("type")
    return (txns.filter(is_customer(F.col("nameOrig")))
            .groupBy(F.col("nameOrig").alias("customerId"))
            .agg(F.count(F.lit(1)).alias("frequency"),
                 F.coalesce(mean(F.when(kind == "TRANSFER", F.col("amount"))), F.lit(0.0))
                 .alias("avg_transfer_amount"),
                 (F.count_if(kind == "CASH_OUT") / F.count(F.lit(1))).alias("cashout_proportion"),
                 F.countDistinct("nameDest").alias("unique_dest_accounts")))


def factor_ranges(factors: DataFrame) -> DataFrame:
    """Smallest and largest value of every factor: one row."""
    return factors.agg(*[agg(c).alias(f"{c}_{end}") for c in RISK_FACTORS
                         for end, agg in (("min", F.min), ("max", F.max))])


def normalise_factors(factors: DataFrame) -> DataFrame:
    ranges = factor_ranges(factors)
    bounds = ranges.select(F.struct(*ranges.columns).alias("b")).scalar()
    with_bounds = factors.withColumn("_b", bounds)
    return with_bounds.select(
        *factors.columns,
        *[min_max(F.col(c), F.col(f"_b.{c}_min"), F.col(f"_b.{c}_max")).alias(f"norm_{c}")
          for c in RISK_FACTORS])


def risk_scores(txns: DataFrame, p: RiskParams = RiskParams()) -> DataFrame:
    weights = (p.w_frequency, p.w_avg_transfer, p.w_cashout_prop, p.w_unique_dest)
    norms = [f"norm_{c}" for c in RISK_FACTORS]
    scored = normalise_factors(risk_factors(txns)).withColumn(
        "risk_score", weighted_score(*[(w, F.col(c)) for w, c in zip(weights, norms)]))
    return scored.select("customerId", "risk_score",
                         risk_tier(F.col("risk_score"), p).alias("risk_tier"),
                         *RISK_FACTORS, *norms)


def clv_components(txns: DataFrame, p: ClvParams = ClvParams()) -> DataFrame:
    """Four component scores per customer.

    The last step is taken over all senders, the largest amount and count over
    customers only.
    """
    last = txns.agg(F.max("step")).scalar()
    per_customer = (txns.filter(is_customer(F.col("nameOrig")))
                    .groupBy(F.col("nameOrig").alias("customerId"))
                    .agg(total(F.col("amount")).alias("total_amount"),
                         F.count(F.lit(1)).alias("txn_count"),
                         F.countDistinct("type").alias("distinct_txn_types"),
                         F.max("step").alias("last_step")))
    # All columns take part, so this is the very aggregate above and is reused.
    peaks = per_customer.agg(F.struct(
        *[F.max(c).alias(c) for c in per_customer.columns[1:]]).alias("peak")).scalar()
    with_peaks = (per_customer.withColumn("_p", peaks)
                  .withColumn("steps_since_last_txn", last - F.col("last_step")))

    def positive(c: str) -> Column:
        return F.when(F.col(f"_p.{c}") > 0, F.col(f"_p.{c}"))

    return with_peaks.select(
        *per_customer.columns, "steps_since_last_txn",
        clamp01(safe_ratio(F.col("total_amount"), positive("total_amount"))).alias("volume_score"),
        clamp01(safe_ratio(F.col("txn_count"), positive("txn_count"))).alias("frequency_score"),
        clamp01(F.col("distinct_txn_types") / F.lit(float(p.n_txn_types))).alias("diversity_score"),
        clamp01(recency(F.col("steps_since_last_txn"), p)).alias("recency_score"))


def clv_scores(txns: DataFrame, p: ClvParams = ClvParams()) -> DataFrame:
    parts = clv_components(txns, p)
    scored = parts.withColumn("clv_score", weighted_score(
        (p.w_volume, F.col("volume_score")), (p.w_frequency, F.col("frequency_score")),
        (p.w_diversity, F.col("diversity_score")), (p.w_recency, F.col("recency_score"))))
    return scored.select("customerId", "clv_score",
                         clv_class(F.col("clv_score"), p).alias("clv_classification"),
                         *parts.columns[1:])


def sender_facts(txns: DataFrame) -> DataFrame:
    """Everything the scores need of each sender, from one scan and two hash aggregates.

    Rows are first added up per sender and receiver, so the receivers of a sender are counted by counting
    rows, and a hot sender's rows are combined before the shuffle.
    """
    kind = F.col("type")
    bits = [F.when(kind == t, F.lit(1 << i)) for i, t in enumerate(TXN_TYPES)]
    pairs = (txns.groupBy(F.col("nameOrig").alias("customerId"), "nameDest")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.max("step").alias("step"),
                  F.sum(F.when(kind == "TRANSFER", F.col("amount"))).alias("transfers"),
                  F.count(F.when(kind == "TRANSFER", F.col("amount"))).alias("n_transfers"),
                  F.count_if(kind == "CASH_OUT").alias("cashout"), F.bit_or(F.coalesce(*bits)).alias("types"),
                  # Decided in the aggregate, so that no filter on it is pushed below: all readers then share one plan.
                  F.max(is_customer(F.col("nameOrig"))).alias("customer")))
    return (pairs.groupBy("customerId")
            .agg(F.sum("n").alias("txn_count"), total(F.col("amount")).alias("total_amount"), F.max("step").alias("last_step"),
                 (F.sum("transfers").cast("double") / F.nullif(F.sum("n_transfers"), F.lit(0))).alias("transfer_mean"),
                 F.sum("cashout").alias("cashout"), F.count("nameDest").alias("unique_dest_accounts"),
                 F.bit_or("types").alias("types"), F.max("customer").alias("customer")))


def customer_scores(txns: DataFrame, risk: RiskParams = RiskParams(), clv: ClvParams = ClvParams()) -> DataFrame:
    """Risk and lifetime value side by side: all columns of both scores from one scan of the transactions.

    Transaction types are the five of the schema.
    """
    shaped = sender_facts(txns).select(
        "customerId", "customer", "txn_count", "total_amount", "last_step", "unique_dest_accounts",
        F.bit_count("types").cast("long").alias("distinct_txn_types"), F.col("txn_count").alias("frequency"),
        F.coalesce("transfer_mean", F.lit(0.0)).alias("avg_transfer_amount"),
        (F.col("cashout") / F.col("txn_count")).alias("cashout_proportion"))
    mine = lambda c: F.when(F.col("customer"), F.col(c))
    # One row with all extremes. It reads every column, so it is the very aggregate of the rows themselves.
    ends = shaped.agg(F.struct(
        F.max("last_step").alias("last"),
        *[F.max(mine(c)).alias(f"{c}_peak") for c in ("total_amount", "txn_count", "distinct_txn_types")],
        *[agg(mine(c)).alias(f"{c}_{end}") for c in RISK_FACTORS for end, agg in (("min", F.min), ("max", F.max))]).alias("b")).scalar()
    rows = shaped.withColumn("_b", ends).where("customer").withColumn("steps_since_last_txn", F.col("_b.last") - F.col("last_step"))
    positive = lambda c: F.when(F.col(f"_b.{c}_peak") > 0, F.col(f"_b.{c}_peak"))
    scaled = rows.withColumns({
        **{f"norm_{c}": min_max(F.col(c), F.col(f"_b.{c}_min"), F.col(f"_b.{c}_max")) for c in RISK_FACTORS},
        "volume_score": clamp01(safe_ratio(F.col("total_amount"), positive("total_amount"))),
        "frequency_score": clamp01(safe_ratio(F.col("txn_count"), positive("txn_count"))),
        "diversity_score": clamp01(F.col("distinct_txn_types") / F.lit(float(clv.n_txn_types))),
        "recency_score": clamp01(recency(F.col("steps_since_last_txn"), clv))})
    scores = scaled.withColumns({
        "risk_score": weighted_score(*zip((risk.w_frequency, risk.w_avg_transfer, risk.w_cashout_prop, risk.w_unique_dest),
                                          [F.col(f"norm_{c}") for c in RISK_FACTORS])),
        "clv_score": weighted_score(*zip((clv.w_volume, clv.w_frequency, clv.w_diversity, clv.w_recency),
                                         [F.col(f"{c}_score") for c in ("volume", "frequency", "diversity", "recency")]))})
    return scores.select(
        "customerId", "risk_score", risk_tier(F.col("risk_score"), risk).alias("risk_tier"), *RISK_FACTORS,
        *[f"norm_{c}" for c in RISK_FACTORS], "clv_score", clv_class(F.col("clv_score"), clv).alias("clv_classification"),
        "total_amount", "txn_count", "distinct_txn_types", "last_step", "steps_since_last_txn",
        "volume_score", "frequency_score", "diversity_score", "recency_score")


def stamped(df: DataFrame) -> DataFrame:
    """Add the time of scoring, as the stored score tables carry it."""
    return df.withColumn("scored_at", F.current_timestamp())


def histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows per tier, class or severity."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
