"""Dimensions and flagged facts of the reporting star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import calendar_columns, event_ts
from ..functions.rules import (
    churn_band, clv_tier, false_positive, income_band, is_fraud, risk_band, type_group,
)
from ..params import SIM_EPOCH, TXN_TYPES, FraudParams
from ..schemas import FLAGGED


def _calendar(steps: DataFrame, epoch: str) -> DataFrame:
    return (steps.withColumn("event_ts", event_ts(F.col("step"), epoch))
            .select("step", "event_ts",
                    *[c.alias(n) for n, c in calendar_columns(F.col("event_ts")).items()]))


def dim_date(spark: SparkSession, max_step: int, epoch: str = SIM_EPOCH) -> DataFrame:
    """One row per step 1..max_step."""
    return _calendar(spark.range(1, max_step + 1).select(F.col("id").cast("int").alias("step")),
                     epoch)


def dim_date_of(txns: DataFrame, epoch: str = SIM_EPOCH) -> DataFrame:
    """One row per step up to the last one in the transactions."""
    steps = txns.agg(F.max("step").alias("last")).filter(F.col("last") >= 1).select(
        F.explode(F.sequence(F.lit(1), F.col("last").cast("int"))).alias("step"))
    return _calendar(steps, epoch)


def dim_transaction_type(spark: SparkSession) -> DataFrame:
    types = spark.createDataFrame([(t,) for t in TXN_TYPES], "transaction_type string")
    return types.withColumn("type_group", type_group(F.col("transaction_type")))


def dim_customer(profiles: DataFrame, clv: DataFrame | None = None,
                 risk: DataFrame | None = None) -> DataFrame:
    """Profiles with the scores that exist, and the reporting bands.

    If both scores come in one table (``customer_scores``), it is given twice and joined once.
    """
    if clv is not None and clv is risk:
        both = clv.select("customerId", "clv_score", "clv_classification",
                          F.col("risk_score").alias("model_risk_score"), "risk_tier")
        plain = dim_customer(profiles)
        return (plain.join(both, "customerId", "left").withColumn("clv_tier", clv_tier(F.col("clv_classification")))
                .select(*plain.columns[:-3], *both.columns[1:], *plain.columns[-3:], "clv_tier"))
    out = profiles.drop("products").withColumnRenamed("composite_risk_score",
                                                      "profile_composite_risk")
    if clv is not None:
        out = out.join(clv.select("customerId", "clv_score", "clv_classification"),
                       "customerId", "left")
    if risk is not None:
        out = out.join(risk.select("customerId", F.col("risk_score").alias("model_risk_score"),
                                   "risk_tier"), "customerId", "left")
    bands = {"churn_band": churn_band(F.col("churn_probability")),
             "risk_band": risk_band(F.col("risk_score")),
             "income_band": income_band(F.col("annualIncome"))}
    if clv is not None:
        bands["clv_tier"] = clv_tier(F.col("clv_classification"))
    return out.withColumns(bands)


def customer_products(profiles: DataFrame) -> DataFrame:
    """One row per customer and product; no products means no row."""
    return profiles.select("customerId", F.explode("products").alias("product")).select(
        "customerId", F.trim("product").alias("product"))


def flag_fraud(txns: DataFrame, p: FraudParams = FraudParams()) -> DataFrame:
    return txns.filter(is_fraud(p))


def flagged_transactions(flagged: DataFrame, epoch: str = SIM_EPOCH,
                         keep: tuple[str, ...] = ()) -> DataFrame:
    """Reporting shape of flagged rows; columns the input lacks are left out."""
    shaped = (flagged.withColumn("event_ts", event_ts(F.col("step"), epoch))
              .withColumn("isFraud", F.coalesce(F.col("isFraud"), F.lit(0)))
              .withColumn("false_positive", false_positive(F.col("isFraud"))))
    return shaped.select(*[c for c in FLAGGED.fieldNames() if c in shaped.columns], *keep)


def star(facts: DataFrame, dates: DataFrame, types: DataFrame, customers: DataFrame) -> DataFrame:
    """Flagged facts beside their date, type and customer; unmatched facts stay.

    The five types are always broadcast. For dates and customers Spark decides by
    size, at run time; a skewed step is split by AQE.
    """
    day = dates.select("step", "date", "iso_week", "week_start")
    kind = types.withColumnRenamed("transaction_type", "type")
    who = customers.withColumnRenamed("customerId", "nameOrig").select(
        "nameOrig", "segment", *[c for c in ("risk_tier", "clv_tier") if c in customers.columns])
    return (facts.join(F.broadcast(kind), "type", "left").join(day, "step", "left")
            .join(who, "nameOrig", "left"))


def customers_with_product(customers: DataFrame, products: DataFrame, *names: str) -> DataFrame:
    """Customers that hold any of the products: the product filter in reverse."""
    return customers.join(products.filter(F.col("product").isin(*names)).select("customerId"),
                          "customerId", "left_semi")


def orphan_facts(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    keys = dimension.select(F.col(dim_key).alias(fact_key))
    return facts.join(keys, fact_key, "left_anti")
