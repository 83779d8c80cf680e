"""The data behind every report visual, with the slicers of its page."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import calendar_columns, event_ts
from ..operators.dimensions import customers_with_product
from ..operators.summaries import report_order
from ..params import SIM_EPOCH
from .measures import (
    account_measures, customer_measures, flagged_measures, product_measures, transaction_measures,
)


@dataclass(frozen=True)
class Slicers:
    """Optional filters; an empty one selects everything."""

    date_from: str | None = None
    date_to: str | None = None
    types: Sequence[str] = ()
    weeks: Sequence[str] = ()  # week start dates
    severities: Sequence[str] = ()
    segments: Sequence[str] = ()
    channels: Sequence[str] = ()
    is_active: bool | None = None
    kyc: Sequence[str] = ()
    products: Sequence[str] = ()
    epoch: str = SIM_EPOCH

    def facts(self, df: DataFrame, type_col: str = "type") -> DataFrame:
        """Slice facts that have a step, a type, or both."""
        if self.types and type_col in df.columns:
            df = df.filter(F.col(type_col).isin(*self.types))
        if "step" in df.columns and (self.date_from or self.date_to or self.weeks):
            cal = calendar_columns(event_ts(F.col("step"), self.epoch))
            if self.date_from:
                df = df.filter(cal["date"] >= F.lit(self.date_from).cast("date"))
            if self.date_to:
                df = df.filter(cal["date"] <= F.lit(self.date_to).cast("date"))
            if self.weeks:
                df = df.filter(cal["week_start"].cast("string").isin(*self.weeks))
        return df

    def dormant(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col("dormancy_severity").isin(*self.severities)) if self.severities else df

    def customers(self, df: DataFrame, products: DataFrame | None = None) -> DataFrame:
        for column, wanted in (("segment", self.segments), ("preferred_channel", self.channels),
                               ("kyc_status", self.kyc)):
            if wanted:
                df = df.filter(F.col(column).isin(*wanted))
        if self.is_active is not None:
            df = df.filter(F.col("is_active") == self.is_active)
        if self.products:
            if products is None:
                raise ValueError("the product slicer needs the customer products")
            df = customers_with_product(df, products, *self.products)
        return df


ALL = Slicers()


def _with_calendar(df: DataFrame, column: str, epoch: str) -> DataFrame:
    """Calendar attribute of the step: a pure function of it, so no join is needed."""
    return df.withColumn(column, calendar_columns(event_ts(F.col("step"), epoch))[column])


# -- fraud alert board --------------------------------------------------------

def daily_fraud_trend(flagged: DataFrame, summary: DataFrame, s: Slicers = ALL) -> DataFrame:
    """Flagged transactions and fraud rate per date."""
    flags = flagged_measures(_with_calendar(s.facts(flagged), "date", s.epoch), ("date",))
    rates = transaction_measures(
        _with_calendar(s.facts(summary, "transaction_type"), "date", s.epoch), ("date",))
    return (rates.select("date", "transaction_count", "fraud_rate_pct")
            .join(flags.select("date", "flagged_transactions"), "date", "full")
            .withColumn("flagged_transactions", F.coalesce("flagged_transactions", F.lit(0))))


def flagged_by_type(flagged: DataFrame, s: Slicers = ALL) -> DataFrame:
    return flagged_measures(s.facts(flagged), ("type",)).select("type", "flagged_transactions")


def recent_flagged(flagged: DataFrame, newest: str = "detected_at", k: int = 100,
                   s: Slicers = ALL) -> DataFrame:
    columns = ("txnId", "type", "amount", "nameOrig", "nameDest", "newbalanceDest", "isFraud",
               "false_positive")
    return (s.facts(flagged).select(newest, *columns)
            .orderBy(F.desc(newest), F.desc("txnId")).limit(k))


# -- customer 360 -------------------------------------------------------------

def risk_vs_churn(customers: DataFrame, s: Slicers = ALL) -> DataFrame:
    return customer_measures(s.customers(customers), ("segment",)).select(
        "segment", "avg_risk_score", "avg_churn_probability", "avg_clv_score", "customers")


def segment_share(customers: DataFrame, s: Slicers = ALL) -> DataFrame:
    counts = customer_measures(s.customers(customers), ("segment",)).select("segment", "customers")
    everyone = counts.agg(F.sum("customers").alias("n")).scalar()
    return counts.withColumn("share_pct", F.col("customers") * F.lit(100.0) / everyone)


def churn_by_channel(customers: DataFrame, s: Slicers = ALL) -> DataFrame:
    """Churn rate and customers per segment and channel, one row each."""
    return customer_measures(s.customers(customers), ("segment", "preferred_channel")).select(
        "segment", "preferred_channel", "customers", "churn_rate_pct")


def churn_matrix(customers: DataFrame, channels: Sequence[str], s: Slicers = ALL) -> DataFrame:
    """The same as a matrix; naming the channels spares Spark a job to find them."""
    return (churn_by_channel(customers, s).groupBy("segment")
            .pivot("preferred_channel", list(channels)).agg(F.first("churn_rate_pct")))


def clv_tiers(customers: DataFrame, s: Slicers = ALL) -> DataFrame:
    return customer_measures(s.customers(customers), ("clv_tier",)).select("clv_tier", "customers")


def customers_per_product(products: DataFrame) -> DataFrame:
    return product_measures(products, ("product",)).select("product", "customers_holding_product")


# -- risk and compliance ------------------------------------------------------

def weekly_fraud_rate(summary: DataFrame, s: Slicers = ALL) -> DataFrame:
    weeks = _with_calendar(s.facts(summary, "transaction_type"), "week_start", s.epoch)
    return transaction_measures(weeks, ("week_start",)).select(
        "week_start", "transaction_count", "fraud_count", "fraud_rate_pct")


def volume_by_type(summary: DataFrame, s: Slicers = ALL) -> DataFrame:
    return transaction_measures(s.facts(summary, "transaction_type"), ("transaction_type",)).select(
        "transaction_type", "total_volume")


def top_flagged_accounts(flagged: DataFrame, customers: DataFrame | None = None, k: int = 20,
                         s: Slicers = ALL) -> DataFrame:
    """Accounts with the largest flagged value, among known customers if those are given."""
    accounts = account_measures(s.facts(flagged))
    if customers is not None:
        accounts = accounts.join(customers.select(
            "customerId", "segment", *[c for c in ("risk_tier",) if c in customers.columns]),
            "customerId")
    return accounts.orderBy(F.desc("account_flagged_value"), F.asc("customerId")).limit(k)


def compliance_table(compliance: DataFrame, s: Slicers = ALL) -> DataFrame:
    return report_order(s.facts(compliance, "transaction_type"), "compliance_summary")


def dormancy_table(dormant: DataFrame, s: Slicers = ALL) -> DataFrame:
    return report_order(s.dormant(dormant).select(
        "customerId", "last_active_step", "steps_inactive", "txn_history_count",
        "dormancy_severity"), "dormancy_report")
