"""Churn detection over sliding windows, for tables.

Rows are first summarised per customer, step and short stretch of the arrival
order. That result is small, and only it is spread over the overlapping windows,
so raw rows are shuffled once and never duplicated. Stretches bound what a task
collects even when one customer sends a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import runs
from ..functions.clock import event_ts, step_of
from ..functions.signals import fired_signals
from ..params import ChurnParams
from .latest import latest_by

#: Offsets in a stretch of the stream, one bit of a long each.
BITS = 62


def step_stretches(txns: DataFrame, p: ChurnParams = ChurnParams(),
                   order: str = "kafka_offset") -> DataFrame:
    """Counts and a low-balance run summary per customer, step and stretch.

    ``order`` is an integer, unique per customer, that gives the arrival order.
    """
    low = runs.is_low(F.col("newbalanceOrig"), p.balance_low_threshold)
    kind = F.col("type")
    grouped = (txns.filter(kind.isNotNull() & F.col("nameOrig").isNotNull())
               .withColumn("stretch", F.floor(F.col(order) / F.lit(p.order_chunk)))
               .groupBy(F.col("nameOrig").alias("customerId"), "step", "stretch")
               .agg(F.count(F.lit(1)).alias("n"),
                    F.sum("amount").alias("amount"),
                    F.count("amount").alias("n_amount"),
                    F.count_if(kind == "CASH_OUT").alias("cashout"),
                    F.count_if(kind.isin("PAYMENT", "DEBIT")).alias("payment_debit"),
                    F.array_sort(F.collect_list(
                        F.struct(F.col(order).alias("at"), low.alias("low")))).alias("_events")))
    return grouped.withColumn("run", runs.summarise(F.col("_events"))).drop("_events")


def _merge_stretches(total: Column | None = None):
    total = F.sum("amount").cast("double") if total is None else total
    return [F.sum("n").alias("w_count"),
            (total / F.nullif(F.sum("n_amount"), F.lit(0)))
            .alias("w_avg_amount"),
            F.sum("cashout").alias("cashout_count"),
            F.sum("payment_debit").alias("payment_debit_count")]


def churn_windows(txns: DataFrame, p: ChurnParams = ChurnParams(),
                  order: str = "kafka_offset") -> DataFrame:
    """Aggregates per customer and sliding window, with the longest low run."""
    pieces = step_stretches(txns, p, order).withColumn("event_ts", event_ts(F.col("step"), p.epoch))
    return (pieces.groupBy(F.window("event_ts", f"{p.window_steps} hours", f"{p.slide_steps} hours"),
                           "customerId")
            .agg(*_merge_stretches(),
                 F.array_sort(F.collect_list(F.struct("step", "stretch", "run"))).alias("_runs"))
            .withColumn("low_run", runs.longest(F.col("_runs"))).drop("_runs"))


def merged_windows(stretches: DataFrame, p: ChurnParams = ChurnParams()) -> DataFrame:
    """Windows from stretches that know their window, each with bit masks of its events in arrival order.

    Stretches are first joined to longer ones of ``order_chunk`` offsets, so no group holds more than one
    chunk's stretches, or more than one entry per step and chunk.
    """
    chunk = F.floor(F.col("stretch") * BITS / F.lit(p.order_chunk))
    sums = [F.sum(c).alias(c) for c in ("n", "amount", "n_amount", "cashout", "payment_debit")]
    chunks = (stretches.withColumn("run", runs.of_bits(F.col("there"), F.col("low_at"), BITS))
              .groupBy("window", "customerId", "step", chunk.alias("stretch"))
              .agg(*sums, F.array_sort(F.collect_list(F.struct("stretch", "run"))).alias("_runs"))
              .withColumn("run", runs.joined(F.col("_runs"))).drop("_runs"))
    # Sums of cents in binary carry noise far below a cent; the average must not show it.
    return (chunks.groupBy("customerId", "window")
            .agg(*_merge_stretches(F.round(F.sum("amount"), 6)),
                 F.array_sort(F.collect_list(F.struct("step", "stretch", "run"))).alias("_runs"))
            .withColumn("low_run", runs.longest(F.col("_runs"))).drop("_runs"))


def score_windows(windows: DataFrame, baseline: DataFrame,
                  p: ChurnParams = ChurnParams()) -> DataFrame:
    """Signals per window. Customers without a baseline can still fire S3 and S4.

    The baseline grows with the customers, so no broadcast is forced: Spark
    broadcasts it when it is small and joins by shuffle when it is not.
    """
    known = baseline.select("customerId", "hist_freq_per_12", "all_time_avg_amount")
    return (windows.join(known, "customerId", "left")
            .withColumn("signals", fired_signals(p))
            .withColumn("signal_count", F.size("signals")))


def churn_alerts(windows: DataFrame, baseline: DataFrame,
                 p: ChurnParams = ChurnParams()) -> DataFrame:
    """Windows with enough signals, in the shape of an alert (without its time)."""
    return (score_windows(windows, baseline, p)
            .filter(F.col("signal_count") >= p.min_signals)
            .select("customerId",
                    F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    step_of(F.col("window.start"), p.epoch).alias("window_start_step"),
                    (step_of(F.col("window.end"), p.epoch) - 1).alias("window_end_step"),
                    "signals", "signal_count",
                    F.col("w_count").alias("window_txn_count"),
                    F.round("w_avg_amount", 2).alias("window_avg_amount")))


def dedupe_alerts(alerts: DataFrame, emitted: str = "detected_at") -> DataFrame:
    """Latest emission per customer and window."""
    return latest_by(alerts, ["customerId", "window_end_step"], [emitted])


def standing_alerts(alerts: DataFrame, windows: DataFrame) -> DataFrame:
    """Alerts of windows as they last were: a window that has grown since its alert was judged anew."""
    last = windows.select("customerId", F.col("window.start").alias("window_start"), F.col("w_count").alias("window_txn_count"))
    return alerts.join(last, ["customerId", "window_start", "window_txn_count"], "left_semi")


def max_churn_signals(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("customerId").agg(F.max("signal_count").alias("churn_signal_count"))


def trailing_windows(txns: DataFrame, p: ChurnParams = ChurnParams(),
                     order: str = "kafka_offset") -> DataFrame:
    """Aggregates over the steps up to and including every active step.

    The frame runs over rows already reduced to one per customer and step, so it
    never holds more than ``window_steps`` of them.
    """
    per_step = (step_stretches(txns, p, order)
                .groupBy("customerId", "step")
                .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"),
                     F.sum("n_amount").alias("n_amount"), F.sum("cashout").alias("cashout"),
                     F.sum("payment_debit").alias("payment_debit"),
                     F.array_sort(F.collect_list(F.struct("stretch", "run"))).alias("_runs")))
    frame = (Window.partitionBy("customerId").orderBy("step")
             .rangeBetween(-(p.window_steps - 1), 0))
    framed = per_step.select(
        "customerId", "step",
        F.sum("n").over(frame).alias("w_count"),
        (F.sum("amount").over(frame).cast("double")
         / F.nullif(F.sum("n_amount").over(frame), F.lit(0))).alias("w_avg_amount"),
        F.sum("cashout").over(frame).alias("cashout_count"),
        F.sum("payment_debit").over(frame).alias("payment_debit_count"),
        F.array_sort(F.collect_list(F.struct("step", "_runs")).over(frame)).alias("_steps"))
    flat = F.flatten(F.transform(F.col("_steps"), lambda s: s["_runs"]))
    return framed.withColumn("low_run", runs.longest(flat)).drop("_steps")


def low_balance_streaks(txns: DataFrame, p: ChurnParams = ChurnParams(),
                        order: str = "kafka_offset") -> DataFrame:
    """Longest run of low balances per customer and step, from the same summaries."""
    return (step_stretches(txns, p, order)
            .groupBy("customerId", "step")
            .agg(F.sum("n").alias("txn_count"),
                 F.array_sort(F.collect_list(F.struct("stretch", "run"))).alias("_runs"))
            .withColumn("low_run", runs.longest(F.col("_runs"))).drop("_runs"))
