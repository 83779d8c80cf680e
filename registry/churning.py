"""Churn: baseline, sliding windows, signals, alerts."""

from pyspark.sql import functions as F

from txnloom.operators import churn
from txnloom.operators.summaries import customer_baseline
from txnloom.params import ChurnParams

from .core import query
from .inputs import evt

# The default history threshold never fires on this data.
PARAMS = ChurnParams(freq_hist_per_12=1.0)


def _steps(df):
    from txnloom.functions.clock import step_of
    return df.select("customerId", step_of(F.col("window.start")).alias("window_start_step"),
                     (step_of(F.col("window.end")) - 1).alias("window_end_step"),
                     *[c for c in df.columns if c not in ("customerId", "window")])


def alerts(spark, d):
    e = evt(spark, d)
    return churn.churn_alerts(churn.churn_windows(e, PARAMS), customer_baseline(e), PARAMS)


@query("customer_baseline", "A12", "SELECT * FROM baseline")
def _(spark, d):
    return customer_baseline(evt(spark, d))


@query("churn_windows", "A19 ST3 P18", """
SELECT customerId, window_start_step, window_end_step, w_count, w_avg_amount, cashout_count,
  payment_debit_count, low_run FROM win""")
def _(spark, d):
    return _steps(churn.churn_windows(evt(spark, d), PARAMS))


@query("churn_signals", "J1 P15 P16 P17 P18 P19", """
SELECT customerId, window_start_step, s1, s2, s3, s4 FROM win_scored""")
def _(spark, d):
    e = evt(spark, d)
    scored = _steps(churn.score_windows(churn.churn_windows(e, PARAMS), customer_baseline(e), PARAMS))
    from txnloom.functions.signals import SIGNAL_NAMES
    return scored.select("customerId", "window_start_step",
                         *[F.array_contains("signals", n).alias(f"s{i + 1}") for i, n in enumerate(SIGNAL_NAMES)])


@query("churn_alerts", "P19 ST4", """
SELECT customerId, window_start_step, window_end_step, signal_names, signal_count, w_count AS window_txn_count,
  w_avg_2 AS window_avg_amount FROM alert""")
def _(spark, d):
    return alerts(spark, d).select(
        "customerId", "window_start_step", "window_end_step", F.array_join("signals", ",").alias("signal_names"),
        "signal_count", "window_txn_count", "window_avg_amount")


@query("max_churn_signals", "A13 J6", """
SELECT customerId, max(signal_count) AS churn_signal_count FROM alert GROUP BY customerId""")
def _(spark, d):
    return churn.max_churn_signals(alerts(spark, d))


@query("alert_dedupe", "T6", """
SELECT nameOrig AS customerId, we AS window_end_step, n AS emitted, seen FROM (
  SELECT nameOrig, ws + 23 AS we, kafka_offset AS n, kafka_offset % 7 AS seen,
    row_number() OVER (PARTITION BY nameOrig, ws ORDER BY kafka_offset DESC) AS rn FROM evt_window) WHERE rn = 1""")
def _(spark, d):
    """Every event stands for one emission of its two windows."""
    bucket = F.floor((F.col("step") - 1) / F.lit(12))
    emissions = evt(spark, d).select(
        F.col("nameOrig").alias("customerId"), F.explode(F.array(bucket, bucket - 1)).alias("b"),
        F.col("kafka_offset").alias("emitted"), (F.col("kafka_offset") % 7).alias("seen")).select(
        "customerId", (F.col("b") * 12 + 24).cast("int").alias("window_end_step"), "emitted", "seen")
    return churn.dedupe_alerts(emissions, "emitted")


@query("low_balance_streaks", "W4", """
SELECT customerId, step, txn_count, coalesce(max(n), 0) AS low_run FROM (
  SELECT e.nameOrig AS customerId, e.step, e.txn_count, r.n FROM
    (SELECT nameOrig, step, count(*) AS txn_count FROM evt GROUP BY nameOrig, step) e
    LEFT JOIN (SELECT nameOrig, step, count(*) AS n FROM (
      SELECT nameOrig, step, newbalanceOrig < 500 AS low,
        row_number() OVER (PARTITION BY nameOrig, step ORDER BY kafka_offset)
        - row_number() OVER (PARTITION BY nameOrig, step, newbalanceOrig < 500 ORDER BY kafka_offset) AS island
      FROM evt) WHERE low GROUP BY nameOrig, step, island) r ON r.nameOrig = e.nameOrig AND r.step = e.step)
GROUP BY customerId, step, txn_count""")
def _(spark, d):
    return churn.low_balance_streaks(evt(spark, d), PARAMS)


@query("trailing_windows", "ST10", """
SELECT k.nameOrig AS customerId, k.step, count(*) AS w_count, CAST(sum(e.amount) AS DOUBLE) / count(*) AS w_avg_amount,
  count(*) FILTER (e.type = 'CASH_OUT') AS cashout_count,
  count(*) FILTER (e.type IN ('PAYMENT', 'DEBIT')) AS payment_debit_count,
  coalesce(max(r.n), 0) AS low_run
FROM (SELECT DISTINCT nameOrig, step FROM evt) k
JOIN evt e ON e.nameOrig = k.nameOrig AND e.step BETWEEN k.step - 23 AND k.step
LEFT JOIN (
  SELECT nameOrig, step, max(n) AS n FROM (
    SELECT nameOrig, step, count(*) AS n FROM (
      SELECT k.nameOrig, k.step, e.newbalanceOrig < 500 AS low,
        row_number() OVER (PARTITION BY k.nameOrig, k.step ORDER BY e.step, e.kafka_offset)
        - row_number() OVER (PARTITION BY k.nameOrig, k.step, e.newbalanceOrig < 500
                             ORDER BY e.step, e.kafka_offset) AS island
      FROM (SELECT DISTINCT nameOrig, step FROM evt) k
      JOIN evt e ON e.nameOrig = k.nameOrig AND e.step BETWEEN k.step - 23 AND k.step)
    WHERE low GROUP BY nameOrig, step, island) GROUP BY nameOrig, step) r
  ON r.nameOrig = k.nameOrig AND r.step = k.step
GROUP BY k.nameOrig, k.step""")
def _(spark, d):
    return churn.trailing_windows(evt(spark, d), PARAMS)
