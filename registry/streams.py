"""Streams over files, checked against their batch twins."""

from pyspark.sql import functions as F

from txnloom.operators.churn import dedupe_alerts, standing_alerts
from txnloom.operators.latest import latest_by
from txnloom.operators.summaries import customer_baseline
from txnloom.params import StreamParams
from txnloom.schemas import TXN_COLUMNS
from txnloom.session import scratch_path
from txnloom.sources.messages import decode_stream, read_message_stream
from txnloom.streaming.churn import churn_stream, window_stream
from txnloom.streaming.flagged import decode_alerts, maintain_flagged, read_flagged
from txnloom.streaming.fraud import fraud_stream
from txnloom.streaming.landing import landed_log, landing_stream
from txnloom.streaming.trailing import trailing_stream
from txnloom.functions.clock import step_of
from txnloom.sinks.batches import configure, parquet_writer

from .churning import PARAMS
from .core import query
from .inputs import evt, messages


#: Triggers of every stream query, the least number of files in each, and the messages of a file.
SLICES, FILES = 6, 4
ROWS_PER_FILE = 100_000


def _drain(*writers):
    """Run the queries one after the other until their input is used up."""
    for w in writers:
        w.start().awaitTermination()


def _topic(spark, df, label, cut_by="offset", cuts=None):
    """Messages as files in offset order: every trigger takes one slice of the offsets, ``FILES`` files or more.

    The file source reads files by their age, so slices are written one after the other. Rows are dealt to
    files by ranges of offsets within a slice. A file is one task's work, so larger tables have more files.
    """
    path = scratch_path(spark, label)
    kept = scratch_path(spark, f"{label}-all")
    df.write.parquet(kept)
    rows = spark.read.parquet(kept)
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(cut_by, [i / SLICES for i in range(1, SLICES)]).alias("cuts")).first()
    cuts = sorted(set((found.cuts or []) if cuts is None else cuts))
    edges = [None, *cuts, None]
    files = max(FILES, -(-found.n // (ROWS_PER_FILE * (len(cuts) + 1))))
    for low, high in zip(edges, edges[1:]):
        part = rows.where((F.lit(low is None) | (F.col(cut_by) > low)) & (F.lit(high is None) | (F.col(cut_by) <= high)))
        part.drop("place").repartitionByRange(files, "offset").sortWithinPartitions("offset").write.mode("append").parquet(path)
    p = StreamParams(kind="parquet", location=path, max_per_trigger=files, once=True)
    return read_message_stream(spark, p), p


def land(spark, d, out):
    """All messages through the landing stream: rows under ``table``, bad messages under ``dead``."""
    stream, p = _topic(spark, messages(spark, d), "landing-topic")
    _drain(landing_stream(stream, f"{out}/table", f"{out}/dead", f"{out}/checkpoint", p, compact_every=4))


def _event_messages(spark, d):
    return evt(spark, d).select(
        F.col("nameOrig").alias("key"),
        F.to_json(F.struct("step", "type", "amount", "nameOrig", "newbalanceOrig")).alias("value"),
        F.lit(0).alias("partition"), F.col("kafka_offset").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"))


@query("stream_fraud_alerts", "ST1 ST6 ST7 S1 K1 P25", """
SELECT CASE WHEN row_no % 97 <> 0 OR row_no // 97 % 9 <> 2 THEN row_no END AS n,
  CASE WHEN row_no % 97 = 0 AND row_no // 97 % 9 = 4 THEN '' ELSE nameOrig END AS account,
  CAST(amount AS DOUBLE) AS amount FROM flagged
WHERE row_no IN (SELECT row_no FROM checked WHERE ok) AND NOT (row_no % 97 = 0 AND row_no // 97 % 9 IN (3, 6))""")
def _(spark, d):
    stream, p = _topic(spark, messages(spark, d), "fraud-topic")
    out = scratch_path(spark, "fraud")
    _drain(fraud_stream(decode_stream(stream), f"{out}/alerts", f"{out}/metrics", f"{out}/checkpoint", p))
    return spark.read.parquet(f"{out}/alerts").select(
        F.regexp_extract(F.coalesce("txnId", F.lit("")), r"(\d+)$", 1).try_cast("long").alias("n"),
        F.get_json_object("value", "$.nameOrig").alias("account"),
        F.get_json_object("value", "$.amount").cast("double").alias("amount"))


@query("stream_fraud_metrics", "ST1 ST9 K4 S9 A18", """
SELECT *, round(flagged_count * 100.0::DOUBLE / total_count, 6) AS fraud_rate_pct,
  'SPEC-7.1: type in (TRANSFER,CASH_OUT) & amount>200000 & newbalanceDest==0' AS rule_id
FROM (SELECT count(*) AS total_count, count(*) FILTER (ok) AS parsed_count,
  (SELECT count(*) FROM flagged WHERE row_no IN (SELECT row_no FROM checked WHERE ok)
     AND NOT (row_no % 97 = 0 AND row_no // 97 % 9 IN (3, 6))) AS flagged_count FROM checked)""")
def _(spark, d):
    from txnloom.sources.tables import read_metrics
    stream, p = _topic(spark, messages(spark, d), "metrics-topic")
    out = scratch_path(spark, "metrics")
    _drain(fraud_stream(decode_stream(stream), f"{out}/alerts", f"{out}/metrics", f"{out}/checkpoint", p))
    return read_metrics(spark, f"{out}/metrics").agg(
        *[F.sum(c).alias(c) for c in ("total_count", "parsed_count", "flagged_count")],
        F.round(F.sum(F.col("fraud_rate_pct") * F.col("total_count")) / F.sum("total_count"), 6).alias("fraud_rate_pct"),
        F.array_join(F.sort_array(F.collect_set("fraud_rule")), "|").alias("rule_id"))


def _last_windows(spark, path):
    return latest_by(spark.read.parquet(path), ["customerId", "window"], ["batch_id"])


@query("stream_churn_windows", "ST2 ST3 A19", """
SELECT customerId, window_start_step, w_count, w_avg_amount, cashout_count, payment_debit_count, low_run FROM win""")
def _(spark, d):
    stream, p = _topic(spark, _event_messages(spark, d), "window-topic")
    out = scratch_path(spark, "windows")
    _drain(window_stream(decode_stream(stream), f"{out}/stretches", parquet_writer(f"{out}/windows"), f"{out}/checkpoint", p, PARAMS))
    return _last_windows(spark, f"{out}/windows").select(
        "customerId", step_of(F.col("window.start")).alias("window_start_step"), "w_count", "w_avg_amount",
        "cashout_count", "payment_debit_count", "low_run")


@query("stream_churn_alerts", "ST4 J1 K3 S10 T6 P25", """
SELECT customerId, window_start_step, window_end_step, signal_names, signal_count, w_count AS window_txn_count,
  w_avg_2 AS window_avg_amount FROM alert""")
def _(spark, d):
    """One stream stores windows and alerts."""
    out = scratch_path(spark, "churn")
    customer_baseline(evt(spark, d)).write.parquet(f"{out}/baseline")
    stream, p = _topic(spark, _event_messages(spark, d), "churn-topic")
    _drain(churn_stream(decode_stream(stream), f"{out}/baseline", f"{out}/alerts", f"{out}/checkpoint", p, PARAMS,
                        windows_path=f"{out}/windows"))
    last = _last_windows(spark, f"{out}/windows")
    return standing_alerts(dedupe_alerts(spark.read.parquet(f"{out}/alerts")), last).select(
        "customerId", "window_start_step", "window_end_step", F.array_join("signals", ",").alias("signal_names"),
        "signal_count", "window_txn_count", "window_avg_amount")


@query("stream_late_rows", "ST5 ST2 ST3", """
SELECT nameOrig AS customerId, ws AS window_start_step, count(*) AS w_count, count(*) FILTER (held) AS late_count,
  count(*) FILTER (type = 'CASH_OUT') AS cashout_count
FROM (SELECT *, kafka_offset % 10 = 3 AS held, max(step) FILTER (kafka_offset % 10 NOT IN (3, 4)) OVER () AS top FROM evt_window)
WHERE NOT held OR ws + 23 > top - 1 - 48 GROUP BY nameOrig, ws""")
def _(spark, d):
    """A tenth of all messages comes last: it counts only in windows that end after the watermark.

    The engine judges a trigger's rows by the watermark of the trigger before, so late rows come third.
    """
    last_digit = F.col("offset") % 10
    place = F.when(last_digit == 3, 2).when(last_digit == 4, 1).otherwise(0)
    moved = (_event_messages(spark, d).withColumn("place", place)
             .withColumn("offset", F.col("offset") + F.col("place").cast("long") * (1 << 40)))
    stream, p = _topic(spark, moved, "late-topic", "place", [0, 1])
    out = scratch_path(spark, "late")
    _drain(window_stream(decode_stream(stream), f"{out}/stretches", parquet_writer(f"{out}/windows"), f"{out}/checkpoint", p, PARAMS))
    first = F.col("batch_id") < 2
    return spark.read.parquet(f"{out}/windows").groupBy("customerId", "window").agg(
        F.max("w_count").alias("w_count"), F.max("cashout_count").alias("cashout_count"),
        F.coalesce(F.max(F.when(first, F.col("w_count"))), F.lit(0)).alias("on_time")).select(
        "customerId", step_of(F.col("window.start")).alias("window_start_step"), "w_count",
        (F.col("w_count") - F.col("on_time")).alias("late_count"), "cashout_count")


@query("stream_trailing_churn", "ST10", """
SELECT nameOrig AS customerId, last AS window_end_step, count(*) AS w_count, CAST(sum(amount) AS DOUBLE) / count(*) AS w_avg_amount,
  count(*) FILTER (type = 'CASH_OUT') AS cashout_count, count(*) FILTER (type IN ('PAYMENT', 'DEBIT')) AS payment_debit_count,
  coalesce(any_value(low_run), 0) AS low_run
FROM evt_tail LEFT JOIN tail_run USING (nameOrig) GROUP BY nameOrig, last""")
def _(spark, d):
    stream, p = _topic(spark, _event_messages(spark, d), "trailing-topic")
    out = scratch_path(spark, "trailing")
    _drain(configure(trailing_stream(decode_stream(stream), PARAMS).writeStream.outputMode("update")
                     .foreachBatch(parquet_writer(f"{out}/windows")), f"{out}/checkpoint", p))
    last = latest_by(spark.read.parquet(f"{out}/windows"), ["customerId"], [F.col("window.end"), F.col("batch_id")])
    return last.select("customerId", (step_of(F.col("window.end")) - 1).alias("window_end_step"), "w_count", "w_avg_amount",
                       "cashout_count", "payment_debit_count", "low_run")


@query("stream_landing", "ST12 K7 ST8", """
SELECT step, type, CAST(amount AS DOUBLE) AS amount, nameOrig, CAST(oldbalanceOrg AS DOUBLE) AS oldbalanceOrg,
  CAST(newbalanceOrig AS DOUBLE) AS newbalanceOrig, nameDest, CAST(oldbalanceDest AS DOUBLE) AS oldbalanceDest,
  CAST(newbalanceDest AS DOUBLE) AS newbalanceDest, isFraud, isFlaggedFraud, txnId, ingest_ts FROM txn
WHERE row_no IN (SELECT row_no FROM checked WHERE problem_text = '')""")
def _(spark, d):
    out = scratch_path(spark, "landing")
    land(spark, d, out)
    return landed_log(f"{out}/table").read(spark).select(*TXN_COLUMNS)


@query("stream_dead_letters", "ST12 V5", """
SELECT row_no AS "offset", problem_text AS problems FROM checked WHERE problem_text <> ''""")
def _(spark, d):
    out = scratch_path(spark, "dead")
    land(spark, d, out)
    rows = spark.read.schema("key string, value string, partition int, offset long, problems array<string>").json(
        f"{out}/dead")
    return rows.select("offset", F.array_join(F.array_sort("problems"), "; ").alias("problems"))


@query("stream_flagged_table", "ST11 W2 T3 P24 P26", """
SELECT txnId, step, CAST(amount AS DOUBLE) AS amount, false_positive FROM flagged
ORDER BY row_no DESC LIMIT 500""")
def _(spark, d):
    """Every alert arrives twice; the second time updates the row in its first place."""
    from txnloom.functions.payloads import fraud_alert
    from txnloom.functions.rules import is_fraud
    from .inputs import txn
    alerts = txn(spark, d, balances=True).filter(is_fraud()).select(
        F.col("nameOrig").alias("key"), fraud_alert().alias("value"), F.lit(0).alias("partition"),
        F.col("row_no").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))
    again = alerts.withColumn("offset", F.col("offset") + 1_000_000_000_000)
    stream, p = _topic(spark, alerts.unionByName(again), "alert-topic")
    out = scratch_path(spark, "flagged")
    _drain(maintain_flagged(decode_alerts(stream), f"{out}/table", f"{out}/checkpoint", p, max_rows=500))
    return read_flagged(spark, f"{out}/table").select("txnId", "step", "amount", "false_positive")
