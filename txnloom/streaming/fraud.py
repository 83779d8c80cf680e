"""Fraud stream: flag each transaction and count every micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.clock import utc_iso_now
from ..functions.payloads import fraud_alert
from ..functions.rules import is_fraud
from ..params import FraudParams, StreamParams
from ..schemas import METRICS, TXN_COLUMNS
from ..sinks import batches

APP_NAME = "txnloom-fraud-stream"


def _counts(p: FraudParams) -> dict[str, F.Column]:
    return {"total_count": F.count(F.lit(1)),
            "parsed_count": F.count_if(F.col("type").isNotNull()),
            "flagged_count": F.count_if(F.coalesce(is_fraud(p), F.lit(False)))}


def batch_metrics(txns: DataFrame, p: FraudParams = FraudParams(),
                  by: tuple[str, ...] = ()) -> DataFrame:
    """Rows, decoded rows, flagged rows and rate. The rate counts undecoded rows too."""
    counts = txns.groupBy(*by).agg(*[c.alias(n) for n, c in _counts(p).items()])
    share = F.col("flagged_count") / F.nullif(F.col("total_count"), F.lit(0)) * 100
    return counts.withColumn("fraud_rate_pct", F.coalesce(share, F.lit(0.0)))


def fraud_batch(write_alerts: Callable[[DataFrame, int], None],
                write_metrics: Callable[[DataFrame, int], None],
                p: FraudParams = FraudParams(), app_name: str = APP_NAME):
    """Handler of one micro-batch, which is read once.

    The counts are observed while the alerts are written, so the batch is neither
    cached nor scanned again.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        counted = batch.observe(seen, *[c.alias(n) for n, c in _counts(p).items()])
        alerts = counted.filter(is_fraud(p)).select(
            *TXN_COLUMNS, F.col("nameOrig").alias("key"), fraud_alert(p).alias("value"))
        write_alerts(alerts, batch_id)
        n = seen.get
        rate = n["flagged_count"] / n["total_count"] * 100.0 if n["total_count"] else 0.0
        row = batch.sparkSession.createDataFrame(
            [(batch_id, None, n["total_count"], n["parsed_count"], n["flagged_count"], rate,
              app_name, p.rule_id)], METRICS)
        write_metrics(row.withColumn("batch_ts", utc_iso_now()), batch_id)

    return handle


def fraud_stream(txns: DataFrame, alerts_path: str, metrics_path: str, checkpoint: str,
                 stream: StreamParams, p: FraudParams = FraudParams(),
                 topic: Callable[[DataFrame, int], None] | None = None) -> DataStreamWriter:
    """Writer of alerts and metrics; replaying a batch replaces what it wrote.

    A ``topic`` gets the alerts as they were stored, so the batch is not read again.
    """
    store = batches.parquet_writer(alerts_path)
    writer = store if topic is None else batches.stored_then(store, alerts_path, topic)
    handle = fraud_batch(writer, batches.json_writer(metrics_path), p)
    return batches.configure(txns.writeStream.foreachBatch(handle), checkpoint, stream, APP_NAME)
