"""Churn stream: sliding windows per customer, merged and scored per micro-batch; trailing windows by state.

Sliding windows are the engine's own: it assigns rows to windows, keeps the watermark, drops rows that come
too late for a window and gives up the state of closed windows. A window's state is one small row per
customer, step and stretch of 62 offsets, in which two longs hold a bit per event (seen, low balance), so
stretches combine in any order and on any task, and a hot customer's rows spread over them. A trigger stores
the stretches that changed, and joins those of the windows they belong to, from the stored ones.
Messages of one account arrive in offset order, as they share a partition.

Rows without a step or a type take no part. A row may count in one of its windows and be late for another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.storagelevel import StorageLevel

from ..functions import runs
from ..functions.clock import event_ts, utc_iso_now
from ..functions.payloads import churn_alert
from ..functions.rules import parsed
from ..operators.churn import BITS, churn_alerts, merged_windows
from ..params import ChurnParams, StreamParams
from ..sinks import batches
from ..sinks.versions import BatchLog
from ..sources.tables import read_baseline

APP_NAME = "txnloom-churn-stream"

_KEYS = ("window_start", "window_end", "customerId", "step", "stretch")
_STRETCH = T.StructType(
    [T.StructField("window_end", T.TimestampType()), T.StructField("customerId", T.StringType()), T.StructField("step", T.IntegerType()),
     T.StructField("stretch", T.LongType()), T.StructField("n", T.LongType()), T.StructField("amount", T.DoubleType()),
     *[T.StructField(c, T.LongType()) for c in ("n_amount", "cashout", "payment_debit", "there", "low_at", "window_start")]])


def _events(txns: DataFrame, p: ChurnParams) -> DataFrame:
    return (txns.filter(parsed() & F.col("step").isNotNull())
            .withColumn("event_ts", event_ts(F.col("step"), p.epoch))
            .withWatermark("event_ts", f"{p.watermark_hours} hours"))


def window_stretches(txns: DataFrame, p: ChurnParams = ChurnParams()) -> DataFrame:
    """Stream of the stretches that change, with the window they count in."""
    bit = F.expr(f"shiftleft(1L, CAST(kafka_offset % {BITS} AS INT))")
    low = runs.is_low(F.col("newbalanceOrig"), p.balance_low_threshold)
    kind, amount = F.col("type"), F.col("amount").cast("double")
    return (_events(txns, p)
            .groupBy(F.window("event_ts", f"{p.window_steps} hours", f"{p.slide_steps} hours"),
                     F.col("nameOrig").alias("customerId"), F.col("step").cast("int").alias("step"),
                     F.floor(F.col("kafka_offset") / F.lit(BITS)).alias("stretch"))
            .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(amount), F.lit(0.0)).alias("amount"),
                 F.count(amount).alias("n_amount"), F.count_if(kind == "CASH_OUT").alias("cashout"),
                 F.count_if(kind.isin("PAYMENT", "DEBIT")).alias("payment_debit"),
                 F.bit_or(bit).alias("there"), F.bit_or(F.when(low, bit).otherwise(F.lit(0).cast("long"))).alias("low_at"))
            .withColumns({"window_start": F.unix_timestamp("window.start"), "window_end": F.col("window.end")})
            .select(*_STRETCH.fieldNames()))


def stretch_log(path: str) -> BatchLog:
    """Stored stretches, by the start of their window."""
    return BatchLog(path, _STRETCH, ("window_start",))


def _newest(stretches: DataFrame) -> DataFrame:
    """One row per stretch: all numbers but the amount only grow, so the fullest version is the newest."""
    return stretches.groupBy(*_KEYS).agg(
        F.max_by("amount", "n").alias("amount"),
        *[F.max(c).alias(c) for c in ("n", "n_amount", "cashout", "payment_debit")],
        *[F.bit_or(c).alias(c) for c in ("there", "low_at")])


def _live(p: ChurnParams) -> Callable[[DataFrame], DataFrame]:
    """Keeps the newest stretches of windows that the engine can still update."""
    def keep(stretches: DataFrame) -> DataFrame:
        # The newest window starts at most one window's length after the newest row's.
        last = stretches.agg(F.max("window_end").alias("last"))
        closed = F.col("last") - F.expr(f"INTERVAL {p.watermark_hours + p.window_steps} HOURS")
        return _newest(stretches.crossJoin(F.broadcast(last)).where(F.col("window_end") > closed)).select(*_STRETCH.fieldNames())

    return keep


def touched_windows(spark: SparkSession, log: BatchLog, batch_id: int, p: ChurnParams = ChurnParams()) -> DataFrame:
    """The windows that a stored batch changed, whole, with the columns of the batch window aggregate."""
    changed = log.read_batch(spark, batch_id).select("window_start", "customerId").distinct()
    # Few: a row lies in window_steps / slide_steps windows, and none is older than the watermark allows.
    starts = [r[0] for r in changed.select("window_start").distinct().collect()]
    kept = (log.read(spark).where(F.col("window_start").isin(starts))
            .join(changed, ["window_start", "customerId"], "left_semi"))
    window = F.struct(F.timestamp_seconds("window_start").alias("start"), F.col("window_end").alias("end"))
    return merged_windows(_newest(kept).withColumn("window", window), p)


def window_batch(log: BatchLog, use: Callable[[DataFrame, int], None], p: ChurnParams = ChurnParams(),
                 compact_every: int = 60) -> Callable[[DataFrame, int], None]:
    """Handler of one micro-batch of stretches: store them, give the windows they change to ``use``.

    Every ``compact_every`` batches the log is put into one folder without closed windows, so a trigger
    reads live windows from few files, however long the stream runs.
    """

    def handle(stretches: DataFrame, batch_id: int) -> None:
        spark = stretches.sparkSession
        log.write(stretches, batch_id)
        use(touched_windows(spark, log, batch_id, p), batch_id)
        if batch_id % compact_every == compact_every - 1:
            log.compact(spark, batch_id, _live(p))

    return handle


def window_stream(txns: DataFrame, log_path: str, use: Callable[[DataFrame, int], None], checkpoint: str,
                  stream: StreamParams, p: ChurnParams = ChurnParams(), name: str | None = None) -> DataStreamWriter:
    """Writer that hands every trigger's changed windows to ``use``."""
    handle = window_batch(stretch_log(log_path), use, p)
    return batches.configure(window_stretches(txns, p).writeStream.outputMode("update").foreachBatch(handle),
                             checkpoint, stream, name)


class Baseline:
    """The stored customer baseline, cached until someone rebuilds it."""

    def __init__(self, path: str):
        self.path, self._stamp, self._df = path, None, None

    def _modified(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return fs.getFileStatus(path).getModificationTime() if fs.exists(path) else -1

    def get(self, spark: SparkSession) -> DataFrame:
        stamp = self._modified(spark)
        if self._df is None or stamp != self._stamp:
            if self._df is not None:
                self._df.unpersist()
            self._df = read_baseline(spark, self.path).persist(StorageLevel.MEMORY_AND_DISK)
            self._stamp = stamp
        return self._df


def churn_batch(baseline: Baseline, write_alerts: Callable[[DataFrame, int], None],
                p: ChurnParams = ChurnParams()):
    """Handler of the windows of one micro-batch."""

    def handle(windows: DataFrame, batch_id: int) -> None:
        alerts = (churn_alerts(windows, baseline.get(windows.sparkSession), p)
                  .withColumn("detected_at", utc_iso_now()))
        write_alerts(batches.with_alert_date(alerts).withColumns(
            {"key": F.col("customerId"), "value": churn_alert()}), batch_id)

    return handle


def churn_stream(txns: DataFrame, baseline_path: str, alerts_path: str, checkpoint: str,
                 stream: StreamParams, p: ChurnParams = ChurnParams(),
                 topic: Callable[[DataFrame, int], None] | None = None, windows_path: str | None = None,
                 log_path: str | None = None) -> DataStreamWriter:
    """Writer of alerts by date, and to a topic as well where one is given.

    With ``windows_path`` the changed windows are stored as well, and alerts come from the stored ones.
    Stretches go to ``log_path``, by default beside the checkpoint.
    """
    store = batches.parquet_writer(alerts_path, ("alert_date",))
    writer = store if topic is None else batches.stored_then(store, alerts_path, topic)
    handle = churn_batch(Baseline(baseline_path), writer, p)
    if windows_path:
        handle = batches.stored_then(batches.parquet_writer(windows_path), windows_path, handle)
    return window_stream(txns, log_path or f"{checkpoint.rstrip('/')}-stretches", handle, checkpoint, stream, p, APP_NAME)
