"""Micro-batch writers.

A micro-batch can run again after a failure. Each batch therefore owns one
``batch_id=N`` folder that it overwrites, which makes the output exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..params import StreamParams
from .tables import write_parquet


def _folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def parquet_writer(path: str, partition_by: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    def write(df: DataFrame, batch_id: int) -> None:
        write_parquet(df, _folder(path, batch_id), partition_by)

    return write


def json_writer(path: str) -> Callable[[DataFrame, int], None]:
    def write(df: DataFrame, batch_id: int) -> None:
        # The id is the folder name, so it is not stored in the rows again.
        df.drop("batch_id").write.mode("overwrite").json(_folder(path, batch_id))

    return write


def kafka_writer(bootstrap_servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Key and value to a topic. A replayed batch is delivered again, as Kafka allows."""

    def write(df: DataFrame, batch_id: int) -> None:
        (df.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())

    return write


def stored_then(store: Callable[[DataFrame, int], None], path: str,
                topic: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Store a batch under ``path``, then send what was stored: computed once, not cached."""

    def write(df: DataFrame, batch_id: int) -> None:
        store(df, batch_id)
        # The schema is known, so an empty batch without files reads as no rows.
        topic(df.sparkSession.read.schema(df.schema).parquet(_folder(path, batch_id)), batch_id)

    return write


def with_alert_date(df: DataFrame) -> DataFrame:
    return df.withColumn("alert_date", F.to_date("window_end"))


def configure(writer: DataStreamWriter, checkpoint: str, p: StreamParams,
              name: str | None = None) -> DataStreamWriter:
    """Checkpoint and trigger; ``once`` drains what is available and stops."""
    if name:
        writer = writer.queryName(name)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if p.once else writer.trigger(processingTime=p.trigger)


def reset_checkpoint(spark: SparkSession, checkpoint: str) -> bool:
    """Forget the progress of a stopped query. True if there was any."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path) and fs.delete(path, True)


def stop_on_signal(*queries: StreamingQuery, patience: float = 600.0) -> None:
    """When the process is asked to end, let every running micro-batch finish, then stop all queries.

    A batch that lasts longer than ``patience`` seconds is given up; it runs again at the next start.
    """
    import signal
    import time

    def stop(signum, frame) -> None:
        until = time.monotonic() + patience
        waiting = [q for q in queries if q.isActive]
        while waiting and time.monotonic() < until:
            for q in [q for q in waiting if not q.status["isTriggerActive"]]:
                q.stop()
                waiting.remove(q)
            time.sleep(0.05)
        for q in waiting:
            q.stop()

    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, stop)
