"""Landing of messages as partitioned Parquet, with a dead-letter output, from one check of each message."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.clock import event_ts
from ..operators.ingest import message_checks
from ..params import SIM_EPOCH, StreamParams
from ..schemas import TXN, TXN_COLUMNS
from ..session import hadoop_path
from ..sinks.batches import configure, json_writer, parquet_writer
from ..sinks.versions import BatchLog
from ..sources.messages import decode_stream

_DEAD = ("key", "value", "partition", "offset", "problems")


def landed_log(path: str, partition_by: str = "step") -> BatchLog:
    """The landed rows: a folder per trigger, compacted in place, by step or day."""
    schema = TXN if partition_by == "step" else T.StructType([*TXN.fields, T.StructField("day", T.DateType())])
    return BatchLog(path, schema, (partition_by,))


def landing_batch(table_path: str, dead_path: str, staging: str, partition_by: str = "step", epoch: str = SIM_EPOCH,
                  files_per_folder: int = 4, compact_every: int = 0) -> Callable[[DataFrame, int], None]:
    """Handler of one micro-batch: checks every message once, then writes good rows and bad messages.

    The checked messages are stored first, and both outputs read the stored ones. All three folders belong to
    the batch, so a replay overwrites them. Rows of one folder meet in at most ``files_per_folder`` tasks.
    """
    log = landed_log(table_path, partition_by)
    dead = json_writer(dead_path)

    def handle(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        checked = message_checks(messages)
        parquet_writer(staging)(checked, batch_id)
        stored = spark.read.schema(checked.schema).parquet(f"{staging.rstrip('/')}/batch_id={batch_id}")
        bad = F.size("problems") > 0
        rows = decode_stream(stored.where(~bad)).select(*TXN_COLUMNS)
        if partition_by == "day":
            rows = rows.withColumn("day", F.to_date(event_ts(F.col("step"), epoch)))
        log.write(rows.repartition(F.col(partition_by), F.pmod(F.xxhash64("txnId"), F.lit(files_per_folder))), batch_id)
        dead(stored.where(bad).select(*_DEAD), batch_id)
        # Earlier batches are committed, so what was staged for them is not needed again.
        _, old, fs = hadoop_path(spark, f"{staging.rstrip('/')}/batch_id={batch_id - 1}")
        fs.delete(old, True)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_landed(spark, log, batch_id, files_per_folder)

    return handle


def landing_stream(messages: DataFrame, table_path: str, dead_path: str, checkpoint: str, stream: StreamParams,
                   partition_by: str = "step", epoch: str = SIM_EPOCH, files_per_folder: int = 4,
                   compact_every: int = 0) -> DataStreamWriter:
    """Writer of good rows and bad messages.

    ``partition_by`` may be ``day``: many steps of little data make small files. The trigger interval sets how
    long a file collects rows; every ``compact_every`` triggers (0: never) the small files are put together.
    """
    handle = landing_batch(table_path, dead_path, f"{checkpoint.rstrip('/')}-checked", partition_by, epoch, files_per_folder, compact_every)
    return configure(messages.writeStream.foreachBatch(handle), f"{checkpoint}/landing", stream, "txnloom-landing")


def compact_landed(spark: SparkSession, log: BatchLog, batch_id: int, files_per_folder: int = 4) -> None:
    """The landed folders with few files each, in place: readers see the old files or the new ones."""
    deal = F.pmod(F.xxhash64("txnId"), F.lit(files_per_folder))
    log.compact(spark, batch_id, lambda rows: rows.repartition(*[F.col(c) for c in log.partition_by], deal))
