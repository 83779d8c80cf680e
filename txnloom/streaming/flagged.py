"""Rolling table of flagged transactions, kept up to date by a stream of alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.clock import utc_iso_now
from ..operators.dimensions import flagged_transactions
from ..operators.expressions import once
from ..operators.latest import rolling_latest, with_dedup_id
from ..params import SIM_EPOCH, StreamParams
from ..schemas import TXN
from ..sinks.batches import configure

# An alert names its key in one of three ways; only the exact spelling tells them apart.
ALERT = T.StructType([*TXN.fields, T.StructField("id", T.StringType()),
                      T.StructField("fraud_rule", T.StringType()),
                      T.StructField("detected_at", T.StringType())])


def decode_alerts(messages: DataFrame) -> DataFrame:
    """Alert columns and the message position; messages that are not JSON are dropped."""
    text = F.col("value").cast("string")
    body = F.coalesce(F.get_json_object(text, "$.payload"), text)
    spelled = F.coalesce(F.get_json_object(F.col("_body"), "$.txnId"),
                         F.get_json_object(F.col("_body"), "$.txnID"))
    opened = once(messages, "_body", body)
    decoded = once(opened, "_alert", F.from_json("_body", ALERT))
    return (decoded.withColumn("_txn_id", spelled)
            .select(F.col("offset").alias("kafka_offset"), "_alert.*", "_txn_id")
            .withColumn("txnId", F.col("_txn_id")).drop("_txn_id"))


def _versions(spark: SparkSession, target: str) -> list[int]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = "_SUCCESS"
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.split("=")[1]) for n in names
                  if n.startswith("version=") and fs.exists(Path(f"{target}/{n}/{done}")))


def read_flagged(spark: SparkSession, target: str) -> DataFrame:
    """Newest finished version of the table."""
    newest = _versions(spark, target)[-1]
    return spark.read.parquet(f"{target}/version={newest}").drop("first_arrival", "last_arrival")


def _arrived(keyed: DataFrame, arrival, epoch: str) -> DataFrame:
    shaped = (keyed.withColumn("txnId", F.col("dedup_id")).withColumn("bridged_at", utc_iso_now())
              .withColumn("_arrival", arrival))
    out = flagged_transactions(shaped, epoch, keep=("_arrival",))
    return out.withColumn("first_arrival", F.col("_arrival")).withColumnRenamed(
        "_arrival", "last_arrival")


def flagged_batch(target: str, max_rows: int = 50000, epoch: str = SIM_EPOCH):
    """Handler that writes version N of the table from version N-1 and batch N.

    A replayed batch starts from the same earlier version and overwrites its own
    result. The table never holds more than ``max_rows``, however long it runs.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keyed = with_dedup_id(batch, ("txnId", "id"))
        arrival = F.struct(F.lit(batch_id).cast("long").alias("batch"),
                           F.col("kafka_offset").cast("long").alias("at"))
        rows = _arrived(keyed, arrival, epoch)
        earlier = [v for v in _versions(spark, target) if v < batch_id]
        if earlier:
            rows = rows.unionByName(spark.read.parquet(f"{target}/version={earlier[-1]}"))
        merged = rolling_latest(rows, "txnId", "last_arrival", max_rows, first="first_arrival")
        merged.write.mode("overwrite").parquet(f"{target}/version={batch_id}")
        Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = Path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for old in earlier[:-1]:
            fs.delete(Path(f"{target}/version={old}"), True)

    return handle


def maintain_flagged(alerts: DataFrame, target: str, checkpoint: str, stream: StreamParams,
                     max_rows: int = 50000, epoch: str = SIM_EPOCH) -> DataStreamWriter:
    return configure(alerts.writeStream.foreachBatch(flagged_batch(target, max_rows, epoch)),
                     checkpoint, stream, "txnloom-flagged")
