"""Streaming sources of transaction messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payloads import decode_txn
from ..operators.expressions import once
from ..params import StreamParams

# The columns of a message, named as the Kafka source names them.
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def read_message_stream(spark: SparkSession, p: StreamParams) -> DataFrame:
    """Stream of key, value, partition, offset and timestamp."""
    if p.kind == "kafka":
        raw = (spark.readStream.format("kafka")
               .option("kafka.bootstrap.servers", p.bootstrap_servers)
               .option("subscribe", p.location)
               .option("startingOffsets", p.starting_offsets)
               .option("maxOffsetsPerTrigger", p.max_per_trigger)
               .option("failOnDataLoss", "false")
               .load())
        return raw.select(*[F.col(f.name).cast(f.dataType) for f in MESSAGE.fields])
    if p.kind in ("json", "parquet"):
        return (spark.readStream.schema(MESSAGE)
                .option("maxFilesPerTrigger", p.max_per_trigger)
                .format(p.kind).load(p.location))
    raise ValueError(f"unknown stream kind {p.kind!r}: use kafka, json or parquet")


def decode_stream(messages: DataFrame) -> DataFrame:
    """Transaction columns beside the message position; works on batches as well."""
    return (once(messages, "txn", decode_txn(F.col("value").cast("string")))
            .select(F.col("key").alias("kafka_key"), F.col("partition").alias("kafka_partition"),
                    F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("kafka_ts"),
                    "txn.*"))


def read_txn_stream(spark: SparkSession, p: StreamParams) -> DataFrame:
    return decode_stream(read_message_stream(spark, p))
