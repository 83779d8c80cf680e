"""Graph bulk-load CSV files with typed headers such as ``amount:float``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import GRAPH_ACCOUNT, GRAPH_RECEIVED, GRAPH_SENT, GRAPH_TXN
from .tables import check_header, local_uri

# Header names of the four files, in schema order.
HEADERS = {
    "accounts": ("accountId:ID", "accountType"),
    "transactions": ("txnId:ID", "step:int", "type", "amount:float", "isFraud:int"),
    "sent": (":START_ID", ":END_ID", "amount:float", "step:int", "transactionType"),
    "received": (":START_ID", ":END_ID", "newbalanceDest:float", "isFraud:int"),
}
_SCHEMAS = {"accounts": GRAPH_ACCOUNT, "transactions": GRAPH_TXN,
            "sent": GRAPH_SENT, "received": GRAPH_RECEIVED}


@dataclass(frozen=True)
class Graph:
    accounts: DataFrame
    transactions: DataFrame
    sent: DataFrame
    received: DataFrame


def read_graph_file(spark: SparkSession, kind: str, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(local_uri(path))
    header = HEADERS[kind]
    check_header(raw, header)
    return raw.select(*[
        F.trim(F.col(f"`{name}`")).cast(field.dataType).alias(field.name)
        for name, field in zip(header, _SCHEMAS[kind].fields)])


def read_graph(spark: SparkSession, paths: dict[str, str]) -> Graph:
    return Graph(**{kind: read_graph_file(spark, kind, paths[kind]) for kind in HEADERS})
