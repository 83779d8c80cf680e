"""Batch readers of transactions and of the datasets derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import parsed
from ..schemas import BASELINE, CSV_COLUMNS, METRICS, TXN
from ..session import exists

# The columns every batch job needs.
CORE_COLUMNS = ("step", "type", "amount", "nameOrig", "newbalanceOrig", "nameDest", "isFraud")


class SourceError(RuntimeError):
    """A dataset is missing, empty or lacks columns."""


def local_uri(path: str) -> str:
    """A bare absolute path means the local file system, not the default one."""
    return f"file://{path}" if path.startswith("/") and "://" not in path else path


def check_header(df: DataFrame, required: Sequence[str] = tuple(CSV_COLUMNS)) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SourceError(f"missing required column(s): {', '.join(missing)}")
    return df


def read_csv(spark: SparkSession, path: str, schema=TXN) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(local_uri(path))


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a CSV as text, header checked, for the row parser."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(local_uri(path))
    return check_header(raw)


def load_transactions(spark: SparkSession, kind: str, location: str,
                      columns: Sequence[str] | None = CORE_COLUMNS,
                      exact_money: bool = False, valid_only: bool = True) -> DataFrame:
    """Transactions from ``csv``, ``parquet`` or a catalog ``table``.

    Rows without a type or a sender are left out unless ``valid_only`` is off.

    ``exact_money`` reads amounts as DECIMAL(18,2), which makes every sum exact
    and independent of the row order.
    """
    try:
        if kind == "csv":
            df = read_csv(spark, location)
        elif kind == "parquet":
            df = spark.read.parquet(location)
        elif kind == "table":
            df = spark.table(location)
        else:
            raise ValueError(f"unknown source kind {kind!r}: use csv, parquet or table")
    except AnalysisException as exc:
        raise SourceError(f"could not read {kind} {location}; has any data landed? ({exc})") from exc
    if columns is not None:
        df = check_header(df, columns).select(*columns)
    if exact_money and "amount" in df.columns:
        df = df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    return df.filter(parsed()) if valid_only else df


def register_transactions(spark: SparkSession, kind: str, location: str,
                          view: str = "txn_source") -> DataFrame:
    """Offer the transactions as a temp view; an empty source is an error."""
    df = load_transactions(spark, kind, location)
    if df.isEmpty():
        raise SourceError(f"no transactions in {kind} {location}")
    df.createOrReplaceTempView(view)
    return df


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Customer baseline, or no rows where none was built yet. A wrong schema is an error."""
    wanted = ("customerId", "hist_freq_per_12", "all_time_avg_amount")
    if not exists(spark, path):
        return spark.createDataFrame([], BASELINE).select(*wanted)
    return spark.read.parquet(path).select(*wanted)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Micro-batch metrics from JSON lines; a rate stored as text is read as well."""
    text_rate = T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "fraud_rate_pct" else f.dataType)
        for f in METRICS.fields])
    return (spark.read.schema(text_rate).json(path)
            .withColumn("fraud_rate_pct", F.col("fraud_rate_pct").cast("double")))
