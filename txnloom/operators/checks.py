"""Data-quality checks. Each returns rows of counts; nothing raises on bad data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import confirmed_fraud, is_fraud
from ..params import SEGMENTS, FraudParams
from ..schemas import CONTRACTS


def segment_counts(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


def segment_problems(profiles: DataFrame, expected: Sequence[str] = SEGMENTS) -> DataFrame:
    """Expected segments nobody has, other segments in use, and customers without one."""
    wanted = profiles.sparkSession.createDataFrame([(s, True) for s in expected],
                                                   "segment string, wanted boolean")
    both = segment_counts(profiles).join(wanted, "segment", "full")
    problem = (F.when(F.col("wanted") & F.col("n").isNull(), "missing segment")
               .when(F.col("segment").isNull(), "no segment")
               .when(F.col("wanted").isNull(), "unexpected segment"))
    return (both.withColumn("problem", problem).filter(F.col("problem").isNotNull())
            .select("problem", "segment", F.coalesce("n", F.lit(0)).alias("customers")))


def key_check(df: DataFrame, key: str) -> DataFrame:
    """Rows, missing keys, and distinct keys; more rows than keys means fan-out."""
    # Count per key first: two plain sums instead of a distinct count over all rows.
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    missing = F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
                       missing.alias("missing_keys"),
                       F.count_if(F.col(key).isNotNull()).alias("distinct_keys"),
                       F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1))
                       .alias("repeated_keys"))


def rule_violations(flagged: DataFrame, p: FraudParams = FraudParams()) -> DataFrame:
    """Flagged rows, and those among them that break the rule (expected: none)."""
    holds = F.coalesce(is_fraud(p), F.lit(False))
    return flagged.agg(F.count(F.lit(1)).alias("flagged"), F.count_if(~holds).alias("violations"))


def violations(df: DataFrame, dataset: str, tests: Mapping[str, Column]) -> DataFrame:
    """Rows that fail each named test, all counted in one pass."""
    named = list(tests.items())
    counts = df.agg(*[F.count_if(~F.coalesce(t, F.lit(False))).alias(f"_{i}")
                      for i, (_, t) in enumerate(named)])
    rows = F.array(*[F.struct(F.lit(n).alias("test"), F.col(f"_{i}").alias("failures"))
                     for i, (n, _) in enumerate(named)])
    return counts.select(F.lit(dataset).alias("dataset"), F.explode(rows).alias("r")).select(
        "dataset", "r.*")


def within(c: str, lo: float, hi: float) -> Column:
    return F.col(c).between(lo, hi)


def reconcile(txns: DataFrame, mart: DataFrame, view: DataFrame,
              summary: DataFrame) -> DataFrame:
    """Totals of derived tables beside those of the transactions they come from.

    ``summary`` is the per-type-and-step table over the whole step range.
    """
    base = txns.agg(F.struct(F.count(F.lit(1)).alias("n"),
                             F.count_if(confirmed_fraud()).alias("fraud")).alias("b")).scalar()
    seen = view.agg(F.count(F.lit(1)).alias("n")).scalar()
    summed = summary.agg(F.struct(F.sum("transaction_count").alias("n"),
                                  F.sum("fraud_count").alias("fraud")).alias("s")).scalar()
    keys = (mart.groupBy("customerId", "step")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("txn_count").alias("txns"),
                 F.sum("fraud_count").alias("fraud")))
    # The scalars meet one row, as plain columns.
    one = (keys.agg(F.sum("rows").alias("mart_rows"), F.count(F.lit(1)).alias("mart_keys"),
                    F.sum("txns").alias("txns"), F.sum("fraud").alias("fraud"))
           .withColumn("_b", base).withColumn("_v", seen).withColumn("_s", summed))
    pairs = (("mart rows are unique per customer and step", "mart_rows", "mart_keys"),
             ("mart transactions equal base", "txns", "_b.n"),
             ("mart fraud equals base", "fraud", "_b.fraud"),
             ("fraud view equals base fraud", "_v", "_b.fraud"),
             ("summary transactions equal base", "_s.n", "_b.n"),
             ("summary fraud equals base", "_s.fraud", "_b.fraud"))
    rows = F.array(*[F.struct(F.lit(name).alias("check"),
                              F.col(a).cast("long").alias("actual"),
                              F.col(b).cast("long").alias("expected")) for name, a, b in pairs])
    return (one.select(F.explode(rows).alias("r")).select("r.*")
            .withColumn("ok", F.col("actual") == F.col("expected")))


def missing_columns(df: DataFrame, dataset: str) -> list[str]:
    """Columns of the dataset's contract that ``df`` lacks; looks at the schema only."""
    return [c for c in CONTRACTS[dataset] if c not in df.columns]
