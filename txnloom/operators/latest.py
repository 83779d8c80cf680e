"""Keep the latest row per key, and the newest rows of a rolling table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Row with the largest ``order`` per key.

    Spark limits every map task to one row per key before the shuffle, so a key
    with very many versions does not load a single task.
    """
    ranked = Window.partitionBy(*keys).orderBy(
        *[(F.col(c) if isinstance(c, str) else c).desc() for c in order])
    return (df.withColumn("_rank", F.row_number().over(ranked))
            .filter(F.col("_rank") == 1).drop("_rank"))


def upsert(existing: DataFrame, incoming: DataFrame, key: str,
           order: Sequence[str] = ()) -> DataFrame:
    """Replace rows whole by key; ``order`` decides among incoming rows of one key.

    ``order`` names columns of ``incoming`` that are not stored.
    """
    stored = existing.columns
    old = existing.withColumn("_new", F.lit(0))
    new = incoming.withColumn("_new", F.lit(1))
    extra = [c for c in order if c not in stored]
    both = new.select(*stored, *extra, "_new").unionByName(old, allowMissingColumns=True)
    return latest_by(both, [key], ["_new", *order]).select(*stored)


def rolling_latest(df: DataFrame, key: str, arrival: str, max_rows: int,
                   first: str | None = None) -> DataFrame:
    """Last version of every key, newest ``max_rows`` keys by first arrival.

    An update keeps the place of the first version, and the oldest keys fall out.
    ``first`` names a column that already holds earlier first arrivals; then both
    arrivals are kept, so that the result can be merged again.
    """
    seen = first or arrival
    # The newest keys are found from two columns; only rows of those few keys are ranked and moved.
    heads = (df.groupBy(F.col(key).alias("_key")).agg(F.min(seen).alias("first_arrival"))
             .orderBy(F.desc("first_arrival"), F.desc("_key")).limit(max_rows))
    rest = [c for c in df.columns if c not in (key, arrival, first)]
    kept = (df.drop(first) if first else df).join(F.broadcast(heads), F.col(key).eqNullSafe(F.col("_key")))
    return (latest_by(kept, [key], [arrival])
            .select(key, "first_arrival", *([arrival] if first else []), *rest)
            .orderBy(F.desc("first_arrival"), F.desc(key)))


def with_dedup_id(df: DataFrame, candidates: Sequence[str] = ("txnId", "txnID", "id")) -> DataFrame:
    """Key from the first candidate that holds a value; rows without key or step go.

    Column names are matched exactly, as the spelling tells the candidates apart.
    """
    def value(c: str) -> Column:
        return F.when(F.col(c).cast("string") != "", F.col(c).cast("string"))

    return (df.withColumn("dedup_id", F.coalesce(*[value(c) for c in candidates]))
            .filter(F.col("dedup_id").isNotNull() & F.col("step").isNotNull()))
