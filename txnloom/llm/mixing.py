"""Mixing sources to target weights by Poisson replication.

Every source has a target share of the words; its repetition rate is what turns its own words into
that share. A document is repeated a Poisson number of times with its source's rate as mean: the
distribution is inverted at a uniform number hashed from the document, so a rerun repeats the same
documents. Copies are exploded and sorted by a hash over the whole cluster.

Defined cases: a NULL source is a source of its own. NULL and empty texts have no words; they take part
at the rate of their source, and a source without any word is left out (rate 0). Repeated rows get the
same count each. A NULL doc_id hashes as its text. An empty table gives an empty result. Extra columns
stay; input columns named like the added ones are replaced. Uniform numbers have 52 bits and are below
1, so a count is finite.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ADDED = ("n_copies", "copy_no", "shuffle_key")


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, power: float = 0.5,
                 epochs: float = 1.0) -> DataFrame:
    """Mean repetition per source: (source, rate).

    The total stays ``epochs`` times the words there are. Without ``weights`` a source weighs its words
    to the given power; a source that ``weights`` does not name has weight 0.
    """
    have = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).cast("double").alias("have")).where("have > 0")
    if weights is None:
        weight = F.sqrt("have") if power == 0.5 else F.pow("have", F.lit(power))
    else:
        weight = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]),
                                         F.coalesce("source", F.lit(""))), F.lit(0.0))
    have = have.withColumn("weight", weight)
    # One row of totals; weights are added in ascending order, so the sum does not depend on the tasks.
    total = have.agg(F.sum("have").alias("have_all"), F.aggregate(
        F.array_sort(F.collect_list("weight")), F.lit(0.0), lambda a, b: a + b).alias("weight_all"))
    return (have.join(F.broadcast(total))
            .select("source", (F.lit(epochs) * F.col("have_all") * (F.col("weight") / F.col("weight_all"))
                               / F.col("have")).alias("rate")).where("rate > 0"))


def poisson_steps(rate: Column) -> Column:
    """Cumulative Poisson probabilities for 0, 1, 2, ... up to where the rest is below 2**-53.

    Terms are built as logarithms, so no rate is too large for them.
    """
    top = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct((-rate).alias("lp"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def step(a, i):
        lp = a["lp"] + (F.log(rate) - F.log(i.cast("double")))
        total = a["sum"] + F.exp(lp)
        return F.struct(lp.alias("lp"), total.alias("sum"), F.concat(a["steps"], F.array(total)).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), top), start, step)["steps"]


def _uniform(label: str, *parts: Column) -> Column:
    text = F.concat(F.lit(label), *parts)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2 ** 52))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, power: float = 0.5,
                epochs: float = 1.0, seed: int = 17, small_sources: int = 10_000, spread: int = 64) -> DataFrame:
    """The documents, each as often as its Poisson count says, in a global random order.

    Up to ``small_sources`` sources their steps are broadcast, so no document moves for the join.
    Beyond that both sides meet by (source, salt), with ``spread`` salts per source, so a source that
    holds a third of all rows is dealt over many tasks.
    """
    spark = docs.sparkSession
    rates = stored(source_rates(docs, weights, power, epochs), "rates")
    steps = rates.select(F.col("source").alias("_source"), poisson_steps(F.col("rate")).alias("_steps"))
    identity = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.lit(":"),
                        F.md5(F.coalesce("text", F.lit(""))))
    held = docs.select(*[c for c in docs.columns if c.lower() not in ADDED]).withColumn("_identity", identity)
    same = F.col("source").eqNullSafe(F.col("_source"))
    if rates.count() <= small_sources:
        joined = held.join(F.broadcast(steps), same)
    else:
        salts = spark.range(spread).select(F.col("id").alias("_salt"))
        joined = (held.withColumn("_at", F.pmod(F.xxhash64("_identity"), F.lit(spread)))
                  .join(steps.join(F.broadcast(salts)), same & (F.col("_at") == F.col("_salt"))).drop("_at", "_salt"))
    u = _uniform(f"mix-{seed}:", F.col("_identity"))
    counted = (joined.withColumn("_u", u)
               .withColumn("n_copies", F.expr("cast(size(filter(_steps, c -> c <= _u)) as bigint)"))
               .where("n_copies > 0").drop("_steps", "_source", "_u"))
    copies = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    key = F.md5(F.concat(F.lit(f"order-{seed}:"), "_identity", F.lit(":"), F.col("copy_no").cast("string")))
    return copies.withColumn("shuffle_key", key).drop("_identity").orderBy("shuffle_key")
