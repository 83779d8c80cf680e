"""Runs of consecutive low balances, as summaries that can be put together.

A summary of an ordered stretch of events holds its length ``n``, the low run it
starts with ``pre``, the low run it ends with ``suf`` and the longest ``best``.
Two neighbouring stretches combine without looking at their events again, so a
very active customer is split into stretches that different tasks summarise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_low(balance: Column, threshold: float) -> Column:
    """An unknown balance is not low, so it ends a run."""
    return F.coalesce(balance < F.lit(threshold), F.lit(False))


def _summary(n: Column, pre: Column, suf: Column, best: Column) -> Column:
    return F.struct(n.cast("long").alias("n"), pre.cast("long").alias("pre"),
                    suf.cast("long").alias("suf"), best.cast("long").alias("best"))


def summarise(events: Column) -> Column:
    """Summary of an array of structs with a boolean ``low``, already in order."""
    zero = F.lit(0)

    def add(acc: Column, e: Column) -> Column:
        low = e["low"]
        run = F.when(low, acc["suf"] + 1).otherwise(F.lit(0).cast("long"))
        return _summary(acc["n"] + 1,
                        F.when(low & (acc["pre"] == acc["n"]), acc["pre"] + 1).otherwise(acc["pre"]),
                        run, F.greatest(acc["best"], run))

    return F.aggregate(events, _summary(zero, zero, zero, zero), add)


def longest(stretches: Column) -> Column:
    """Longest low run over an array of structs with a ``run`` summary, in order."""
    start = F.struct(F.lit(0).cast("long").alias("open"), F.lit(0).cast("long").alias("best"))

    def add(acc: Column, s: Column) -> Column:
        r = s["run"]
        return F.struct(
            F.when(r["pre"] == r["n"], acc["open"] + r["n"]).otherwise(r["suf"]).alias("open"),
            F.greatest(acc["best"], r["best"], acc["open"] + r["pre"]).alias("best"))

    return F.aggregate(stretches, start, add, lambda acc: acc["best"])


def of_bits(there: Column, low: Column, width: int) -> Column:
    """Summary of up to ``width`` events, each a bit of ``there`` and, if low, of ``low``, in order of their bits."""
    places = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.getbit(there, i) == 1)
    return summarise(F.transform(places, lambda i: F.struct((F.getbit(low, i) == 1).alias("low"))))


def joined(stretches: Column) -> Column:
    """One summary of an array of structs with a ``run`` summary, in order."""
    zero = F.lit(0)

    def add(acc: Column, s: Column) -> Column:
        r = s["run"]
        return _summary(acc["n"] + r["n"],
                        F.when(acc["pre"] == acc["n"], acc["n"] + r["pre"]).otherwise(acc["pre"]),
                        F.when(r["suf"] == r["n"], acc["suf"] + r["n"]).otherwise(r["suf"]),
                        F.greatest(acc["best"], r["best"], acc["suf"] + r["pre"]))

    return F.aggregate(stretches, _summary(zero, zero, zero, zero), add)
