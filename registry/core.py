"""Registration of queries and assembly of oracle SQL from shared CTEs."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .ctes import CTES


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    plan: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def _used(text: str) -> list[str]:
    """Names of the CTEs a text needs, each after those it needs itself."""
    ordered: list[str] = []

    def visit(body: str) -> None:
        for name, sub in CTES.items():
            if name not in ordered and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", body):
                visit(sub)
                ordered.append(name)

    visit(text)
    return ordered


def sql(body: str) -> str:
    names = _used(body)
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + body


def query(name: str, ids: str, oracle: str | None = None):
    """Register a plan under a name, with the inventory ids it covers."""

    def add(plan: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plan(spark, sf_dir)

        QUERIES[name] = Query(name, tuple(ids.split()), run, sql(oracle) if oracle else None)
        return plan

    return add
