"""Plan-shaping helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later steps use many times.

    Spark copies a projected expression into every use of it, so a filter on
    thirty fields of a parsed document would parse it thirty times. A generator
    of one row is not copied; it fixes the value in a column.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
