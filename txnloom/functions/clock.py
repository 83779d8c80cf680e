"""Conversions between integer steps (one hour each) and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import SIM_EPOCH


def _epoch(epoch: str) -> Column:
    return F.lit(epoch).cast("timestamp")


def event_ts(step: Column, epoch: str = SIM_EPOCH) -> Column:
    """Start of a step: step 1 is the epoch itself."""
    return F.timestamp_add("HOUR", step.cast("int") - 1, _epoch(epoch))


def step_of(ts: Column, epoch: str = SIM_EPOCH) -> Column:
    """Step that starts at, or contains, a timestamp."""
    hours = (F.unix_timestamp(ts) - F.unix_timestamp(_epoch(epoch))) / F.lit(3600)
    return (hours + 1).cast("int")


def utc_iso_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Calendar attributes of a timestamp; the ISO year may differ from the year."""
    iso_year = F.extract(F.lit("YEAROFWEEK"), ts).cast("string")
    iso_week = F.lpad(F.weekofyear(ts).cast("string"), 2, "0")
    return {
        "date": F.to_date(ts),
        "hour_of_day": F.hour(ts),
        "day_name": F.date_format(ts, "EEEE"),
        "iso_week": F.concat(iso_year, F.lit("-W"), iso_week),
        "week_start": F.to_date(F.date_trunc("week", ts)),
    }
