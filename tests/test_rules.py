import datetime as dt

import pytest

from pyspark.sql import functions as F

from txnloom.functions import clock, rules
from txnloom.operators import checks, dimensions
from txnloom.params import ChurnParams, ClvParams, SEGMENTS


def _value(spark, column):
    return spark.range(1).select(column).first()[0]


def _d(v):
    return F.lit(v).cast("double")


@pytest.mark.parametrize("rate, churn, normal, want", [
    (12.5, .30, False, 7.62), (None, None, False, 0.0), (None, .5, False, 0.2), (10.0, None, False, 6.0),
    (50.0, .4, True, 0.46)])
def test_composite(spark, rate, churn, normal, want):
    assert _value(spark, rules.composite_risk(_d(rate), _d(churn), normalize=normal)) == want


@pytest.mark.parametrize("num, den, want, blank", [(1000.0, 4, 250.0, 250.0), (0.0, 0, 0.0, None), (None, None, 0.0, None)])
def test_safe_ratio(spark, num, den, want, blank):
    assert _value(spark, rules.safe_ratio(_d(num), _d(den))) == want
    assert _value(spark, rules.safe_ratio(_d(num), _d(den), blank=True)) == blank


@pytest.mark.parametrize("step, want", [(1, True), (168, True), (0, False), (169, False), (None, False)])
def test_step_window(spark, step, want):
    assert _value(spark, rules.in_step_window(F.lit(step).cast("int"))) is want


@pytest.mark.parametrize("step, want", [(1, "2023-01-01 00:00"), (25, "2023-01-02 00:00"), (168, "2023-01-07 23:00")])
def test_step_times(spark, step, want):
    ts = clock.event_ts(F.lit(step))
    assert _value(spark, F.date_format(ts, "yyyy-MM-dd HH:mm")) == want
    assert _value(spark, clock.step_of(ts)) == step


def test_dim_date(spark):
    rows = dimensions.dim_date(spark, 168).orderBy("step").collect()
    assert len(rows) == 168 and len({r.date for r in rows}) == 7
    assert (rows[0].day_name, rows[0].hour_of_day, rows[0].iso_week, rows[0].week_start) == (
        "Sunday", 0, "2022-W52", dt.date(2022, 12, 26))
    assert rows[24].iso_week == "2023-W01"
    types = {r.transaction_type: r.type_group for r in dimensions.dim_transaction_type(spark).collect()}
    assert len(types) == 5 and [t for t, g in types.items() if g == "inflow"] == ["CASH_IN"]


@pytest.mark.parametrize("gap, want", [(0, 1.0), (12, 0.75), (47, 1 - 47 / 48), (48, 0.0), (500, 0.0)])
def test_recency(spark, gap, want):
    assert _value(spark, rules.recency(F.lit(gap), ClvParams())) == want


@pytest.mark.parametrize("x, lo, hi, want", [(5, 0, 10, 0.5), (5, 5, 5, 0.0), (-1, 0, 10, 0.0), (11, 0, 10, 1.0), (1, None, None, 0.0)])
def test_min_max(spark, x, lo, hi, want):
    assert _value(spark, rules.min_max(_d(x), _d(lo), _d(hi))) == want


def test_bands(spark):
    cases = [(rules.churn_band, .66, "High"), (rules.churn_band, .65, "Medium"), (rules.churn_band, .33, "Medium"),
             (rules.churn_band, .32, "Low"), (rules.risk_band, .60, "High"), (rules.risk_tier, .60, "Medium"),
             (rules.risk_band, .25, "Medium"), (rules.income_band, 250000, "250k+"), (rules.income_band, 100000, "100-250k"),
             (rules.income_band, 50000, "50-100k"), (rules.income_band, 49999, "<50k"), (rules.amount_band, 1e6, "1M+"),
             (rules.amount_band, 5e5, "500k-1M"), (rules.amount_band, 2e5, "200-500k"), (rules.amount_band, 1, "<200k")]
    got = spark.range(1).select(*[f(F.lit(v)).alias(f"c{i}") for i, (f, v, _) in enumerate(cases)]).first()
    assert list(got) == [w for *_, w in cases]
    assert _value(spark, rules.clv_tier(F.lit(None).cast("string"))) == "Unscored"


def _profiles(spark, counts):
    rows = spark.createDataFrame(list(counts), "segment string, n int")
    return rows.select("segment", F.explode(F.sequence(F.lit(1), "n"))).drop("col")


def test_segments(spark):
    full = list(zip(SEGMENTS, (3, 5, 2, 1, 4)))
    assert checks.segment_problems(_profiles(spark, full)).count() == 0
    odd = _profiles(spark, full[:-1] + [("Platinum", 2), (None, 5)])
    assert {tuple(r) for r in checks.segment_problems(odd).collect()} == {
        ("missing segment", "Student", 0), ("unexpected segment", "Platinum", 2), ("no segment", None, 5)}


def test_key_check(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert tuple(checks.key_check(df, "k").first()) == (4, 1, 2, 1)


def test_range_checks(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (None,)], "s double")
    assert [tuple(r) for r in checks.violations(df, "d", {"t": checks.within("s", 0, 1)}).collect()] == [("d", "t", 2)]


def test_params_from_env():
    p = ChurnParams.from_env({"CHURN_WINDOW_STEPS": "48", "CHURN_FREQ_HIST_PER_12": "2.5", "CHURN_MIN_SIGNALS": ""})
    assert (p.window_steps, p.freq_hist_per_12, p.min_signals) == (48, 2.5, 2)
