import random

from rows import txns

from pyspark.sql import functions as F

from txnloom.functions import runs
from txnloom.functions.signals import SIGNAL_NAMES
from txnloom.operators import churn
from txnloom.operators.summaries import customer_baseline
from txnloom.params import ChurnParams

HISTORY = {"CHURN-S12": (30, 40000.0), "CHURN-S34": (6, 10000.0), "CHURN-S123": (40, 100000.0),
           "NOFLAG-S1": (25, 10000.0), "NOFLAG-S3": (6, 10000.0), "NOFLAG-NONE": (10, 10000.0)}
STREAM = {"CHURN-S12": [(10, "PAYMENT", 2000.0, 9000.0)],
          "CHURN-S34": [(8, "CASH_OUT", 9500.0, 400.0), (9, "CASH_OUT", 9400.0, 100.0),
                        (10, "CASH_OUT", 9600.0, 50.0)],
          "CHURN-S123": [(12, "CASH_OUT", 500.0, 9000.0)],
          "NOFLAG-S1": [(10, "TRANSFER", 10000.0, 9000.0)],
          "NOFLAG-S3": [(8, "CASH_OUT", 10000.0, 6000.0), (9, "CASH_OUT", 10000.0, 7000.0)],
          "NOFLAG-NONE": [(5, "PAYMENT", 10000.0, 9000.0), (6, "PAYMENT", 10000.0, 9100.0),
                          (7, "PAYMENT", 10000.0, 9200.0)]}
EXPECTED = {("CHURN-S12", ("S1_LOW_FREQUENCY", "S2_AMOUNT_DROP"), 2000.0),
            ("CHURN-S34", ("S3_EXCLUSIVE_CASHOUT", "S4_CONSECUTIVE_LOW_BALANCE"), 9500.0),
            ("CHURN-S123", ("S1_LOW_FREQUENCY", "S2_AMOUNT_DROP", "S3_EXCLUSIVE_CASHOUT"), 500.0)}


def history(spark):
    return txns(spark, [{"nameOrig": c, "step": 1 + round(i * 59 / max(n - 1, 1)), "amount": a}
                        for c, (n, a) in HISTORY.items() for i in range(n)])


def stream_rows():
    rows, at = [], 0
    for c, events in STREAM.items():
        for step, kind, amount, balance in events:
            rows.append({"nameOrig": c, "step": step, "type": kind, "amount": amount,
                         "newbalanceOrig": balance, "kafka_offset": at})
            at += 1
    return rows


def with_offsets(spark, rows):
    return spark.createDataFrame(
        [(r["nameOrig"], r["step"], r["type"], r["amount"], r["newbalanceOrig"], r["kafka_offset"])
         for r in rows],
        "nameOrig string, step int, type string, amount double, newbalanceOrig double, kafka_offset long")


def test_baseline(spark):
    freq = {r.customerId: r.hist_freq_per_12 for r in customer_baseline(history(spark)).collect()}
    assert freq == {"CHURN-S12": 6.0, "CHURN-S34": 1.2, "CHURN-S123": 8.0, "NOFLAG-S1": 5.0,
                    "NOFLAG-S3": 1.2, "NOFLAG-NONE": 2.0}


def test_alerts(spark):
    windows = churn.churn_windows(with_offsets(spark, stream_rows()))
    alerts = churn.churn_alerts(windows, customer_baseline(history(spark))).collect()
    assert len(alerts) == 6
    assert {(a.customerId, tuple(a.signals), a.window_avg_amount) for a in alerts} == EXPECTED
    assert {(a.window_start_step, a.window_end_step) for a in alerts} == {(-11, 12), (1, 24)}


def test_without_baseline_only_window_signals_fire(spark):
    windows = churn.churn_windows(with_offsets(spark, stream_rows()))
    none = spark.createDataFrame([], "customerId string, hist_freq_per_12 double, all_time_avg_amount double")
    alerts = churn.churn_alerts(windows, none).collect()
    assert {a.customerId for a in alerts} == {"CHURN-S34"}


def _signals(spark, hist, usual, n, avg, cash, pd, run=0):
    windows = spark.createDataFrame([("c", n, avg, cash, pd, run)],
                                    "customerId string, w_count long, w_avg_amount double, "
                                    "cashout_count long, payment_debit_count long, low_run long")
    base = spark.createDataFrame([("c", hist, usual)],
                                 "customerId string, hist_freq_per_12 double, all_time_avg_amount double")
    fired = churn.score_windows(windows, base).first().signals
    return {s.split("_")[0] for s in fired}


def test_signal_edges(spark):
    assert "S1" in _signals(spark, 3.01, 1.0, 1, 1.0, 0, 0)
    assert "S1" not in _signals(spark, 3.0, 1.0, 1, 1.0, 0, 0)
    assert "S1" not in _signals(spark, 9.0, 1.0, 2, 1.0, 0, 0)
    assert "S2" in _signals(spark, 1.0, 100.0, 1, 19.99, 0, 0)
    assert "S2" not in _signals(spark, 1.0, 100.0, 1, 20.0, 0, 0)
    assert "S2" not in _signals(spark, 1.0, 0.0, 1, -1.0, 0, 0)
    assert "S2" not in _signals(spark, None, None, 1, 1.0, 0, 0)
    assert "S3" in _signals(spark, None, None, 2, 1.0, 2, 0)
    assert "S3" not in _signals(spark, None, None, 2, 1.0, 1, 0)
    assert "S4" in _signals(spark, None, None, 2, 1.0, 0, 0, 2)
    assert "S4" not in _signals(spark, None, None, 2, 1.0, 0, 0, 1)
    assert len(SIGNAL_NAMES) == 4


def test_low_runs(spark):
    cases = [([9000, 100, 50, 8000], 2), ([0, 0], 2), ([100, 9000, 200], 1), ([500, 500], 0),
             ([499.99, 499.99], 2), ([100, None, 100], 1), ([], 0)]
    for balances, expected in cases:
        df = spark.createDataFrame([([float(b) if b is not None else None for b in balances],)],
                                   "b array<double>")
        events = F.transform("b", lambda b: F.struct(runs.is_low(b, 500.0).alias("low")))
        s = df.select(runs.summarise(events).alias("s")).first().s
        assert (s.best, s.n) == (expected, len(balances)), balances


def _longest(flags):
    best = run = 0
    for f in flags:
        run = run + 1 if f else 0
        best = max(best, run)
    return best


def test_any_stretch_size_gives_the_brute_force_result(spark):
    rng = random.Random(7)
    rows = [{"nameOrig": rng.choice(["C1", "C1", "C1", "C2"]), "step": rng.randint(1, 40), "type": "CASH_OUT",
             "amount": 1.0, "newbalanceOrig": rng.choice([100.0, 400.0, None, 900.0]), "kafka_offset": i}
            for i in range(400)]
    want = {}
    for r in rows:
        for j in (0, 1):
            want.setdefault((r["nameOrig"], ((r["step"] - 1) // 12 - j) * 12), []).append(r)
    want = {k: (len(v), _longest([e["newbalanceOrig"] is not None and e["newbalanceOrig"] < 500 for e in
                                  sorted(v, key=lambda e: (e["step"], e["kafka_offset"]))]))
            for k, v in want.items()}
    df = with_offsets(spark, rows)
    for size in (1, 3, 65536):
        got = churn.churn_windows(df, ChurnParams(order_chunk=size))
        hour = F.unix_timestamp("window.start") / 3600 - F.lit(1672531200 / 3600)
        assert {(r.customerId, int(r.h)): (r.w_count, r.low_run) for r in
                got.withColumn("h", hour).collect()} == want


def test_dedupe_keeps_latest_emission(spark):
    df = spark.createDataFrame([("c", 12, "a", 2), ("c", 12, "b", 3), ("c", 24, "a", 2)],
                               "customerId string, window_end_step int, detected_at string, signal_count int")
    assert {(r.window_end_step, r.signal_count) for r in churn.dedupe_alerts(df).collect()} == {(12, 3), (24, 2)}
