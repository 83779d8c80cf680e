from rows import by, txns

from pyspark.sql import functions as F

from txnloom.functions.rules import false_positive, is_fraud
from txnloom.operators.checks import rule_violations
from txnloom.operators.dimensions import flag_fraud, flagged_transactions
from txnloom.params import FraudParams
from txnloom.streaming.fraud import batch_metrics

CASES = [("T1", "TRANSFER", 250000.0, 0.0), ("T2", "CASH_OUT", 500000.0, 0.0),
         ("T3", "TRANSFER", 150000.0, 0.0), ("T4", "PAYMENT", 300000.0, 0.0),
         ("T5", "CASH_OUT", 400000.0, 1234.56)]


def _df(spark, cases):
    return txns(spark, [{"txnId": i, "type": t, "amount": a, "newbalanceDest": b} for i, t, a, b in cases])


def test_scenarios(spark):
    df = _df(spark, CASES)
    assert {r.txnId for r in flag_fraud(df).collect()} == {"T1", "T2"}
    m = batch_metrics(df).first()
    assert (m.total_count, m.parsed_count, m.flagged_count, m.fraud_rate_pct) == (5, 5, 2, 40.0)


def test_edges(spark):
    df = _df(spark, [("at", "TRANSFER", 200000.0, 0.0), ("above", "TRANSFER", 200000.01, 0.0),
                     ("debit", "DEBIT", 900000.0, 0.0), ("cashin", "CASH_IN", 900000.0, 0.0),
                     ("cent", "TRANSFER", 900000.0, 0.01), ("lower", "transfer", 900000.0, 0.0),
                     ("none", "TRANSFER", None, 0.0), ("nodest", "TRANSFER", 900000.0, None)])
    assert [r.txnId for r in flag_fraud(df).collect()] == ["above"]


def test_parameters_are_used(spark):
    df = _df(spark, CASES)
    p = FraudParams(amount_threshold=100000.0)
    assert {r.txnId for r in df.filter(is_fraud(p)).collect()} == {"T1", "T2", "T3"}
    env = FraudParams.from_env({"FRAUD_AMOUNT_THRESHOLD": "450000", "FRAUD_TYPES": "CASH_OUT, DEBIT"})
    assert env.types == ("CASH_OUT", "DEBIT")
    assert [r.txnId for r in df.filter(is_fraud(env)).collect()] == ["T2"]


def test_conformance_finds_violations(spark):
    row = rule_violations(_df(spark, CASES)).first()
    assert (row.flagged, row.violations) == (5, 3)


def test_empty_batch_has_rate_zero(spark):
    m = batch_metrics(_df(spark, CASES).filter("false")).first()
    assert (m.total_count, m.fraud_rate_pct) == (0, 0.0)


def test_false_positive_treats_unknown_as_not_fraud(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "isFraud int")
    assert [r[0] for r in df.select(false_positive(F.col("isFraud"))).collect()] == [0, 1, 1]
    shaped = by(flagged_transactions(_df(spark, CASES[:1])), "txnId")["T1"]
    assert shaped.false_positive == 1 and shaped.event_ts.isoformat() == "2023-01-01T00:00:00"
