import pytest
from rows import by, txns

from txnloom.operators import scoring
from txnloom.params import RiskParams


def risk_rows():
    rows = [{"nameOrig": "C-HIGH", "step": s, "type": "CASH_OUT", "amount": 40000.0, "nameDest": f"D{s:03}",
             "isFraud": int(s in (5, 6))} for s in range(1, 16)]
    rows += [{"nameOrig": "C-HIGH", "step": s, "type": "TRANSFER", "amount": 800000.0, "nameDest": f"D{s:03}"}
             for s in range(16, 21)]
    mid = [("CASH_OUT", 9000.0)] * 4 + [("PAYMENT", 3000.0)] * 4 + [("TRANSFER", 200000.0)] * 2
    rows += [{"nameOrig": "C-MID", "step": i + 1, "type": t, "amount": a, "nameDest": f"M{(i + 1) % 5:02}"}
             for i, (t, a) in enumerate(mid)]
    rows += [{"nameOrig": "C-LOW", "amount": 500.0}]
    for who, kinds in (("C-F1", [("CASH_OUT", 12000.0)] * 3 + [("TRANSFER", 300000.0)] * 3),
                       ("C-F2", [("PAYMENT", 2000.0)] * 4 + [("TRANSFER", 50000.0)]),
                       ("C-F3", [("CASH_IN", 5000.0)] * 3)):
        rows += [{"nameOrig": who, "step": i + 1, "type": t, "amount": a, "nameDest": f"{who}-{i}"}
                 for i, (t, a) in enumerate(kinds)]
    return rows


def test_risk(spark):
    got = by(scoring.risk_scores(txns(spark, risk_rows())), "customerId")
    want = {"C-HIGH": (20, 800000.0, 0.75, 20, 1.0, "High"), "C-MID": (10, 200000.0, 0.4, 5, 0.366886, "Medium"),
            "C-LOW": (1, 0.0, 0.0, 1, 0.0, "Low"), "C-F1": (6, 300000.0, 0.5, 6, 0.391996, "Medium"),
            "C-F2": (5, 50000.0, 0.0, 5, 0.120888, "Low"), "C-F3": (3, 0.0, 0.0, 3, 0.052632, "Low")}
    assert {k: (r.frequency, r.avg_transfer_amount, r.cashout_proportion, r.unique_dest_accounts, r.risk_score,
                r.risk_tier) for k, r in got.items()} == want


def test_risk_of_a_single_customer_is_zero(spark):
    row = scoring.risk_scores(txns(spark, [{"type": "TRANSFER", "amount": 5.0}])).first()
    assert (row.risk_score, row.risk_tier) == (0.0, "Low")


@pytest.mark.parametrize("score, tier", [(0.249999, "Low"), (0.25, "Medium"), (0.60, "Medium"), (0.600001, "High")])
def test_tier_edges(spark, score, tier):
    from pyspark.sql import functions as F
    from txnloom.functions.rules import risk_tier
    assert spark.range(1).select(risk_tier(F.lit(score), RiskParams())).first()[0] == tier


def test_weights_are_parameters(spark):
    p = RiskParams(w_frequency=1.0, w_avg_transfer=0.0, w_cashout_prop=0.0, w_unique_dest=0.0)
    got = by(scoring.risk_scores(txns(spark, risk_rows()), p), "customerId")
    assert got["C-MID"].risk_score == round(9 / 19, 6)


def clv_rows():
    five = ["PAYMENT", "TRANSFER", "CASH_IN", "DEBIT", "CASH_OUT"]
    rows = [{"nameOrig": "C-HIGH", "step": s, "type": five[(s - 1) % 5], "amount": 50000.0} for s in range(1, 25)]
    rows += [{"nameOrig": "C-HIGH", "step": 168, "type": "CASH_OUT", "amount": 50000.0}]
    rows += [{"nameOrig": "C-GROWTH", "step": 1 + 9 * i, "type": five[i % 3], "amount": 30000.0} for i in range(14)]
    rows += [{"nameOrig": "C-GROWTH", "step": 145, "amount": 30000.0}]
    rows += [{"nameOrig": "C-ATRISK", "step": s, "amount": 1000.0} for s in (3, 10)]
    rows += [{"nameOrig": "C-LATE", "step": 168, "amount": 500.0}]
    rows += [{"nameOrig": "C-F1", "step": 2 + 3 * i, "type": ("PAYMENT", "DEBIT")[i % 2], "amount": 15000.0}
             for i in range(8)]
    return rows


def test_clv(spark):
    got = by(scoring.clv_scores(txns(spark, clv_rows())), "customerId")
    want = {"C-HIGH": (1250000.0, 25, 5, 0, 1.0, "High Value"),
            "C-GROWTH": (450000.0, 15, 3, 23, 0.512167, "Growth Potential"),
            "C-ATRISK": (2000.0, 2, 1, 158, 0.070480, "At Risk"),
            "C-LATE": (500.0, 1, 1, 0, 0.260120, "At Risk"),
            "C-F1": (120000.0, 8, 2, 145, 0.208800, "At Risk")}
    assert {k: (r.total_amount, r.txn_count, r.distinct_txn_types, r.steps_since_last_txn, r.clv_score,
                r.clv_classification) for k, r in got.items()} == want


def test_clv_gap_counts_merchant_senders(spark):
    rows = [{"nameOrig": "C1", "step": 1}, {"nameOrig": "M1", "step": 49}]
    got = scoring.clv_scores(txns(spark, rows)).collect()
    assert [(r.customerId, r.steps_since_last_txn, r.recency_score) for r in got] == [("C1", 48, 0.0)]


@pytest.mark.parametrize("score, cls", [(0.70, "Growth Potential"), (0.700001, "High Value"),
                                        (0.40, "Growth Potential"), (0.399999, "At Risk")])
def test_clv_class_edges(spark, score, cls):
    from pyspark.sql import functions as F
    from txnloom.functions.rules import clv_class
    assert spark.range(1).select(clv_class(F.lit(score))).first()[0] == cls
