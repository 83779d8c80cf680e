from rows import by, txns

from txnloom.operators import checks, summaries
from txnloom.operators.latest import rolling_latest, upsert, with_dedup_id


def _spread(who, kind, amount, count, fraud):
    return [{"nameOrig": who, "type": kind, "amount": amount, "isFraud": int(i < fraud),
             "step": 1 + round(i * 167 / max(count - 1, 1))} for i in range(count)]


def sql_rows():
    rows = (_spread("C-FILL1", "CASH_IN", 5000.0, 20, 0) + _spread("C-FILL2", "PAYMENT", 3000.0, 50, 1)
            + _spread("C-FILL3", "CASH_OUT", 9000.0, 20, 2) + _spread("C-FILL4", "TRANSFER", 250000.0, 10, 3)
            + _spread("C-FILL5", "DEBIT", 1500.0, 4, 3))
    for who, steps, amount in (("C-LATE", [168], 100.0), ("C-ACTIVE", [150, 155, 160, 163, 165, 168], 1000.0),
                               ("C-DORMANT", [20, 25, 30, 40, 50, 60], 1000.0),
                               ("C-SEVERE", [5, 8, 12, 15, 18, 20], 1000.0), ("C-FEW", [2, 5, 10], 1000.0),
                               ("M-MERCH", [2, 5, 8, 11, 14, 17], 1000.0)):
        rows += [{"nameOrig": who, "step": s, "amount": amount} for s in steps]
    return rows


def test_compliance(spark):
    got = by(summaries.compliance_summary(txns(spark, sql_rows())), "transaction_type")
    want = {"CASH_IN": (20, 100000.0, 0, 0.0, "Low"), "PAYMENT": (78, 177100.0, 1, 1.2821, "Medium"),
            "CASH_OUT": (20, 180000.0, 2, 10.0, "High"), "TRANSFER": (10, 2500000.0, 3, 30.0, "High"),
            "DEBIT": (4, 6000.0, 3, 75.0, "High")}
    assert {k: (r.transaction_count, r.transaction_volume, r.fraud_count, r.fraud_rate_pct,
                r.risk_classification) for k, r in got.items()} == want


def test_compliance_class_uses_the_exact_rate(spark):
    rows = [{"type": "PAYMENT", "isFraud": int(i < 4999)} for i in range(100000)]
    row = summaries.compliance_summary(txns(spark, rows)).first()
    assert (row.fraud_rate_pct, row.risk_classification) == (4.999, "Medium")


def test_customer_summary(spark):
    df = summaries.customer_fraud_summary(txns(spark, sql_rows()))
    got = by(df, "customerId")
    assert len(got) == 10 and "M-MERCH" not in got
    assert (got["C-FILL5"].total_transactions, got["C-FILL5"].confirmed_fraud_count,
            float(got["C-FILL5"].fraud_rate_pct)) == (4, 3, 75.0)
    assert dict(df.dtypes)["fraud_rate_pct"] == "decimal(31,6)"


def test_dormancy(spark):
    got = by(summaries.dormancy_report(txns(spark, sql_rows())), "customerId")
    assert {k: (r.last_active_step, r.steps_inactive, r.dormancy_severity) for k, r in got.items()} == {
        "C-DORMANT": (60, 108, "Dormant"), "C-SEVERE": (20, 148, "Severely Dormant")}


def test_dormancy_edges(spark):
    def who(gap, n):
        return [{"nameOrig": f"C{gap}-{n}", "step": 200 - gap}] * n
    rows = [{"nameOrig": "C-END", "step": 200}]
    for gap, n in ((72, 5), (73, 5), (120, 5), (121, 5), (100, 4)):
        rows += who(gap, n)
    got = {r.customerId: r.dormancy_severity for r in summaries.dormancy_report(txns(spark, rows)).collect()}
    assert got == {"C73-5": "Dormant", "C120-5": "Dormant", "C121-5": "Severely Dormant"}


def mart_rows():
    return [{"nameOrig": "C1", "step": 1, "type": t, "amount": a, "newbalanceOrig": b, "txnId": i, "ingest_ts": ts,
             "isFraud": f}
            for t, a, b, i, ts, f in [("TRANSFER", 10.0, 5.0, "T1", "2023-01-02", 1), ("PAYMENT", 20.0, 6.0, "T2", "2023-01-02", 0),
                                      ("PAYMENT", 30.0, 7.0, "T3", "2023-01-01", 0)]] + [
        {"nameOrig": "M1", "step": 1, "txnId": "T9", "ingest_ts": "2023-01-01", "newbalanceOrig": 1.0}]


def test_mart(spark):
    r = by(summaries.txn_summary_mart(txns(spark, mart_rows())), "customerId")["C1"]
    assert (r.txn_count, r.total_amount, r.avg_amount, r.max_amount, r.fraud_count, r.txn_types, r.last_balance) == (
        3, 60.0, 20.0, 30.0, 1, "PAYMENT,TRANSFER", 6.0)


def test_reconciliation_and_its_failure(spark):
    t = txns(spark, mart_rows())
    mart, view, summary = summaries.txn_summary_mart(t), summaries.fraud_view(t), summaries.transaction_summary(t)
    assert all(r.ok for r in checks.reconcile(t, mart, view, summary).collect())
    broken = checks.reconcile(t, mart.union(mart.limit(1)), view, summary).collect()
    assert not {r.check: r.ok for r in broken}["mart rows are unique per customer and step"]


def test_transaction_summary_rounds_half_up(spark):
    t = txns(spark, [{"amount": 0.01}, {"amount": 0.02}, {"step": 169}, {"step": 0}])
    exact = t.withColumn("amount", t.amount.cast("decimal(18,2)"))
    row, = summaries.transaction_summary(exact).collect()
    assert (row.total_volume, row.transaction_count, row.avg_transaction_amount) == (0.03, 2, 0.02)


def test_daily_summary_counts_unknown_fraud_as_zero(spark):
    row, = summaries.daily_summary(txns(spark, [{"isFraud": None}, {"isFraud": 1}])).collect()
    assert (row.transaction_volume, row.fraud_count) == (2, 1)


def test_report_order_and_top(spark):
    t = txns(spark, sql_rows())
    got = summaries.report_order(summaries.dormancy_report(t), "dormancy_report").collect()
    assert [r.customerId for r in got] == ["C-SEVERE", "C-DORMANT"]
    assert len(summaries.top(summaries.customer_fraud_summary(t), "customer_fraud_summary", 3).collect()) == 3


def test_rolling_cap_keeps_the_place_of_the_first_version(spark):
    df = spark.createDataFrame([("a", 1, "a1"), ("b", 2, "b1"), ("c", 3, "c1"), ("a", 4, "a2")],
                               "k string, at int, v string")
    assert [r.v for r in rolling_latest(df, "k", "at", 3).collect()] == ["c1", "b1", "a2"]
    assert [r.v for r in rolling_latest(df, "k", "at", 2).collect()] == ["c1", "b1"]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", None, 1), ("b", 5, 0), ("c", 3, 0)], "k string, v int, seq int")
    once = upsert(old, new, "k", ("seq",))
    want = {("a", 1), ("b", None), ("c", 3)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in upsert(once, new, "k", ("seq",)).collect()} == want


def test_dedup_id(spark):
    df = spark.createDataFrame([("T", "x", 1), (None, "y", 1), ("", "z", 1), (None, None, 1), ("U", "u", None)],
                               "txnId string, id string, step int")
    assert {r.dedup_id for r in with_dedup_id(df, ("txnId", "id")).collect()} == {"T", "y", "z"}
