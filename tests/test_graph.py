from rows import by

from txnloom.operators import graph as g
from txnloom.sources.graph_files import Graph

SENT = [("S1", "T1"), ("S2", "T2"), ("S3", "T3"), ("S4", "T4"), ("S1", "T5"), ("S2", "T6"), ("S3", "T7")] + [
    ("S1", f"T{i}") for i in range(8, 13)]
RECEIVED = [(f"T{i}", "R1") for i in range(1, 5)] + [(f"T{i}", "R2") for i in range(5, 8)] + [
    (f"T{i}", "R3") for i in range(8, 13)]


def build(spark, sent=SENT, received=RECEIVED, without=()):
    accounts = sorted({a for a, _ in SENT} | {a for _, a in RECEIVED})
    return Graph(
        spark.createDataFrame([(a, "CUSTOMER") for a in accounts if a not in without],
                              "accountId string, accountType string"),
        spark.createDataFrame([(t, 1, "TRANSFER", 10.0, int(t == "T1")) for _, t in SENT if t not in without],
                              "txnId string, step int, type string, amount double, isFraud int"),
        spark.createDataFrame(list(sent), "accountId string, txnId string"),
        spark.createDataFrame(list(received), "txnId string, accountId string"))


def _rings(graph, n=3):
    return {r.account: r.distinct_senders for r in g.fraud_rings(graph, n).collect()}


def test_rings(spark):
    assert _rings(build(spark)) == {"R1": 4}
    assert _rings(build(spark), 0) == {"R1": 4, "R2": 3, "R3": 1}
    assert _rings(build(spark, [], [])) == {}
    row = by(g.fraud_rings(build(spark)), "account")["R1"]
    assert (row.account_type, row.inbound_txns, row.inbound_amount, row.confirmed_fraud_txns) == ("CUSTOMER", 4, 40.0, 1)


def test_paths_need_existing_nodes(spark):
    assert _rings(build(spark, without=("S4",)), 2) == {"R1": 3, "R2": 3}
    assert _rings(build(spark, without=("T4", "R2")), 2) == {"R1": 3}
    assert _rings(build(spark, sent=SENT + [("S9", "T1")]), 3) == {"R1": 4}


def test_path_counts_two_senders_of_one_transaction(spark):
    assert _rings(build(spark, sent=SENT + [("S4", "T5")]), 3) == {"R1": 4, "R2": 4}


def test_integrity_and_counts(spark):
    broken = build(spark, without=("S4", "T7"))
    rows = {r.edge_type: r for r in g.edge_integrity(broken).collect()}
    assert (rows["SENT"].edges, rows["SENT"].missing_account, rows["SENT"].missing_transaction,
            rows["SENT"].missing_endpoint) == (12, 1, 1, 2)
    assert (rows["RECEIVED_BY"].missing_account, rows["RECEIVED_BY"].missing_endpoint) == (0, 1)
    counts = {r.item: r.n for r in g.graph_counts(broken).collect()}
    assert counts == {"accounts": 6, "transactions": 11, "sent": 10, "received": 11, "full_path_transactions": 10}
    assert sum(r.missing for r in g.graph_property_gaps(broken).collect()) == 0
