"""The payment graph."""

from pyspark.sql import functions as F

from txnloom.operators import graph as g

from .core import query
from .inputs import graph


@query("graph_accounts", "J8", "SELECT * FROM account")
def _(spark, d):
    return graph(spark, d).accounts


@query("graph_edges", "J9", """
SELECT 'SENT' AS edge_type, nameOrig AS accountId, txnId FROM txn WHERE nameOrig IN (SELECT accountId FROM account)
UNION ALL SELECT 'RECEIVED_BY', nameDest, txnId FROM txn WHERE nameDest IN (SELECT accountId FROM account)""")
def _(spark, d):
    net = graph(spark, d)
    return g.connect_edges(net.sent, net).select(F.lit("SENT").alias("edge_type"), "accountId", "txnId").unionByName(
        g.connect_edges(net.received, net).select(F.lit("RECEIVED_BY").alias("edge_type"), "accountId", "txnId"))


@query("edge_integrity", "V11", """
SELECT 'SENT' AS edge_type, count(*) AS edges,
  count(*) FILTER (nameOrig NOT IN (SELECT accountId FROM account)) AS missing_account,
  CAST(0 AS BIGINT) AS missing_transaction,
  count(*) FILTER (nameOrig NOT IN (SELECT accountId FROM account)) AS missing_endpoint FROM txn
UNION ALL SELECT 'RECEIVED_BY', count(*), count(*) FILTER (nameDest NOT IN (SELECT accountId FROM account)), 0,
  count(*) FILTER (nameDest NOT IN (SELECT accountId FROM account)) FROM txn""")
def _(spark, d):
    return g.edge_integrity(graph(spark, d))


@query("graph_paths", "J8", """
SELECT txnId, sender, receiver, CAST(amount AS DOUBLE) AS amount, isFraud FROM path""")
def _(spark, d):
    return g.paths(graph(spark, d)).select("txnId", "sender", "receiver", F.col("amount").cast("double").alias("amount"),
                                           "isFraud")


@query("fraud_rings", "A14", "SELECT * FROM ring WHERE distinct_senders > 3")
def _(spark, d):
    return g.fraud_rings(graph(spark, d))


@query("fraud_rings_wide", "A14 T1", """
SELECT * FROM ring WHERE distinct_senders > 5 ORDER BY distinct_senders DESC, inbound_amount DESC, account""")
def _(spark, d):
    from txnloom.operators.summaries import report_order
    return report_order(g.fraud_rings(graph(spark, d), 5), "fraud_rings")


@query("graph_counts", "A15", """
SELECT 'accounts' AS item, count(*) AS n FROM account
UNION ALL SELECT 'transactions', count(*) FROM txn
UNION ALL SELECT 'sent', count(*) FROM txn WHERE nameOrig IN (SELECT accountId FROM account)
UNION ALL SELECT 'received', count(*) FROM txn WHERE nameDest IN (SELECT accountId FROM account)
UNION ALL SELECT 'full_path_transactions', count(DISTINCT txnId) FROM path""")
def _(spark, d):
    return g.graph_counts(graph(spark, d))


@query("graph_property_gaps", "V16", """
SELECT 'Account' AS node, unnest(['accountId', 'accountType']) AS property, unnest([a, b]) AS missing
FROM (SELECT count(*) - count(accountId) AS a, count(*) - count(accountType) AS b FROM account)
UNION ALL SELECT 'Transaction', unnest(['txnId', 'step', 'type', 'amount', 'isFraud']), unnest([a, b, c, d, e])
FROM (SELECT count(*) - count(txnId) AS a, count(*) - count(step) AS b, count(*) - count(type) AS c,
  count(*) - count(amount) AS d, count(*) - count(isFraud) AS e FROM txn)""")
def _(spark, d):
    return g.graph_property_gaps(graph(spark, d))
