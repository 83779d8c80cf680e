"""The payment graph as DataFrames: accounts, transactions and two kinds of edges.

Path: account -[sent]-> transaction -[received]-> account.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.graph_files import Graph


def graph_from_transactions(txns: DataFrame) -> Graph:
    """Build the four tables from transactions; both ends become accounts."""
    accounts = (txns.select(F.explode(F.array("nameOrig", "nameDest")).alias("accountId"))
                .filter(F.col("accountId").isNotNull()).distinct()
                .withColumn("accountType", F.when(F.col("accountId").startswith("M"), "MERCHANT")
                            .otherwise("CUSTOMER")))
    return Graph(
        accounts=accounts,
        transactions=txns.select("txnId", "step", "type", "amount", "isFraud"),
        sent=txns.select(F.col("nameOrig").alias("accountId"), "txnId", "amount", "step",
                         F.col("type").alias("transactionType")),
        received=txns.select("txnId", F.col("nameDest").alias("accountId"), "newbalanceDest",
                             "isFraud"))


def connect_edges(edges: DataFrame, g: Graph) -> DataFrame:
    """Edges whose account and transaction both exist."""
    return (edges.join(g.transactions.select("txnId"), "txnId", "left_semi")
            .join(g.accounts.select("accountId"), "accountId", "left_semi"))


def edge_integrity(g: Graph) -> DataFrame:
    """Per edge kind: rows, and rows that miss their account, transaction or either."""
    accounts = g.accounts.select("accountId", F.lit(True).alias("_a"))
    txns = g.transactions.select("txnId", F.lit(True).alias("_t"))

    def check(kind: str, edges: DataFrame) -> DataFrame:
        # Edges are counted per account before the accounts are looked up, so an
        # account with very many edges is one row in that join.
        per_account = (edges.select("accountId", "txnId").join(txns, "txnId", "left")
                       .groupBy("accountId")
                       .agg(F.count(F.lit(1)).alias("n"),
                            F.count_if(F.col("_t").isNull()).alias("no_t")))
        lost = F.col("_a").isNull()
        add = lambda c: F.coalesce(F.sum(c), F.lit(0))
        return (per_account.join(accounts, "accountId", "left")
                .agg(add("n").alias("edges"),
                     add(F.when(lost, F.col("n"))).alias("missing_account"),
                     add("no_t").alias("missing_transaction"),
                     add(F.when(lost, F.col("n")).otherwise(F.col("no_t"))).alias("missing_endpoint"))
                .select(F.lit(kind).alias("edge_type"), "*"))

    return check("SENT", g.sent).unionByName(check("RECEIVED_BY", g.received))


def paths(g: Graph) -> DataFrame:
    """Every sender -> transaction -> receiver path over existing nodes."""
    sent = g.sent.select("txnId", F.col("accountId").alias("sender"))
    received = g.received.select("txnId", F.col("accountId").alias("receiver"))
    ids = g.accounts.select("accountId")
    return (sent.join(received, "txnId").join(g.transactions, "txnId")
            .join(ids.withColumnRenamed("accountId", "sender"), "sender", "left_semi")
            .join(ids.withColumnRenamed("accountId", "receiver"), "receiver", "left_semi"))


def fraud_rings(g: Graph, min_senders: int = 3) -> DataFrame:
    """Accounts that receive from more than ``min_senders`` distinct senders.

    Paths are added up per (receiver, sender) pair before any account is looked
    up: a busy receiver is spread over its senders, its distinct senders are the
    number of its pairs, and both account joins run on reduced rows.
    """
    sent = g.sent.select("txnId", F.col("accountId").alias("sender"))
    received = g.received.select("txnId", F.col("accountId").alias("receiver"))
    facts = g.transactions.select("txnId", "amount", "isFraud")
    pairs = (sent.join(received, "txnId").join(facts, "txnId")
             .groupBy("receiver", "sender")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"),
                  F.sum("isFraud").alias("fraud")))
    known = g.accounts.select(F.col("accountId").alias("sender"))
    per_receiver = (pairs.join(known, "sender", "left_semi")
                    .groupBy("receiver")
                    .agg(F.count(F.lit(1)).alias("distinct_senders"),
                         F.sum("n").alias("inbound_txns"),
                         F.round(F.sum("amount"), 2).cast("double").alias("inbound_amount"),
                         F.sum("fraud").alias("confirmed_fraud_txns"))
                    .filter(F.col("distinct_senders") > min_senders))
    return (per_receiver.join(g.accounts, per_receiver["receiver"] == g.accounts["accountId"])
            .select(F.col("receiver").alias("account"), F.col("accountType").alias("account_type"),
                    "distinct_senders", "inbound_txns", "inbound_amount", "confirmed_fraud_txns"))


def graph_counts(g: Graph) -> DataFrame:
    """Nodes, connected edges and transactions on a full path: one row per measure."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("item"), "n")

    full = paths(g).select("txnId").distinct()
    parts = [one("accounts", g.accounts), one("transactions", g.transactions),
             one("sent", connect_edges(g.sent, g)), one("received", connect_edges(g.received, g)),
             one("full_path_transactions", full)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def graph_property_gaps(g: Graph) -> DataFrame:
    """Missing required properties per node kind, in one pass over each."""
    def gaps(kind: str, df: DataFrame, required: tuple[str, ...]) -> DataFrame:
        return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).select(
            F.lit(kind).alias("node"),
            F.explode(F.array(*[F.struct(F.lit(c).alias("property"), F.col(c).alias("missing"))
                                for c in required])).alias("g")).select("node", "g.*")

    return gaps("Account", g.accounts, ("accountId", "accountType")).unionByName(
        gaps("Transaction", g.transactions, ("txnId", "step", "type", "amount", "isFraud")))
