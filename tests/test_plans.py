"""What the plans must and must not contain."""

import os
import re

import pytest

from pyspark.sql import functions as F

from registry import QUERIES
from txnloom.functions.rules import is_fraud
from txnloom.operators import churn, graph, scoring, summaries
from txnloom.schemas import TXN_COLUMNS
from txnloom.sources import load_transactions

from rows import txns

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final(df):
    df.collect()
    return _plan(df)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "p")
    txns(spark, [{"step": s, "nameOrig": f"C{s % 7}", "amount": 1.0 * s, "type": "TRANSFER", "txnId": f"T{s}"}
                 for s in range(1, 200)]).write.parquet(path)
    return path


def test_fraud_rule_reaches_the_scan(spark, table):
    df = load_transactions(spark, "parquet", table, TXN_COLUMNS).filter(is_fraud()).select("txnId")
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    for pushed in ("GreaterThan(amount,200000.0)", "EqualTo(newbalanceDest,0.0)", "In(type"):
        assert pushed in plan
    read = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert "oldbalance" not in read and "ingest_ts" not in read


def test_customer_prefix_reaches_the_scan(spark, table):
    plan = _plan(summaries.dormancy_report(load_transactions(spark, "parquet", table)))
    assert "StringStartsWith(nameOrig,C)" in plan


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_batch_plans_have_no_python_and_no_cross_join(spark, name):
    plan = _plan(QUERIES[name].plan(spark, SF_DIR))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert bad not in plan, bad


def test_scores_aggregate_once(spark, table):
    for build in (scoring.risk_scores, scoring.clv_scores):
        assert "ReusedExchange" in _final(build(load_transactions(spark, "parquet", table)))


def test_mart_has_one_shuffle_and_no_join(spark, table):
    plan = _plan(summaries.txn_summary_mart(load_transactions(spark, "parquet", table, TXN_COLUMNS)))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_windows_shuffle_rows_once_before_spreading(spark, table):
    df = load_transactions(spark, "parquet", table, TXN_COLUMNS).withColumn("kafka_offset", F.col("step").cast("long"))
    plan = _plan(churn.churn_windows(df))
    # Reading from the scan upwards: the first aggregate comes before the rows are expanded.
    assert plan.index("Expand" if "Expand" in plan else "Generate") < plan.rindex("ObjectHashAggregate")
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_busy_receiver_is_spread_over_its_senders(spark):
    t = txns(spark, [{"txnId": f"T{i}", "nameOrig": f"C{i % 50}", "nameDest": "C999"} for i in range(200)])
    plan = _plan(graph.fraud_rings(graph.graph_from_transactions(t)))
    assert re.search(r"Exchange hashpartitioning\(receiver#\d+, sender#\d+", plan)


def test_latest_rows_are_limited_before_the_shuffle(spark, table):
    from txnloom.operators.latest import latest_by
    plan = _plan(latest_by(load_transactions(spark, "parquet", table, TXN_COLUMNS), ["nameOrig"], ["txnId"]))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below


def _as_run(plan):
    """Lines of the final plans only: what follows a mark of an initial plan, as deep or deeper, goes."""
    out, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return out


def test_customer_scores_scan_the_transactions_once(spark, table):
    from txnloom.operators import dimensions
    scores = scoring.customer_scores(load_transactions(spark, "parquet", table))
    people = spark.createDataFrame([("C1", 0.5, 0.5, 1000.0)], "customerId string, churn_probability double, risk_score double, annualIncome double")
    people = people.withColumn("products", F.array(F.lit("Loan"))).withColumn("composite_risk_score", F.lit(0.1))
    for df in (scores, dimensions.dim_customer(people, scores, scores)):
        final = "\n".join(_as_run(_final(df)))
        assert final.count("Scan parquet") == 1 and "ReusedExchange" in final, final
        assert "ObjectHashAggregate" not in final and "SortAggregate" not in final


def test_customer_scores_equal_the_single_ones(spark, table):
    txns_ = load_transactions(spark, "parquet", table, exact_money=True)
    both = scoring.customer_scores(txns_)
    for one in (scoring.risk_scores(txns_), scoring.clv_scores(txns_)):
        assert sorted(map(str, both.select(*one.columns).collect())) == sorted(map(str, one.collect()))
