import json
import os

import pytest
from pyspark.errors import AnalysisException

from pyspark.sql import functions as F

from rows import txns
from txnloom.operators import dimensions, scoring, summaries
from txnloom.operators.checks import missing_columns
from txnloom.plans.jobs import main as run_job
from txnloom.plans.warehouse import build_warehouse
from txnloom.schemas import TXN_COLUMNS
from txnloom.sinks import tables
from txnloom.sources import (
    SourceError, load_transactions, read_baseline, read_graph, read_metrics, read_profiles, register_transactions,
)
from txnloom.sources.tables import check_header, read_csv_text

HEADER = "step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud"


def _csv(tmp_path, *lines):
    p = tmp_path / "t.csv"
    p.write_text("\n".join((HEADER, *lines)) + "\n")
    return str(p)


ROW = "1,TRANSFER,250000.0,C1,250000,0,C2,0,0,1,0"


def test_csv(spark, tmp_path):
    path = _csv(tmp_path, ROW, "2,PAYMENT,5.5,C2,10,4.5,M1,0,0,0,0", "3,,5,C3,1,1,M1,0,0,0,0")
    rows = load_transactions(spark, "csv", path, None).orderBy("step").collect()
    assert [(r.step, r.amount, r.txnId) for r in rows] == [(1, 250000.0, None), (2, 5.5, None)]
    assert dict(load_transactions(spark, "csv", path, exact_money=True).dtypes)["amount"] == "decimal(18,2)"


def test_text_rows_need_their_header(spark, tmp_path):
    assert read_csv_text(spark, _csv(tmp_path, ROW)).count() == 1
    bad = tmp_path / "bad.csv"
    bad.write_text("step,type\n1,DEBIT\n")
    with pytest.raises(SourceError, match="amount"):
        read_csv_text(spark, str(bad))


def test_parquet_in_step_folders(spark, tmp_path):
    t = txns(spark, [{"step": s, "txnId": f"T{s}"} for s in (1, 2, 3)])
    path = str(tmp_path / "p")
    tables.write_parquet(t, path, ("step",))
    assert sorted(os.listdir(path))[-3:] == ["step=1", "step=2", "step=3"]
    two = load_transactions(spark, "parquet", path, TXN_COLUMNS).filter("step = 2")
    assert [r.txnId for r in two.collect()] == ["T2"]
    assert "PartitionFilters: [isnotnull(step" in two._jdf.queryExecution().toString()
    with pytest.raises(SourceError, match="has any data landed"):
        load_transactions(spark, "parquet", str(tmp_path / "none"))


def test_view_and_empty_source(spark, tmp_path):
    register_transactions(spark, "csv", _csv(tmp_path, ROW))
    assert spark.sql("SELECT count(*) FROM txn_source").first()[0] == 1
    with pytest.raises(SourceError, match="no transactions"):
        register_transactions(spark, "csv", _csv(tmp_path))
    with pytest.raises(SourceError):
        load_transactions(spark, "table", "no_such_table")


def test_profiles_as_array_and_as_lines(spark, tmp_path):
    docs = [{"customerId": "C1", "segment": "Basic", "products": ["card", " loan "], "age": 30, "composite_risk_score": 0.5},
            {"customerId": "C2", "segment": None, "products": None}]
    array, lines = tmp_path / "a.json", tmp_path / "l.json"
    array.write_text("  " + json.dumps(docs, indent=1))
    lines.write_text("\n".join(json.dumps(d) for d in docs))
    for p in (array, lines):
        df = read_profiles(spark, str(p))
        assert {(r.customerId, r.segment, r.age) for r in df.collect()} == {("C1", "Basic", 30), ("C2", None, None)}
        assert {tuple(r) for r in dimensions.customer_products(df).collect()} == {("C1", "card"), ("C1", "loan")}
    dim = dimensions.dim_customer(read_profiles(spark, str(lines)))
    assert "profile_composite_risk" in dim.columns and "products" not in dim.columns
    with pytest.raises(SourceError):
        read_profiles(spark, str(tmp_path / "none.json"))


def test_graph_files(spark, tmp_path):
    files = {"accounts": "accountId:ID,accountType\nC1,CUSTOMER\nM1,MERCHANT\n",
             "transactions": "txnId:ID,step:int,type,amount:float,isFraud:int\nT1,3,PAYMENT,12.5,0\n",
             "sent": ":START_ID,:END_ID,amount:float,step:int,transactionType\nC1,T1,12.5,3,PAYMENT\n",
             "received": ":START_ID,:END_ID,newbalanceDest:float,isFraud:int\nT1,M1,12.5,0\n"}
    paths = {}
    for kind, text in files.items():
        (tmp_path / f"{kind}.csv").write_text(text)
        paths[kind] = str(tmp_path / f"{kind}.csv")
    g = read_graph(spark, paths)
    assert tuple(g.transactions.first()) == ("T1", 3, "PAYMENT", 12.5, 0)
    assert tuple(g.sent.first()) == ("C1", "T1", 12.5, 3, "PAYMENT")
    from txnloom.operators.graph import fraud_rings
    assert fraud_rings(g, 0).first().account == "M1"


def test_metrics_with_rates_as_text(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"batch_id":0,"total_count":4,"flagged_count":1,"fraud_rate_pct":"25.000000"}\n'
                                     '{"batch_id":1,"total_count":2,"flagged_count":0,"fraud_rate_pct":0.0}\n')
    assert sorted(r.fraud_rate_pct for r in read_metrics(spark, str(tmp_path)).collect()) == [0.0, 25.0]


def test_baseline_may_be_absent(spark, tmp_path):
    df = read_baseline(spark, str(tmp_path / "none"))
    assert df.count() == 0 and df.columns == ["customerId", "hist_freq_per_12", "all_time_avg_amount"]


def test_single_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string").repartition(2)
    path = str(tmp_path / "out.csv")
    for _ in range(2):  # the second run replaces the file
        tables.write_single_csv(df.orderBy("n"), path)
    assert open(path).read().split() == ["n,s", "1,a", "2,b"]
    assert [x for x in os.listdir(tmp_path) if not x.startswith(".")] == ["out.csv"]
    tables.write_single_csv(df.where("n > 5"), path)
    assert open(path).read().split() == ["n,s"]


def test_folders_become_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "step int, s string")
    for by in ("step", None):
        path = str(tmp_path / f"by-{by}")
        tables.write_parquet(rows, path, (by,) if by else ())
        tables.external_table(spark, "landed_rows", "step int, s string", path)
        assert sorted(map(tuple, spark.table("landed_rows").select("step", "s").collect())) == [(1, "a"), (2, "b"), (2, "c")]
    days = rows.selectExpr("*", "date_add(date'2023-01-01', step) AS day")
    tables.write_parquet(days, str(tmp_path / "days"), ("day",))
    tables.external_table(spark, "landed_rows", "step int, s string", str(tmp_path / "days"))
    assert spark.table("landed_rows").where("day = date'2023-01-03'").count() == 2
    spark.sql("DROP TABLE landed_rows")


def test_baseline_with_a_wrong_schema_is_an_error(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "b"))
    with pytest.raises(AnalysisException):
        read_baseline(spark, str(tmp_path / "b"))


def test_alerts_are_stored_by_date(spark, tmp_path):
    df = spark.createDataFrame([("c", "2023-01-02 00:00:00")], "customerId string, e string").select(
        "customerId", F.col("e").cast("timestamp").alias("window_end"))
    path = str(tmp_path / "alerts")
    tables.append_alerts(df, path)
    tables.append_alerts(df, path)
    assert "alert_date=2023-01-02" in os.listdir(path) and spark.read.parquet(path).count() == 2


def test_warehouse(spark, tmp_path):
    t = txns(spark, [{"step": s, "nameOrig": f"C{s % 2}", "isFraud": s % 2, "txnId": f"T{s}", "ingest_ts": "x"} for s in range(1, 5)])
    raw, clv = str(tmp_path / "raw"), str(tmp_path / "clv")
    t.write.parquet(raw + "/step=1")  # rows keep their own step column
    scoring.stamped(scoring.clv_scores(t)).write.parquet(clv)
    db = "wh_test"
    for _ in range(2):  # rebuilding gives the same
        build_warehouse(spark, db, raw, clv, location=str(tmp_path / "db"))
    try:
        assert spark.table(f"{db}.transactions").count() == 4
        assert spark.table(f"{db}.vw_fraud_transactions").count() == 2
        mart = spark.table(f"{db}.txn_summary_mart")
        assert mart.count() == 4 and missing_columns(mart, "txn_summary_mart") == []
        assert spark.table(f"{db}.customer_clv").count() == 2
        stats = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {db}.txn_summary_mart").collect()}
        assert "4 rows" in stats["Statistics"]
        assert load_transactions(spark, "table", f"{db}.transactions").count() == 4
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_exports(spark, tmp_path):
    t = txns(spark, [{}])
    report = tables.export_datasets({"daily_summary": summaries.daily_summary(t), "dim_date": dimensions.dim_date(spark, 3),
                                     "dormancy_report": None, "compliance_summary": t}, str(tmp_path))
    assert [(n, s) for n, s, _ in report] == [("daily_summary", "OK"), ("dim_date", "OK"), ("dormancy_report", "SKIP"), ("compliance_summary", "BAD")]
    assert spark.read.option("header", True).csv(str(tmp_path / "dim_date")).count() == 3


def test_content_takes_every_digit_of_large_fractions(spark):
    import hashlib
    values = [290846024216.23, -290145906235.19, 9e12, 1.5e20, 0.1, -2.5, 0.0]
    for v in values:
        text = str(int(v * 1_000_000))
        want = int(hashlib.md5(text.encode()).hexdigest()[:12], 16)
        assert tables.content_sums(spark.createDataFrame([(v,)], "v double")).first().content == want, v
    odd = tables.content_sums(spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "v double")).first()
    assert odd.rows == 3 and odd.content == 3 * int(hashlib.md5(b"\x00").hexdigest()[:12], 16)


def test_header_check(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert check_header(df, ["a"]) is df
    with pytest.raises(SourceError, match="b"):
        check_header(df, ["a", "b"])


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    rows = [f"{s},{k},{1000.0 * s},C{s % 3},1,400,C9,0,0,{int(s == 3)},0" for s in range(1, 100) for k in ("TRANSFER", "CASH_OUT")]
    path, out = _csv(tmp_path, *rows), str(tmp_path / "out")
    for job in ("risk", "clv", "baseline", "compliance", "customer-summary", "dormancy", "transaction-summary", "ingest"):
        assert run_job([job, "--source", "csv", "--input", path, "--out", out]) == 0, job
    profiles = tmp_path / "profiles.json"
    profiles.write_text(json.dumps([{"customerId": f"C{i}", "segment": "Basic", "churn_probability": 0.5} for i in range(3)]))
    assert run_job(["risk-blend", "--out", out, "--profiles", str(profiles)]) == 0
    assert run_job(["export", "--out", out, "--profiles", str(profiles)]) == 0
    assert "OK   dim_customer" in capsys.readouterr().out
    assert spark.read.parquet(out + "/customer_risk_blend").count() == 3
    assert spark.read.parquet(out + "/transactions").count() == 198
    assert open(out + "/exports/compliance_summary.csv").readline().startswith("transaction_type,")
    assert run_job(["clv", "--input", str(tmp_path / "none"), "--out", out]) == 2
