"""Command-line jobs: each reads a source, runs operators and writes outputs.

    python -m txnloom <job> --source parquet --input <path> --out <folder>
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from ..operators import blend, dimensions, scoring, summaries
from ..operators.ingest import stamp_ingest, to_records, validate_rows, with_txn_ids
from ..params import (
    BlendParams, ChurnParams, ClvParams, ComplianceParams, DormancyParams, FraudParams, RiskParams,
    StreamParams,
)
from ..session import build_session
from ..sinks import tables
from ..sinks.batches import kafka_writer, reset_checkpoint, stop_on_signal
from ..sources import (
    SourceError, load_transactions, read_metrics, read_profiles, read_txn_stream,
)
from ..sources.messages import read_message_stream
from ..sources.tables import read_csv_text
from ..streaming.churn import churn_stream
from ..streaming.flagged import decode_alerts, maintain_flagged
from ..streaming.fraud import fraud_stream
from ..streaming.landing import compact_landed, landed_log, landing_stream
from .warehouse import build_warehouse


def _out(args: argparse.Namespace, name: str) -> str:
    return f"{args.out.rstrip('/')}/{name}"


def _txns(spark: SparkSession, args: argparse.Namespace, valid_only: bool = True) -> DataFrame:
    # One emptiness check reads at most one file; counting would scan everything.
    df = load_transactions(spark, args.source, args.input, valid_only=valid_only)
    if df.isEmpty():
        raise SourceError(f"no transactions in {args.source} {args.input}")
    return df


def risk(spark, args):
    txns = _txns(spark, args)
    tables.write_parquet(scoring.stamped(scoring.risk_scores(txns, RiskParams.from_env())),
                         _out(args, "risk_scores"))
    tables.write_parquet(summaries.daily_summary(txns), _out(args, "daily_summary"))
    # The export reads the small table just written instead of the transactions.
    daily = spark.read.parquet(_out(args, "daily_summary"))
    tables.write_csv(summaries.report_order(daily, "daily_summary"), _out(args, "exports/daily_summary"))
    scoring.histogram(spark.read.parquet(_out(args, "risk_scores")), "risk_tier").show()


def clv(spark, args):
    tables.write_parquet(scoring.stamped(scoring.clv_scores(_txns(spark, args), ClvParams.from_env())),
                         _out(args, "clv_scores"))
    scoring.histogram(spark.read.parquet(_out(args, "clv_scores")), "clv_classification").show()


def baseline(spark, args):
    from pyspark.sql import functions as F
    built = summaries.customer_baseline(_txns(spark, args, valid_only=False)).withColumn(
        "baseline_built_at", F.current_timestamp())
    tables.write_parquet(built, _out(args, "customer_baseline"))


def compliance(spark, args):
    tables.write_parquet(summaries.compliance_summary(_txns(spark, args), ComplianceParams.from_env()),
                         _out(args, "compliance_summary"))
    done = summaries.report_order(spark.read.parquet(_out(args, "compliance_summary")), "compliance_summary")
    tables.write_single_csv(done, _out(args, "exports/compliance_summary.csv"))
    done.show(truncate=False)


def customer_summary(spark, args):
    tables.write_parquet(summaries.customer_fraud_summary(_txns(spark, args)),
                         _out(args, "customer_fraud_summary"))


def dormancy(spark, args):
    tables.write_parquet(summaries.dormancy_report(_txns(spark, args), DormancyParams.from_env()),
                         _out(args, "dormancy_report"))
    done = spark.read.parquet(_out(args, "dormancy_report"))
    # One row per dormant customer: written by all tasks, not as one file.
    tables.write_csv(summaries.report_order(done, "dormancy_report"), _out(args, "exports/dormancy_report"))
    scoring.histogram(done, "dormancy_severity").show()


def transaction_summary(spark, args):
    tables.write_parquet(summaries.transaction_summary(_txns(spark, args, valid_only=False)), _out(args, "transaction_summary"))
    done = spark.read.parquet(_out(args, "transaction_summary"))
    tables.write_single_csv(summaries.report_order(done, "transaction_summary"),
                            _out(args, "exports/transaction_summary.csv"))


def warehouse(spark, args):
    for name in build_warehouse(spark, args.database, args.input):
        print(name)


def risk_blend(spark, args):
    """Needs the stored fraud summary and CLV scores; churn alerts are optional."""
    read = lambda name: tables.read_if_present(spark, _out(args, name))
    out = blend.customer_risk_blend(
        tables.require(read("customer_fraud_summary"), "customer_fraud_summary"),
        read_profiles(spark, args.profiles), tables.require(read("clv_scores"), "clv_scores"),
        read("churn_alerts"), BlendParams.from_env(), args.normalize_fraud_pct)
    tables.write_parquet(out, _out(args, "customer_risk_blend"))
    done = spark.read.parquet(_out(args, "customer_risk_blend"))
    tables.write_csv(summaries.report_order(done, "customer_risk_blend"),
                     _out(args, "exports/customer_risk_blend"))


def export(spark, args):
    """Every table of the reporting model that has been built, as CSV."""
    read = lambda name: tables.read_if_present(spark, _out(args, name))
    clv_scores, risk_scores = read("clv_scores"), read("risk_scores")
    profiles = read_profiles(spark, args.profiles) if args.profiles else None
    metrics_path = _out(args, "streaming_metrics")
    metrics = read_metrics(spark, metrics_path) if tables.exists(spark, metrics_path) else None
    datasets = {
        "dim_date": dimensions.dim_date(spark, args.max_step),
        "dim_transaction_type": dimensions.dim_transaction_type(spark),
        "dim_customer": profiles and dimensions.dim_customer(profiles, clv_scores, risk_scores),
        "customer_products": profiles and dimensions.customer_products(profiles),
        "streaming_metrics": metrics,
        **{n: read(n) for n in ("transaction_summary", "daily_summary", "compliance_summary",
                                "dormancy_report", "customer_risk_blend", "flagged_transactions")},
    }
    for row in tables.export_datasets(datasets, _out(args, "exports"), args.list):
        print("{1:4} {0} - {2}".format(*row))


def ingest(spark, args):
    """Text rows to typed transactions; rejected rows go to their own folder.

    Rows are numbered by the numeric column ``--order``, else by their place in the files.
    """
    raw = read_csv_text(spark, args.input)
    good, bad = validate_rows(with_txn_ids(raw, args.order or None))
    tables.write_parquet(to_records(stamp_ingest(good)), _out(args, "transactions"))
    tables.write_parquet(bad, _out(args, "rejected"))


def _stream(args, trigger: str = "10 seconds") -> StreamParams:
    return StreamParams(kind=args.stream_kind, location=args.input,
                        bootstrap_servers=args.bootstrap_servers,
                        starting_offsets=args.starting_offsets,
                        max_per_trigger=args.max_per_trigger, trigger=args.trigger or trigger, once=args.once)


def _run(spark, args, *writers):
    queries = [w.start() for w in writers]
    stop_on_signal(*queries)
    if args.once:
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def _checkpoint(spark, args, name):
    path = _out(args, f"checkpoints/{name}")
    if args.reset_checkpoint:
        reset_checkpoint(spark, path)
    return path


def _topic(args):
    return kafka_writer(args.bootstrap_servers, args.output_topic) if args.output_topic else None


def stream_fraud(spark, args):
    p = _stream(args)
    _run(spark, args, fraud_stream(read_txn_stream(spark, p), _out(args, "fraud_alerts"),
                                   _out(args, "streaming_metrics"), _checkpoint(spark, args, "fraud"), p,
                                   FraudParams.from_env(), _topic(args)))


def stream_churn(spark, args):
    p = _stream(args)
    _run(spark, args, churn_stream(read_txn_stream(spark, p), _out(args, "customer_baseline"),
                                   _out(args, "churn_alerts"), _checkpoint(spark, args, "churn"), p,
                                   ChurnParams.from_env(), _topic(args)))


def stream_landing(spark, args):
    p = _stream(args, trigger="5 minutes")
    _run(spark, args, landing_stream(read_message_stream(spark, p), _out(args, "transactions"),
                                       _out(args, "dead_letters"), _checkpoint(spark, args, "landing"), p,
                                       args.partition_by))


def compact(spark, args):
    """The landed folders with few files each, in place."""
    log = landed_log(args.input, args.partition_by)
    compact_landed(spark, log, log.latest(spark))


def stream_flagged(spark, args):
    p = _stream(args)
    _run(spark, args, maintain_flagged(decode_alerts(read_message_stream(spark, p)),
                                       _out(args, "flagged_transactions"),
                                       _checkpoint(spark, args, "flagged"), p))


JOBS = {"risk": risk, "clv": clv, "baseline": baseline, "compliance": compliance,
        "customer-summary": customer_summary, "dormancy": dormancy,
        "transaction-summary": transaction_summary, "warehouse": warehouse, "risk-blend": risk_blend,
        "export": export, "ingest": ingest, "compact": compact, "stream-fraud": stream_fraud,
        "stream-churn": stream_churn, "stream-landing": stream_landing,
        "stream-flagged": stream_flagged}


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="txnloom", description=__doc__)
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--source", choices=("csv", "parquet", "table"), default="parquet")
    ap.add_argument("--input", default="")
    ap.add_argument("--out", default="warehouse")
    ap.add_argument("--master", default="")
    ap.add_argument("--database", default="txnloom")
    ap.add_argument("--profiles", default="")
    ap.add_argument("--order", default="")
    ap.add_argument("--max-step", type=int, default=168)
    ap.add_argument("--normalize-fraud-pct", action="store_true")
    ap.add_argument("--list", action="store_true", help="report what an export would write")
    ap.add_argument("--stream-kind", choices=("kafka", "json", "parquet"), default="kafka")
    ap.add_argument("--bootstrap-servers", default="")
    ap.add_argument("--output-topic", default="", help="send alerts to this topic as well")
    ap.add_argument("--starting-offsets", choices=("latest", "earliest"), default="latest")
    ap.add_argument("--max-per-trigger", type=int, default=100000)
    ap.add_argument("--trigger", default="", help="10 seconds, for landing 5 minutes, unless given")
    ap.add_argument("--partition-by", choices=("step", "day"), default="step")
    ap.add_argument("--once", action="store_true", help="drain what is available and stop")
    ap.add_argument("--reset-checkpoint", action="store_true")
    return ap.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    spark = build_session(f"txnloom-{args.job}", args.master or None)
    try:
        JOBS[args.job](spark, args)
    except SourceError as exc:
        print(f"error: {exc}", file=sys.stderr)
        return 2
    return 0
