"""Time the headline queries at ``$BENCH_SF_DIR``; prints one JSON line."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import QUERIES  # noqa: E402
from txnloom.session import build_session  # noqa: E402

HEADLINE = ("compliance_summary", "customer_fraud_summary", "dormancy_report", "daily_summary",
            "transaction_summary", "txn_summary_mart", "risk_scores", "clv_scores",
            "flagged_transactions", "customer_baseline", "churn_alerts", "trailing_windows",
            "fraud_rings", "customer_risk_blend", "dim_customer", "measures_flagged",
            "report_daily_fraud_trend", "report_top_accounts", "message_problems",
            "surrogate_keys", "reconciliation", "stream_fraud_alerts", "stream_churn_alerts")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        runs = []
        # Streams pay for their start each time, so one run tells enough.
        for _ in range(1 if name.startswith("stream_") else 3):
            start = time.perf_counter()
            QUERIES[name].plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
