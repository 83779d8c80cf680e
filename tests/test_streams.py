import json

from pyspark.sql import functions as F

from rows import txns
from test_churn import EXPECTED, history, stream_rows, with_offsets
from txnloom.functions.payloads import encode_txn, fraud_alert
from txnloom.functions.rules import is_fraud
from txnloom.operators.churn import churn_windows, trailing_windows
from txnloom.operators.summaries import customer_baseline
from txnloom.params import ChurnParams, StreamParams
from txnloom.sinks import batches
from txnloom.sources import read_metrics
from txnloom.sources.messages import MESSAGE, decode_stream, read_message_stream
from txnloom.streaming.churn import churn_stream, stretch_log, window_stream, window_stretches
from txnloom.streaming.flagged import decode_alerts, flagged_batch, maintain_flagged, read_flagged
from txnloom.streaming.fraud import fraud_batch, fraud_stream
from txnloom.streaming import landing, trailing
from txnloom.streaming.landing import compact_landed, landed_log, landing_stream
from txnloom.streaming.trailing import trailing_stream


def _write(spark, path, values, start=0):
    rows = [(None, v, 0, start + i, None) for i, v in enumerate(values)]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").json(path)


def _source(spark, path, per_trigger=1):
    p = StreamParams(kind="json", location=path, max_per_trigger=per_trigger, once=True)
    return read_message_stream(spark, p), p


def _texts(df, column):
    return [r[0] for r in df.select(column).collect()]


def _drain(writer):
    q = writer.start()
    q.awaitTermination()
    return q


def _fraud_rows(n, first=0):
    return [{"txnId": f"TXN{i:09}", "type": "TRANSFER", "amount": 250000.0 + i, "newbalanceDest": 0.0, "ingest_ts": "x"} for i in range(first, first + n)]


def test_fraud_stream_resumes_and_counts(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    good = _texts(txns(spark, _fraud_rows(2) + [{"txnId": "TXN9"}]), encode_txn())
    _write(spark, src, good + ["broken"])

    def run():
        messages, p = _source(spark, src)
        _drain(fraud_stream(decode_stream(messages), f"{out}/alerts", f"{out}/metrics", f"{out}/cp", p))

    run()
    _write(spark, src, _texts(txns(spark, _fraud_rows(1, 5)), encode_txn(False)), 10)
    run()  # continues from the checkpoint: only the new file
    m = read_metrics(spark, f"{out}/metrics").orderBy("total_count").collect()
    assert [(r.total_count, r.parsed_count, r.flagged_count, r.fraud_rate_pct) for r in m] == [(1, 1, 1, 100.0), (4, 3, 2, 50.0)]
    alerts = spark.read.parquet(f"{out}/alerts").collect()
    assert sorted(r.txnId for r in alerts) == ["TXN000000000", "TXN000000001", "TXN000000005"]
    payload = json.loads(alerts[0].value)
    assert len(payload) == 15 and payload["fraud_rule"] and payload["detected_at"]
    assert batches.reset_checkpoint(spark, f"{out}/cp") and not batches.reset_checkpoint(spark, f"{out}/cp")


def test_replayed_batch_does_not_duplicate(spark, tmp_path):
    out = str(tmp_path)
    handle = fraud_batch(batches.parquet_writer(f"{out}/a"), batches.json_writer(f"{out}/m"))
    for _ in range(2):
        handle(txns(spark, _fraud_rows(3)), 7)
    handle(txns(spark, _fraud_rows(1)).filter("false"), 8)
    assert spark.read.parquet(f"{out}/a").count() == 3
    assert {(r.batch_id, r.total_count) for r in read_metrics(spark, f"{out}/m").collect()} == {(7, 3), (8, 0)}


def _event_texts(spark, rows):
    df = with_offsets(spark, rows)
    return _texts(df.orderBy("kafka_offset"), F.to_json(F.struct("step", "type", "amount", "nameOrig", "newbalanceOrig")))


def test_churn_stream_finds_the_batch_alerts(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    customer_baseline(history(spark)).write.parquet(f"{out}/baseline")
    _write(spark, src, _event_texts(spark, stream_rows()))
    messages, p = _source(spark, src)
    _drain(churn_stream(decode_stream(messages), f"{out}/baseline", f"{out}/alerts", f"{out}/cp", p))
    got = spark.read.parquet(f"{out}/alerts")
    assert got.count() == 6 and "alert_date" in got.columns
    assert {(r.customerId, tuple(r.signals), r.window_avg_amount) for r in got.collect()} == EXPECTED
    assert set(json.loads(got.first().value)) >= {"customerId", "signals", "detected_at", "window_start"}


def _run_windows(spark, src, out, p=ChurnParams()):
    messages, s = _source(spark, src)
    q = _drain(window_stream(decode_stream(messages), f"{out}/log", batches.parquet_writer(f"{out}/w"), f"{out}/cp", s, p))
    return spark.read.parquet(f"{out}/w"), q


def _run_trailing(spark, src, out, p=ChurnParams()):
    messages, s = _source(spark, src)
    _drain(batches.configure(trailing_stream(decode_stream(messages), p).writeStream.outputMode("update")
                             .foreachBatch(batches.parquet_writer(f"{out}/w")), f"{out}/cp", s))
    return spark.read.parquet(f"{out}/w")


def _activity(n, seed):
    import random
    rng = random.Random(seed)
    return [{"nameOrig": rng.choice(["C1", "C1", "C2"]), "step": 1 + i // 6, "type": rng.choice(["CASH_OUT", "PAYMENT"]),
             "amount": rng.randint(1, 999) / 100, "newbalanceOrig": rng.choice([100.0, 900.0]), "kafka_offset": i} for i in range(n)]


def _same(df):
    return {(r.customerId, r.window.start, r.w_count, r.w_avg_amount, r.cashout_count, r.payment_debit_count, r.low_run) for r in df.collect()}


def test_last_emission_of_every_window_equals_the_batch_twin(spark, tmp_path):
    rows = _activity(300, 3)
    src = str(tmp_path / "in")
    for part in (rows[:100], rows[100:220], rows[220:]):
        _write(spark, src, _event_texts(spark, part), part[0]["kafka_offset"])
    df = with_offsets(spark, rows)
    want = _same(churn_windows(df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))))
    for chunk in (ChurnParams.order_chunk, 62, 124):
        got, _ = _run_windows(spark, src, str(tmp_path / f"out{chunk}"), ChurnParams(order_chunk=chunk))
        assert got.select("batch_id").distinct().count() == 3
        last = got.groupBy("customerId", "window").agg(F.max_by(F.struct(*[c for c in got.columns if c not in ("customerId", "window")]), "batch_id").alias("r"))
        assert _same(last.select("customerId", "window", "r.*")) == want


def test_window_plan_has_no_python(spark, tmp_path):
    _write(spark, str(tmp_path), _event_texts(spark, _activity(3, 1)))
    messages, _ = _source(spark, str(tmp_path))
    plan = window_stretches(decode_stream(messages))._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan and "Python" not in plan and "Pandas" not in plan and "collect_list" not in plan


def test_late_rows_are_dropped_and_closed_windows_leave_the_state(spark, tmp_path):
    src = str(tmp_path / "in")
    def one(step, at):
        return {"nameOrig": "C1", "step": step, "type": "DEBIT", "amount": 1.0, "newbalanceOrig": 900.0, "kafka_offset": at}
    # Step 200 sets the limit 48 hours back, to hour 151; the engine applies it from the second trigger after.
    for at, step in enumerate((200, 200, 120, 140, 400, 401, 402)):
        _write(spark, src, _event_texts(spark, [one(step, at)]), at)
    got, q = _run_windows(spark, src, str(tmp_path / "out"))
    hour = (F.unix_timestamp("window.end") - F.lit(1672531200)) / 3600
    ends = sorted(int(r.h) for r in got.withColumn("h", hour).filter("batch_id in (2, 3)").collect())
    # Step 120 comes too late for both of its windows; step 140 only for the first, ending at hour 144.
    assert ends == [156]
    progress = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert sum(p["numRowsDroppedByWatermark"] for p in progress) == 3
    # Two windows of step 400 and on stay; those of steps 140 and 200 are given up.
    assert sum(p["numRowsRemoved"] for p in progress) > 0 and progress[-1]["numRowsTotal"] <= 6


def test_stretch_log_is_compacted_in_place(spark, tmp_path):
    rows = _activity(300, 8)
    df = with_offsets(spark, rows).withColumn("amount", F.col("amount").cast("double"))
    from txnloom.streaming.churn import touched_windows, window_batch
    log, seen = stretch_log(str(tmp_path / "log")), {}
    stretched = window_stretches(df)  # the same plan over a table: one trigger with all rows
    handle = window_batch(log, lambda w, n: seen.update({n: _same(w)}), compact_every=2)
    want = _same(churn_windows(df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))))
    for n in range(6):
        handle(stretched, n)
        listed = log.folders(spark)
        assert len(listed) <= 2 and seen[n] == want
        # A base and what it replaces are never listed together.
        bases = [int(f.rsplit("-", 1)[1]) for f in listed if "base" in f]
        assert len(bases) <= 1 and all(int(f.rsplit("-", 1)[1]) > bases[0] for f in listed if bases and "batch" in f)
    # Folders stay readable until the compaction after the next.
    before = log.read(spark)
    log.compact(spark, 5)
    handle(stretched, 6)
    assert before.count() > 0 and _same(touched_windows(spark, log, 6)) == want


def test_trailing_stream_equals_the_batch_twin(spark, tmp_path):
    rows = _activity(200, 5)
    src = str(tmp_path / "in")
    _write(spark, src, _event_texts(spark, rows))
    got = _run_trailing(spark, src, str(tmp_path / "out"))
    batch = trailing_windows(with_offsets(spark, rows))
    last = batch.groupBy("customerId").agg(F.max_by(F.struct("w_count", "cashout_count", "low_run"), "step").alias("r")).select("customerId", "r.*")
    assert {tuple(r) for r in got.select("customerId", "w_count", "cashout_count", "low_run").collect()} == {tuple(r) for r in last.collect()}


def test_trailing_run_spans_the_ends_of_a_stretch(spark, tmp_path):
    src = str(tmp_path / "in")
    ends = [{"nameOrig": "C1", "step": 1, "type": "PAYMENT", "amount": 1.0, "newbalanceOrig": 100.0, "kafka_offset": at} for at in (0, 61)]
    _write(spark, src, _event_texts(spark, ends[:1]), 0)
    _write(spark, src + "/more", _event_texts(spark, ends[1:]), 61)
    texts = [(None, r.value, 0, r.offset, None) for r in spark.read.schema(MESSAGE).option("recursiveFileLookup", True).json(src).collect()]
    spark.createDataFrame(texts, MESSAGE).coalesce(1).write.json(str(tmp_path / "one"))
    got = _run_trailing(spark, str(tmp_path / "one"), str(tmp_path / "out")).collect()
    assert [(r.w_count, r.low_run) for r in got] == [(2, 2)]


def _low_run(low):
    return max(map(len, "".join("1" if x else "0" for x in low).split("0")))


def test_trailing_state_grows_with_groups_and_not_with_customers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trailing, "GROUPS", 8, raising=False)
    src = str(tmp_path / "in")
    rows = [{"nameOrig": f"C{i % 300}", "step": 1 + i // 300, "type": "CASH_OUT", "amount": 2.0, "newbalanceOrig": 100.0, "kafka_offset": i} for i in range(900)]
    _write(spark, src, _event_texts(spark, rows))
    messages, s = _source(spark, src)
    q = _drain(batches.configure(trailing_stream(decode_stream(messages)).writeStream.outputMode("update")
                                 .foreachBatch(batches.parquet_writer(f"{tmp_path}/w")), f"{tmp_path}/cp", s))
    got = spark.read.parquet(f"{tmp_path}/w").select("customerId", "w_count", "w_avg_amount", "cashout_count", "low_run").collect()
    assert sorted(map(tuple, got)) == sorted((f"C{i}", 3, 2.0, 3, 3) for i in range(300))
    assert q.recentProgress[0]["stateOperators"][0]["numRowsUpdated"] <= 8


def test_trailing_windows_of_every_trigger(spark, tmp_path, monkeypatch):
    import random
    rng = random.Random(4)
    monkeypatch.setattr(trailing, "GROUPS", 3, raising=False)
    src, seen, want = str(tmp_path / "in"), {}, []
    for trigger in range(4):
        rows = []
        for at in rng.sample(range(1000 * trigger, 1000 * trigger + 300), 120):
            rows.append({"nameOrig": rng.choice(["C1", "C1", *[f"C{k}" for k in range(2, 9 + trigger)]]), "step": 1 + 10 * trigger + rng.randint(0, 30),
                         "type": rng.choice(["CASH_OUT", "PAYMENT", "CASH_IN"]), "amount": rng.choice([None, 0.25, 7.5]),
                         "newbalanceOrig": rng.choice([100.0, 100.0, 900.0]), "kafka_offset": at})
        texts = [(None, json.dumps({k: v for k, v in r.items() if k != "kafka_offset"}), 0, r["kafka_offset"], None) for r in rows]
        spark.createDataFrame(texts, MESSAGE).coalesce(1).write.mode("append").json(src)
        for name in {r["nameOrig"] for r in rows}:
            seen.setdefault(name, []).extend(r for r in rows if r["nameOrig"] == name)
            last = max(r["step"] for r in seen[name])
            held = sorted((r for r in seen[name] if r["step"] > last - 24), key=lambda r: (r["step"], r["kafka_offset"]))
            known = [r["amount"] for r in held if r["amount"] is not None]
            want.append((trigger, name, len(held), sum(known) / len(known) if known else None, sum(r["type"] == "CASH_OUT" for r in held),
                         sum(r["type"] == "PAYMENT" for r in held), _low_run(r["newbalanceOrig"] < 500 for r in held)))
    got = _run_trailing(spark, src, str(tmp_path / "out")).select(
        "batch_id", "customerId", "w_count", "w_avg_amount", "cashout_count", "payment_debit_count", "low_run").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_trailing_stretches_are_added_up_in_any_order(monkeypatch):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(2)
    at = rng.permutation(4000)
    rows = pd.DataFrame({"customerId": np.where(rng.random(4000) < 0.9, "hot", "C2").astype(object), "step": 1 + at // 1500, "at": at,
                         "amount": np.where(rng.random(4000) < 0.1, np.nan, 0.5), "flags": rng.integers(0, 8, 4000)})
    batches_ = [rows[i:i + 100] for i in range(0, 4000, 100)]
    at_once = trailing._arrived(iter([rows]), names := {})
    monkeypatch.setattr(trailing, "_WAITING", 50)
    for a, b in zip(at_once, trailing._arrived(iter(batches_), dict(names))):
        assert a.dtype == b.dtype and (a == b).all()
    customer, step, _, *sums, there, low = at_once
    (customer, step), values = trailing.folded([customer, step], [*sums, *trailing.run_summaries(there, low)])
    got = {(c, s): (n, best) for c, s, n, best in zip(customer, step, values[0], values[-1])}
    rows["low"] = rows["flags"] & 4 > 0
    assert got == {(names[c], s): (len(g), _low_run(g.sort_values("at")["low"])) for (c, s), g in rows.groupby(["customerId", "step"])}


def test_landing_splits_good_from_bad(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    good = _texts(txns(spark, [{"step": s, "txnId": f"TXN{s}", "ingest_ts": "x"} for s in (1, 2, 30)]), encode_txn())
    _write(spark, src, good + ["{", '{"step":1}'])
    messages, p = _source(spark, src)
    _drain(landing_stream(messages, f"{out}/t", f"{out}/dead", f"{out}/cp", p))
    assert {(r.step, r.txnId) for r in landed_log(f"{out}/t").read(spark).collect()} == {(1, "TXN1"), (2, "TXN2"), (30, "TXN30")}
    assert [len(r.problems) for r in spark.read.json(f"{out}/dead").orderBy("offset").collect()] == [1, 12]
    _drain(landing_stream(messages, f"{out}/d", f"{out}/dead2", f"{out}/cp2", p, partition_by="day"))
    assert {str(r.day) for r in landed_log(f"{out}/d", "day").read(spark).collect()} == {"2023-01-01", "2023-01-02"}


def test_landing_checks_a_message_once_and_compacts_under_readers(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    checks = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        checks.add(1)
        return value

    real = landing.message_checks
    monkeypatch.setattr(landing, "message_checks", lambda df: real(df.withColumn("value", counted("value"))))
    handle = landing.landing_batch(f"{out}/t", f"{out}/dead", f"{out}/staged", compact_every=0)
    log = landed_log(f"{out}/t")

    def batch(n):
        texts = _texts(txns(spark, [{"step": s, "txnId": f"TXN{n}{s}", "ingest_ts": "x"} for s in (1, 2)]), encode_txn()) + ["{"]
        return spark.createDataFrame([(None, v, 0, 10 * n + i, None) for i, v in enumerate(texts)], MESSAGE)

    for n in (0, 1, 1, 2):  # the second batch is replayed
        handle(batch(n), n)
    assert checks.value == 4 * 3
    rows = lambda df: sorted(r.txnId for r in df.collect())
    want = sorted(f"TXN{n}{s}" for n in range(3) for s in (1, 2))
    assert rows(log.read(spark)) == want and spark.read.json(f"{out}/dead").count() == 3
    during = log.read(spark)  # listed before the compaction, read after it
    compact_landed(spark, log, 2)
    assert rows(during) == want and rows(log.read(spark)) == want and len(log.folders(spark)) == 1
    handle(batch(3), 3)
    assert len(rows(log.read(spark))) == 8 and len(log.folders(spark)) == 2
    compact_landed(spark, log, 3)
    assert len(rows(log.read(spark))) == 8


def test_batch_table_adds_only_new_folders(spark, tmp_path):
    import uuid
    from txnloom.sinks import tables
    log, db = landed_log(str(tmp_path / "t")), f"db_{uuid.uuid4().hex[:8]}"
    tables.create_database(spark, db, str(tmp_path / "db"))
    put = lambda n: log.write(txns(spark, [{"step": s, "txnId": f"TXN{n}{s}"} for s in (1, 2)]), n)
    put(0)
    assert [f.rsplit("log=", 1)[1] for f in tables.batch_table(spark, f"{db}.t", log)] == ["batch-0"]
    put(1)
    assert [f.rsplit("log=", 1)[1] for f in tables.batch_table(spark, f"{db}.t", log)] == ["batch-1"]
    assert tables.batch_table(spark, f"{db}.t", log) == [] and spark.table(f"{db}.t").count() == 4
    log.compact(spark, 1)
    assert [f.rsplit("log=", 1)[1] for f in tables.batch_table(spark, f"{db}.t", log)] == ["base-1"]
    assert spark.table(f"{db}.t").count() == 4 and spark.table(f"{db}.t").where("step = 2").count() == 2


def test_flagged_table(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    alerts = _texts(txns(spark, _fraud_rows(4)).filter(is_fraud()), fraud_alert())
    _write(spark, src, alerts)
    def run():
        messages, p = _source(spark, src)
        _drain(maintain_flagged(decode_alerts(messages), f"{out}/t", f"{out}/cp", p, max_rows=3))
    run()
    assert [r.txnId[-1] for r in read_flagged(spark, f"{out}/t").orderBy("txnId").collect()] == ["1", "2", "3"]
    # An update of row 2 and a new row spelled differently: row 1 falls out, row 2 keeps its place.
    update = json.dumps({**json.loads(alerts[2]), "isFraud": 1})
    other = json.loads(alerts[0])
    other["txnID"] = "NEW"
    del other["txnId"]
    _write(spark, src, [update, json.dumps(other), "junk", '{"id":"nostep"}'], 100)
    run()
    rows = {r.txnId: r for r in read_flagged(spark, f"{out}/t").collect()}
    assert set(rows) == {"TXN000000002", "TXN000000003", "NEW"}
    assert (rows["TXN000000002"].isFraud, rows["TXN000000002"].false_positive) == (1, 0)
    assert rows["NEW"].false_positive == 1 and rows["NEW"].bridged_at


def test_flagged_batch_replay(spark, tmp_path):
    target = str(tmp_path / "t")
    handle = flagged_batch(target)
    def batch(n, first):
        return txns(spark, _fraud_rows(n, first)).withColumns({"kafka_offset": F.monotonically_increasing_id(), "id": F.lit(None).cast("string"),
                                                               "fraud_rule": F.lit("r"), "detected_at": F.lit("d")})
    handle(batch(2, 0), 0)
    for _ in range(2):
        handle(batch(2, 1), 1)
    assert read_flagged(spark, target).count() == 3


def test_topic_gets_what_was_stored(spark, tmp_path):
    src, out, sent = str(tmp_path / "in"), str(tmp_path / "out"), []
    _write(spark, src, _texts(txns(spark, _fraud_rows(3) + [{"txnId": "TXN9"}]), encode_txn()))
    messages, p = _source(spark, src)
    topic = lambda df, batch_id: sent.extend((r.key, json.loads(r.value)["txnId"]) for r in df.select("key", "value").collect())
    _drain(fraud_stream(decode_stream(messages), f"{out}/alerts", f"{out}/metrics", f"{out}/cp", p, topic=topic))
    assert sorted(sent) == [("C1", f"TXN00000000{i}") for i in range(3)]


def test_larger_topics_have_more_files_in_a_trigger(spark, monkeypatch):
    from registry import streams
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 10, raising=False)
    rows = spark.range(480).select(F.lit(None).cast("string").alias("key"), F.lit("{}").alias("value"), F.lit(0).alias("partition"),
                                   F.col("id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))
    _, p = streams._topic(spark, rows, "many")
    assert p.max_per_trigger == 8
    kept = spark.read.parquet(p.location).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.min("offset").alias("a"), F.max("offset").alias("b")).orderBy("a").collect()
    # Every row is there once, and files hold ranges that do not overlap.
    assert sum(r.n for r in kept) == 480 and all(r.n == r.b - r.a + 1 for r in kept) and len(kept) == 48


def test_python_workers_can_import_the_package_anywhere(spark):
    import os
    import zipfile

    from pyspark import SparkFiles
    from txnloom.session import ship_package
    for _ in range(2):
        ship_package(spark)
    assert spark.sparkContext._python_includes.count("txnloom.zip") == 1
    with zipfile.ZipFile(os.path.join(SparkFiles.getRootDirectory(), "txnloom.zip")) as z:
        assert "txnloom/streaming/churn.py" in z.namelist()
