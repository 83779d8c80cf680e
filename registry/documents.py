"""Messages, raw rows and customer documents."""

from pyspark.sql import functions as F

from txnloom.operators import checks, ingest, latest
from txnloom.sources.messages import decode_stream

from .core import query
from .inputs import messages, profile, raw_rows, txn

_TYPES = "('PAYMENT', 'TRANSFER', 'CASH_IN', 'CASH_OUT', 'DEBIT')"


@query("decoded_messages", "S2 V8", """
SELECT row_no AS kafka_offset, json_extract_string(doc, '$.type') AS type,
  CASE WHEN json_type(doc, '$.amount') = 'DOUBLE' THEN CAST(json_extract_string(doc, '$.amount') AS DOUBLE) END AS amount,
  json_extract_string(doc, '$.nameOrig') AS nameOrig, json_extract_string(doc, '$.txnId') AS txnId
FROM opened""")
def _(spark, d):
    """A message that is not JSON gives a row of NULLs beside its position."""
    return decode_stream(messages(spark, d)).select("kafka_offset", "type", "amount", "nameOrig", "txnId")


@query("message_problems", "V2", """
SELECT row_no AS "offset", ok AS valid_json, problem_text AS problems FROM checked""")
def _(spark, d):
    return ingest.message_checks(messages(spark, d)).select(
        "offset", "valid_json", F.array_join(F.array_sort("problems"), "; ").alias("problems"))


@query("ingest_quality", "V6", """
SELECT part AS "partition", count(*) AS received, count(*) FILTER (NOT ok) AS invalid_json,
  count(*) FILTER (ok AND problem_text <> '') AS invalid_schema, count(*) FILTER (problem_text = '') AS valid
FROM checked GROUP BY part""")
def _(spark, d):
    return ingest.ingest_quality(ingest.message_checks(messages(spark, d)))


@query("ingest_quality_total", "V6", """
SELECT count(*) AS received, count(*) FILTER (NOT ok) AS invalid_json,
  count(*) FILTER (ok AND problem_text <> '') AS invalid_schema, count(*) FILTER (problem_text = '') AS valid
FROM checked""")
def _(spark, d):
    return ingest.ingest_quality(ingest.message_checks(messages(spark, d)), by=())


@query("dead_letters", "V5", """
SELECT m.row_no AS "offset", m.value, c.problem_text AS problems
FROM message m JOIN checked c USING (row_no) WHERE c.problem_text <> ''""")
def _(spark, d):
    _, bad = ingest.split_good_bad(ingest.message_checks(messages(spark, d)))
    return bad.select("offset", "value", F.array_join(F.array_sort("problems"), "; ").alias("problems"))


@query("accepted_messages", "V5", "SELECT row_no AS \"offset\" FROM checked WHERE problem_text = ''")
def _(spark, d):
    good, _ = ingest.split_good_bad(ingest.message_checks(messages(spark, d)))
    return good.select("offset")


@query("parsed_rows", "V1", """
SELECT row_no, step, type, CAST(amount AS DOUBLE) AS amount, nameOrig, CAST(newbalanceOrig AS DOUBLE) AS newbalanceOrig,
  isFraud, isFlaggedFraud FROM raw_row WHERE kind NOT IN (0, 1, 2, 3, 4)""")
def _(spark, d):
    good, _ = ingest.validate_rows(raw_rows(spark, d))
    return good.select("row_no", "step", "type", "amount", "nameOrig", "newbalanceOrig", "isFraud", "isFlaggedFraud")


@query("rejected_rows", "V1", """
SELECT row_no, CASE kind WHEN 0 THEN 'type: not allowed' WHEN 1 THEN 'amount: negative'
  WHEN 2 THEN 'isFraud: not 0 or 1' WHEN 3 THEN 'step: not an integer' ELSE 'missing column: nameOrig' END AS problems
FROM raw_row WHERE kind IN (0, 1, 2, 3, 4)""")
def _(spark, d):
    _, bad = ingest.validate_rows(raw_rows(spark, d))
    return bad.select("row_no", F.array_join("problems", "; ").alias("problems"))


@query("surrogate_keys", "V3", """
SELECT row_no, 'TXN' || lpad(CAST(seq AS VARCHAR), 9, '0') AS txnId FROM (
  SELECT *, row_number() OVER (ORDER BY row_no) AS seq FROM raw_row) WHERE kind NOT IN (0, 1, 2, 3, 4)""")
def _(spark, d):
    """Numbers are given to all rows read, then the rejected ones leave gaps."""
    numbered = ingest.with_txn_ids(raw_rows(spark, d), "row_no")
    good, _ = ingest.validate_rows(numbered)
    return good.select("row_no", "txnId")


@query("segment_counts", "A17", "SELECT segment, count(*) AS n FROM profile GROUP BY segment")
def _(spark, d):
    return checks.segment_counts(profile(spark, d))


@query("segment_problems", "V9", """
SELECT 'missing segment' AS problem, 'Student' AS segment, CAST(0 AS BIGINT) AS customers
UNION ALL SELECT 'unexpected segment', 'Platinum', count(*) FROM profile WHERE segment = 'Student' AND c_custkey % 2 = 0
UNION ALL SELECT 'no segment', NULL, count(*) FROM profile WHERE segment = 'Student' AND c_custkey % 2 = 1""")
def _(spark, d):
    """Students are renamed or lose their segment, so that all three problems show."""
    odd = F.substring("customerId", 2, 20).cast("long") % 2 == 1
    spoilt = profile(spark, d).withColumn("segment", F.when(F.col("segment") != "Student", F.col("segment"))
                                          .when(~odd, "Platinum"))
    return checks.segment_problems(spoilt)


@query("profile_key_check", "V10", """
SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS missing_keys, count(DISTINCT customerId) AS distinct_keys,
  CAST(0 AS BIGINT) AS repeated_keys FROM profile""")
def _(spark, d):
    return checks.key_check(profile(spark, d), "customerId")


@query("sender_key_check", "V10", """
SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS missing_keys, count(DISTINCT nameOrig) AS distinct_keys,
  (SELECT count(*) FROM (SELECT nameOrig FROM txn GROUP BY nameOrig HAVING count(*) > 1)) AS repeated_keys FROM txn""")
def _(spark, d):
    return checks.key_check(txn(spark, d), "nameOrig")


@query("profile_upsert", "V14", """
SELECT customerId, CASE WHEN c_custkey % 3 = 0 THEN 'reloaded' ELSE segment END AS segment,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE risk_score END AS risk_score FROM profile
UNION ALL SELECT 'N' || substr(customerId, 2), 'reloaded', NULL FROM profile WHERE c_custkey % 3 = 0""")
def _(spark, d):
    """A third of the customers arrive again without a score, and as new customers too."""
    stored = profile(spark, d).select("customerId", "segment", "risk_score")
    third = stored.filter(F.substring("customerId", 2, 20).cast("long") % 3 == 0)
    again = third.select("customerId", F.lit("reloaded").alias("segment"), F.lit(None).cast("double").alias("risk_score"))
    new = again.withColumn("customerId", F.concat(F.lit("N"), F.substring("customerId", 2, 20)))
    return latest.upsert(stored, again.unionByName(new), "customerId")
