"""Oracle CTEs in DuckDB SQL, written apart from the Spark plans they check."""

_TYPE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT'
    WHEN '3-MEDIUM' THEN 'PAYMENT' WHEN '4-NOT SPECIFIED' THEN 'CASH_IN' ELSE 'DEBIT' END"""

CTES = {
    # -- inputs ---------------------------------------------------------------
    "txn": f"""
  SELECT *,
    CASE WHEN type IN ('PAYMENT', 'DEBIT') THEN 'M' ELSE 'C' END
      || CAST(CAST(floor(o_totalprice) AS BIGINT) % 4001 AS VARCHAR) AS nameDest,
    CAST(newbalanceOrig + amount AS DECIMAL(18,2)) AS oldbalanceOrg,
    CAST(0 AS DECIMAL(18,2)) AS oldbalanceDest,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE amount END AS DECIMAL(18,2)) AS newbalanceDest,
    CASE WHEN type IN ('TRANSFER', 'CASH_OUT') AND o_orderstatus = 'F' AND amount > 300000 THEN 1
         WHEN type = 'PAYMENT' AND row_no % 40 = 0 THEN 1 ELSE 0 END AS isFraud,
    CASE WHEN type = 'TRANSFER' AND amount > 200000 THEN 1 ELSE 0 END AS isFlaggedFraud
  FROM (
    SELECT o_orderkey AS row_no, o_orderstatus, o_totalprice,
      CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) % 168 + 1 AS INTEGER) AS step,
      {_TYPE} AS type,
      CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
      CASE WHEN o_custkey % 25 = 7 THEN 'M' ELSE 'C' END || CAST(o_custkey AS VARCHAR) AS nameOrig,
      CAST(CAST(coalesce(greatest(c_acctbal, 0.0), 0) AS DECIMAL(18,2)) + o_orderkey % 1000
           AS DECIMAL(18,2)) AS newbalanceOrig,
      'TXN' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS txnId,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ingest_ts
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey)""",
    "evt": """
  SELECT CAST(floor((epoch(ts) - 1704067200) / 3600) + 1 AS INTEGER) AS step,
    CASE event_type WHEN 'error' THEN 'CASH_OUT' WHEN 'click' THEN 'PAYMENT' WHEN 'view' THEN 'CASH_IN'
      WHEN 'purchase' THEN 'TRANSFER' ELSE 'DEBIT' END AS type,
    CAST(value AS DECIMAL(18,2)) AS amount,
    'C' || CAST(user_id AS VARCHAR) AS nameOrig,
    CAST(CAST(value AS DECIMAL(18,2)) * 10 AS DECIMAL(18,2)) AS newbalanceOrig,
    event_id AS kafka_offset
  FROM events""",
    "profile": """
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS customerId,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Premium' WHEN 'BUILDING' THEN 'Standard'
      WHEN 'FURNITURE' THEN 'Basic' WHEN 'HOUSEHOLD' THEN 'Private Banking' ELSE 'Student' END AS segment,
    CASE c_nationkey % 3 WHEN 0 THEN 'branch' WHEN 1 THEN 'mobile' ELSE 'web' END AS preferred_channel,
    CAST(c_custkey % 320 * 1000 AS DOUBLE) AS annualIncome,
    CASE WHEN c_custkey % 5 = 0 THEN 'pending' ELSE 'verified' END AS kyc_status,
    c_custkey % 10 <> 0 AS is_active,
    CAST(c_custkey % 101 AS DOUBLE) / 100 AS risk_score,
    (c_acctbal + 1000) / 11000 AS churn_probability,
    CAST(c_custkey % 37 AS DOUBLE) / 37 AS composite_risk_score,
    c_custkey % 4 AS n_products, c_custkey
  FROM customer WHERE c_custkey % 25 <> 7""",
    "product": """
  SELECT customerId, p.product
  FROM profile JOIN (VALUES (1, 'savings'), (2, 'card'), (3, 'loan'), (4, 'broker')) p(pos, product)
    ON p.pos <= n_products""",

    # -- scores and summaries -------------------------------------------------
    "risk_factor": """
  SELECT nameOrig AS customerId, count(*) AS frequency,
    coalesce(CAST(sum(amount) FILTER (type = 'TRANSFER') AS DOUBLE)
             / nullif(count(amount) FILTER (type = 'TRANSFER'), 0), 0.0) AS avg_transfer_amount,
    CAST(count(*) FILTER (type = 'CASH_OUT') AS DOUBLE) / count(*) AS cashout_proportion,
    count(DISTINCT nameDest) AS unique_dest_accounts
  FROM txn WHERE nameOrig LIKE 'C%' GROUP BY nameOrig""",
    "risk_norm": """
  SELECT f.*,
    CAST(frequency - a.f0 AS DOUBLE) / nullif(CAST(a.f1 - a.f0 AS DOUBLE), 0) AS norm_frequency,
    (avg_transfer_amount - a.t0) / nullif(a.t1 - a.t0, 0) AS norm_avg_transfer_amount,
    (cashout_proportion - a.c0) / nullif(a.c1 - a.c0, 0) AS norm_cashout_proportion,
    CAST(unique_dest_accounts - a.d0 AS DOUBLE) / nullif(CAST(a.d1 - a.d0 AS DOUBLE), 0)
      AS norm_unique_dest_accounts
  FROM risk_factor f, (SELECT min(frequency) f0, max(frequency) f1, min(avg_transfer_amount) t0,
    max(avg_transfer_amount) t1, min(cashout_proportion) c0, max(cashout_proportion) c1,
    min(unique_dest_accounts) d0, max(unique_dest_accounts) d1 FROM risk_factor) a""",
    "risk": """
  SELECT *, CASE WHEN risk_score < 0.25 THEN 'Low' WHEN risk_score <= 0.60 THEN 'Medium' ELSE 'High' END
    AS risk_tier
  FROM (SELECT *, round(0.25 * norm_frequency + 0.25 * norm_avg_transfer_amount
    + 0.25 * norm_cashout_proportion + 0.25 * norm_unique_dest_accounts, 6) AS risk_score
    FROM risk_norm)""",
    "clv_part": """
  SELECT c.*, m.last - c.last_step AS steps_since_last_txn,
    total_amount / max(total_amount) OVER () AS volume_score,
    CAST(txn_count AS DOUBLE) / max(txn_count) OVER () AS frequency_score,
    distinct_txn_types / 5.0::DOUBLE AS diversity_score,
    CASE WHEN m.last - c.last_step >= 48 THEN 0.0::DOUBLE
         ELSE 1.0::DOUBLE - CAST(m.last - c.last_step AS DOUBLE) / 48.0::DOUBLE END AS recency_score
  FROM (SELECT nameOrig AS customerId, CAST(sum(amount) AS DOUBLE) AS total_amount,
      count(*) AS txn_count, count(DISTINCT type) AS distinct_txn_types, max(step) AS last_step
    FROM txn WHERE nameOrig LIKE 'C%' GROUP BY nameOrig) c,
    (SELECT max(step) AS last FROM txn) m""",
    "clv": """
  SELECT *, CASE WHEN clv_score > 0.70 THEN 'High Value' WHEN clv_score >= 0.40 THEN 'Growth Potential'
    ELSE 'At Risk' END AS clv_classification
  FROM (SELECT *, round(0.30::DOUBLE * volume_score + 0.25::DOUBLE * frequency_score
    + 0.25::DOUBLE * diversity_score + 0.20::DOUBLE * recency_score, 6) AS clv_score FROM clv_part)""",
    "fraud_summary": """
  SELECT nameOrig AS customerId, count(*) AS total_transactions, CAST(sum(amount) AS DOUBLE) AS total_amount,
    count(*) FILTER (isFraud = 1) AS confirmed_fraud_count,
    round(CAST(count(*) FILTER (isFraud = 1) AS DOUBLE) * 100 / count(*), 6) AS fraud_rate_pct
  FROM txn WHERE nameOrig LIKE 'C%' GROUP BY nameOrig""",
    "compliance": """
  SELECT *, CASE WHEN r >= 5 THEN 'High' WHEN r >= 1 THEN 'Medium' ELSE 'Low' END AS risk_classification,
    round(r, 4) AS fraud_rate_pct
  FROM (SELECT type AS transaction_type, count(*) AS transaction_count,
      CAST(sum(amount) AS DOUBLE) AS transaction_volume,
      count(*) FILTER (isFraud = 1) AS fraud_count,
      CAST(count(*) FILTER (isFraud = 1) AS DOUBLE) * 100 / count(*) AS r
    FROM txn WHERE step BETWEEN 1 AND 168 GROUP BY type)""",
    "dormant": """
  SELECT customerId, last_active_step, max_step, max_step - last_active_step AS steps_inactive,
    txn_history_count,
    CASE WHEN max_step - last_active_step > 120 THEN 'Severely Dormant' ELSE 'Dormant' END
      AS dormancy_severity
  FROM (SELECT nameOrig AS customerId, max(step) AS last_active_step, count(*) AS txn_history_count
        FROM txn GROUP BY nameOrig) a, (SELECT max(step) AS max_step FROM txn) m
  WHERE customerId LIKE 'C%' AND txn_history_count >= 5 AND max_step - last_active_step > 72""",
    "mart": """
  SELECT nameOrig AS customerId, step, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
    CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount, CAST(max(amount) AS DOUBLE) AS max_amount,
    count(*) FILTER (isFraud = 1) AS fraud_count, string_agg(DISTINCT type, ',' ORDER BY type) AS txn_types,
    CAST(arg_max(newbalanceOrig, (ingest_ts, txnId)) AS DOUBLE) AS last_balance
  FROM txn GROUP BY ALL""",
    "landed_mart": """
  SELECT nameOrig AS customerId, step, count(*) AS txn_count, round(CAST(sum(amount) AS DOUBLE), 2) AS total_amount,
    count(*) FILTER (isFraud = 1) AS fraud_count,
    CAST(arg_max(newbalanceOrig, (ingest_ts, txnId)) AS DOUBLE) AS last_balance
  FROM txn WHERE row_no IN (SELECT row_no FROM checked WHERE problem_text = '') GROUP BY nameOrig, step""",
    # averages are rounded half up on whole cents
    "summary": """
  SELECT type AS transaction_type, step, CAST(sum(amount) AS DOUBLE) AS total_volume,
    count(*) AS transaction_count,
    CAST((2 * CAST(sum(amount) * 100 AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100
      AS avg_transaction_amount,
    count(*) FILTER (isFraud = 1) AS fraud_count
  FROM txn WHERE step BETWEEN 1 AND 168 GROUP BY type, step""",

    # -- fraud ----------------------------------------------------------------
    "flagged": """
  SELECT *, CASE WHEN coalesce(isFraud, 0) = 0 THEN 1 ELSE 0 END AS false_positive,
    TIMESTAMP '2023-01-01' + to_hours(step - 1) AS event_ts
  FROM txn WHERE type IN ('TRANSFER', 'CASH_OUT') AND amount > 200000 AND newbalanceDest = 0""",
    "metric": """
  SELECT row_no % 8 AS batch_id, count(*) AS total_count,
    count(*) FILTER (type IN ('TRANSFER', 'CASH_OUT') AND amount > 200000 AND newbalanceDest = 0)
      AS flagged_count
  FROM txn GROUP BY row_no % 8""",

    # -- churn ----------------------------------------------------------------
    "baseline": """
  SELECT nameOrig AS customerId, count(*) AS all_time_txn_count,
    CAST(sum(amount) AS DOUBLE) / count(*) AS all_time_avg_amount,
    min(step) AS first_step, max(step) AS last_step,
    CAST(count(*) AS DOUBLE) / (CAST(any_value(m.last) - min(step) + 1 AS DOUBLE) / 12.0::DOUBLE)
      AS hist_freq_per_12
  FROM evt, (SELECT max(step) AS last FROM evt) m GROUP BY nameOrig""",
    "evt_window": """
  SELECT e.*, ((step - 1) // 12 - j) * 12 + 1 AS ws,
    coalesce(newbalanceOrig < 500, FALSE) AS low
  FROM evt e, (VALUES (0), (1)) v(j)""",
    "win_run": """
  SELECT nameOrig, ws, max(n) AS low_run FROM (
    SELECT nameOrig, ws, count(*) AS n FROM (
      SELECT nameOrig, ws, low,
        row_number() OVER (PARTITION BY nameOrig, ws ORDER BY step, kafka_offset)
        - row_number() OVER (PARTITION BY nameOrig, ws, low ORDER BY step, kafka_offset) AS island
      FROM evt_window) WHERE low GROUP BY nameOrig, ws, island)
  GROUP BY nameOrig, ws""",
    "win": """
  SELECT w.nameOrig AS customerId, w.ws AS window_start_step, w.ws + 23 AS window_end_step,
    count(*) AS w_count, CAST(sum(amount) AS DOUBLE) / count(*) AS w_avg_amount,
    CAST((2 * CAST(sum(amount) * 100 AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS w_avg_2,
    count(*) FILTER (type = 'CASH_OUT') AS cashout_count,
    count(*) FILTER (type IN ('PAYMENT', 'DEBIT')) AS payment_debit_count,
    coalesce(max(r.low_run), 0) AS low_run
  FROM evt_window w LEFT JOIN win_run r ON r.nameOrig = w.nameOrig AND r.ws = w.ws
  GROUP BY w.nameOrig, w.ws""",
    "evt_tail": """
  SELECT *, coalesce(newbalanceOrig < 500, FALSE) AS low
  FROM (SELECT *, max(step) OVER (PARTITION BY nameOrig) AS last FROM evt) WHERE step > last - 24""",
    "tail_run": """
  SELECT nameOrig, max(n) AS low_run FROM (SELECT nameOrig, count(*) AS n FROM (
    SELECT nameOrig, low, row_number() OVER (PARTITION BY nameOrig ORDER BY step, kafka_offset)
      - row_number() OVER (PARTITION BY nameOrig, low ORDER BY step, kafka_offset) AS island FROM evt_tail)
  WHERE low GROUP BY nameOrig, island) GROUP BY nameOrig""",
    "win_scored": """
  SELECT w.*,
    coalesce(b.hist_freq_per_12 > 1.0 AND w_count / 2.0::DOUBLE < 1.0, FALSE) AS s1,
    coalesce(b.all_time_avg_amount > 0 AND w_avg_amount < 0.2::DOUBLE * b.all_time_avg_amount, FALSE) AS s2,
    cashout_count = w_count AND payment_debit_count = 0 AS s3,
    low_run >= 2 AS s4
  FROM win w LEFT JOIN baseline b USING (customerId)""",
    "alert": """
  SELECT *, CASE WHEN s1 THEN 1 ELSE 0 END + CASE WHEN s2 THEN 1 ELSE 0 END
      + CASE WHEN s3 THEN 1 ELSE 0 END + CASE WHEN s4 THEN 1 ELSE 0 END AS signal_count,
    concat_ws(',', CASE WHEN s1 THEN 'S1_LOW_FREQUENCY' END, CASE WHEN s2 THEN 'S2_AMOUNT_DROP' END,
      CASE WHEN s3 THEN 'S3_EXCLUSIVE_CASHOUT' END, CASE WHEN s4 THEN 'S4_CONSECUTIVE_LOW_BALANCE' END)
      AS signal_names
  FROM win_scored
  WHERE CASE WHEN s1 THEN 1 ELSE 0 END + CASE WHEN s2 THEN 1 ELSE 0 END
      + CASE WHEN s3 THEN 1 ELSE 0 END + CASE WHEN s4 THEN 1 ELSE 0 END >= 2""",

    # -- graph ----------------------------------------------------------------
    "account": """
  SELECT accountId, CASE WHEN accountId LIKE 'M%' THEN 'MERCHANT' ELSE 'CUSTOMER' END AS accountType
  FROM (SELECT nameOrig AS accountId FROM txn UNION SELECT nameDest FROM txn)
  WHERE NOT (accountId LIKE 'C%' AND CAST(substr(accountId, 2) AS BIGINT) % 17 = 3)""",
    "path": """
  SELECT t.txnId, t.nameOrig AS sender, t.nameDest AS receiver, t.amount, t.isFraud
  FROM txn t WHERE t.nameOrig IN (SELECT accountId FROM account)
    AND t.nameDest IN (SELECT accountId FROM account)""",
    "ring": """
  SELECT receiver AS account, a.accountType AS account_type, count(DISTINCT sender) AS distinct_senders,
    count(*) AS inbound_txns, CAST(sum(amount) AS DOUBLE) AS inbound_amount,
    CAST(sum(isFraud) AS BIGINT) AS confirmed_fraud_txns
  FROM path p JOIN account a ON a.accountId = p.receiver
  GROUP BY receiver, a.accountType""",

    # -- customer dimension ---------------------------------------------------
    "dim_customer": """
  SELECT p.*, c.clv_score, c.clv_classification, r.risk_score AS model_risk_score, r.risk_tier,
    CASE WHEN p.churn_probability >= 0.66 THEN 'High' WHEN p.churn_probability >= 0.33 THEN 'Medium'
      ELSE 'Low' END AS churn_band,
    CASE WHEN p.risk_score >= 0.60 THEN 'High' WHEN p.risk_score >= 0.25 THEN 'Medium' ELSE 'Low' END
      AS risk_band,
    CASE WHEN annualIncome >= 250000 THEN '250k+' WHEN annualIncome >= 100000 THEN '100-250k'
      WHEN annualIncome >= 50000 THEN '50-100k' ELSE '<50k' END AS income_band,
    coalesce(c.clv_classification, 'Unscored') AS clv_tier
  FROM profile p LEFT JOIN clv c USING (customerId) LEFT JOIN risk r USING (customerId)""",

    # -- messages -------------------------------------------------------------
    "message": """
  SELECT row_no, CAST(row_no % 4 AS INTEGER) AS part,
    CASE WHEN row_no % 2 = 0 THEN '{"schema":{"type":"struct"},"payload":' || body || '}' ELSE body END AS value
  FROM (SELECT *,
    '{"step":' || CASE WHEN kind = 1 THEN '"' || step || '"' WHEN kind = 8 THEN '5000000000' ELSE CAST(step AS VARCHAR) END
    || ',"type":"' || CASE WHEN kind = 3 THEN 'BOGUS' ELSE type END
    || '","amount":' || CASE WHEN kind = 6 THEN '"much"' ELSE CAST(amount AS VARCHAR) END
    || ',"nameOrig":"' || CASE WHEN kind = 4 THEN '' ELSE nameOrig END
    || '","oldbalanceOrg":' || oldbalanceOrg || ',"newbalanceOrig":' || newbalanceOrig
    || ',"nameDest":"' || nameDest || '","oldbalanceDest":' || oldbalanceDest
    || ',"newbalanceDest":' || newbalanceDest
    || ',"isFraud":' || isFraud || CASE WHEN kind = 5 THEN '.0' ELSE '' END
    || ',"isFlaggedFraud":' || CASE WHEN kind = 7 THEN 'true' ELSE CAST(isFlaggedFraud AS VARCHAR) END
    || CASE WHEN kind = 2 THEN '' ELSE ',"txnId":"' || txnId || '"' END
    || ',"ingest_ts":"' || ingest_ts || CASE WHEN kind = 0 THEN '"' ELSE '"}' END AS body
    FROM (SELECT *, CASE WHEN row_no % 97 = 0 THEN row_no // 97 % 9 ELSE -1 END AS kind FROM txn))""",
    "opened": """
  SELECT row_no, part, json_valid(value) AS ok,
    CASE WHEN json_valid(value) THEN
      CASE WHEN json_extract(value, '$.payload') IS NOT NULL THEN json_extract(value, '$.payload')
           ELSE CAST(value AS JSON) END END AS doc
  FROM message""",
    "checked": """
  SELECT row_no, part, ok, doc,
    CASE WHEN NOT ok THEN 'not JSON'
      WHEN json_type(doc, '$.txnId') IS NULL THEN 'absent: txnId'
      ELSE concat_ws('; ',
        CASE WHEN json_type(doc, '$.isFraud') NOT IN ('UBIGINT', 'BIGINT') THEN 'isFraud: whole number expected' END,
        CASE WHEN json_type(doc, '$.isFlaggedFraud') NOT IN ('UBIGINT', 'BIGINT')
          THEN 'isFlaggedFraud: whole number expected' END,
        CASE WHEN json_type(doc, '$.amount') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'amount: number expected' END,
        CASE WHEN json_extract_string(doc, '$.nameOrig') = '' THEN 'nameOrig: text expected' END,
        CASE WHEN json_type(doc, '$.step') NOT IN ('UBIGINT', 'BIGINT') THEN 'step: whole number expected'
          WHEN CAST(json_extract(doc, '$.step') AS BIGINT) > 2147483647 THEN 'step: beyond 32 bits' END,
        CASE WHEN json_extract_string(doc, '$.type') NOT IN
          ('PAYMENT', 'TRANSFER', 'CASH_IN', 'CASH_OUT', 'DEBIT') THEN 'type: unknown' END)
    END AS problem_text
  FROM opened""",
    "raw_row": """
  SELECT *, CASE WHEN row_no % 97 = 0 THEN row_no // 97 % 7 ELSE -1 END AS kind FROM txn""",
}
