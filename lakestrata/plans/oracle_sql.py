"""DuckDB SQL twins of the registered queries.

The SQL computes each result directly from the given tables with the same
mapping as ``lakestrata.sources.fixtures`` but without the JSON round trip:
reasons, de-duplication and aggregates are written out as plain SQL. Exact
half-even rounding uses integer arithmetic.
"""

from __future__ import annotations

FIXTURE_DATE = "2024-01-31"
ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"

# --- fixture CTEs -----------------------------------------------------------------

CARD_CTE = f"""
card_src AS (
  SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, l.l_partkey AS pk, l.l_suppkey AS sk, o.o_custkey AS ck,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents, l.l_returnflag AS rf, l.l_linestatus AS ls,
         o.o_orderpriority AS prio, p.p_name, p.p_brand, s.s_name, n.n_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
),
card_f AS (
  SELECT *,
    'evt_card_auth_' || ok || '_' || ln AS event_id,
    'txn_' || ok AS transaction_id,
    'auth_' || ok || '_' || ln AS authorization_id,
    'cust_' || ck AS customer_id,
    'acct_' || ok AS account_id,
    CASE WHEN pk % 227 = 0 THEN NULL ELSE 'card_' || ck END AS card_id,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((ok * 7919 + ln * 104729) % 2592000), {ISO}) AS event_time,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds((ok * 7919 + ln * 104729) % 2592000) AS event_ts,
    (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS amount_2dp,
    (CASE WHEN pk % 241 = 0 THEN -1 ELSE 1 END)
      * CASE WHEN pk % 233 = 0 THEN NULL WHEN pk % 7 = 0 THEN cents + cents % 2 ELSE cents END AS amount_cents,
    CASE WHEN pk % 241 = 0 THEN '-' ELSE '' END AS sign_text,
    CASE WHEN sk % 20 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN pk % 223 = 0 OR pk % 227 = 0 THEN NULL ELSE 'mrc_' || sk END AS merchant_id,
    CASE WHEN pk % 229 = 0 THEN '' ELSE p_name END AS merchant_name,
    p_brand AS merchant_category_code,
    n_name AS merchant_country,
    CASE WHEN ln % 3 <> 0 THEN s_name END AS merchant_city,
    CASE WHEN rf = 'R' THEN 'declined' WHEN rf = 'N' AND sk % 20 = 1 THEN 'pending' ELSE 'approved' END
      AS authorization_status,
    CASE WHEN ls = 'O' THEN 'ecommerce' ELSE 'card_present' END AS channel,
    ls = 'F' AS card_present,
    CASE prio WHEN '1-URGENT' THEN 'manual_keyed' WHEN '2-HIGH' THEN 'chip' WHEN '3-MEDIUM' THEN 'contactless'
      WHEN '4-NOT SPECIFIED' THEN 'swipe' ELSE 'card_on_file' END AS entry_mode,
    pk % 211 = 0 AS not_object
  FROM card_src
),
card_b AS (
  SELECT *,
    CASE WHEN pk % 233 = 0 THEN 'abc' WHEN pk % 7 = 0 THEN sign_text || amount_2dp || '5'
      ELSE sign_text || amount_2dp END AS amount_text,
    CAST(ok % 6 AS INTEGER) AS kafka_partition,
    CAST((ok * 8 + ln) * 1024 + pk % 1024 AS BIGINT) AS kafka_offset,
    card_id AS kafka_key,
    event_time AS bronze_ingest_time
  FROM card_f
),
card_m AS (
  SELECT *,
    CASE WHEN not_object THEN '["' || event_id || '"]' ELSE '{{' || concat_ws(',',
      '"event_id":"' || event_id || '"', '"transaction_id":"' || transaction_id || '"',
      '"authorization_id":"' || authorization_id || '"', '"customer_id":"' || customer_id || '"',
      '"account_id":"' || account_id || '"', '"card_id":"' || card_id || '"',
      '"event_time":"' || event_time || '"', '"amount":"' || amount_text || '"',
      '"currency":"' || currency || '"', '"merchant_id":"' || merchant_id || '"',
      '"merchant_name":"' || merchant_name || '"', '"merchant_category_code":"' || merchant_category_code || '"',
      '"merchant_country":"' || merchant_country || '"', '"merchant_city":"' || merchant_city || '"',
      '"authorization_status":"' || authorization_status || '"', '"channel":"' || channel || '"',
      '"card_present":' || CASE WHEN card_present THEN 'true' ELSE 'false' END,
      '"entry_mode":"' || entry_mode || '"', '"source_system":"synthetic-card-processor"',
      '"schema_version":"1.0.0"') || '}}' END AS raw_value,
    CASE
      WHEN not_object THEN 'parsed_value must be a JSON object'
      WHEN card_id IS NULL THEN 'missing fields: [''card_id'', ''merchant_id'']'
      WHEN merchant_id IS NULL THEN 'missing fields: [''merchant_id'']'
      WHEN merchant_name = '' THEN 'field is null or empty: merchant_name'
      WHEN currency <> 'USD' THEN 'unsupported currency: ' || currency
      WHEN authorization_status NOT IN ('approved', 'declined')
        THEN 'unsupported authorization_status: ' || authorization_status
      WHEN amount_cents IS NULL THEN 'invalid amount: ' || amount_text
    END AS rejection_reason,
    CAST(CASE WHEN amount_cents < 0 THEN '-' ELSE '' END || (abs(amount_cents) // 100) || '.'
      || lpad(CAST(abs(amount_cents) % 100 AS VARCHAR), 2, '0') AS DECIMAL(18,2)) AS amount
  FROM card_b
),
card_silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
      ORDER BY kafka_partition DESC, kafka_offset DESC, raw_value DESC) AS rn
    FROM card_m WHERE rejection_reason IS NULL) WHERE rn = 1
)"""

LOGIN_CTE = f"""
login_f AS (
  SELECT event_id AS eid, user_id AS uid, ts, value AS val,
    'evt_login_' || event_id AS event_id,
    'login_' || event_id AS login_event_id,
    CASE WHEN event_id % 211 <> 0 THEN 'cust_' || user_id END AS customer_id,
    strftime(ts, {ISO}) AS event_time,
    CASE event_type WHEN 'click' THEN 'login_success' WHEN 'error' THEN 'login_failed'
      WHEN 'signup' THEN 'new_device_registered' WHEN 'purchase' THEN 'password_reset' ELSE 'page_view' END
      AS event_type,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS login_status,
    CASE WHEN event_type = 'error' THEN 'invalid_password' END AS failure_reason,
    'dev_' || user_id || '_' || (event_id % 3) AS device_id,
    CASE event_id % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END AS device_type,
    '10.' || (user_id % 256) || '.' || (event_id % 256) || '.' || (event_id % 7 + 1) AS ip_address,
    CASE WHEN value >= 45 THEN 'NL' ELSE 'US' END AS country,
    event_id % 401 = 0 AS not_object
  FROM events
),
login_g AS (
  SELECT *,
    CASE WHEN eid % 223 = 0 THEN '' WHEN country = 'NL' THEN 'Amsterdam' ELSE 'Chicago' END AS city,
    CASE WHEN device_type = 'web' THEN 'web' ELSE 'mobile' END AS channel,
    CASE device_type WHEN 'web' THEN 'Mozilla/5.0' WHEN 'ios' THEN 'BankingApp/5.2 iOS' END AS user_agent,
    'synthetic-digital-banking-platform' AS source_system,
    '1.0.0' AS schema_version,
    CAST(uid % 6 AS INTEGER) AS kafka_partition,
    CAST(eid AS BIGINT) AS kafka_offset,
    customer_id AS kafka_key,
    event_time AS bronze_ingest_time
  FROM login_f
),
login_m AS (
  SELECT *,
    CASE WHEN not_object THEN 'not json {{' || eid ELSE '{{' || concat_ws(',',
      '"event_id":"' || event_id || '"', '"login_event_id":"' || login_event_id || '"',
      '"customer_id":"' || customer_id || '"', '"event_time":"' || event_time || '"',
      '"event_type":"' || event_type || '"', '"login_status":"' || login_status || '"',
      '"failure_reason":"' || failure_reason || '"', '"device_id":"' || device_id || '"',
      '"device_type":"' || device_type || '"', '"ip_address":"' || ip_address || '"',
      '"country":"' || country || '"', '"city":"' || city || '"', '"channel":"' || channel || '"',
      '"user_agent":"' || user_agent || '"', '"source_system":"' || source_system || '"',
      '"schema_version":"' || schema_version || '"') || '}}' END AS raw_value,
    CASE
      WHEN not_object THEN 'parsed_value must be a JSON object'
      WHEN customer_id IS NULL THEN 'missing fields: [''customer_id'']'
      WHEN city = '' THEN 'field is null or empty: city'
      WHEN event_type NOT IN ('login_success', 'login_failed', 'password_reset', 'new_device_registered')
        THEN 'unsupported event_type: ' || event_type
    END AS rejection_reason
  FROM login_g
),
login_silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
      ORDER BY kafka_partition DESC, kafka_offset DESC, raw_value DESC) AS rn
    FROM login_m WHERE rejection_reason IS NULL) WHERE rn = 1
)"""

RISK_CTE = f"""
risk_o AS (
  SELECT o_orderkey AS ok, o_custkey AS ck, o_orderstatus AS st, o_orderdate AS od, 1 AS copy
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, 2
  FROM orders WHERE o_orderkey % 5 = 0
),
risk_f AS (
  SELECT *,
    CAST(CASE WHEN copy = 1 THEN ok % 101 ELSE greatest(ok % 101 - 3, 0) END AS BIGINT) AS risk_score
  FROM risk_o
),
risk_g AS (
  SELECT *,
    'risk_' || ok AS risk_event_id,
    strftime(od, {ISO}) AS event_time,
    'txn_' || ok AS source_transaction_id,
    'cust_' || ck AS customer_id, 'acct_' || ok AS account_id, 'card_' || ck AS card_id,
    CASE WHEN risk_score >= 90 THEN 'high' WHEN risk_score >= 75 THEN 'medium_high'
      WHEN risk_score >= 50 THEN 'medium' ELSE 'low' END AS risk_level,
    CASE WHEN ok % 13 = 0 THEN '' WHEN st = 'P' THEN 'high_value_transaction,pending_order'
      ELSE 'high_value_transaction' END AS rule_flags,
    'Order reviewed by the risk engine.' AS explanation,
    'evt_card_auth_' || ok || '_1' AS source_events,
    ok % 29 = 0 AS not_object,
    CAST(ck % 6 AS INTEGER) AS kafka_partition,
    CAST(ok * 2 + copy AS BIGINT) AS kafka_offset,
    'cust_' || ck AS kafka_key
  FROM risk_f
),
risk_m AS (
  SELECT *,
    CASE risk_level WHEN 'high' THEN 'block_and_review' WHEN 'medium_high' THEN 'step_up_authentication'
      WHEN 'medium' THEN 'manual_review' ELSE 'monitor' END AS recommended_action,
    event_time AS bronze_ingest_time
  FROM risk_g
),
risk_b AS (
  SELECT *,
    CASE WHEN not_object THEN 'null' ELSE '{{' || concat_ws(',',
      '"risk_event_id":"' || risk_event_id || '"', '"event_time":"' || event_time || '"',
      '"source_transaction_id":"' || source_transaction_id || '"', '"customer_id":"' || customer_id || '"',
      '"account_id":"' || account_id || '"', '"card_id":"' || card_id || '"',
      '"risk_score":' || risk_score, '"risk_level":"' || risk_level || '"',
      '"recommended_action":"' || recommended_action || '"',
      '"rule_flags":' || CASE WHEN rule_flags = '' THEN '[]'
        ELSE '["' || replace(rule_flags, ',', '","') || '"]' END,
      '"explanation":"' || explanation || '"',
      '"source_events":["' || source_events || '"]',
      '"source_system":"synthetic-fraud-risk-engine"', '"schema_version":"1.0.0"') || '}}' END AS raw_value
  FROM risk_m
),
risk_ev AS (SELECT * FROM risk_b WHERE NOT not_object)"""

AUDIT_CTE = f"""
audit AS (
  SELECT
    'run_' || o_orderkey AS run_id,
    'job_' || o_orderpriority AS job_name,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 50 = 0 THEN 'failed' ELSE 'success' END AS status,
    '{FIXTURE_DATE}' AS process_date,
    's3://banking-bronze/orders/' AS input_prefix,
    's3://banking-gold/orders/' AS output_prefix,
    CAST(o_custkey % 1000 + 1 AS BIGINT) AS records_read,
    CAST(CASE WHEN o_orderstatus = 'P' AND o_orderkey % 50 = 0 THEN 0
      ELSE o_custkey % 1000 + 1 - CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 7 ELSE 0 END END AS BIGINT)
      AS records_written,
    CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 7 ELSE 0 END AS BIGINT) AS records_rejected,
    strftime(o_orderdate, {ISO}) AS started_at,
    strftime(o_orderdate + to_seconds(o_custkey), {ISO}) AS finished_at,
    CAST(o_custkey AS DOUBLE) AS duration_seconds,
    o_orderdate + to_seconds(o_custkey) AS finished_ts,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 50 = 0 THEN 'No valid records produced.' END AS error_message
  FROM orders
),
latest_health AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY process_date, job_name ORDER BY finished_ts DESC, run_id ASC) AS rn
    FROM audit) WHERE rn = 1
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


SILVER_CARD_COLS = """event_id, transaction_id, authorization_id, customer_id, account_id, card_id, event_time,
  amount, currency, merchant_id, merchant_name, merchant_category_code, merchant_country, merchant_city,
  authorization_status, channel, card_present, entry_mode, 'synthetic-card-processor' AS source_system,
  '1.0.0' AS schema_version, 'banking.transaction.card-authorizations.v1' AS bronze_kafka_topic,
  kafka_partition AS bronze_kafka_partition, kafka_offset AS bronze_kafka_offset, bronze_ingest_time,
  '{d}' AS process_date""".format(d=FIXTURE_DATE)

SILVER_LOGIN_COLS = """event_id, login_event_id, customer_id, event_time, event_type, login_status,
  failure_reason, device_id, device_type, ip_address, country, city, channel, user_agent, source_system,
  schema_version, 'banking.digital-activity.login-events.v1' AS bronze_kafka_topic,
  kafka_partition AS bronze_kafka_partition, kafka_offset AS bronze_kafka_offset, bronze_ingest_time,
  '{d}' AS process_date""".format(d=FIXTURE_DATE)


def _object_key(prefix: str, topic: str) -> str:
    return (f"'{prefix}/ingest_date={FIXTURE_DATE}/{topic}-partition=' || kafka_partition || "
            f"'-offset=' || kafka_offset || '.json'")


def _quarantine(cte: str, src: str, job: str, prefix: str, topic: str) -> str:
    return with_ctes(cte, body=f"""
SELECT '{job}' AS job_name, '{FIXTURE_DATE}' AS process_date, 'banking-bronze' AS source_bucket,
  {_object_key(prefix, topic)} AS source_object_key, rejection_reason, raw_value AS raw_record
FROM {src} WHERE rejection_reason IS NOT NULL""")


def _counts(cte: str, src: str) -> str:
    return with_ctes(cte, body=f"""
SELECT '{FIXTURE_DATE}' AS process_date, count(*) AS records_read,
  count(*) FILTER (WHERE rejection_reason IS NULL) AS records_valid,
  count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS records_rejected,
  count(DISTINCT CASE WHEN rejection_reason IS NULL THEN event_id END) AS records_deduplicated,
  count(*) FILTER (WHERE rejection_reason IS NULL)
    - count(DISTINCT CASE WHEN rejection_reason IS NULL THEN event_id END) AS duplicates
FROM {src}""")


# half-even integer quotient of two non-negative integers
def half_even(num: str, den: str) -> str:
    return (f"(({num}) // ({den}) + CASE WHEN 2 * (({num}) % ({den})) > ({den}) OR "
            f"(2 * (({num}) % ({den})) = ({den}) AND (({num}) // ({den})) % 2 = 1) THEN 1 ELSE 0 END)")


TX_CTE = f"""
tx_g AS (
  SELECT authorization_status, channel, merchant_country, merchant_category_code,
    count(*) AS transaction_count,
    CAST(sum(amount) AS DECIMAL(28,2)) AS total_amount,
    CAST(sum(CAST(amount * 100 AS HUGEINT)) AS HUGEINT) AS total_cents,
    count(*) FILTER (WHERE authorization_status = 'approved') AS approved_count,
    count(*) FILTER (WHERE authorization_status = 'declined') AS declined_count
  FROM card_silver GROUP BY ALL
),
tx AS (
  SELECT authorization_status, channel, merchant_country, merchant_category_code, transaction_count,
    total_amount,
    CAST(CAST(sign(total_cents) * {half_even('abs(total_cents)', 'transaction_count')} AS DECIMAL(38,0)) / 100
      AS DECIMAL(18,2)) AS average_amount,
    approved_count, declined_count, '{FIXTURE_DATE}' AS process_date
  FROM tx_g
)"""

LOGIN_SUMMARY_CTE = """
login_summary AS (
  SELECT customer_id, count(*) AS login_event_count,
    count(*) FILTER (WHERE event_type = 'login_failed') AS failed_login_count,
    count(*) FILTER (WHERE event_type = 'new_device_registered') AS new_device_count,
    count(*) FILTER (WHERE event_type = 'password_reset') AS password_reset_count
  FROM login_silver GROUP BY customer_id
)"""

CASES_CTE = f"""
card_latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT transaction_id, amount AS transaction_amount, merchant_name, merchant_country,
      merchant_category_code, authorization_status,
      row_number() OVER (PARTITION BY transaction_id ORDER BY event_id DESC) AS rn
    FROM card_silver) WHERE rn = 1
),
cases AS (
  SELECT r.risk_event_id, r.customer_id, r.account_id, r.card_id, r.source_transaction_id, r.risk_score,
    r.risk_level, r.recommended_action, r.rule_flags, r.explanation,
    c.transaction_amount, c.merchant_name, c.merchant_country, c.merchant_category_code,
    c.authorization_status,
    CAST(coalesce(l.login_event_count, 0) AS BIGINT) AS login_event_count,
    CAST(coalesce(l.failed_login_count, 0) AS BIGINT) AS failed_login_count,
    CAST(coalesce(l.new_device_count, 0) AS BIGINT) AS new_device_count,
    CAST(coalesce(l.password_reset_count, 0) AS BIGINT) AS password_reset_count,
    r.source_events, '{FIXTURE_DATE}' AS process_date, r.event_time, r.kafka_offset
  FROM risk_ev r
  LEFT JOIN card_latest c ON c.transaction_id = r.source_transaction_id
  LEFT JOIN login_summary l ON l.customer_id = r.customer_id
)"""

def dec1(tenths: str) -> str:
    """Non-negative integer tenths -> DECIMAL(21,1) without float steps."""
    return f"CAST((({tenths}) // 10) || '.' || (({tenths}) % 10) AS DECIMAL(21,1))"


def pct(part: str, whole: str) -> str:
    return (f"CASE WHEN coalesce({whole}, 0) = 0 THEN CAST(0 AS DECIMAL(21,1)) "
            f"ELSE {dec1(half_even(f'CAST({part} AS HUGEINT) * 1000', f'CAST({whole} AS HUGEINT)'))} END")


MON_CTE = f"""
cases_u AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY risk_event_id, customer_id, source_transaction_id
      ORDER BY coalesce(risk_score, 0) DESC, account_id ASC NULLS FIRST, card_id ASC NULLS FIRST,
        risk_level ASC NULLS FIRST, recommended_action ASC NULLS FIRST, explanation ASC NULLS FIRST) AS rn
    FROM cases) WHERE rn = 1
),
m_h AS (
  SELECT count(*) AS jobs, count(*) FILTER (WHERE status = 'success') AS success,
    count(*) FILTER (WHERE coalesce(status, 'unknown') <> 'success') AS failed,
    CAST(coalesce(sum(records_read), 0) AS BIGINT) AS records_read,
    CAST(coalesce(sum(records_written), 0) AS BIGINT) AS records_written,
    CAST(coalesce(sum(records_rejected), 0) AS BIGINT) AS records_rejected
  FROM latest_health
),
m_t AS (
  SELECT count(*) AS groups, CAST(coalesce(sum(transaction_count), 0) AS BIGINT) AS transactions,
    CAST(coalesce(sum(approved_count), 0) AS BIGINT) AS approved,
    CAST(coalesce(sum(declined_count), 0) AS BIGINT) AS declined,
    CAST(coalesce(sum(total_amount), 0) AS DECIMAL(38,2)) AS amount
  FROM tx
),
m_r AS (SELECT count(*) AS raw_cases FROM cases),
m_u AS (
  SELECT count(*) AS cases, CAST(coalesce(max(coalesce(risk_score, 0)), 0) AS BIGINT) AS max_score,
    count(*) FILTER (WHERE merchant_name IS NULL OR merchant_name = '') AS unmatched_merchants,
    count(*) FILTER (WHERE risk_level IN ('medium_high', 'high')) AS high_risk,
    CAST(coalesce(sum(failed_login_count), 0) AS BIGINT) AS failed_logins
  FROM cases_u
),
metrics AS (
  SELECT '{FIXTURE_DATE}' AS process_date, jobs, success, failed, records_read, records_written, records_rejected,
    groups, transactions, approved, declined, amount, cases, raw_cases, max_score, unmatched_merchants,
    high_risk, failed_logins, {pct('declined', 'transactions')} AS decline_rate,
    greatest(raw_cases - cases, 0) AS duplicates
  FROM m_h, m_t, m_r, m_u
),
findings AS (
  SELECT process_date, 1 AS finding_order, '' AS job_name, 'critical' AS severity,
    'missing_pipeline_health' AS rule_id, 'No latest pipeline health records were found.' AS message,
    CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS threshold FROM metrics WHERE jobs = 0
  UNION ALL SELECT process_date, 2, '', 'critical', 'missing_transaction_monitoring',
    'No Gold transaction monitoring records were found.', NULL, NULL FROM metrics WHERE groups = 0
  UNION ALL SELECT process_date, 3, '', 'warning', 'missing_fraud_cases',
    'No Gold fraud case records were found.', NULL, NULL FROM metrics WHERE raw_cases = 0
  UNION ALL SELECT process_date, 4, coalesce(job_name, ''), 'critical', 'pipeline_job_not_successful',
    coalesce(job_name, 'unknown job') || ' finished with status ' || coalesce(status, 'unknown') || '.',
    coalesce(status, 'unknown'), 'success' FROM latest_health WHERE coalesce(status, 'unknown') <> 'success'
  UNION ALL SELECT process_date, 5, '', 'warning', 'rejected_records_present',
    format('{{:,}}', records_rejected) || ' records were rejected in latest pipeline health.',
    CAST(records_rejected AS VARCHAR), '0' FROM metrics WHERE records_rejected > 0
  UNION ALL SELECT process_date, 6, '', 'warning', 'decline_rate_high',
    'Decline rate is ' || CAST(decline_rate AS VARCHAR) || '% for this process date.',
    CAST(decline_rate AS VARCHAR), '20.0' FROM metrics WHERE decline_rate > 20.0
  UNION ALL SELECT process_date, 7, '', 'warning', 'high_fraud_risk_score',
    'Maximum fraud risk score is ' || max_score || '.', CAST(max_score AS VARCHAR), '90'
    FROM metrics WHERE max_score >= 90
  UNION ALL SELECT process_date, 8, '', 'warning', 'duplicate_fraud_cases',
    format('{{:,}}', duplicates) || ' duplicate fraud case rows were detected across repeated runs.',
    CAST(duplicates AS VARCHAR), '0' FROM metrics WHERE duplicates > 0
  UNION ALL SELECT process_date, 9, '', 'warning', 'unmatched_fraud_merchants',
    format('{{:,}}', unmatched_merchants) || ' fraud cases have no matched merchant.',
    CAST(unmatched_merchants AS VARCHAR), '0' FROM metrics WHERE unmatched_merchants > 0
),
f_agg AS (
  SELECT process_date, max(CASE severity WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS rk,
    count(*) AS finding_count, count(*) FILTER (WHERE severity = 'critical') AS critical_count,
    count(*) FILTER (WHERE severity = 'warning') AS warning_count
  FROM findings GROUP BY process_date
),
status AS (
  SELECT m.process_date,
    CASE coalesce(rk, 0) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'healthy' END AS status,
    CAST(coalesce(finding_count, 0) AS BIGINT) AS finding_count,
    CAST(coalesce(critical_count, 0) AS BIGINT) AS critical_count,
    CAST(coalesce(warning_count, 0) AS BIGINT) AS warning_count,
    coalesce(rk, 0) = 2 AS fail_on_critical
  FROM metrics m LEFT JOIN f_agg f ON f.process_date = m.process_date
),
alerts AS (
  SELECT substr(sha256(f.process_date || '|' || f.severity || '|' || f.rule_id || '|' || f.message), 1, 16)
      AS alert_id,
    f.process_date, 'local_file' AS channel, s.status AS monitoring_status, f.severity, f.rule_id, f.message,
    f.value, f.threshold, f.finding_order, f.job_name
  FROM findings f LEFT JOIN status s ON s.process_date = f.process_date
),
summary AS (
  SELECT s.process_date, 'local_file' AS channel, s.status AS monitoring_status,
    CAST(count(a.alert_id) AS BIGINT) AS alert_count,
    CAST(count(a.alert_id) FILTER (WHERE a.severity = 'critical') AS BIGINT) AS critical_count,
    CAST(count(a.alert_id) FILTER (WHERE a.severity = 'warning') AS BIGINT) AS warning_count,
    coalesce(string_agg(a.alert_id, ',' ORDER BY a.finding_order, a.job_name, a.alert_id), '') AS alert_ids
  FROM status s LEFT JOIN alerts a ON a.process_date = s.process_date GROUP BY ALL
)"""

MONEY = "'$' || format('{{:,.2f}}', {x})"

CARD_KEY = _object_key("transaction/card-authorizations", "banking.transaction.card-authorizations.v1")
LOGIN_KEY = _object_key("digital-activity/login-events", "banking.digital-activity.login-events.v1")
RISK_KEY = _object_key("fraud-risk/risk-events", "banking.fraud-risk.risk-events.v1")

VB_CTE = f"""
vb AS (
  SELECT 'banking.transaction.card-authorizations.v1' AS dataset, {CARD_KEY} AS source_object_key,
    CASE WHEN not_object THEN 1 ELSE 0 END AS error_count,
    CASE WHEN not_object THEN 'parsed_value must be a JSON object' END AS errors
  FROM card_m
  UNION ALL
  SELECT 'banking.digital-activity.login-events.v1', {LOGIN_KEY},
    CASE WHEN not_object THEN 1 WHEN customer_id IS NULL THEN 2 ELSE 0 END,
    CASE WHEN not_object THEN 'parsed_value must be a JSON object'
      WHEN customer_id IS NULL
      THEN 'missing event fields: [''customer_id'']; event field is null or empty: customer_id' END
  FROM login_m
  UNION ALL
  SELECT 'banking.fraud-risk.risk-events.v1', {RISK_KEY},
    CASE WHEN not_object THEN 1 ELSE 0 END,
    CASE WHEN not_object THEN 'parsed_value must be a JSON object' END
  FROM risk_b
)"""


def _summary(src: str, failed: str, dataset: str | None = None) -> str:
    ds = f", '{dataset}' AS dataset" if dataset else ""
    return (f"SELECT '{FIXTURE_DATE}' AS process_date, count(*) AS records_checked, "
            f"count(*) FILTER (WHERE {failed}) AS records_failed, CAST(0 AS BIGINT) AS duplicate_keys, "
            f"CASE WHEN count(*) FILTER (WHERE {failed}) = 0 AND count(*) > 0 THEN 'passed' ELSE 'failed' END "
            f"AS status{ds} FROM {src}")


CORE_CTE = """
customers AS (
  SELECT 'cust_' || c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
    split_part(c_name, '#', 2) AS last_name,
    CASE WHEN c_custkey % 250 = 0 THEN 'shared@example.com'
      ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
    DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS date_of_birth,
    'US' AS country_code,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'active' WHEN c_mktsegment = 'FURNITURE' THEN 'inactive'
      WHEN c_mktsegment = 'MACHINERY' THEN 'restricted' WHEN c_custkey % 97 = 0 THEN 'suspended'
      ELSE 'closed' END AS customer_status,
    CAST(DATE '2019-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS TIMESTAMP) AS created_at,
    CASE WHEN c_custkey % 151 <> 0 THEN CAST(DATE '2022-01-01' + CAST(c_custkey % 700 AS INTEGER) AS TIMESTAMP) END AS updated_at
  FROM customer
),
accounts AS (
  SELECT 'acct_' || o_orderkey AS account_id,
    CASE WHEN o_orderkey % 997 = 0 THEN 'cust_missing_' || o_custkey ELSE 'cust_' || o_custkey END AS customer_id,
    lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS account_number, '021000021' AS routing_number,
    CASE WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') THEN 'checking' WHEN o_orderpriority = '2-HIGH'
      THEN 'savings' WHEN o_orderpriority = '3-MEDIUM' THEN 'money_market' ELSE 'brokerage' END AS account_type,
    CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE 'frozen' END AS account_status,
    DATE '2023-01-01' + CAST(o_orderkey % 400 AS INTEGER) AS opened_at,
    CAST(DATE '2023-01-01' + CAST(o_orderkey % 400 AS INTEGER) AS TIMESTAMP) AS created_at,
    CASE WHEN o_orderkey % 1009 <> 0 THEN CAST(DATE '2023-02-01' + CAST(o_orderkey % 400 AS INTEGER) AS TIMESTAMP) END AS updated_at
  FROM orders
),
account_balances AS (
  SELECT 'bal_' || o_orderkey AS balance_id, 'acct_' || o_orderkey AS account_id,
    CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 100 || '.'
      || lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS DECIMAL(18,2))
      AS available_balance,
    CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 100 || '.'
      || lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS DECIMAL(18,2))
      AS current_balance,
    CASE WHEN o_orderkey % 499 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN o_orderkey % 1013 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS balance_as_of,
    CAST(o_orderdate AS TIMESTAMP) AS created_at
  FROM orders
),
customer_risk_profiles AS (
  SELECT 'rp_' || c_custkey AS risk_profile_id, 'cust_' || c_custkey AS customer_id,
    ['pending', 'verified', 'failed', 'expired'][c_nationkey % 4 + 1] AS kyc_status,
    CASE WHEN c_acctbal < 0 THEN 'high' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'low' END AS kyc_risk_rating,
    'clear' AS sanctions_screening_status, false AS pep_flag, c_custkey % 50 = 0 AS fraud_watchlist_flag,
    CAST(((CAST(round(c_acctbal * 100) AS BIGINT) + 100000) // 90) // 100 || '.'
      || lpad(CAST(((CAST(round(c_acctbal * 100) AS BIGINT) + 100000) // 90) % 100 AS VARCHAR), 2, '0')
      AS DECIMAL(5,2)) AS risk_score,
    CASE WHEN c_custkey % 149 <> 0 THEN CAST(DATE '2023-06-01' + CAST(c_custkey % 200 AS INTEGER) AS TIMESTAMP) END AS updated_at
  FROM customer
)"""


def _rule(table: str, name: str, kind: str, cond: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, '{kind}' AS constraint_type, "
            f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violation_count FROM {table}")


def _not_null(table: str, *cols: str) -> list[str]:
    return [_rule(table, f"{c}_not_null", "NOT NULL", f"{c} IS NULL") for c in cols]


def _chk(table: str, name: str, cond: str) -> str:
    return _rule(table, name, "CHECK", f"NOT coalesce({cond}, true)")


def _key(table: str, name: str, kind: str, key: str) -> str:
    return (f"SELECT '{table}', '{name}', '{kind}', CAST(coalesce(sum(n), 0) AS BIGINT) FROM "
            f"(SELECT count(*) AS n FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)")


def _fk(table: str, name: str, fk: str, parent: str, pk: str) -> str:
    return (f"SELECT '{table}', '{name}', 'FOREIGN KEY', CAST(count(*) AS BIGINT) FROM {table} c "
            f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")


CONSTRAINT_SQL = "\nUNION ALL ".join([
    *_not_null("customers", "customer_id", "first_name", "last_name", "email", "date_of_birth", "country_code",
               "customer_status", "created_at", "updated_at"),
    _chk("customers", "customers_status_chk", "customer_status IN ('active', 'inactive', 'closed', 'restricted')"),
    _key("customers", "customers_pkey", "PRIMARY KEY", "customer_id"),
    _key("customers", "customers_email_key", "UNIQUE", "email"),
    *_not_null("accounts", "account_id", "customer_id", "account_number", "routing_number", "account_type",
               "account_status", "opened_at", "created_at", "updated_at"),
    _chk("accounts", "accounts_type_chk", "account_type IN ('checking', 'savings', 'money_market')"),
    _chk("accounts", "accounts_status_chk", "account_status IN ('open', 'closed', 'frozen', 'restricted')"),
    _key("accounts", "accounts_pkey", "PRIMARY KEY", "account_id"),
    _key("accounts", "accounts_account_number_key", "UNIQUE", "account_number"),
    _fk("accounts", "accounts_customer_id_fkey", "customer_id", "customers", "customer_id"),
    *_not_null("account_balances", "balance_id", "account_id", "available_balance", "current_balance",
               "currency", "balance_as_of", "created_at"),
    _chk("account_balances", "account_balances_currency_chk", "currency = 'USD'"),
    _key("account_balances", "account_balances_pkey", "PRIMARY KEY", "balance_id"),
    _fk("account_balances", "account_balances_account_id_fkey", "account_id", "accounts", "account_id"),
    *_not_null("customer_risk_profiles", "risk_profile_id", "customer_id", "kyc_status", "kyc_risk_rating",
               "sanctions_screening_status", "pep_flag", "fraud_watchlist_flag", "risk_score", "updated_at"),
    _chk("customer_risk_profiles", "risk_profiles_kyc_status_chk",
         "kyc_status IN ('pending', 'verified', 'failed', 'expired')"),
    _chk("customer_risk_profiles", "risk_profiles_rating_chk", "kyc_risk_rating IN ('low', 'medium', 'high')"),
    _chk("customer_risk_profiles", "risk_profiles_sanctions_chk",
         "sanctions_screening_status IN ('clear', 'potential_match', 'confirmed_match')"),
    _chk("customer_risk_profiles", "risk_profiles_score_chk", "risk_score >= 0 AND risk_score <= 100"),
    _key("customer_risk_profiles", "customer_risk_profiles_pkey", "PRIMARY KEY", "risk_profile_id"),
    _key("customer_risk_profiles", "customer_risk_profiles_customer_id_key", "UNIQUE", "customer_id"),
    _fk("customer_risk_profiles", "customer_risk_profiles_customer_id_fkey", "customer_id", "customers",
        "customer_id"),
])

SIGNAL_SQL = """
, sig_counts AS (
  SELECT c.event_id,
    count(*) FILTER (WHERE l.event_type = 'login_failed') AS failed_logins,
    count(*) FILTER (WHERE l.event_type = 'password_reset') AS password_resets,
    count(*) FILTER (WHERE l.event_type = 'new_device_registered') AS new_devices,
    count(*) FILTER (WHERE l.country NOT IN ('US', 'UNITED STATES')) AS foreign_logins
  FROM card_silver c JOIN login_silver l ON l.customer_id = c.customer_id
    AND l.ts BETWEEN c.event_ts - INTERVAL 86400 SECOND AND c.event_ts
  GROUP BY c.event_id
),
sig AS (
  SELECT c.event_id, c.transaction_id, c.customer_id,
    CAST(coalesce(s.failed_logins, 0) AS BIGINT) AS failed_logins,
    CAST(coalesce(s.password_resets, 0) AS BIGINT) AS password_resets,
    CAST(coalesce(s.new_devices, 0) AS BIGINT) AS new_devices,
    CAST(coalesce(s.foreign_logins, 0) AS BIGINT) AS foreign_logins,
    coalesce(ac.held, false) AS f8, coalesce(rp.high_kyc, false) AS f9, coalesce(rp.watch, false) AS f10,
    c.merchant_country NOT IN ('US', 'UNITED STATES') AS f11,
    c.merchant_category_code IN ('Brand#11', 'Brand#55') AS f12,
    coalesce(CAST(c.event_ts AS DATE) - ac.opened BETWEEN 0 AND 30, false) AS f13,
    coalesce(s.foreign_logins, 0) >= 1 AS f14,
    c.amount >= 50000.00 AS f1, NOT c.card_present AS f2, c.entry_mode = 'manual_keyed' AS f3,
    coalesce(s.failed_logins, 0) >= 2 AS f4, coalesce(s.password_resets, 0) >= 1 AS f5,
    coalesce(s.new_devices, 0) >= 1 AS f6, coalesce(cu.restricted, false) AS f7
  FROM card_silver c LEFT JOIN sig_counts s ON s.event_id = c.event_id
  LEFT JOIN (SELECT customer_id, bool_or(customer_status = 'restricted') AS restricted
             FROM customers GROUP BY customer_id) cu ON cu.customer_id = c.customer_id
  LEFT JOIN (SELECT customer_id, bool_or(kyc_risk_rating = 'high') AS high_kyc, bool_or(fraud_watchlist_flag) AS watch
             FROM customer_risk_profiles GROUP BY customer_id) rp ON rp.customer_id = c.customer_id
  LEFT JOIN (SELECT account_id, customer_id, bool_or(account_status IN ('restricted', 'frozen')) AS held, max(opened_at) AS opened
             FROM accounts GROUP BY account_id, customer_id) ac ON ac.account_id = c.account_id AND ac.customer_id = c.customer_id
),
scored AS (
  SELECT *, CAST(least(CASE WHEN f1 THEN 20 ELSE 0 END + CASE WHEN f2 THEN 10 ELSE 0 END
      + CASE WHEN f3 THEN 15 ELSE 0 END + CASE WHEN f4 THEN 25 ELSE 0 END + CASE WHEN f5 THEN 15 ELSE 0 END
      + CASE WHEN f6 THEN 15 ELSE 0 END + CASE WHEN f7 THEN 20 ELSE 0 END + CASE WHEN f8 THEN 15 ELSE 0 END
      + CASE WHEN f9 THEN 10 ELSE 0 END + CASE WHEN f10 THEN 20 ELSE 0 END + CASE WHEN f11 THEN 10 ELSE 0 END
      + CASE WHEN f12 THEN 10 ELSE 0 END + CASE WHEN f13 THEN 10 ELSE 0 END + CASE WHEN f14 THEN 10 ELSE 0 END, 100) AS INTEGER) AS signal_score,
    concat_ws(',', CASE WHEN f1 THEN 'high_value_transaction' END, CASE WHEN f2 THEN 'card_not_present' END,
      CASE WHEN f3 THEN 'manual_keyed' END, CASE WHEN f4 THEN 'multiple_failed_logins' END,
      CASE WHEN f5 THEN 'password_reset' END, CASE WHEN f6 THEN 'new_device_registered' END,
      CASE WHEN f7 THEN 'restricted_customer' END, CASE WHEN f8 THEN 'restricted_account' END,
      CASE WHEN f9 THEN 'high_kyc_risk' END, CASE WHEN f10 THEN 'fraud_watchlist' END,
      CASE WHEN f11 THEN 'cross_border' END, CASE WHEN f12 THEN 'high_risk_category' END,
      CASE WHEN f13 THEN 'new_account' END, CASE WHEN f14 THEN 'foreign_login' END) AS rule_flags
  FROM sig
)
SELECT '""" + FIXTURE_DATE + """' AS process_date, event_id, transaction_id, customer_id, failed_logins,
  password_resets, new_devices, foreign_logins, rule_flags, signal_score,
  CASE WHEN signal_score >= 70 THEN 'high' WHEN signal_score >= 50 THEN 'medium_high'
    WHEN signal_score >= 30 THEN 'medium' ELSE 'low' END AS risk_level
FROM scored"""

BRONZE_DOCUMENTS_SQL = f"""
, lacking AS (
  SELECT *, CAST(kafka_offset AS BIGINT) AS n, {LOGIN_KEY} AS source_object_key FROM login_m
),
doc AS (
  SELECT *, list_filter([CASE WHEN customer_id IS NULL THEN 'kafka_key' END, CASE WHEN n % 79 = 0 THEN 'kafka_offset' END,
      CASE WHEN n % 83 = 0 THEN 'kafka_partition' END, CASE WHEN n % 89 = 0 THEN 'kafka_topic' END], lambda x: x IS NOT NULL) AS missing
  FROM lacking
),
found AS (
  SELECT source_object_key, CASE WHEN n % 307 = 0 THEN ['document must be a JSON object'] ELSE list_filter(list_concat(
      [CASE WHEN len(missing) > 0 THEN 'missing Bronze fields: [''' || array_to_string(missing, ''', ''') || ''']' END],
      CASE WHEN not_object OR n % 73 = 0 THEN ['parsed_value must be a JSON object'] ELSE [
        CASE WHEN customer_id IS NULL THEN 'missing event fields: [''customer_id'']' END,
        CASE WHEN customer_id IS NULL THEN 'event field is null or empty: customer_id' END,
        CASE WHEN n % 97 = 0 THEN 'raw_value is null or empty' END,
        CASE WHEN n % 89 = 0 THEN 'kafka_topic is null or empty' END,
        CASE WHEN n % 83 = 0 THEN 'kafka_partition is null' END,
        CASE WHEN n % 79 = 0 THEN 'kafka_offset is null' END] END), lambda x: x IS NOT NULL) END AS errs
  FROM doc
)
SELECT '{FIXTURE_DATE}' AS process_date, source_object_key, CAST(len(errs) AS INTEGER) AS error_count,
  array_to_string(errs, '; ') AS errors
FROM found WHERE len(errs) > 0"""

HEALTH_BAD = "records_read < 0 OR records_written < 0 OR records_rejected < 0 OR duration_seconds < 0"

HEALTH_COLS = """run_id, job_name, status, process_date, records_read, records_written, records_rejected,
  started_at, finished_at, duration_seconds, input_prefix, output_prefix, error_message"""

SQL: dict[str, str] = {
    "bronze_envelope": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, body=f"""
SELECT bronze_ingest_time, 'banking.transaction.card-authorizations.v1' AS kafka_topic, kafka_partition,
  kafka_offset, kafka_key, raw_value, '{FIXTURE_DATE}' AS ingest_date FROM card_m
UNION ALL
SELECT bronze_ingest_time, 'banking.digital-activity.login-events.v1', kafka_partition, kafka_offset,
  kafka_key, raw_value, '{FIXTURE_DATE}' FROM login_m
UNION ALL
SELECT bronze_ingest_time, 'banking.fraud-risk.risk-events.v1', kafka_partition, kafka_offset, kafka_key,
  raw_value, '{FIXTURE_DATE}' FROM risk_b"""),
    "silver_card": with_ctes(CARD_CTE, body=f"SELECT {SILVER_CARD_COLS} FROM card_silver"),
    "silver_card_quarantine": _quarantine(CARD_CTE, "card_m", "silver_card_authorizations",
                                          "transaction/card-authorizations",
                                          "banking.transaction.card-authorizations.v1"),
    "silver_card_counts": _counts(CARD_CTE, "card_m"),
    "silver_login": with_ctes(LOGIN_CTE, body=f"SELECT {SILVER_LOGIN_COLS} FROM login_silver"),
    "silver_login_quarantine": _quarantine(LOGIN_CTE, "login_m", "silver_login_events",
                                           "digital-activity/login-events",
                                           "banking.digital-activity.login-events.v1"),
    "silver_login_counts": _counts(LOGIN_CTE, "login_m"),
    "gold_tx_monitoring": with_ctes(CARD_CTE, TX_CTE, body="SELECT * FROM tx"),
    "login_summary": with_ctes(LOGIN_CTE, LOGIN_SUMMARY_CTE,
                               body=f"SELECT '{FIXTURE_DATE}' AS process_date, * FROM login_summary"),
    "gold_fraud_cases": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE,
                                  body="SELECT * EXCLUDE (event_time, kafka_offset) FROM cases"),
    "unmatched_fraud_cases": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, body="""
SELECT process_date, risk_event_id, customer_id, source_transaction_id, risk_score FROM cases
WHERE merchant_name IS NULL OR merchant_name = ''"""),
    "pipeline_health": with_ctes(AUDIT_CTE, body=f"SELECT {HEALTH_COLS} FROM audit"),
    "pipeline_health_latest": with_ctes(AUDIT_CTE, body="""
SELECT process_date, job_name, run_id, status, records_read, records_written, records_rejected,
  duration_seconds, finished_at FROM latest_health"""),
    "fraud_cases_dedup": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                                   MON_CTE, body="SELECT * EXCLUDE (event_time, kafka_offset) FROM cases_u"),
    "monitoring_metrics": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                                    MON_CTE, body="SELECT * FROM metrics"),
    "monitoring_findings": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                                     MON_CTE, body="SELECT * FROM findings"),
    "monitoring_status": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                                   MON_CTE, body="SELECT * FROM status"),
    "alerts": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                        MON_CTE, body="SELECT * FROM alerts"),
    "alert_summary": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                               MON_CTE, body="SELECT * FROM summary"),
    "dash_channel_amount": with_ctes(CARD_CTE, TX_CTE, body=f"""
SELECT process_date, channel, amount,
  {pct('floor(amount)', 'floor(sum(amount) OVER ())')} AS share_pct
FROM (SELECT process_date, coalesce(channel, 'unknown') AS channel,
        CAST(sum(total_amount) AS DECIMAL(38,2)) AS amount FROM tx GROUP BY ALL)"""),
    "dash_risk_levels": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                                  MON_CTE, body=f"""
SELECT process_date, risk_level, case_count, {pct('case_count', 'sum(case_count) OVER ()')} AS share_pct
FROM (SELECT process_date, coalesce(risk_level, 'unknown') AS risk_level, count(*) AS case_count
      FROM cases_u GROUP BY ALL)"""),
    "dash_approval_mix": with_ctes(CARD_CTE, TX_CTE, body=f"""
, g AS (SELECT process_date, CAST(sum(transaction_count) AS BIGINT) AS transactions,
             CAST(sum(approved_count) AS BIGINT) AS approved, CAST(sum(declined_count) AS BIGINT) AS declined
           FROM tx GROUP BY ALL)
SELECT process_date, 'Approved' AS label, approved AS count, {pct('approved', 'transactions')} AS share_pct FROM g
UNION ALL
SELECT process_date, 'Declined', declined, {pct('declined', 'transactions')} FROM g"""),
    "dash_top_tx": with_ctes(CARD_CTE, TX_CTE, body=f"""
SELECT * FROM (
  SELECT process_date,
    CAST(row_number() OVER (ORDER BY transaction_count DESC, authorization_status, channel, merchant_country,
      merchant_category_code) AS INTEGER) AS rank,
    authorization_status, channel, merchant_country, merchant_category_code, transaction_count, total_amount,
    average_amount, format('{{:,}}', transaction_count) AS count_display,
    {MONEY.format(x='total_amount')} AS total_display, {MONEY.format(x='average_amount')} AS average_display
  FROM tx) WHERE rank <= 10"""),
    "dash_top_fraud": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                                MON_CTE, body="""
SELECT * FROM (
  SELECT process_date,
    CAST(row_number() OVER (ORDER BY coalesce(risk_score, 0) DESC, risk_event_id, customer_id,
      source_transaction_id) AS INTEGER) AS rank,
    risk_event_id, customer_id, risk_score, risk_level, recommended_action, failed_login_count,
    CASE WHEN merchant_name IS NULL OR merchant_name = '' THEN 'Not matched' ELSE merchant_name END
      AS merchant_display
  FROM cases_u) WHERE rank <= 10"""),
    "dash_kpis": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                           MON_CTE, body=f"""
, k AS (
  SELECT m.*, s.status AS ms, s.finding_count AS fc, su.alert_count AS ac, su.monitoring_status AS ast
  FROM metrics m LEFT JOIN status s ON s.process_date = m.process_date
  LEFT JOIN summary su ON su.process_date = m.process_date
)
SELECT process_date, 1 AS kpi_order, 'Pipeline Jobs' AS label, CAST(jobs AS VARCHAR) AS value,
  success || ' success / ' || failed || ' failing' AS note,
  CASE WHEN failed = 0 AND jobs > 0 THEN 'good' ELSE 'warn' END AS tone FROM k
UNION ALL SELECT process_date, 2, 'Records Moved', format('{{:,}}', records_written),
  format('{{:,}}', records_read) || ' read', 'good' FROM k
UNION ALL SELECT process_date, 3, 'Rejected Records', format('{{:,}}', records_rejected), 'latest job health',
  CASE WHEN records_rejected > 0 THEN 'bad' ELSE 'good' END FROM k
UNION ALL SELECT process_date, 4, 'Transactions', format('{{:,}}', transactions),
  {MONEY.format(x='amount')} || ' total amount', 'violet' FROM k
UNION ALL SELECT process_date, 5, 'Declines', format('{{:,}}', declined), format('{{:,}}', approved) || ' approved',
  CASE WHEN declined > 0 THEN 'warn' ELSE 'good' END FROM k
UNION ALL SELECT process_date, 6, 'Fraud Cases', format('{{:,}}', cases),
  high_risk || ' medium-high/high after dedupe', CASE WHEN high_risk > 0 THEN 'bad' ELSE 'good' END FROM k
UNION ALL SELECT process_date, 7, 'Max Risk Score', format('{{:,}}', max_score),
  format('{{:,}}', failed_logins) || ' failed logins', CASE WHEN max_score >= 90 THEN 'bad' ELSE 'warn' END FROM k
UNION ALL SELECT process_date, 8, 'Duplicate Cases', format('{{:,}}', duplicates),
  format('{{:,}}', raw_cases) || ' raw case rows', CASE WHEN duplicates > 0 THEN 'warn' ELSE 'good' END FROM k
UNION ALL SELECT process_date, 9, 'Monitoring Status', coalesce(ms, 'missing'), coalesce(fc, 0) || ' findings',
  CASE WHEN ms IS NULL THEN 'warn' WHEN ms = 'healthy' THEN 'good' WHEN ms = 'critical' THEN 'bad' ELSE 'warn' END
  FROM k
UNION ALL SELECT process_date, 10, 'Alerts Delivered', format('{{:,}}', coalesce(ac, 0)), 'local alert history',
  CASE WHEN ast IS NULL THEN 'warn' WHEN ast = 'healthy' THEN 'good' WHEN ast = 'critical' THEN 'bad' ELSE 'warn' END
  FROM k"""),
    "dash_ops_messages": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE,
                                   MON_CTE, body=f"""
, k AS (
  SELECT *, CASE WHEN failed > 0 OR records_rejected > 0 THEN 'bad'
    WHEN duplicates > 0 OR unmatched_merchants > 0 THEN 'warn' ELSE 'good' END AS severity FROM metrics
)
SELECT process_date, severity, 1 AS message_order,
  CASE WHEN failed > 0 THEN failed || ' pipeline job is not successful.'
    ELSE 'All latest pipeline jobs are successful.' END AS message FROM k
UNION ALL SELECT process_date, severity, 2, CASE WHEN records_rejected > 0
    THEN format('{{:,}}', records_rejected) || ' records were rejected.'
    ELSE 'No rejected records in latest job health.' END FROM k
UNION ALL SELECT process_date, severity, 3,
  format('{{:,}}', duplicates) || ' duplicate fraud case rows detected across repeated runs.'
  FROM k WHERE duplicates > 0
UNION ALL SELECT process_date, severity, 4, format('{{:,}}', unmatched_merchants)
  || ' fraud cases have no matched merchant.' FROM k WHERE unmatched_merchants > 0
UNION ALL SELECT process_date, severity, 5,
  'Decline rate is ' || CAST({pct('declined', 'transactions')} AS VARCHAR) || '% for this partition.'
  FROM k WHERE declined > 0"""),
    "validate_bronze": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, VB_CTE, body=f"""
SELECT '{FIXTURE_DATE}' AS process_date, count(*) AS records_checked,
  count(*) FILTER (WHERE error_count > 0) AS records_failed, CAST(0 AS BIGINT) AS duplicate_keys,
  CASE WHEN count(*) FILTER (WHERE error_count > 0) = 0 THEN 'passed' ELSE 'failed' END AS status, dataset
FROM vb GROUP BY dataset"""),
    "validate_bronze_failures": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, VB_CTE, body=f"""
SELECT '{FIXTURE_DATE}' AS process_date, source_object_key, error_count, errors FROM vb WHERE error_count > 0"""),
    "validate_silver_card": with_ctes(CARD_CTE, body=_summary("card_silver", "amount < 0")),
    "validate_silver_card_failures": with_ctes(CARD_CTE, body=f"""
SELECT '{FIXTURE_DATE}' AS process_date, event_id, 1 AS error_count,
  'invalid amount: ' || CAST(amount AS VARCHAR) AS errors FROM card_silver WHERE amount < 0"""),
    "validate_silver_login": with_ctes(LOGIN_CTE, body=_summary("login_silver", "false")),
    "validate_gold_tx": with_ctes(CARD_CTE, TX_CTE, body=_summary("tx", "total_amount < 0 OR average_amount < 0")),
    "validate_gold_tx_failures": with_ctes(CARD_CTE, TX_CTE, body="""
SELECT process_date, authorization_status, channel, merchant_country, merchant_category_code,
  CAST(total_amount < 0 AS INTEGER) + CAST(average_amount < 0 AS INTEGER) AS error_count,
  concat_ws('; ', CASE WHEN total_amount < 0 THEN 'invalid total_amount: ' || CAST(total_amount AS VARCHAR) END,
    CASE WHEN average_amount < 0 THEN 'invalid average_amount: ' || CAST(average_amount AS VARCHAR) END) AS errors
FROM tx WHERE total_amount < 0 OR average_amount < 0"""),
    "validate_gold_fraud": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE,
                                     body=_summary("cases", "rule_flags = ''")),
    "validate_gold_fraud_failures": with_ctes(CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, body="""
SELECT process_date, risk_event_id, customer_id, source_transaction_id, 1 AS error_count,
  'rule_flags must be a non-empty list' AS errors FROM cases WHERE rule_flags = ''"""),
    "validate_gold_health": with_ctes(AUDIT_CTE, body=_summary("audit", HEALTH_BAD, "pipeline_health")
                                      + "\nUNION ALL\n" + _summary("latest_health", HEALTH_BAD,
                                                                    "pipeline_health_latest")),
    "quarantine_listing": with_ctes(CARD_CTE, LOGIN_CTE, body=f"""
SELECT 'silver_card_authorizations' AS job_name, '{FIXTURE_DATE}' AS process_date, rejection_reason,
  's3://banking-bronze/' || {CARD_KEY} AS source_path FROM card_m WHERE rejection_reason IS NOT NULL
UNION ALL
SELECT 'silver_login_events', '{FIXTURE_DATE}', rejection_reason, 's3://banking-bronze/' || {LOGIN_KEY}
FROM login_m WHERE rejection_reason IS NOT NULL"""),
    "bronze_flatten": with_ctes(CARD_CTE, body="""
SELECT 'banking.transaction.card-authorizations.v1' AS kafka_topic, kafka_partition, kafka_offset,
  bronze_ingest_time,
  CASE WHEN NOT not_object THEN event_id END AS event_id,
  CASE WHEN NOT not_object THEN transaction_id END AS transaction_id,
  CASE WHEN NOT not_object THEN customer_id END AS customer_id,
  CASE WHEN NOT not_object THEN account_id END AS account_id,
  CASE WHEN NOT not_object THEN card_id END AS card_id,
  CASE WHEN NOT not_object THEN event_time END AS event_time,
  CASE WHEN NOT not_object THEN amount_text END AS amount,
  CASE WHEN NOT not_object THEN currency END AS currency,
  CASE WHEN NOT not_object THEN merchant_name END AS merchant_name,
  CASE WHEN NOT not_object THEN merchant_country END AS merchant_country,
  CASE WHEN NOT not_object THEN authorization_status END AS authorization_status,
  CASE WHEN NOT not_object THEN channel END AS channel
FROM card_m"""),
    "core_table_counts": """
SELECT 'customers' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'accounts', count(*) FROM orders
UNION ALL SELECT 'account_balances', count(*) FROM orders
UNION ALL SELECT 'customer_risk_profiles', count(*) FROM customer""",
    "core_constraint_violations": with_ctes(CORE_CTE, body=CONSTRAINT_SQL),
    "cdc_current_state": """
WITH chg AS (
  SELECT 'r' AS op, o_orderkey * 10 AS lsn, o_orderkey AS ok, o_custkey AS ck, o_orderstatus AS status,
    o_totalprice AS tp FROM orders
  UNION ALL SELECT 'u', o_orderkey * 10 + 1, o_orderkey, o_custkey, 'U', o_totalprice FROM orders
    WHERE o_orderkey % 3 = 0
  UNION ALL SELECT 'd', o_orderkey * 10 + 2, o_orderkey, o_custkey, NULL, o_totalprice FROM orders
    WHERE o_orderkey % 7 = 0
),
last AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ok ORDER BY lsn DESC) AS rn FROM chg) WHERE rn = 1
)
SELECT 'ord_' || ok AS order_id, 'cust_' || ck AS customer_id, status,
  CAST(round(tp * 100) AS BIGINT) // 100 || '.' || lpad(CAST(CAST(round(tp * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')
    AS total,
  lsn AS source_lsn, op AS last_op
FROM last WHERE op <> 'd'""",
    "cdc_events_decoded": """
WITH o AS (
  SELECT o_orderkey AS k, CASE WHEN k % 7 = 0 THEN 'd' WHEN k % 3 = 0 THEN 'u' ELSE 'c' END AS op,
    CASE WHEN k % 101 = 0 THEN 'event must be a JSON object' WHEN k % 103 = 0 THEN 'unknown op: x'
      WHEN k % 109 = 0 THEN 'missing source.lsn' WHEN k % 7 <> 0 AND k % 113 = 0 THEN 'missing after'
      WHEN k % 107 = 0 THEN CASE WHEN k % 7 = 0 THEN 'bad value: before.total' ELSE 'bad value: after.total' END END AS problem, *
  FROM orders)
SELECT k AS event_no, problem, CASE WHEN problem IS NULL THEN op END AS op, CASE WHEN problem IS NULL THEN k * 10 END AS lsn,
  CASE WHEN problem IS NULL THEN 'false' END AS snapshot, CASE WHEN problem IS NULL THEN k * 1000 END AS event_ms,
  CASE WHEN problem IS NULL THEN 'ord_' || k END AS order_id, CASE WHEN problem IS NULL THEN 'cust_' || o_custkey END AS customer_id,
  CASE WHEN problem IS NULL THEN CASE WHEN op = 'u' THEN 'U' ELSE o_orderstatus END END AS status,
  CASE WHEN problem IS NULL THEN CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) END AS total,
  CASE WHEN problem IS NULL THEN CAST(o_orderdate AS DATE) END AS order_date, CASE WHEN problem IS NULL THEN k % 2 = 0 END AS gift,
  CASE WHEN problem IS NULL THEN epoch_us(CAST(o_orderdate AS TIMESTAMP)) + k END AS changed_micros,
  CASE WHEN problem IS NULL AND op <> 'c' THEN o_orderstatus END AS status_before
FROM o""",
    "validate_bronze_documents": with_ctes(LOGIN_CTE, body=BRONZE_DOCUMENTS_SQL),
    "fraud_signals": with_ctes(CARD_CTE, LOGIN_CTE, CORE_CTE, body=SIGNAL_SQL),
    "audit_runs": with_ctes(AUDIT_CTE, body="""
SELECT process_date, run_id, job_name, status, records_read, records_written, records_rejected, finished_at,
  status <> 'success' AS is_failure FROM audit"""),
    "health_listing": with_ctes(AUDIT_CTE, body="""
SELECT job_name, status, records_read, records_written, records_rejected, duration_seconds, finished_at,
  status <> 'success' AS is_failure FROM latest_health"""),
    "monitoring_findings_empty_date": with_ctes(
        CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE, MON_CTE, body="""
SELECT * FROM findings
UNION ALL SELECT '2024-02-01', 1, '', 'critical', 'missing_pipeline_health',
  'No latest pipeline health records were found.', NULL, NULL
UNION ALL SELECT '2024-02-01', 2, '', 'critical', 'missing_transaction_monitoring',
  'No Gold transaction monitoring records were found.', NULL, NULL
UNION ALL SELECT '2024-02-01', 3, '', 'warning', 'missing_fraud_cases',
  'No Gold fraud case records were found.', NULL, NULL"""),
    "dash_alerts": with_ctes(
        CARD_CTE, LOGIN_CTE, RISK_CTE, LOGIN_SUMMARY_CTE, CASES_CTE, AUDIT_CTE, TX_CTE, MON_CTE, body="""
SELECT process_date, position, alert_id, severity, rule_id, message FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY process_date ORDER BY finding_order, job_name, alert_id) AS INTEGER)
    AS position FROM alerts) WHERE position <= 8"""),
    "validate_gold_health_failures": with_ctes(AUDIT_CTE, body=f"""
SELECT process_date, run_id, CAST(records_read < 0 AS INTEGER) + CAST(records_written < 0 AS INTEGER)
    + CAST(records_rejected < 0 AS INTEGER) AS error_count,
  concat_ws('; ', CASE WHEN records_read < 0 THEN 'invalid count field records_read: ' || records_read END,
    CASE WHEN records_written < 0 THEN 'invalid count field records_written: ' || records_written END,
    CASE WHEN records_rejected < 0 THEN 'invalid count field records_rejected: ' || records_rejected END) AS errors
FROM audit WHERE {HEALTH_BAD}"""),
    "bronze_sample": with_ctes(CARD_CTE, body=f"""
SELECT 'banking.transaction.card-authorizations.v1' AS kafka_topic, kafka_partition, kafka_offset, raw_value
FROM card_m ORDER BY {CARD_KEY} LIMIT 100"""),
    "quarantine_listing_login": with_ctes(LOGIN_CTE, body=f"""
SELECT 'silver_login_events' AS job_name, '{FIXTURE_DATE}' AS process_date, rejection_reason,
  's3://banking-bronze/' || {LOGIN_KEY} AS source_path FROM login_m WHERE rejection_reason IS NOT NULL"""),
    "cdc_core_state": with_ctes(CORE_CTE, body="\nUNION ALL\n".join(f"""
SELECT '{table}' AS table_name, {key} AS row_key, CASE WHEN n % 3 = 0 THEN '{value}' ELSE {column} END AS updated_value,
  n * 10 + CASE WHEN n % 3 = 0 THEN 1 ELSE 0 END AS source_lsn, CASE WHEN n % 3 = 0 THEN 'u' ELSE 'r' END AS last_op
FROM (SELECT *, CAST(regexp_extract({key}, '([0-9]+)$', 1) AS BIGINT) AS n FROM {table}) WHERE n % 7 <> 0"""
        for table, key, column, value in (
            ("customers", "customer_id", "customer_status", "inactive"),
            ("accounts", "account_id", "account_status", "closed"),
            ("account_balances", "balance_id", "currency", "GBP"),
            ("customer_risk_profiles", "risk_profile_id", "kyc_status", "expired")))),
}
