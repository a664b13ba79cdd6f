"""DuckDB SQL of the queries in ledgerlark.queries_more."""

from __future__ import annotations

from oracles import CONTROL, FEAT, FEAT_B, FINE, HP, ING, MODEL, MTX, SCORED, SIGNAL, STATS, TXN, VOCAB, W, second, with_ctes
from oracles import SQL as BASE
from oracles_checks import EXPLAINED
from oracles_state import _CHECKS

SQL: dict[str, str] = {}

SQL["ingest_plan"] = """
WITH n AS (SELECT event_id AS n FROM events WHERE event_id % 97 = 0),
found AS (SELECT 'f' || n AS path, md5((n - CASE WHEN n % 5 = 0 THEN 97 ELSE 0 END)::VARCHAR) AS sha256 FROM n),
logged AS (SELECT n AS file_id, md5(n::VARCHAR) AS sha256, n % 4 > 1 AS done FROM n WHERE n % 3 <> 1)
SELECT path, sha256, CASE WHEN done THEN 'skip' WHEN path > (SELECT min(g.path) FROM found g WHERE g.sha256 = f.sha256) THEN 'same content'
  WHEN file_id IS NOT NULL THEN 'load again' ELSE 'load' END AS action, file_id
FROM found f LEFT JOIN logged USING (sha256)"""
RAW = ", numbered AS (SELECT *, row_number() OVER (ORDER BY file_id, source_row_number) AS raw_record_id FROM classified)\n"
SQL["correction_targets"] = ING + RAW + """
SELECT event_id AS correction_id, xor(event_id - event_id % 100, 63) AS target_raw_record_id FROM events
WHERE event_id % 23 = 0 AND xor(event_id - event_id % 100, 63) NOT IN (SELECT raw_record_id FROM numbered WHERE validation_status = 'accepted')"""
SQL["load_generated"] = """
SELECT TIMESTAMP '2022-09-01' + to_days((i // 500)::INT) + to_seconds(i % 500 * 172) AS event_time, '001' AS from_bank, printf('A%04d', i % 1000) AS from_account,
  '002' AS to_bank, printf('B%04d', (i + 1) % 1000) AS to_account, (i % 1000 + 1)::DECIMAL(24,6) AS amount_received, 'US Dollar' AS receiving_currency,
  (i % 1000 + 1)::DECIMAL(24,6) AS amount_paid, 'US Dollar' AS payment_currency, 'ACH' AS payment_format, 0 AS is_laundering
FROM range((SELECT count(*) FROM events)) r(i)"""
SQL["model_load"] = with_ctes(TXN, MTX) + """, told AS (
  SELECT *, row_number() OVER (ORDER BY transaction_id) AS id, CASE WHEN transaction_id % 501 = 0 THEN '1.1234567890123'
    WHEN transaction_id % 502 = 0 THEN '100000000000000000000000000' WHEN transaction_id % 503 = 0 THEN '-1' END AS strange FROM mtx)
SELECT id AS transaction_id, date_trunc('minute', transaction_time) AS transaction_time, from_account, to_account, coalesce(strange, amount_paid::VARCHAR) AS amount_paid,
  payment_format, is_laundering, CASE WHEN strange IS NULL THEN 'loaded' ELSE 'amount does not fit' END AS outcome FROM told"""
SQL["contract_amounts"] = """
SELECT event_id, CASE WHEN f IN (3, 9, 13) OR (f IN (1, 2) AND event_id % 3 <> 0) OR (f = 5 AND value::DECIMAL(18,2) <> 0)
  THEN 'invalid_amount_paid' ELSE '' END AS reason_codes FROM (SELECT *, event_id % 14 AS f FROM events)"""
_FIELDS = ("raw_record_id, file_id AS source_file_id, strptime(v[1], '%Y/%m/%d %H:%M') AS event_time, v[2] AS from_bank_code, v[3] AS from_account_code, "
           "v[4] AS to_bank_code, v[5] AS to_account_code, v[6]::DECIMAL(24,6) AS amount_received, v[7] AS receiving_currency, "
           "v[8]::DECIMAL(24,6) AS amount_paid, v[9] AS payment_currency, v[10] AS payment_format, v[11]::INT AS is_laundering, record_hash")
SQL["promote_staged"] = ING + RAW + f"""
SELECT {_FIELDS} FROM (SELECT *, string_split(raw_text, ',') AS v FROM numbered WHERE validation_status = 'accepted')"""
SQL["promote_staged_corrections"] = W + """
SELECT correction_id, target_raw_record_id, date_trunc('minute', event_time) AS event_time, from_bank_code, from_account_code, to_bank_code, to_account_code,
  amount_received, receiving_currency, amount_paid, payment_currency, CASE WHEN correction_id % 9 = 8 THEN payment_format || ', again' ELSE payment_format END
  AS payment_format, is_laundering::INT AS is_laundering
FROM corr WHERE correction_id % 9 IN (0, 5, 7, 8)"""
SQL["model_score_export"] = MODEL + """
SELECT transaction_id, round(review_score, 9) AS review_score, data_split, model_version FROM scored WHERE data_split IN ('validation', 'test')"""
SQL["rounded_control_check"] = """
SELECT unnest(['payment_currency', 'payment_format', 'transaction_hour', 'has_prior_history', 'is_laundering', 'data_split']) AS column_name,
  unnest([0, n, 0, 0, 0, 0]) AS unequal_rows FROM (SELECT count(*) AS n FROM events WHERE event_id % 977 = 1)"""
SQL["queue_score_delta"] = with_ctes(TXN, FINE, FEAT, CONTROL, FEAT_B, STATS, VOCAB, SCORED, second(SCORED, "scored", "numf")) + """
SELECT count(*) AS rows, count(*) FILTER (WHERE d > 1e-9) AS changed, round(max(d), 7) AS largest, round(avg(d), 9) AS mean
FROM (SELECT abs(a.review_score - b.review_score) AS d FROM scored a JOIN scored_b b USING (transaction_id) WHERE a.data_split = 'test')"""
SQL["case_filters"] = EXPLAINED + """, dated AS (SELECT *, transaction_time::DATE AS d FROM cases)
SELECT 'date' AS filter, review_rank, transaction_id FROM dated WHERE d = DATE '2024-01-25'
UNION ALL SELECT 'format', review_rank, transaction_id FROM dated WHERE payment_format = 'Wire'
UNION ALL SELECT 'spike', review_rank, transaction_id FROM dated WHERE amount_spike_rule
UNION ALL SELECT 'search', review_rank, transaction_id FROM dated WHERE concat_ws('|', from_bank, from_account, to_bank, to_account) ILIKE '%c1%'
UNION ALL SELECT 'all', review_rank, transaction_id FROM dated
  WHERE review_rank < 901 AND d = DATE '2024-01-26' AND payment_currency = 'Euro' AND payment_format = 'Cheque'"""
SQL["report_file_checks"] = HP + f""", n AS (SELECT (SELECT sum(core_count) FROM ({BASE["reconcile_rows"]})) AS f, (SELECT count(*) FROM signal) AS t,
  (SELECT count(*) FROM signal WHERE risk_score > 1) AS a)
SELECT unnest(['files_equal_transactions', 'files_equal_transactions', 'sample_within_alerts', 'sample_within_alerts',
               'no_identifier_columns', 'no_identifier_columns']) AS check_name,
  unnest([f = t, true, true, a = 0, true, false]) AS passed, unnest(['faulty', 'sound', 'sound', 'faulty', 'sound', 'faulty']) AS export FROM n"""
SQL["report_file_measures"] = f"""
SELECT count(*) AS files, sum(manifest_total)::BIGINT AS source_rows, sum(manifest_accepted)::BIGINT AS accepted_rows, sum(manifest_rejected)::BIGINT AS rejected_rows,
  sum(manifest_duplicate_candidates)::BIGINT AS duplicate_candidates, sum(core_count)::BIGINT AS published_rows FROM ({BASE["reconcile_rows"]})"""
SQL["profile_schema"] = """
SELECT * FROM (VALUES (1, 'transaction_id', 'bigint'), (2, 'transaction_time', 'timestamp_ntz'), (3, 'from_bank', 'string'), (4, 'from_account', 'string'),
  (5, 'to_bank', 'string'), (6, 'to_account', 'string'), (7, 'amount_received', 'decimal(38,12)'), (8, 'receiving_currency', 'string'),
  (9, 'amount_paid', 'decimal(38,12)'), (10, 'payment_currency', 'string'), (11, 'payment_format', 'string'), (12, 'is_laundering', 'smallint'),
  (NULL, 'amount', 'amount_paid'), (NULL, 'label', 'is_laundering'), (NULL, 'bank', 'from_bank'), (NULL, 'none', NULL)) t(position, column_name, data_type)"""
SQL["profile_first_rows"] = with_ctes(TXN, MTX) + "SELECT transaction_id, amount_paid, payment_format FROM mtx ORDER BY transaction_id LIMIT 25"

SQL["pipeline_state"] = ING + RAW + """, acc AS (
  SELECT raw_record_id, file_id, strptime(v[1], '%Y/%m/%d %H:%M') AS event_time, v[2] AS from_bank, v[3] AS from_account, v[4] AS to_bank, v[5] AS to_account,
    v[8]::DECIMAL(24,6) AS amount_paid, v[9] AS payment_currency, v[10] AS payment_format, v[11]::INT AS is_laundering
  FROM (SELECT *, string_split(raw_text, ',') AS v FROM numbered WHERE validation_status = 'accepted')),""" + SIGNAL.replace("FROM txn t", "FROM acc t") + """,
n AS (SELECT count(*) AS accepted, (count(*) + 1) // 2 AS half, max(raw_record_id) AS last FROM acc),
mid AS (SELECT raw_record_id AS m FROM acc, n QUALIFY row_number() OVER (ORDER BY raw_record_id) = any_value(half) OVER ()),
per_file AS (SELECT file_id, count(*) AS t, count(*) FILTER (WHERE validation_status = 'accepted') AS a, count(*) FILTER (WHERE validation_status = 'rejected') AS r,
  count(*) FILTER (WHERE validation_status = 'duplicate_candidate') AS d FROM numbered GROUP BY file_id)
SELECT 'load' AS section, (file_id - 1)::VARCHAR AS key, file_id || ' completed' AS value FROM per_file
UNION ALL SELECT 'load', count(*)::VARCHAR, '1 skipped' FROM per_file
UNION ALL SELECT 'run', '0', '1 ' || half || ' ' || half || ' ' || m FROM n, mid
UNION ALL SELECT 'run', '1', '2 ' || (accepted - half) || ' ' || (accepted - half) || ' ' || last FROM n
UNION ALL SELECT 'run', '2', 'skipped'
UNION ALL SELECT 'publication', '1', count(DISTINCT event_date) || ' ' || (SELECT count(*) FROM per_file) || ' ' || count(*) || ' ' ||
  count(DISTINCT (event_date, from_bank, payment_currency, payment_format)) FROM signal
UNION ALL SELECT 'publication', 'again', 'skipped'
UNION ALL SELECT 'manifest', file_id::VARCHAR, concat_ws(' ', t, a, r, d) FROM per_file
UNION ALL SELECT 'mart', event_date::VARCHAR, concat_ws(' ', count(*), sum(amount_paid)::DECIMAL(38,6), count(*) FILTER (WHERE risk_score > 1)) FROM signal GROUP BY event_date
UNION ALL SELECT 'health', 'PUBLISHED', concat_ws(' ', count(*), sum(t), sum(a), sum(a), 0, 0, 1) FROM per_file
UNION ALL SELECT 'verify', unnest([""" + ", ".join(f"'{c}'" for c in _CHECKS) + """]), 'true'"""
