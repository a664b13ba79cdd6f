"""DuckDB SQL of the queries in ledgerlark.queries_state."""

from __future__ import annotations

from oracles import ING, TXN, WORLD, with_ctes
from oracles import SQL as BASE

SQL: dict[str, str] = {}

SNAP = with_ctes(TXN, """
core AS (SELECT raw_record_id, file_id, event_time, payment_currency, amount_paid FROM txn)""", """
other AS (SELECT * REPLACE (CAST(amount_paid + CASE WHEN raw_record_id % 5000 = 17 THEN 0.01 ELSE 0 END AS DECIMAL(24,6)) AS amount_paid)
          FROM core WHERE raw_record_id % 5000 <> 33 UNION ALL SELECT * FROM core WHERE raw_record_id % 5000 = 51)""", """
days AS (SELECT DISTINCT CAST(event_time AS DATE) AS d, payment_currency FROM core)""", """
gone AS (SELECT * FROM core EXCEPT ALL SELECT * FROM other)""", """
come AS (SELECT * FROM other EXCEPT ALL SELECT * FROM core)""")
SQL["snapshot_compare"] = SNAP + """
SELECT 'core' AS table_name, (SELECT count(*) FROM core) AS rows_first, (SELECT count(*) FROM other) AS rows_second,
  (SELECT count(*) FROM gone) AS only_first, (SELECT count(*) FROM come) AS only_second, false AS is_equal
UNION ALL SELECT 'daily', count(*), count(*), 0, 0, true FROM days
UNION ALL SELECT 'files', count(DISTINCT file_id), 0, count(DISTINCT file_id), 0, false FROM core"""
SQL["snapshot_differences"] = SNAP + """
SELECT raw_record_id, amount_paid, 'first' AS side, count(*) AS times FROM gone GROUP BY ALL
UNION ALL SELECT raw_record_id, amount_paid, 'second', count(*) FROM come GROUP BY ALL"""

RUNS = with_ctes(TXN, WORLD, """
runs AS (SELECT event_id AS a, event_id + CASE WHEN event_id % 5000 < 2500 THEN 40 ELSE 0 END AS b, event_id + 60 AS c
         FROM events WHERE event_id % 2500 IN (100, 130))""", """
new_staged AS (SELECT * FROM stg WHERE EXISTS (SELECT 1 FROM runs WHERE raw_record_id > a AND raw_record_id <= b))""", """
new_corr AS (SELECT * FROM corr WHERE EXISTS (SELECT 1 FROM runs WHERE correction_id > a AND correction_id <= c))""", """
corrected AS (SELECT DISTINCT target_raw_record_id AS t FROM new_corr)""")
SQL["publish_affected_days"] = RUNS + """
SELECT CAST(event_time AS DATE) AS event_date FROM new_staged
UNION SELECT CAST(event_time AS DATE) FROM new_corr
UNION SELECT CAST(event_time AS DATE) FROM stg JOIN corrected ON t = raw_record_id
UNION SELECT CAST(event_time AS DATE) FROM corr JOIN corrected ON t = target_raw_record_id"""
SQL["publish_affected_files"] = RUNS + """
SELECT file_id FROM txn WHERE event_id = 3
UNION SELECT source_file_id FROM new_staged UNION SELECT source_file_id FROM stg JOIN corrected ON t = raw_record_id"""
SQL["publish_covered_rows"] = RUNS + """
SELECT 'raw' AS kind, raw_record_id AS id FROM new_staged UNION ALL SELECT 'correction', correction_id FROM new_corr"""

SQL["publish_unready"] = with_ctes(TXN, WORLD) + """
SELECT * FROM (
  SELECT 'unpromoted source rows' AS gate, count(*) AS n FROM stg
  WHERE raw_record_id % 3 <> 0 AND raw_record_id > (SELECT max(raw_record_id) FROM stg) - 50
  UNION ALL SELECT 'unpromoted corrections', count(*) FROM corr WHERE correction_id > (SELECT max(correction_id) FROM corr) - 99
  UNION ALL SELECT 'source files still loading', count(DISTINCT source_file_id) FROM stg WHERE source_file_id = 3)
WHERE n > 0"""
_AMOUNT_OFF = "raw_staging_delta <> 0 OR effective_core_delta <> 0"
SQL["publish_gate_failures"] = f"""
SELECT DISTINCT 'row reconciliation failed' AS gate, file_id FROM ({BASE["reconcile_rows"]}) WHERE NOT coalesce(is_balanced, false)
UNION ALL SELECT DISTINCT 'amount reconciliation failed', file_id FROM ({BASE["reconcile_amounts"]}) WHERE {_AMOUNT_OFF}
UNION ALL SELECT 'rejected-row fraction exceeds quality policy', file_id FROM ({BASE["quality_gate"]})
WHERE file_id < 3 AND NOT passes_quality_policy"""

# --- health ---------------------------------------------------------------------------------------
_STATES = ("PUBLISHED", "FAILED FILES", "LOADING", "PUBLICATION FAILED", "PROMOTION FAILED", "AWAITING PROMOTION",
           "AWAITING PUBLICATION", "NO PUBLICATION", "NO DATA")
SQL["pipeline_health"] = f"""
WITH e AS (SELECT event_id AS n, event_id % 9 AS p, event_id // 9 % 40 AS f, ts FROM events),
newest AS (SELECT p, f, max(n) AS n FROM e WHERE p < 8 GROUP BY ALL),
files AS (
  SELECT p, count(*) AS files, sum(f + 10) AS total_rows, sum(f + 9) AS accepted_rows, count(*) AS rejected_rows,
    count(*) FILTER (WHERE p = 1 AND f = 3) AS failed, max_by(f, n) AS last_f, max(n) AS last_n FROM newest GROUP BY p),
started AS (SELECT p, f, max(n) AS n FROM e WHERE p < 8 GROUP BY ALL),
runs AS (SELECT p, max(n) AS n, max_by(ts, n) AS ts FROM e WHERE p < 7 AND n % 90 < 9 GROUP BY p),
pubs AS (SELECT p, max(n) AS n FROM e WHERE p < 7 AND n % 900 < 9 GROUP BY p),
spine AS (SELECT p, count(*) FILTER (WHERE p = 5 AND n % 10 = 0) AS pr, count(*) FILTER (WHERE p = 5 AND n % 100 = 0) AS pc,
  count(*) FILTER (WHERE p < 7) AS rows, count(*) FILTER (WHERE p < 7 AND n % 1000 = 0) AS uneven FROM e GROUP BY p)
SELECT s.p AS pipeline, ({list(_STATES)!r})[s.p + 1] AS status, last_f AS latest_file_id,
  CASE WHEN s.p = 7 THEN 'skipped' WHEN s.p = 1 AND last_f = 3 THEN 'failed' WHEN s.p = 2 AND last_f = 4 THEN 'started'
       WHEN s.p < 8 THEN 'completed' END AS latest_file_status,
  CASE WHEN s.p < 7 AND NOT (s.p = 1 AND last_f = 3) AND NOT (s.p = 2 AND last_f = 4) THEN round(5 / 1e9, 6) END AS latest_file_ingestion_seconds,
  coalesce(files, 0) AS files, coalesce(total_rows, 0)::BIGINT AS total_rows, coalesce(accepted_rows, 0)::BIGINT AS accepted_rows,
  coalesce(rejected_rows, 0) AS rejected_rows, 0 AS duplicate_candidates, rows AS published_rows, uneven AS imbalanced_files,
  pubs.n AS publication_id, round((4 * 10::BIGINT ** 12 - (pubs.n + 2 * 10::BIGINT ** 12)) / 1e9, 6) AS publication_age_seconds,
  pr AS pending_source_rows, pc AS pending_corrections, coalesce(failed, 0) AS failed_source_files, 0 AS failed_correction_files,
  runs.n AS last_promotion_run_id, runs.n AS last_raw_record_id, runs.n // 2 AS last_correction_id, runs.ts AS max_event_time,
  CASE WHEN s.p = 3 THEN (pubs.n + 3 * 10::BIGINT ** 12)::BIGINT END AS last_publication_failure,
  CASE WHEN s.p = 4 THEN (runs.n + 3 * 10::BIGINT ** 12)::BIGINT END AS last_promotion_failure
FROM spine s LEFT JOIN files USING (p) LEFT JOIN runs USING (p) LEFT JOIN pubs USING (p)"""

_CHECKS = ("minimum_source_rows", "all_files_completed", "manifest_arithmetic", "manifest_to_raw", "accepted_to_staging", "staging_to_core",
           "core_to_risk", "core_to_mart", "row_reconciliation", "amount_reconciliation", "no_pending_accepted_rows", "publication_caught_up")
_BROKEN = {"all_files_completed": "1", "accepted_to_staging": "a", "core_to_risk": "b", "amount_reconciliation": "b",
           "no_pending_accepted_rows": "1", "publication_caught_up": "1"}
SQL["run_verification"] = ING + """,
lost AS (SELECT count(*) AS n, count(*) FILTER (WHERE validation_status = 'accepted' AND record_hash LIKE '0%') AS a,
  count(*) FILTER (WHERE validation_status = 'accepted' AND record_hash LIKE '00%') AS b FROM classified)
""" + "\nUNION ALL ".join(
    [f"SELECT 'sound' AS run, '{c}' AS check_name, {'n >= 100' if c == _CHECKS[0] else 'true'} AS passed FROM lost" for c in _CHECKS]
    + [f"SELECT 'faulty', '{c}', {'n >= 100' if c == _CHECKS[0] else _BROKEN.get(c, '0') + ' = 0'} FROM lost" for c in _CHECKS])
