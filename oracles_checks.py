"""DuckDB SQL of the queries in ledgerlark.queries_checks."""

from __future__ import annotations

from oracles import _CHECKS, CASES, CATS, FEAT, FINE, FIXED_W, HP, MODEL, MTX, NUMS, SCORED, STATS, TXN, VOCAB, WP, W, with_ctes
from oracles import SQL as BASE

SQL: dict[str, str] = {}

# --- explanations ------------------------------------------------------------------------------
SPIKY = MTX.replace("CAST(amount_paid AS DECIMAL(38,12)) AS amount_paid",
                    "CAST(amount_paid * CASE WHEN event_id % 211 = 0 THEN 50 ELSE 1 END AS DECIMAL(38,12)) AS amount_paid")
_TERM = {c: f"(n.{c} - s.{c}__mean) / s.{c}__scale * ({w})" for c, w in zip(NUMS, FIXED_W)}
_GROUPS = [(c, [c]) for c in NUMS[:7]] + [("Time of day", ["hour_sin", "hour_cos"]), ("Day of week", ["weekday_sin", "weekday_cos"])]
_EFFECTS = [f"SELECT review_rank, {i} AS place, '{g}' AS name, CAST({' + '.join(_TERM[m] for m in members)} AS DECIMAL(18,9)) AS effect FROM joined n CROSS JOIN stats s"
            for i, (g, members) in enumerate(_GROUPS)]
_EFFECTS += [f"SELECT n.review_rank, {20 + i}, '{c}', CAST(coalesce({sign} * 0.05 * (v.category_index + 1), 0) AS DECIMAL(18,9)) FROM joined n "
             f"LEFT JOIN vocab v ON v.column_name = '{c}' AND v.value = coalesce(n.{c}, 'UNKNOWN')" for i, (c, sign) in enumerate(CATS)]
_AMOUNT = """format('{:,}', CAST(floor(amount) AS BIGINT)) ||
  CASE WHEN regexp_extract(CAST(amount AS VARCHAR), '\\.(\\d*?)0*$', 1) = '' THEN '' ELSE '.' || regexp_extract(CAST(amount AS VARCHAR), '\\.(\\d*?)0*$', 1) END"""
EXPLAINED = with_ctes(TXN, SPIKY, FEAT, STATS, VOCAB, SCORED) + CASES + """,
joined AS (SELECT n.*, c.review_rank, f.transaction_hour AS h, f.transaction_weekday AS d, f.amount_paid AS amount,
  f.prior_transaction_count AS earlier, f.prior_average_amount AS average
  FROM cases c JOIN numf n USING (transaction_id) JOIN feat f USING (transaction_id)),
effects AS (""" + "\nUNION ALL ".join(_EFFECTS) + """),
ordered AS (SELECT *, row_number() OVER (PARTITION BY review_rank ORDER BY effect DESC, place) AS slot FROM effects WHERE effect > 0),
told AS (SELECT review_rank, slot, effect, CASE o.name
  WHEN 'log_amount_paid' THEN 'Payment amount: ' || """ + _AMOUNT + """ || ' ' || payment_currency
  WHEN 'log_prior_transaction_count' THEN 'Earlier sender payments: ' || CAST(earlier AS BIGINT)
  WHEN 'log_prior_average_amount' THEN 'Earlier average payment: ' || regexp_extract(payment_currency, '[^ ]+$')
  WHEN 'log_amount_to_prior_average' THEN CASE WHEN average > 0 THEN 'Amount versus earlier average: ' || format('{:,.1f}', amount / average) || 'x'
    ELSE 'No earlier average payment available' END
  WHEN 'same_bank' THEN 'Same bank: ' || CASE WHEN same_bank = 1 THEN 'yes' ELSE 'no' END
  WHEN 'self_transfer' THEN 'Same sender and receiver: ' || CASE WHEN self_transfer = 1 THEN 'yes' ELSE 'no' END
  WHEN 'has_prior_history' THEN 'Earlier sender history: ' || CASE WHEN has_prior_history = 1 THEN 'yes' ELSE 'no' END
  WHEN 'Time of day' THEN printf('Time of day: %02d:00 hour', h)
  WHEN 'Day of week' THEN 'Day of week: ' || (['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'])[d]
  WHEN 'payment_currency' THEN 'Payment currency: ' || payment_currency
  WHEN 'receiving_currency' THEN 'Receiving currency: ' || receiving_currency
  ELSE 'Payment format: ' || payment_format END AS reason
  FROM ordered o JOIN joined USING (review_rank) WHERE slot <= 3),
wide AS (SELECT review_rank, """ + ", ".join(
    f"coalesce(max(reason) FILTER (slot = {i}), '') AS reason_{i}, coalesce(max(effect) FILTER (slot = {i}), 0)::DOUBLE AS reason_{i}_effect" for i in (1, 2, 3)) + """,
  string_agg(reason, ' / ' ORDER BY slot) AS reasons FROM told GROUP BY review_rank),
shown AS (SELECT c.*, w.* EXCLUDE (review_rank), CASE WHEN amount_spike_rule THEN 'Amount at least 10x earlier average after 5+ earlier payments' ELSE '' END AS rule_reason,
  CASE WHEN prior_average_amount > 0 THEN f.amount_paid / prior_average_amount END AS ratio
  FROM cases c LEFT JOIN wide w USING (review_rank) JOIN (SELECT transaction_id, amount_paid FROM feat) f USING (transaction_id))
"""
SQL["case_explanations"] = EXPLAINED + """SELECT review_rank, transaction_id, coalesce(reason_1, '') AS reason_1, coalesce(reason_1_effect, 0) AS reason_1_effect,
  coalesce(reason_2, '') AS reason_2, coalesce(reason_2_effect, 0) AS reason_2_effect, coalesce(reason_3, '') AS reason_3,
  coalesce(reason_3_effect, 0) AS reason_3_effect, amount_spike_rule, rule_reason, true AS reconstructed FROM shown"""
SQL["case_export"] = EXPLAINED + """SELECT review_rank, transaction_id, round(review_score, 9) AS review_score, CAST(transaction_time AS VARCHAR) AS transaction_time,
  round(amount_paid::DOUBLE, 9) AS amount_paid, CAST(prior_transaction_count AS BIGINT) AS prior_transaction_count, amount_spike_rule,
  round(ratio, 9) AS amount_to_earlier_average, coalesce(reasons, '') AS model_reasons, rule_reason FROM shown"""

# --- lineage and integrity --------------------------------------------------------------------------
SQL["evaluate_lineage"] = with_ctes(TXN, MTX, FEAT) + """, n AS (SELECT count(*) AS n FROM feat WHERE data_split = 'test'),
worlds AS (SELECT * FROM (VALUES ('same', 0, true, true), ('changed', 0, false, true), ('lost', -1, false, true), ('doubled', 1, false, true),
  ('feature', 0, true, false)) v(world, more, s, f))
SELECT 'scores' AS artifact, n + more AS rows, s AS matches, world FROM worlds CROSS JOIN n
UNION ALL SELECT 'features', n, f, world FROM worlds CROSS JOIN n"""
FAULTS = MODEL + """, plain AS (SELECT transaction_id AS id, data_split AS split FROM scored WHERE data_split <> 'train'),
given AS (SELECT id, CASE WHEN id % 1000 = 3 THEN 'validation' ELSE split END AS split FROM plain WHERE id % 1000 <> 5
  UNION ALL SELECT id, split FROM plain WHERE id % 1000 = 7 UNION ALL SELECT -id - 1, split FROM plain WHERE id % 1000 = 9)
"""
SQL["model_binding_faults"] = FAULTS + """SELECT (SELECT count(*) FROM (SELECT id FROM given GROUP BY id HAVING count(*) > 1)) AS duplicate_score_ids,
  (SELECT count(*) FROM plain WHERE id NOT IN (SELECT id FROM given)) AS missing_scores,
  (SELECT count(*) FROM given g JOIN plain p USING (id) WHERE g.split <> p.split) AS split_mismatches"""
SQL["model_score_faults"] = FAULTS + """SELECT (SELECT count(*) FROM mtx) - (SELECT count(*) FROM given) AS row_count_difference,
  (SELECT count(*) FROM given WHERE id NOT IN (SELECT transaction_id FROM mtx)) AS unmatched_scores"""
SQL["precision_loss_fine"] = BASE["precision_loss"].replace(MTX, FINE)

_HOLES = {"from_bank": "CASE WHEN transaction_id % 101 = 1 THEN ' ' ELSE from_bank END",
          "to_account": "CASE WHEN transaction_id % 103 = 1 THEN '' ELSE to_account END",
          "payment_format": "CASE WHEN transaction_id % 107 = 1 THEN '  ' ELSE payment_format END"}
_HOLES |= {c: f"CASE WHEN transaction_id % {m} <> 1 THEN {c} END" for c, m in (
    ("transaction_time", 109), ("to_bank", 113), ("amount_paid", 127), ("payment_currency", 131), ("is_laundering", 137))}
SQL["investigate_missingness_holes"] = with_ctes(TXN, MTX) + ", holed AS (SELECT * REPLACE (" + ", ".join(
    f"{v} AS {c}" for c, v in _HOLES.items()) + ") FROM mtx)\nSELECT " + ", ".join(
    f"count(*) FILTER (WHERE {v}) AS {k}" for k, v in _CHECKS.items()) + " FROM holed"

# --- checks with faults --------------------------------------------------------------------------------
SQL["promote_orphan_faults"] = W + """
SELECT correction_id, target_raw_record_id FROM corr
WHERE target_raw_record_id NOT IN (SELECT source_raw_record_id FROM fact WHERE source_raw_record_id % 7 <> 0)"""
SQL["publish_currency_faults"] = WP + """
SELECT coalesce(c.payment_currency, m.payment_currency) AS payment_currency, core_paid, coalesce(mart_paid, 0) AS mart_paid, core_rows,
  coalesce(mart_rows, 0) AS mart_rows, core_paid - coalesce(mart_paid, 0) AS amount_delta
FROM (SELECT payment_currency, sum(amount_paid) AS core_paid, count(*) AS core_rows FROM factcur GROUP BY 1) c
LEFT JOIN (SELECT payment_currency, sum(amount_paid * times) AS mart_paid, sum(times)::BIGINT AS mart_rows FROM (
    SELECT *, CASE WHEN event_date = (SELECT min(event_date) FROM signal WHERE payment_currency <> 'Euro') THEN 2 ELSE 1 END AS times
    FROM signal WHERE payment_currency <> 'Euro') GROUP BY 1) m USING (payment_currency)"""
_N = "SELECT '{}' AS check_name, ({}) AS failures"
SQL["data_check_faults"] = WP + """, r AS (SELECT *, source_raw_record_id % 2000 AS r FROM factcur),
b AS (SELECT bank_key, bank_code FROM banks WHERE bank_key <> 2 UNION ALL SELECT bank_key, bank_code FROM banks WHERE bank_key = 1),
grain AS (SELECT event_date, from_bank, payment_currency, payment_format, count(*) AS n FROM signal GROUP BY ALL),
ends AS (SELECT max(event_date) AS d FROM signal)
""" + "\nUNION ALL ".join(_N.format(*x) for x in (
    ("fact_unique_source", "SELECT count(*) FROM r WHERE r = 7"), ("bank_code_unique", "SELECT count(*) FROM banks WHERE bank_key = 1"),
    ("mart_unique_grain", "SELECT 0"), ("fact_from_account_not_null", "SELECT count(*) FROM r WHERE r = 3"), ("signal_date_not_null", "SELECT 0"),
    ("signal_score_accepted", "SELECT count(*) FROM r WHERE r = 13"), ("mart_count_positive", "SELECT count(*) FROM grain WHERE payment_format = 'Cash'"),
    ("fact_from_account_fk", "SELECT 0"), ("fact_to_account_fk", "SELECT count(*) FROM r WHERE r = 5"),
    ("account_bank_fk", "SELECT count(*) FROM accts WHERE bank_key = 2"), ("signal_transaction_fk", "SELECT count(*) FROM r WHERE r = 17"),
    ("daily_count_matches_core", "SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM r WHERE payment_format = 'Cash'"),
    ("risk_covers_core", "SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM r WHERE r = 11"),
    ("risk_evaluation_reconciles", "SELECT count(*) FROM (SELECT DISTINCT event_date, payment_currency FROM signal, ends WHERE event_date = d OR day(event_date) = 2)")))

# --- snapshot document and star --------------------------------------------------------------------------
_PLAIN = "regexp_replace(regexp_replace(CAST({0} AS VARCHAR), '(\\.\\d*?)0+$', '\\1'), '\\.$', '')"
SQL["report_snapshot_header"] = f"""SELECT 'pipeline_export' AS kind, 1 AS publication_id, t.*, q.*, 300 AS daily_rows_limit, 50 AS risk_alerts_limit
FROM ({BASE["report_totals"]}) t CROSS JOIN ({BASE["report_quality_rollup"]}) q"""
SQL["report_snapshot_daily"] = f"""SELECT CAST(event_date AS VARCHAR) AS event_date, from_bank, payment_currency, payment_format, transaction_count,
  {_PLAIN.format("paid_amount")} AS paid_amount, labelled_laundering_count, risk_alert_count FROM ({BASE["report_daily_export"]})"""
SQL["report_snapshot_alerts"] = f"""SELECT * REPLACE (strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time)
FROM (SELECT * EXCLUDE (amount_paid) FROM ({BASE["report_alert_export"]}))"""
SQL["report_star_dimensions"] = HP + """, span AS (SELECT unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY))::DATE AS d FROM mart)
SELECT 'date' AS dimension, CAST(d AS VARCHAR) AS key FROM span
UNION ALL SELECT DISTINCT 'currency', payment_currency FROM mart UNION ALL SELECT DISTINCT 'format', payment_format FROM mart
UNION ALL SELECT DISTINCT 'file', CAST(file_id AS VARCHAR) FROM txn
UNION ALL SELECT 'rule', unnest(['High amount', 'High hourly velocity', 'Repeated counterparty'])"""
SQL["report_star_checks"] = HP + """, n AS (SELECT (max(event_date) - min(event_date)) + 1 AS days, count(DISTINCT payment_currency) AS cur,
  count(DISTINCT payment_format) AS fmt, (SELECT count(DISTINCT file_id) FROM txn) AS files,
  count(*) FILTER (WHERE event_date = (SELECT min(event_date) FROM dh)) AS first_rows, count(*) FILTER (WHERE day(event_date) = 3) AS third FROM dh)
SELECT unnest(['daily.date', 'daily.currency', 'daily.format', 'quality.file', 'faulty.date', 'faulty.currency', 'faulty.format']) AS relation,
  unnest([days, cur, fmt, files, days - 1, cur + 1, fmt]) AS dimension_rows, unnest([0, 0, 0, 0, 0, 1, 0]) AS repeated_keys,
  unnest([0, 0, 0, 0, first_rows, 0, third]) AS orphan_rows, unnest([true, true, true, true, false, false, false]) AS passed FROM n"""
