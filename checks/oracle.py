"""What DuckDB should return for every registered query.

One chain of common table expressions restates the rules over the derived deliveries; each query
selects from it. Decimals are compared as doubles and dates as text, on both sides.
"""

from __future__ import annotations

from checks.fixture import MEMBER_TOKENS, MONTHS, RAW_CLAIMS, SCALED_ORDERS
from feedgate import FeedContract

C = FeedContract()
TYPES = {"int": C.integer_columns, "decimal(12,2)": C.money_columns, "date": C.date_columns}


def _typed(column: str) -> str:
    for sql_type, columns in TYPES.items():
        if column in columns:
            return f"TRY_CAST({column} AS {sql_type}) AS {column}"
    return column


def _portable(column: str) -> str:
    if column in C.money_columns:
        return f"CAST({column} AS double) AS {column}"
    if column in C.date_columns:
        return f"CAST({column} AS string) AS {column}"
    return column


TABLES = {n: n for n in ("lineitem", "orders", "customer")}
KEY = ", ".join(C.line_key)
HASHED = ", ".join(f"coalesce(CAST({c} AS string), '')" for c in C.columns)
CONTRACTED = ", ".join(_portable(c) for c in C.columns)
BLOCKING = ", ".join(f"'{r}'" for r in C.blocking_reasons)
CALENDAR = ", ".join(f"('{m}')" for m in MONTHS)


def _empty(column: str) -> str:
    return f"length(trim(coalesce({column}, ''))) = 0"


def _rate(predicate: str) -> str:
    return f"CAST(count_if(coalesce({predicate}, false)) AS double) / count(*)"


def _verdict(test: str) -> str:
    return f"if(coalesce({test}, false), 'PASS', 'FAIL')"


STEPS = {
    "raw_claims": RAW_CLAIMS.format(**TABLES),
    "graph": MEMBER_TOKENS.format(**TABLES),
    "calendar": f"SELECT * FROM (VALUES {CALENDAR}) AS t(delivery_month)",
    "typed": f"""
        SELECT {", ".join(_typed(c) for c in C.columns)}, _delivery_month, _source_file,
               if(suffix(lower(_source_file), '.csv'), 'csv', 'parquet') AS _physical_format
        FROM raw_claims""",
    "lines": f"SELECT *, md5(concat_ws('|', {HASHED})) AS _row_hash FROM typed",
    "ids_per_token": "SELECT member_token, vi_pid FROM graph WHERE vi_pid IS NOT NULL GROUP BY ALL",
    "tokens": """
        SELECT member_token, if(count(i.vi_pid) = 1, any_value(i.vi_pid), NULL) AS vi_pid,
               count(i.vi_pid) > 1 AS is_ambiguous
        FROM (SELECT DISTINCT member_token FROM graph) LEFT JOIN ids_per_token i USING (member_token)
        GROUP BY member_token""",
    "identified": f"""
        SELECT l.*, t.vi_pid, t.is_ambiguous IS NOT NULL AS _token_known,
               coalesce(t.is_ambiguous, false) AS _token_ambiguous,
               t.is_ambiguous IS NULL AND NOT {_empty("l.member_token")} AS _token_unresolved
        FROM lines l LEFT JOIN tokens t USING (member_token)""",
    "measured": f"""
        SELECT _delivery_month, count(*) AS total_rows,
               {_rate(f"NOT {_empty('dx_code')}")} AS dx_populated,
               {_rate(f"NOT {_empty('npi')}")} AS npi_populated,
               {_rate(f"NOT {_empty('member_token')}")} AS token_populated,
               {_rate(f"NOT {_empty('claim_id')} AND claim_line IS NOT NULL AND date_of_service IS NOT NULL"
                      " AND charge_amount IS NOT NULL")} AS required_populated,
               {_rate("token_version = 'v2'")} AS token_v2_rate,
               {_rate("gender IN ('M', 'F', 'U')")} AS gender_valid_rate,
               {_rate("icd_version = '10' AND dx_code IS NOT NULL")} AS icd10_rate,
               {_rate("length(npi) = 10")} AS npi_len_rate,
               {_rate("length(member_zip) = 5")} AS zip_len_rate,
               {_rate("length(place_of_service) = 2")} AS pos_len_rate,
               {_rate("coalesce(date_of_service <= paid_date, paid_date IS NULL)")} AS date_order_rate,
               {_rate("coalesce(units, 1) >= 1")} AS units_valid_rate,
               CAST(bool_or(_physical_format = 'csv') AS int) AS is_csv,
               max(_physical_format) AS physical_format,
               {_rate("_token_known AND NOT _token_ambiguous")} AS token_resolution_rate
        FROM identified GROUP BY ALL""",
    "scaled": f"""
        SELECT m.*, total_rows * factor AS scaled_row_count
        FROM measured m, (SELECT {SCALED_ORDERS} // count(*) AS factor FROM orders)""",
    "measures": f"""
        SELECT *,
               {_verdict(f"scaled_row_count >= {C.min_claim_lines}")} AS clause_2_2,
               {_verdict("is_csv = 0")} AS clause_2_4,
               {_verdict(f"dx_populated >= {C.dx_min}")} AS clause_3_1,
               {_verdict(f"npi_populated >= {C.npi_min}")} AS clause_3_2,
               {_verdict(f"token_populated >= {C.token_min}")} AS clause_3_3,
               {_verdict(f"required_populated >= {C.required_min}")} AS clause_3_4,
               {_verdict("gender_valid_rate = 1")} AS clause_4_2,
               {_verdict("token_v2_rate = 1")} AS clause_5_4,
               {_verdict(f"token_resolution_rate >= {C.resolution_min}")} AS clause_5_2
        FROM scaled""",
    "placed": """
        SELECT m.*, count(p._delivery_month) + 1 AS delivery_number,
               avg(p.total_rows) FILTER (WHERE p.recent) AS prior_three_mean
        FROM measures m LEFT JOIN (
            SELECT a._delivery_month AS of_month, b._delivery_month, b.total_rows,
                   row_number() OVER (PARTITION BY a._delivery_month
                                      ORDER BY b._delivery_month DESC) <= 3 AS recent
            FROM measures a JOIN measures b ON b._delivery_month < a._delivery_month
        ) p ON p.of_month = m._delivery_month
        GROUP BY ALL""",
    "results": f"""
        SELECT *, CASE WHEN delivery_number <= 3 THEN 'NOT_APPLICABLE'
                       ELSE {_verdict(f"abs(total_rows - prior_three_mean) <= prior_three_mean * {C.volume_band}")}
                  END AS clause_2_3,
               'UNTESTABLE' AS clause_2_1, 'UNTESTABLE' AS clause_2_5,
               {_verdict("icd10_rate = 1")} AS clause_4_1,
               {_verdict("least(npi_len_rate, zip_len_rate, pos_len_rate) = 1")} AS clause_4_3,
               {_verdict("date_order_rate = 1")} AS clause_4_4,
               {_verdict("units_valid_rate = 1")} AS clause_4_7
        FROM placed""",
    "contents": f"SELECT {KEY}, _delivery_month, _row_hash, count(*) AS copies FROM lines GROUP BY ALL",
    "conflicts": f"SELECT {KEY}, _delivery_month FROM contents GROUP BY ALL HAVING count(*) > 1",
    "reasons": """
        SELECT c.delivery_month AS _delivery_month, coalesce(r.total_rows, 0) AS total_rows,
               list_filter([
                   if(r.total_rows IS NULL, 'EMPTY_DELIVERY', NULL),
                   if(r.clause_2_4 = 'FAIL', 'WRONG_FORMAT', NULL),
                   if('FAIL' IN (r.clause_3_1, r.clause_3_2, r.clause_3_3, r.clause_3_4),
                      'COMPLETENESS_FAIL', NULL),
                   if(c.delivery_month IN (SELECT _delivery_month FROM conflicts),
                      'SAME_MONTH_CONFLICT', NULL),
                   if(r.clause_4_2 = 'FAIL', 'DOMAIN_FAIL', NULL),
                   if(r.clause_5_4 = 'FAIL', 'TOKEN_VERSION_FAIL', NULL),
                   if(r.clause_5_2 = 'FAIL', 'TOKEN_RESOLUTION_LOW', NULL),
                   if(r.clause_2_2 = 'FAIL', 'VOLUME_FAIL', NULL),
                   if(r.clause_2_3 = 'FAIL', 'VOLUME_BAND_FAIL', NULL)
               ], lambda code: code IS NOT NULL) AS codes
        FROM calendar c LEFT JOIN results r ON r._delivery_month = c.delivery_month""",
    "decisions": f"""
        SELECT _delivery_month, total_rows, array_to_string(codes, '|') AS reason_codes,
               CASE WHEN list_has_any(codes, [{BLOCKING}]) THEN 'BLOCK'
                    WHEN codes = [] THEN 'LOAD' ELSE 'LOAD_WITH_WARNINGS' END AS decision
        FROM reasons""",
    "accepted": """
        SELECT * FROM identified
        WHERE _delivery_month NOT IN (SELECT _delivery_month FROM decisions WHERE decision = 'BLOCK')""",
    "warned": f"""
        SELECT *, array_to_string(list_filter([
                   if({_empty("dx_code")}, 'DX_MISSING', NULL),
                   if({_empty("npi")}, 'NPI_MISSING', NULL),
                   if({_empty("member_token")}, 'MEMBER_TOKEN_MISSING', NULL),
                   if(_token_unresolved, 'TOKEN_UNRESOLVED', NULL),
                   if(coalesce(token_version, '') <> 'v2', 'TOKEN_VERSION_INVALID', NULL),
                   if(coalesce(gender, '') NOT IN ('M', 'F', 'U'), 'GENDER_INVALID', NULL),
                   if(coalesce(units, 1) < 1, 'UNITS_INVALID', NULL),
                   if(date_of_service > paid_date, 'DATE_ORDER_INVALID', NULL),
                   if(charge_amount < 0 AND (claim_freq_code <> '8' OR original_claim_id IS NULL),
                      'NEGATIVE_CHARGE_INVALID', NULL)
               ], lambda code: code IS NOT NULL), '|') AS warnings
        FROM accepted""",
    "disposed": f"""
        SELECT w.*, coalesce(conflict, _token_ambiguous) AS held,
               CASE WHEN held THEN 'QUARANTINE' WHEN warnings = '' THEN 'PASS' ELSE 'WARN' END AS _dq_status,
               CASE WHEN conflict IS NOT NULL THEN 'SAME_MONTH_CONFLICT'
                    WHEN _token_ambiguous THEN 'TOKEN_AMBIGUOUS' ELSE warnings END AS _dq_reasons
        FROM warned w LEFT JOIN (SELECT *, true AS conflict FROM conflicts) USING ({KEY}, _delivery_month)""",
    "deduped": f"""
        SELECT *, rank() OVER same + row_number() OVER (PARTITION BY {KEY}, _row_hash, _delivery_month) - 1
               AS dup_rank
        FROM disposed WHERE NOT held
        WINDOW same AS (PARTITION BY {KEY}, _row_hash ORDER BY _delivery_month)""",
    "versions": f"""
        SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY _delivery_month DESC, _row_hash DESC)
               AS version_rank
        FROM deduped WHERE dup_rank = 1""",
    "latest": "SELECT * FROM versions WHERE version_rank = 1",
    "replaced": "SELECT DISTINCT original_claim_id FROM latest WHERE claim_freq_code = '7'",
    "silver": """
        SELECT l.*, r.original_claim_id IS NOT NULL AS is_superseded,
               r.original_claim_id IS NULL AS is_current
        FROM latest l LEFT JOIN replaced r ON r.original_claim_id = l.claim_id""",
    "header_sums": """
        SELECT claim_id, min(vi_pid) AS vi_pid, min(date_of_service) AS d1, max(date_of_service) AS d2,
               sum(charge_amount) AS charge, sum(allowed_amount) AS allowed, count(*) AS line_count,
               max(_delivery_month) AS _delivery_month, max(_source_file) AS _source_file,
               max(_dq_status) AS _dq_status,
               array_to_string(list_sort(list(DISTINCT _dq_reasons) FILTER (WHERE _dq_reasons <> '')), '|')
                   AS reasons
        FROM silver WHERE is_current GROUP BY claim_id""",
    "header": """
        SELECT claim_id, vi_pid, CAST(d1 AS string) AS first_date_of_service,
               CAST(d2 AS string) AS last_date_of_service,
               CAST(charge AS double) AS total_charge_amount, CAST(allowed AS double) AS total_allowed_amount,
               line_count, _delivery_month, _source_file, _dq_status,
               nullif(reasons, '') AS _dq_reasons,
               md5(array_to_string(list_filter([claim_id, coalesce(vi_pid, ''), CAST(d1 AS string),
                   CAST(d2 AS string), CAST(charge AS string), CAST(allowed AS string),
                   CAST(line_count AS string)], lambda part: part IS NOT NULL), '|')) AS _row_hash,
               true AS all_lines_current
        FROM header_sums""",
    "outcomes": """
        SELECT _delivery_month, 'quarantine' AS outcome FROM disposed WHERE held
        UNION ALL SELECT _delivery_month, 'dropped' FROM deduped WHERE dup_rank > 1
        UNION ALL SELECT _delivery_month, 'dropped' FROM versions WHERE version_rank > 1
        UNION ALL SELECT _delivery_month, 'silver' FROM silver""",
    "reconciled": """
        SELECT d._delivery_month, decision, total_rows AS raw_rows,
               count_if(coalesce(outcome, '') = 'quarantine') AS quarantine_rows,
               count_if(coalesce(outcome, '') = 'dropped') AS deduplicated_rows,
               count_if(coalesce(outcome, '') = 'silver') AS silver_eligible_rows
        FROM decisions d LEFT JOIN outcomes USING (_delivery_month)
        GROUP BY ALL""",
}

LINE_COLUMNS = (
    f"{CONTRACTED}, vi_pid, _source_file, _delivery_month, _dq_status, _dq_reasons, _row_hash"
)
MEASURES = """_delivery_month, total_rows, dx_populated, npi_populated, token_populated, required_populated,
    token_v2_rate, gender_valid_rate, icd10_rate, npi_len_rate, zip_len_rate, pos_len_rate, date_order_rate,
    units_valid_rate, is_csv, physical_format, token_resolution_rate, scaled_row_count, clause_2_2, clause_2_4,
    clause_3_1, clause_3_2, clause_3_3, clause_3_4, clause_4_2, clause_5_4, clause_5_2"""
BAND = """prior_three_mean, delivery_number, clause_2_3, clause_2_1, clause_2_5, clause_4_1, clause_4_3,
    clause_4_4, clause_4_7"""
SILVER = f"SELECT {LINE_COLUMNS}, is_current, is_superseded FROM silver"
HELD = f"SELECT {LINE_COLUMNS}, false AS is_current, false AS is_superseded FROM disposed WHERE held"
TOTALS = """
    SELECT (SELECT count(*) FROM silver) AS silver_lines, count(*) AS current_lines,
           CAST(sum(charge_amount) AS double) AS total_charge,
           (SELECT count(*) FROM disposed WHERE held) AS quarantine_lines
    FROM silver WHERE is_current"""

# Name and physical type of the columns of a delivery, as the inventory lists them.
_TEXT_SCHEMA = ",".join(
    f'{{"name":"{c}","type":"string"}}' for c in (*C.columns, "_delivery_month", "_source_file")
)
_DRIFT_SCHEMA = _TEXT_SCHEMA
for _code in ("member_zip", "place_of_service", "npi"):
    _DRIFT_SCHEMA = _DRIFT_SCHEMA.replace(f'"{_code}","type":"string"', f'"{_code}","type":"int"')

# The same deliveries in their physical schemas, for the union by name.
_AS_SENT = ", ".join(
    f"TRY_CAST({c} AS int) AS {c}" if c in ("member_zip", "place_of_service", "npi") else c
    for c in C.columns
)

SELECTS = {
    "delivery_key": """
        SELECT _source_file, strftime(strptime(regexp_extract(_source_file, '[0-9]{6}'), '%Y%m'), '%Y-%m')
               AS delivery_month, count(*) AS line_count FROM raw_claims GROUP BY ALL""",
    "physical_format": "SELECT _physical_format, count(*) AS line_count FROM typed GROUP BY ALL",
    "lineage": "SELECT claim_id, claim_line, _delivery_month, _source_file FROM raw_claims",
    "scan_csv": f"""
        SELECT {", ".join(C.columns)}, _source_file FROM raw_claims
        WHERE suffix(_source_file, '.csv')""",
    "scan_parquet": f"""
        SELECT {", ".join(C.columns)}, _source_file FROM raw_claims
        WHERE NOT suffix(_source_file, '.csv')""",
    "drifting_parts": f"""
        SELECT * REPLACE (if(claim_type = 'PROF' OR gender = 'M' OR suffix(_source_file, '.csv'), npi, NULL) AS npi),
               if(suffix(_source_file, '.csv'), 'line' || chr(10) || claim_line, NULL) AS vendor_note
        FROM (SELECT {", ".join(C.columns)}, _source_file FROM raw_claims)""",
    "scan_tokens": "SELECT member_token, vi_pid FROM graph",
    "inventory": f"""
        SELECT 'claims_' || replace(delivery_month, '-', '') || ending AS s3_key, delivery_month,
               ltrim(ending, '.') AS file_format,
               (SELECT count(*) FROM raw_claims r WHERE r._delivery_month = c.delivery_month) AS row_count,
               if(delivery_month IN ('2025-04', '2025-05'), '[{_DRIFT_SCHEMA}]', '[{_TEXT_SCHEMA}]')
                   AS columns_json
        FROM (SELECT delivery_month,
                     if(delivery_month IN ('2025-09', '2025-12'), '.csv', '.parquet') AS ending
              FROM calendar) c""",
    "expected_deliveries": """
        SELECT delivery_month,
               (SELECT count(*) FROM raw_claims r WHERE r._delivery_month = c.delivery_month) AS line_count
        FROM calendar c""",
    "union_by_name": f"""
        SELECT * EXCLUDE (vendor_note), vendor_note FROM (
            SELECT {", ".join(C.columns)}, _delivery_month, _source_file, NULL AS vendor_note
            FROM raw_claims WHERE _delivery_month NOT IN ('2025-01', '2025-04', '2025-05')
            UNION ALL BY NAME
            SELECT {_AS_SENT}, _delivery_month, _source_file FROM raw_claims
            WHERE _delivery_month IN ('2025-04', '2025-05')
            UNION ALL BY NAME
            SELECT * EXCLUDE (allowed_amount), 'note ' || claim_line AS vendor_note
            FROM raw_claims WHERE _delivery_month = '2025-01')""",
    "normalize": f"SELECT {CONTRACTED}, _delivery_month, _source_file, _physical_format FROM lines",
    "row_hash": f"SELECT {KEY}, _delivery_month, _row_hash FROM lines",
    "token_resolve": "SELECT member_token, vi_pid, is_ambiguous FROM tokens",
    "attach_identity": f"""
        SELECT {KEY}, _delivery_month, _row_hash, vi_pid, _token_ambiguous, _token_unresolved FROM accepted""",
    "token_vi_ambiguous": "SELECT member_token FROM tokens WHERE is_ambiguous",
    "token_patient_ambiguous": """
        SELECT member_token, count(DISTINCT patient_id) AS patient_count FROM lines
        WHERE member_token IS NOT NULL GROUP BY ALL HAVING patient_count > 1""",
    "token_resolution_rate": "SELECT _delivery_month, token_resolution_rate FROM measured",
    "contract_measures": f"SELECT {MEASURES} FROM measures",
    "volume_band": f"SELECT {MEASURES}, {BAND} FROM results",
    "global_key_dupes": f"""
        SELECT {KEY}, count(DISTINCT _delivery_month) AS delivery_count, sum(copies)::bigint AS row_count
        FROM contents WHERE claim_id IS NOT NULL AND claim_line IS NOT NULL
        GROUP BY ALL HAVING sum(copies) > 1""",
    "same_delivery_conflicts": f"SELECT {KEY}, _delivery_month FROM conflicts",
    "gate_reasons": """
        SELECT _delivery_month, total_rows, array_to_string(codes, '|') AS reason_codes,
               len(codes) AS reason_count FROM reasons""",
    "promotion_decisions": "SELECT _delivery_month, total_rows, decision, reason_codes FROM decisions",
    "row_warnings": f"SELECT {KEY}, _delivery_month, _row_hash, warnings FROM warned",
    "row_disposition": f"SELECT {KEY}, _delivery_month, _row_hash, _dq_status, _dq_reasons FROM disposed",
    "quarantine": HELD,
    "dedup_rank": f"SELECT {KEY}, _row_hash, _delivery_month, dup_rank FROM deduped",
    "replays": f"""
        SELECT {KEY}, _row_hash, _delivery_month, count(*) AS replayed_rows
        FROM deduped WHERE dup_rank > 1 GROUP BY ALL""",
    "version_rank": f"SELECT {KEY}, _row_hash, _delivery_month, version_rank FROM versions",
    "silver_line": SILVER,
    "net_charge": """
        SELECT claim_freq_code, count(*) AS line_count, CAST(sum(charge_amount) AS double) AS net_charge
        FROM silver WHERE is_current GROUP BY ALL""",
    "claim_header": "SELECT * FROM header",
    "reconciliation": "SELECT * FROM reconciled",
    "reconciliation_failures": """
        SELECT *, 'built' AS checked FROM reconciled WHERE decision <> 'BLOCK'
        AND raw_rows - silver_eligible_rows - quarantine_rows - deduplicated_rows <> 0
        UNION ALL BY NAME
        SELECT * REPLACE (raw_rows + 1 AS raw_rows), 'seeded' AS checked FROM reconciled
        WHERE decision <> 'BLOCK' AND deduplicated_rows > 0""",
    "grain_delivered": f"SELECT {KEY}, count(*) AS rows_at_grain FROM lines GROUP BY ALL HAVING count(*) > 1",
    "grain_line": f"""
        SELECT {KEY}, count(*) AS rows_at_grain, 'built' AS checked FROM silver GROUP BY ALL HAVING count(*) > 1
        UNION ALL
        SELECT {KEY}, count(*), 'seeded' FROM (
            SELECT {KEY} FROM silver UNION ALL SELECT {KEY} FROM silver WHERE claim_freq_code = '7')
        GROUP BY ALL HAVING count(*) > 1""",
    "grain_header": """
        SELECT claim_id, count(*) AS rows_at_grain, 'built' AS checked FROM header GROUP BY ALL HAVING count(*) > 1
        UNION ALL
        SELECT claim_id, count(*), 'seeded' FROM (
            SELECT claim_id FROM header UNION ALL SELECT claim_id FROM header WHERE _dq_status = 'WARN')
        GROUP BY ALL HAVING count(*) > 1""",
    "decision_report": """
        SELECT _delivery_month, total_rows, decision, reason_codes, dx_populated, npi_populated,
               token_resolution_rate
        FROM decisions LEFT JOIN (SELECT * EXCLUDE (total_rows) FROM results) USING (_delivery_month)
        ORDER BY _delivery_month""",
    "run_totals": TOTALS,
    "replay_check": f"""
        SELECT run, t.* FROM (VALUES ('first'), ('second')) AS runs(run), ({TOTALS}) t""",
    "sink_roundtrip": SILVER,
    "audit_roundtrip": f"SELECT {MEASURES}, {BAND} FROM results",
    "catalog_table": """
        SELECT 'silver_claim_line' AS table_name, _delivery_month, count(*) AS row_count,
               count_if(is_current) AS current_rows, CAST(sum(charge_amount) AS double) AS charge
        FROM silver GROUP BY ALL
        UNION ALL
        SELECT 'silver_claim_line_quarantine', _delivery_month, count(*), count_if(false),
               CAST(sum(charge_amount) AS double)
        FROM disposed WHERE held GROUP BY ALL
        UNION ALL
        SELECT 'silver_claim_header', _delivery_month, count(*), count(*), CAST(sum(charge) AS double)
        FROM header_sums GROUP BY ALL""",
    "catalog_audit": """
        SELECT 'inventory' AS table_name, delivery_month,
               if(delivery_month IN ('2025-09', '2025-12'), 'csv', 'parquet') AS detail FROM calendar
        UNION ALL SELECT 'validation_results', _delivery_month, clause_2_3 FROM results
        UNION ALL SELECT 'promotion_decisions', _delivery_month, reason_codes FROM decisions
        UNION ALL SELECT 'reconciliation', _delivery_month, decision FROM reconciled""",
    "catalog_raw": """
        SELECT 'raw_claims_' || replace(delivery_month, '-', '_') AS table_name,
               (SELECT count(*) FROM raw_claims r WHERE r._delivery_month = c.delivery_month) AS line_count
        FROM calendar c
        UNION ALL SELECT 'raw_member_tokens', count(*) FROM graph""",
}


# Rows of the damaged deliveries that can be measured, and what is against the others.
RAGGED = "_delivery_month = '2025-09' AND claim_line = '7'"
DAMAGED = f"SELECT * FROM ({RAW_CLAIMS.format(**TABLES)}) WHERE _delivery_month NOT IN ('2025-02', '2025-05') AND NOT ({RAGGED})"
ISOLATED = """
    SELECT _delivery_month, total_rows,
           CASE _delivery_month
               WHEN '2025-02' THEN 'MISSING_REQUIRED_COLUMNS' WHEN '2025-05' THEN 'UNREADABLE_FILE'
               WHEN '2025-09' THEN array_to_string(list_prepend('REJECTED_ROWS', codes), '|')
               ELSE reason_codes END AS reason_codes,
           if(_delivery_month IN ('2025-02', '2025-05', '2025-09'), 'BLOCK', decision) AS decision
    FROM decisions JOIN (SELECT _delivery_month, codes FROM reasons) USING (_delivery_month)"""
_RECORD = ", ".join(f"coalesce({c}, '')" for c in C.columns)
SELECTS["rejected_rows"] = f"""
    SELECT _delivery_month, _source_file, concat_ws('|', {_RECORD}, 'EXTRA') AS record
    FROM raw_claims WHERE {RAGGED}"""
SELECTS["catalog_drift"] = SELECTS["drifting_parts"]


# The feed with text that fits no type and lines without claim; conflicts do not block, and more is warned of.
SPOILT = f"""
    SELECT * REPLACE (if(claim_line = '6', NULL, claim_id) AS claim_id,
                      if(claim_line = '5', 'n/a', allowed_amount) AS allowed_amount,
                      if(claim_line = '4', ' ', paid_date) AS paid_date,
                      if(claim_line = '3', 'one', units) AS units)
    FROM ({RAW_CLAIMS.format(**TABLES)})"""


def _failed(column: str) -> str:
    sql_type = next(t for t, columns in TYPES.items() if column in columns)
    return f"(NOT {_empty(column)} AND TRY_CAST({column} AS {sql_type}) IS NULL)"


def _any_failed(columns) -> str:
    return " OR ".join(f"{c}_failed" for c in columns)


REPEATED = "SELECT (claim_id, claim_line) FROM lines WHERE claim_id || claim_line IS NOT NULL GROUP BY ALL HAVING count(*) > 1"
SHARED = "SELECT member_token FROM lines WHERE member_token IS NOT NULL GROUP BY ALL HAVING count(DISTINCT patient_id) > 1"
FAILURES = ", ".join(f"{_failed(c)} AS {c}_failed" for c in C.cast_columns)
EXTENDED_STEPS = STEPS | {
    "raw_claims": SPOILT,
    "typed": STEPS["typed"].replace("FROM raw_claims", f", {FAILURES} FROM raw_claims"),
    "decisions": STEPS["decisions"].replace("'SAME_MONTH_CONFLICT'", "'-'"),
    "warned": f"""
        SELECT w.* REPLACE (concat_ws('|', nullif(warnings, ''),
                   if({_any_failed(C.date_columns)}, 'DATE_FAIL', NULL),
                   if({_any_failed(C.money_columns)}, 'MONEY_FAIL', NULL),
                   if((claim_id, claim_line) IN ({REPEATED}), 'GLOBAL_KEY_DUP', NULL),
                   if(member_token IN ({SHARED}), 'TOKEN_PATIENT_AMBIGUOUS', NULL))
               AS warnings)
        FROM ({STEPS['warned']}) w""",
}
EXTENDED = {
    "cast_failures": f"""
        SELECT _delivery_month, count(*) AS total_rows, {", ".join(f"count_if({c}_failed) AS {c}_failed" for c in C.cast_columns)}
        FROM typed GROUP BY ALL""",
    "extended_disposition": f"SELECT {KEY}, _delivery_month, _row_hash, _dq_status, _dq_reasons FROM disposed",
    "extended_reconciliation": "SELECT * FROM reconciled",
    "incomplete_keys": """
        SELECT d._delivery_month, count(*) AS incomplete_rows, count_if(d.dup_rank > 1) AS replayed_rows,
               count_if(d.dup_rank = 1)
               - (SELECT count(*) FROM latest l WHERE l._delivery_month = d._delivery_month
                  AND (l.claim_id IS NULL OR l.claim_line IS NULL)) AS collapsed_rows
        FROM deduped d WHERE d.claim_id IS NULL OR d.claim_line IS NULL GROUP BY d._delivery_month""",
}


def _chain(steps: dict[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items())


def oracle_sql() -> dict[str, str]:
    found = {key: f"{_chain(STEPS)}\n{select}" for key, select in SELECTS.items()}
    found |= {key: f"{_chain(EXTENDED_STEPS)}\n{select}" for key, select in EXTENDED.items()}
    return found | {"isolated_decisions": f"{_chain(STEPS | {'raw_claims': DAMAGED})}\n{ISOLATED}"}
