"""The same queries in SQL, written for DuckDB from the definition of each operator."""

from __future__ import annotations

_REVIEWS = """
reviews AS (
  SELECT e.event_id AS eid,
    CAST(e.event_id AS VARCHAR) AS id,
    CASE WHEN e.event_id % 103 <> 0 THEN d.text END AS comment,
    CAST(e.event_id % 11 AS VARCHAR) AS votes_count,
    CASE WHEN e.event_id % 107 = 0 THEN NULL WHEN e.event_id % 2 = 0 THEN 'Android' ELSE 'iOS' END AS os,
    CAST(10 + e.event_id % 9 AS VARCHAR) AS os_version,
    CASE d.lang WHEN 'es' THEN 'España' WHEN 'de' THEN 'Österreich' WHEN 'fr' THEN 'Québec' ELSE 'US' END AS country,
    CAST(18 + e.user_id % 60 AS VARCHAR) AS age,
    CASE WHEN e.event_id % 109 <> 0 THEN CAST(e.user_id AS VARCHAR) END AS customer_id,
    CASE WHEN e.event_id % 101 <> 0 THEN lpad(CAST(e.user_id AS VARCHAR), 11, '0') END AS cpf,
    '1.' || CAST(e.event_id % 40 AS VARCHAR) || '.0' AS app_version,
    CASE WHEN e.event_id % 97 = 0 THEN NULL WHEN e.event_id % 89 = 0 THEN 'abc' WHEN e.event_id % 83 = 0 THEN '3.7'
      ELSE CAST(e.event_id % 5 + 1 AS VARCHAR) END AS rating,
    strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
    'app-x' AS app
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents))"""

_COLUMNS = "id, comment, votes_count, os, os_version, country, age, customer_id, cpf, app_version, rating, timestamp, app"
_KEY = "customer_id, app_version, rating"
_REQUIRED = ["customer_id", "rating", "comment", "app_version", "cpf", "os", "os_version", "timestamp", "app"]
_IS_NULL = "(" + " OR ".join(f"{name} IS NULL" for name in _REQUIRED) + ")"


def _fold(name: str) -> str:
    return (
        f"upper(translate(replace({name}, 'ß', 'ss'), 'ÄÇÈÉÊÍÑÓÖÜäçèéêíñóöü', 'ACEEEINOOUaceeeinoou')) AS {name}"
    )


def _int(name: str) -> str:
    edge = "^[ \\t\\r\\n]+|[ \\t\\r\\n]+$"
    trimmed = f"regexp_replace({name}, '{edge}', '', 'g')"
    return (
        f"CASE WHEN regexp_matches({trimmed}, '^[+-]?[0-9]+([.][0-9]*)?$') "
        f"THEN try_cast(regexp_replace({trimmed}, '[.][0-9]*$', '') AS INTEGER) "
        f"WHEN regexp_matches({trimmed}, '^[+-]?[.][0-9]*$') THEN 0 END"
    )


_TEXT = ("comment", "os", "country")
_INT = ("votes_count", "age", "rating")
_NORMAL = ", ".join(_fold(c) if c in _TEXT else c for c in _COLUMNS.split(", "))
_CONFORM = ", ".join(f"{_int(c)} AS {c}" if c in _INT else c for c in _COLUMNS.split(", "))

_PROCESSED = f"""{_REVIEWS},
p AS (SELECT {_NORMAL} FROM reviews)"""

_GROUPS = f"groups AS (SELECT {_KEY}, count(*) AS n FROM p GROUP BY {_KEY} HAVING count(*) > 1)"
_DUPLICATES = f"""duplicates AS (
  SELECT {', '.join('p.' + c for c in _COLUMNS.split(', '))} FROM p JOIN groups g
    ON p.customer_id = g.customer_id AND p.app_version = g.app_version AND p.rating = g.rating)"""
_LANDED = f"""landed AS (
  SELECT {_CONFORM}, CASE WHEN timestamp < '2024-01-29' THEN '20240129' ELSE '20240130' END AS odate
  FROM p WHERE NOT {_IS_NULL})"""

_NULL_COUNTS = [c for c in _REQUIRED if c != "app"]
_NULL_LIST = ", ".join(
    f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 "
    f"THEN '''{c}'': ' || CAST(count(*) FILTER (WHERE {c} IS NULL) AS VARCHAR) END"
    for c in _NULL_COUNTS
)
_ANY_NULL = " OR ".join(f"{c} IS NULL" for c in _NULL_COUNTS)
_PROFILE = f"""{_PROCESSED}, {_GROUPS}, {_DUPLICATES},
prof AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE {_IS_NULL}) AS null_rows,
    count(*) FILTER (WHERE {_ANY_NULL}) AS profiled_nulls,
    'Valores nulos encontrados nas colunas: {{' || concat_ws(', ', {_NULL_LIST}) || '}}.' AS null_message,
    count(*) FILTER (WHERE ({_int('rating')}) IS NULL) AS type_failures,
    (SELECT count(*) FROM groups) AS n_groups, (SELECT count(*) FROM duplicates) AS n_duplicates
  FROM p)"""

_DOCUMENT = f"""{_PROFILE},
doc AS (
  SELECT 'bronze' AS layer_lake, total - null_rows AS valid_count,
    CAST(total - null_rows AS DOUBLE) / CAST(total + n_duplicates AS DOUBLE) * 100 AS valid_percentage,
    null_rows + n_duplicates AS invalid_count,
    CAST(null_rows + n_duplicates AS DOUBLE) / CAST(total + n_duplicates AS DOUBLE) * 100 AS invalid_percentage,
    total + n_duplicates AS total_records, total AS input_records,
    CAST(CASE WHEN n_groups > 0 THEN 409 ELSE 200 END AS INTEGER) AS duplicate_code,
    CASE WHEN profiled_nulls > 0 THEN null_message ELSE 'Nenhum valor nulo encontrado nas colunas criticas.' END
      AS null_message,
    type_failures = 0 AS type_status,
    CAST((n_groups = 0)::INTEGER + (profiled_nulls = 0)::INTEGER + (type_failures = 0)::INTEGER AS INTEGER)
      AS success_count,
    CAST((n_groups > 0)::INTEGER + (profiled_nulls > 0)::INTEGER + (type_failures > 0)::INTEGER AS INTEGER)
      AS error_count,
    'PF' AS type_client, 'app-x' AS app
  FROM prof)"""

_SKEWED = f"""{_REVIEWS},
p AS (
  SELECT * REPLACE (
    CASE WHEN eid % 3 = 0 THEN '7' WHEN eid % 9 <> 1 THEN customer_id END AS customer_id,
    CASE WHEN eid % 3 = 0 THEN '1.0.0' ELSE app_version END AS app_version,
    CASE WHEN eid % 3 = 0 THEN '5' ELSE rating END AS rating)
  FROM reviews)"""

_RUN_COLUMNS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _COLUMNS.split(", "))

ORACLES = {
    "scan_full": "SELECT * FROM documents",
    "landed_read": f"WITH {_PROCESSED}, {_LANDED} SELECT * FROM landed",
    "high_water_mark": f"""WITH {_PROCESSED}, {_LANDED}
SELECT strftime(strptime(max(odate), '%Y%m%d'), '%Y-%m-%dT%H:%M:%S') AS mark FROM landed WHERE odate < '20240131'""",
    "incremental_scan": f"WITH {_REVIEWS} SELECT {_COLUMNS} FROM reviews WHERE timestamp >= '2024-01-30T00:00:00'",
    "load_mode_full": f"WITH {_REVIEWS} SELECT {_COLUMNS}, 'full' AS mode, CAST(NULL AS VARCHAR) AS mark FROM reviews",
    "load_mode_incr": f"""WITH {_REVIEWS}
SELECT {_COLUMNS}, 'incremental' AS mode, '2024-01-30T00:00:00' AS mark FROM reviews
WHERE timestamp >= '2024-01-30T00:00:00'""",
    "flatten_project": f"WITH {_REVIEWS} SELECT {_COLUMNS} FROM reviews",
    "normalize_text": f"WITH {_PROCESSED} SELECT {_COLUMNS} FROM p",
    "conform_schema": f"WITH {_PROCESSED} SELECT {_CONFORM} FROM p",
    "duplicate_groups": f"WITH {_REVIEWS} SELECT {_KEY}, count(*) AS count FROM reviews GROUP BY {_KEY} HAVING count(*) > 1",
    "null_profile": f"WITH {_REVIEWS} SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM reviews" for c in _NULL_COUNTS
    )
    + ") WHERE null_count > 0",
    "type_check": f"WITH {_REVIEWS} SELECT {_COLUMNS} FROM reviews WHERE ({_int('rating')}) IS NULL",
    # The names, codes and messages of the checks.
    "quality_report": f"""WITH {_PROFILE}
SELECT 'duplicate_check' AS "check", n_groups = 0 AS status,
  CAST(CASE WHEN n_groups > 0 THEN 409 ELSE 200 END AS INTEGER) AS code,
  CASE WHEN n_groups > 0 THEN 'Registros duplicados encontrados: ' || CAST(n_groups AS VARCHAR)
    || ' registros com base no ''id''.' ELSE 'Nenhum registro duplicado encontrado.' END AS message,
  total AS total_records FROM prof
UNION ALL
SELECT 'null_check', profiled_nulls = 0, CAST(CASE WHEN profiled_nulls > 0 THEN 400 ELSE 200 END AS INTEGER),
  CASE WHEN profiled_nulls > 0 THEN null_message ELSE 'Nenhum valor nulo encontrado nas colunas criticas.' END, total
FROM prof
UNION ALL
SELECT 'type_consistency_check', type_failures = 0, CAST(CASE WHEN type_failures > 0 THEN 400 ELSE 200 END AS INTEGER),
  CASE WHEN type_failures > 0 THEN 'Valores não numéricos encontrados na coluna ''rating''.'
    ELSE 'Consistencia dos tipos de dados verificada com sucesso.' END, total
FROM prof""",
    "valid_records": f"WITH {_PROCESSED} SELECT {_COLUMNS} FROM p WHERE NOT {_IS_NULL}",
    "null_records": f"WITH {_PROCESSED} SELECT {_COLUMNS} FROM p WHERE {_IS_NULL}",
    "duplicate_rows": f"WITH {_PROCESSED}, {_GROUPS}, {_DUPLICATES} SELECT {_COLUMNS} FROM duplicates",
    "duplicate_rows_skewed": f"WITH {_SKEWED}, {_GROUPS}, {_DUPLICATES} SELECT {_COLUMNS} FROM duplicates",
    "invalid_records": f"""WITH {_PROCESSED}, {_GROUPS}, {_DUPLICATES}
SELECT {_COLUMNS}, 'null' AS reason FROM p WHERE {_IS_NULL}
UNION ALL SELECT {_COLUMNS}, 'duplicate' FROM duplicates""",
    "invalid_records_screened": f"""WITH {_SKEWED}, {_GROUPS}, {_DUPLICATES}
SELECT {_COLUMNS}, 'null' AS reason FROM p WHERE {_IS_NULL}
UNION ALL SELECT {_COLUMNS}, 'duplicate' FROM duplicates""",
    "partitioned_roundtrip": f"WITH {_PROCESSED} SELECT {_CONFORM}, '20240130' AS odate FROM p WHERE NOT {_IS_NULL}",
    "run_log_roundtrip": f"""WITH {_DOCUMENT}
SELECT 'success' AS metrics_type, type_client AS client, CAST(total_records AS VARCHAR) AS total_records, CAST(NULL AS VARCHAR) AS priority,
  CAST(NULL AS VARCHAR) AS error FROM doc
UNION ALL SELECT 'fail', 'PF', NULL, '0', 'source not reachable'
UNION ALL SELECT 'fail', 'UNKNOWN_CLIENT', NULL, '0', 'disk full'""",
    "metrics_document": f"WITH {_DOCUMENT} SELECT * FROM doc",
    "stage_report_parse": """
SELECT event_id AS run, 'Spark Context default degree of parallelism' AS key, CAST(event_id % 64 AS VARCHAR) AS value
FROM events
UNION ALL SELECT event_id, 'elapsedTime', CAST(user_id AS VARCHAR) || ' (0.5 s)' FROM events
UNION ALL SELECT event_id, 'kind', event_type FROM events
UNION ALL SELECT event_id, 'numStages', CAST(event_id % 5 AS VARCHAR) FROM events""",
    "stage_metrics": """
WITH t AS (SELECT CAST(l_orderkey % 500 AS BIGINT) AS stage_id, CAST(floor(l_quantity) AS BIGINT) AS q,
  CAST(l_linenumber AS BIGINT) AS ln FROM lineitem)
SELECT stage_id, count(*) AS tasks, CAST(sum(q) AS BIGINT) AS run_time_ms,
  CAST(sum(q * 1000) AS BIGINT) AS cpu_time_ns,
  CAST(sum(ln) AS BIGINT) AS gc_time_ms, max(q * ln) AS peak_memory_bytes,
  CAST(0 AS BIGINT) AS memory_spilled_bytes, CAST(0 AS BIGINT) AS disk_spilled_bytes,
  CAST(sum(q + 10) AS BIGINT) AS shuffle_read_bytes, CAST(sum(q * 2) AS BIGINT) AS shuffle_write_bytes,
  CAST(sum(q) AS BIGINT) AS records_read, CAST(sum(q * 3) AS BIGINT) AS bytes_read,
  count(*) AS records_written, CAST(sum(q * 4) AS BIGINT) AS bytes_written
FROM t GROUP BY stage_id""",
    "ingest_run": f"""WITH {_PROCESSED}, {_GROUPS}, {_DUPLICATES},
valid AS (SELECT {_CONFORM} FROM p WHERE NOT {_IS_NULL})
SELECT 'valid' AS outcome, {_RUN_COLUMNS}, '20240130' AS odate FROM valid
UNION ALL SELECT 'null', {_COLUMNS}, '20240130' FROM p WHERE {_IS_NULL}
UNION ALL SELECT 'duplicate', {_COLUMNS}, '20240130' FROM duplicates""",
    "ingest_two_days": f"""WITH {_REVIEWS}, normal AS (SELECT {_NORMAL} FROM reviews),
p AS (
  SELECT *, '20240130' AS odate FROM normal
  UNION ALL SELECT *, '20240131' FROM normal WHERE timestamp >= '2024-01-30T00:00:00'),
counted AS (SELECT *, count(*) OVER (PARTITION BY odate, {_KEY}) AS n FROM p),
valid AS (SELECT {_CONFORM}, odate FROM p WHERE NOT {_IS_NULL})
SELECT 'valid' AS outcome, {_RUN_COLUMNS}, odate FROM valid
UNION ALL SELECT 'null', {_COLUMNS}, odate FROM p WHERE {_IS_NULL}
UNION ALL SELECT 'duplicate', {_COLUMNS}, odate FROM counted
  WHERE n > 1 AND customer_id IS NOT NULL AND app_version IS NOT NULL AND rating IS NOT NULL""",
}

# The same rows, whatever the join.
ORACLES["duplicate_rows_merged"] = ORACLES["duplicate_rows_skewed"]
ORACLES["invalid_records_merged"] = ORACLES["invalid_records_screened"]

