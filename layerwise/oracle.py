"""The registered queries as DuckDB SQL, written from the operators' semantics."""

from __future__ import annotations

from layerwise.testbed import TABLES

_DAY = "replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '')"

_DIRTY = f"""d AS (
SELECT event_id, user_id, event_type AS table_name,
 CASE user_id % 5 WHEN 0 THEN 'North TV' WHEN 1 THEN 'North TV - Resellers' WHEN 2 THEN 'Arts+ West'
      WHEN 3 THEN 'arts  plus  WEST' ELSE 'Unmapped Co' END AS brand,
 CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '' ELSE event_type END AS kind,
 CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS ex_pause,
 CASE WHEN event_id % 19 = 0 THEN 0 WHEN event_id % 29 = 0 THEN NULL ELSE user_id END AS asset_duration,
 CASE WHEN event_id % 23 = 0 THEN 'not-a-date' WHEN event_id % 31 = 0 THEN NULL
      ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS start_date,
 CASE WHEN event_id % 37 = 0 THEN 'abc' ELSE CAST(user_id AS VARCHAR) END AS user_ref,
 {_DAY} AS filedate
FROM events)"""

_NOTED = f"""n AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN 'a' || sep || 'b' WHEN event_id % 11 = 0 THEN 'two' || chr(10) || 'lines'
  WHEN event_id % 13 = 0 THEN 'a "word" in quotes' ELSE 'n' || event_id END AS note
 FROM (SELECT event_id, user_id, event_type, CASE event_type WHEN 'signup' THEN ',' WHEN 'purchase' THEN ';'
  WHEN 'view' THEN chr(9) WHEN 'click' THEN '|' ELSE ':' END AS sep FROM events))"""

_FILES = f"""f AS (
SELECT 'User ' || user_id AS brand, {_DAY} AS filedate, event_type AS table_name FROM events)"""

_LEDGER = f"""l AS (
SELECT {_DAY} AS filedate, event_type AS table_name,
 CASE WHEN event_id % 10 = 0 THEN 'failed' ELSE 'success' END AS status, event_id AS processed_at
FROM events)"""

_KINDS = "('signup', 'purchase', 'view', 'click')"
_E = {
    "invalid_kinds": f"(kind IS NOT NULL AND kind NOT IN {_KINDS})",
    "missing_fields": "(kind IS NULL OR kind = '' OR start_date IS NULL OR start_date = '')",
    "invalid_dates": "(start_date IS NOT NULL AND try_cast(start_date AS TIMESTAMP) IS NULL)",
    "invalid_duration": "coalesce(ex_pause > asset_duration AND asset_duration <> 0, false)",
    "inconsistent_duration": "(NOT coalesce(asset_duration >= ex_pause, false))",
    "missing_kind": "(kind IS NULL OR kind = '')",
}
_ANY = "(" + " OR ".join(_E.values()) + ")"
_FLAGS = ", ".join(f"{sql} AS {name}" for name, sql in _E.items())

_BRAND_KEY = "trim(regexp_replace(replace(lower(brand), '-', ' '), '\\s+', ' ', 'g'))"
_CODES = """CASE {key} WHEN 'north tv' THEN 'NT' WHEN 'north tv resellers' THEN 'NTR'
 WHEN 'arts plus west' THEN 'APW' END"""
_CODE = _CODES.format(key=_BRAND_KEY)


def _d(sql: str) -> str:
    return f"WITH {_DIRTY} {sql}"


def _bad_per_brand(error_type: str) -> str:
    return _d(
        f"SELECT brand, count(*) AS n_rows, count(*) FILTER (WHERE {_E[error_type]}) AS n_bad "
        "FROM d GROUP BY brand"
    )


def _gold(group: str, keys: str, errors: dict[str, str], total: int, skipped: int, source: str) -> str:
    """Gold log columns by row_number and plain grouping, from a relation with the raw rows."""
    any_bad = " OR ".join(errors)
    failed = " + ".join(f"CAST(bool_or({e}) AS BIGINT)" for e in errors)
    flags = ", ".join(f"{sql} AS {name}" for name, sql in errors.items())
    return f"""
b AS (SELECT {group}, count(*) AS n_before FROM {source} GROUP BY {group}),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {group}, {keys} ORDER BY event_id) AS rn
      FROM {source}) WHERE rn = 1),
c AS (SELECT *, {flags} FROM k),
a AS (SELECT {group}, count(*) AS n_after, count(*) FILTER (WHERE {any_bad}) AS n_error,
      {failed} AS failed FROM c GROUP BY {group}),
g AS (SELECT {group}, n_before AS records_before_agg, n_after AS records_after_agg,
      n_before - n_after AS duplicates_removed, CAST({total} AS BIGINT) AS checks_total,
      CAST({total} - {skipped} - failed AS BIGINT) AS checks_passed, CAST(failed AS BIGINT) AS checks_failed,
      CAST({skipped} AS BIGINT) AS checks_skipped, n_after - n_error AS records_valid,
      n_error AS records_error,
      CASE WHEN failed = 0 THEN 'OK' WHEN n_after - n_error > 0 THEN 'WARNING' ELSE 'ERROR' END AS status
      FROM a JOIN b USING ({group}))"""


_DQ = (
    f"WITH {_DIRTY}, s AS (SELECT *, filedate AS date_folder FROM d),"
    + _gold(
        "date_folder, table_name, brand",
        "user_id",
        _E,
        8,
        2,
        "s",
    )
    + """, q AS (
SELECT date_folder, table_name, CAST(sum(records_before_agg) AS BIGINT) AS total_records,
 CAST(sum(records_error) AS BIGINT) AS error_records,
 CAST(round(CAST(100 * sum(records_error) AS DECIMAL(30,10)) / nullif(sum(records_before_agg), 0), 2) AS DOUBLE)
   AS error_percent
FROM g GROUP BY date_folder, table_name)"""
)
_GATE = (
    _DQ
    + """, t AS (
SELECT date_folder, CAST(sum(total_records) AS BIGINT) AS total_records,
 CAST(sum(error_records) AS BIGINT) AS error_records,
 CAST(sum(error_records) AS DOUBLE) / CAST(sum(total_records) AS DOUBLE) * 100 AS error_percentage
FROM q GROUP BY date_folder),
w AS (
SELECT *, CASE WHEN error_percentage > 51 THEN 'ERROR' WHEN error_percentage > 49.5 THEN 'WARNING'
  ELSE 'OK' END AS status,
 CASE WHEN error_percentage > 51 THEN 'DATA QUALITY ERROR: Overall error rate is '
      || printf('%.2f', error_percentage) || '%, exceeding threshold of 51.0%'
  WHEN error_percentage > 49.5 THEN 'DATA QUALITY WARNING: Overall error rate is '
      || printf('%.2f', error_percentage) || '%, exceeding threshold of 49.5%'
  ELSE 'Data quality acceptable: Error rate ' || printf('%.2f', error_percentage) || '%' END AS message
FROM t)"""
)

_DONE = (
    f"WITH {_LEDGER}, "
    """p AS (SELECT filedate, table_name, arg_max(status, processed_at) AS status FROM l
 GROUP BY filedate, table_name),
a AS (SELECT filedate, arg_max(status, processed_at) AS status FROM l GROUP BY filedate),
done AS (SELECT a.filedate FROM a WHERE a.status = 'success'
 AND NOT EXISTS (SELECT 1 FROM p WHERE p.filedate = a.filedate AND p.status <> 'success'))"""
)

_EXPECTED = "(VALUES ('signup'), ('purchase'), ('view'), ('click'), ('error')) AS e(table_name)"

_LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_LINE_ROW = f"row({_LINE_ORDER})"

ORACLE: dict[str, str] = {
    "parse_source_name": _d(
        """, n AS (SELECT CASE WHEN kind IS NULL THEN table_name || '_notes.txt'
  WHEN kind = '' THEN table_name || '_' || filedate || '.csv'
  ELSE brand || '_' || table_name || '_' || filedate || '.csv' END AS file_name FROM d),
c AS (SELECT file_name, count(*) AS n_rows,
  regexp_full_match(file_name, '.*_[^_]*_[^_]*\\.csv') AS ok FROM n GROUP BY file_name)
SELECT file_name,
 CASE WHEN ok THEN regexp_extract(file_name, '^(.*)_([^_]*)_([^_]*)\\.csv$', 1) END AS brand,
 CASE WHEN ok THEN regexp_extract(file_name, '^(.*)_([^_]*)_([^_]*)\\.csv$', 2) END AS table_name,
 CASE WHEN ok THEN regexp_extract(file_name, '^(.*)_([^_]*)_([^_]*)\\.csv$', 3) END AS filedate,
 CASE WHEN regexp_matches(file_name, '_[0-9]{8}\\.csv$')
        THEN regexp_extract(file_name, '([^_]*)_[0-9]{8}\\.csv$', 1)
      WHEN contains(file_name, 'signup') THEN 'signup' WHEN contains(file_name, 'view') THEN 'view'
      ELSE regexp_replace(file_name, '\\.csv$', '') END AS stem_table,
 nullif(regexp_extract(file_name, '^(.+)_[0-9]{8}\\.csv$', 1), '') AS gold_table, n_rows FROM c"""
    ),
    "sniff_delimiter": """
SELECT l_orderkey AS file, true AS valid,
 CASE l_orderkey % 4 WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN chr(9) ELSE '|' END AS delimiter,
 CAST(5 AS BIGINT) AS n_columns, CAST(least(count(*), 5) - 1 AS BIGINT) AS sample_rows
FROM lineitem GROUP BY l_orderkey""",
    "landing_roundtrip": f"""WITH {_NOTED}
SELECT event_id, user_id, event_type, note FROM n""",
    "large_csv_splits": """WITH n AS (SELECT *, CASE WHEN l_linenumber = 1 THEN 'one' || chr(10) || 'two'
  ELSE '5" pipe "' || l_returnflag || '"' || chr(10) || ',' || l_linestatus END AS note FROM lineitem)
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, count(*) AS n_rows, CAST(sum(l_linenumber) AS BIGINT) AS lines,
 CAST(sum(l_partkey) AS BIGINT) AS parts, min(note) AS first_note, max(note) AS last_note FROM n GROUP BY 1""",
    "landing_encodings": """WITH f AS (SELECT unnest(['configured', 'none']) AS fallback),
n AS (SELECT *, 'Café à ' || c_name || ' ñ' AS name FROM customer, f WHERE fallback = 'configured' OR c_nationkey % 2 = 0)
SELECT fallback, CAST(c_nationkey AS BIGINT) AS c_nationkey, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS keys,
 min(name) AS first_name, max(name) AS last_name FROM n GROUP BY 1, 2""",
    "landing_rejects": """
SELECT CASE WHEN event_id % 10 <> 0 AND event_id % 15 <> 5 THEN event_type END AS event_type,
 CASE WHEN event_id % 10 = 0 THEN event_id || ',' || event_type || ',EXTRA'
  WHEN event_id % 15 = 5 THEN CAST(event_id AS VARCHAR) END AS record, count(*) AS n_rows,
 CAST(sum(CASE WHEN event_id % 10 <> 0 AND event_id % 15 <> 5 THEN event_id END) AS BIGINT) AS id_sum
FROM events GROUP BY 1, 2""",
    "file_inventory": """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS empty_files,
 CAST(sum(strlen(event_id || ',' || user_id) + 1) AS BIGINT) AS data_bytes FROM events""",
    "raw_copy": f"""WITH {_NOTED}, w AS (SELECT event_type,
  event_id || sep || user_id || sep || event_type || sep || CASE
   WHEN contains(note, '"') THEN '"' || replace(note, '"', '""') || '"'
   WHEN contains(note, sep) OR contains(note, chr(10)) THEN '"' || note || '"' ELSE note END AS line FROM n)
SELECT event_type AS table_name, CAST(sum(1 + CAST(contains(line, chr(10)) AS INT)) AS BIGINT) AS n_lines,
 CAST(sum(strlen(replace(line, chr(10), ''))) AS BIGINT) AS n_bytes FROM w GROUP BY event_type""",
    "redelivery": """
SELECT count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(1 AS BIGINT) AS n_tables
FROM events WHERE event_id % 2 = 0""",
    "upsert_files": """WITH m AS (SELECT max(o_orderkey) AS top FROM orders),
o AS (SELECT o_orderkey, o_custkey, top, o_orderkey // (top // 20 + 1) AS file FROM orders, m),
f AS (SELECT count(DISTINCT file) AS files, count(DISTINCT file) FILTER (WHERE o_orderkey < top // 100) AS rewritten FROM o),
r AS (SELECT 'updated' AS kind, o_orderkey AS k, o_custkey + 1000000 AS c FROM o WHERE o_orderkey < top // 100
 UNION ALL SELECT 'kept', o_orderkey, o_custkey FROM o WHERE o_orderkey >= top // 100
 UNION ALL SELECT 'inserted', -o_orderkey - 1, o_custkey FROM o WHERE o_orderkey < top // 200)
SELECT kind, count(*) AS n_rows, CAST(sum(k) AS BIGINT) AS keys, CAST(sum(c) AS BIGINT) AS customers, files AS n_files,
 rewritten AS n_rewritten, files - rewritten AS n_untouched FROM r, f GROUP BY ALL""",
    "silver_swap": """WITH r AS (SELECT 'file ' || (user_id % 10) AS src_file, event_id FROM events),
s AS (SELECT unnest(['staged', 'committed', 'merged']) AS state)
SELECT state, src_file, CAST(CASE WHEN state <> 'staged' AND src_file < 'file 5' THEN 1 ELSE 0 END AS INT) AS edition,
 count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM r, s
WHERE state = 'staged' OR src_file >= 'file 5' OR event_id % 3 = 0 GROUP BY 1, 2, 3""",
    "force_rerun": """WITH r AS (SELECT * FROM (VALUES ('first', 'SUCCESS'), ('again', 'ALREADY_PROCESSED'), ('forced', 'SUCCESS')) v(run, status)),
l AS (SELECT unnest(['silver', 'gold', 'target']) AS layer)
SELECT run, status, layer, event_type, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(2 AS BIGINT) AS n_runs
FROM events, r, l GROUP BY ALL""",
    "target_load": _d(
        """, o AS (SELECT *, CASE WHEN user_ref = 'abc' OR start_date = 'not-a-date' THEN 'rejected' ELSE 'loaded' END AS outcome FROM d)
SELECT outcome, nullif(kind, '') AS kind, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum,
 CAST(sum(CASE WHEN outcome = 'loaded' THEN try_cast(user_ref AS BIGINT) END) AS BIGINT) AS ref_sum,
 CASE WHEN outcome = 'loaded' THEN count(start_date) END AS n_dates,
 (SELECT count(*) FROM o WHERE outcome = 'loaded') AS n_loaded
FROM o GROUP BY outcome, nullif(kind, '')"""
    ),
    "stream_roundtrip": """
SELECT event_type, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY event_type""",
    "failed_runs": f"""WITH {_LEDGER}, s AS (SELECT filedate, arg_max(status, processed_at) AS status,
  max(processed_at) AS last FROM l GROUP BY filedate)
SELECT 'run-' || filedate AS process_id, filedate AS date_folder, CAST(90 AS BIGINT) AS duration_seconds,
 'ERROR' AS status, CAST(5 AS BIGINT) AS tables_error, 'entry ' || last AS error_message, 'CRITICAL' AS alert_type,
 '{{"message":"entry ' || last || '","severity":"CRITICAL"}}' AS details FROM s WHERE status = 'failed'""",
    "config_aggregate_unusable": _d(
        """SELECT c.name AS "case", c.failed, CASE WHEN c.failed THEN t.n ELSE t.total END AS n_rows
FROM (SELECT count(*) AS n, CAST(sum(try_cast(user_ref AS BIGINT)) AS BIGINT) AS total FROM d) t,
 (VALUES ('absent key', true), ('absent column', true), ('unknown name', true), ('mixed text', true),
  ('text sum', false)) c(name, failed)"""
    ),
    "configured_gold": _d(
        """SELECT kind, brand, CAST(sum(ex_pause) AS BIGINT) AS ex_pause, count(event_id) AS event_id_count,
 max(event_id) AS event_id_max, '20240131' AS extraction_date
FROM d WHERE asset_duration > 10 AND kind <> '' GROUP BY kind, brand"""
    ),
    "extract_date_token": _d(
        """, o AS (SELECT CASE table_name WHEN 'view' THEN 'raw/' || filedate || '/x.csv'
  WHEN 'error' THEN 'nodate_' || brand || '.csv'
  ELSE 'in/' || brand || '_' || filedate || '.csv' END AS object_key,
  CASE WHEN table_name = 'error' THEN NULL ELSE filedate END AS digits FROM d)
SELECT object_key, coalesce(digits, 'none') AS token,
 coalesce(digits[1:4] || '-' || digits[5:6] || '-' || digits[7:8], 'none') AS iso_date,
 digits, count(*) AS n_rows FROM o GROUP BY object_key, digits"""
    ),
    "scan_date_partition": """
SELECT event_id, user_id, value FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-05' AND event_type = 'view'""",
    "rule_catalog": _d(
        ", c AS (SELECT count(*) AS n_rows, "
        + ", ".join(f"count(*) FILTER (WHERE {sql}) AS {name}" for name, sql in _E.items())
        + """ FROM d), r AS (
SELECT 'valid_types' AS rule_name, 'allowed_values' AS kind, 'kind' AS columns,
 'signup,purchase,view,click' AS allowed, NULL AS condition, 'invalid_kinds' AS error_type,
 invalid_kinds AS n_bad, n_rows FROM c
UNION ALL SELECT 'required_fields', 'required_fields', 'kind,start_date,user_login', '', NULL,
 'missing_fields', missing_fields, n_rows FROM c
UNION ALL SELECT 'date_validation', 'date_validation', 'start_date', '', NULL, 'invalid_dates',
 invalid_dates, n_rows FROM c
UNION ALL SELECT 'duration_validation', 'duration', 'ex_pause,asset_duration', '', NULL,
 'invalid_duration', invalid_duration, n_rows FROM c
UNION ALL SELECT 'duration_consistency', 'condition', '', '', 'asset_duration >= ex_pause',
 'inconsistent_duration', inconsistent_duration, n_rows FROM c
UNION ALL SELECT 'kind_existence', 'not_empty', 'kind', '', NULL, 'missing_kind', missing_kind,
 n_rows FROM c
UNION ALL SELECT 'device_presence', 'condition', '', '', 'device_type IS NOT NULL',
 'missing_device', NULL, n_rows FROM c)
SELECT rule_name, kind, columns, allowed, condition, error_type,
 CASE WHEN n_bad IS NULL THEN 'SKIPPED' WHEN n_bad > 0 THEN 'FAILED' ELSE 'PASSED' END AS status,
 n_bad, n_rows FROM r"""
    ),
    "table_sample": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100""",
    "file_row_counts": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
    "slugify": _d(
        """, n AS (SELECT brand AS name FROM d UNION ALL SELECT p_brand FROM part
 UNION ALL SELECT p_name FROM part),
s AS (SELECT name, count(*) AS n_rows,
 regexp_replace(regexp_replace(lower(name), '\\s+', '_', 'g'), '[^a-z0-9_]', '', 'g') AS slug
 FROM n GROUP BY name)
SELECT name, slug, array_to_string(list_transform(string_split(slug, '_'),
  lambda x: upper(x[1]) || lower(x[2:])), ' ') AS readable,
 trim(regexp_replace(replace(lower(name), '-', ' '), '\\s+', ' ', 'g')) AS match_key, n_rows FROM s"""
    ),
    "add_lineage": """
SELECT o_orderkey, o_custkey, o_orderpriority AS brand_src, 'North TV' AS BRAND,
 '20240105' AS FILEDATE, '2024-01-05 00:00:00' AS LOADDATE, 'loader' AS LOADEDBY FROM orders""",
    "project_to_target": "SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_acctbal AS C_ACCTBAL FROM customer",
    "non_empty_filter": _d("SELECT event_id, kind FROM d WHERE kind IS NOT NULL AND kind <> ''"),
    "config_filter": """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem
WHERE l_quantity > 30 AND (l_returnflag = 'R' OR l_linestatus = 'O')""",
    "config_filter_unusable": """
SELECT count(*) AS n_rows, 'UNRESOLVED_COLUMN.WITH_SUGGESTION' AS filter_error FROM lineitem""",
    "truncate_text": """
SELECT doc_id, CAST(least(length(text), 4000) AS BIGINT) AS n_kept, CAST(length(text) AS BIGINT) AS n_whole,
 length(text) > 4000 AS was_cut,
 md5(CASE WHEN length(text) > 4000 THEN substr(text, 1, 3997) || '...' ELSE text END) AS digest
FROM documents""",
    "harmonized_union": """
SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS nation, c_acctbal AS balance,
 CAST(c_nationkey AS VARCHAR) AS SSOID, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_nationkey, s_name, CAST(s_nationkey AS DOUBLE), CAST(s_suppkey AS VARCHAR), NULL
FROM supplier""",
    "stringify_ids": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, value
FROM events""",
    "stringify_complex": """
SELECT CAST(event_id AS VARCHAR) AS event_id,
 '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS ids,
 '["' || event_type || '","' || event_type || '"]' AS kinds, event_type FROM events""",
    "schema_cast": _d(
        """SELECT event_id, try_cast(user_ref AS BIGINT) AS user_ref,
 CAST(ex_pause AS DOUBLE) AS ex_pause, CAST(asset_duration AS VARCHAR) AS asset_duration,
 CASE kind WHEN 'view' THEN true WHEN 'click' THEN false END AS flag, start_date,
 upper(kind) AS kind, try_cast(start_date AS TIMESTAMP) IS NOT NULL AS start_date_valid FROM d"""
    ),
    "date_validity": _bad_per_brand("invalid_dates"),
    "null_policy": _d(
        """SELECT event_id, nullif(kind, '') AS kind, start_date, 'empty_to_null' AS policy FROM d
UNION ALL SELECT event_id, coalesce(kind, ''), start_date, 'null_to_empty' FROM d
UNION ALL SELECT event_id, kind, start_date, 'keep' FROM d"""
    ),
    "brand_enrich": _d(f"SELECT event_id, brand, coalesce({_CODE}, brand) AS brand_code FROM d"),
    "brand_enrich_exact": _d(
        """SELECT event_id, brand, CASE brand WHEN 'North TV' THEN 'NT'
 WHEN 'North TV - Resellers' THEN 'NTR' END AS brand_code FROM d"""
    ),
    "unmatched_brands": _d(f"SELECT DISTINCT brand FROM d WHERE {_CODE} IS NULL"),
    "expected_tables": f"""WITH {_FILES}, g AS (SELECT DISTINCT brand, filedate FROM f),
p AS (SELECT DISTINCT brand, filedate, table_name FROM f)
SELECT g.brand, g.filedate, e.table_name,
 CASE WHEN p.table_name IS NULL THEN 'NoK' ELSE 'OK' END AS status
FROM g CROSS JOIN {_EXPECTED} LEFT JOIN p
 ON p.brand = g.brand AND p.filedate = g.filedate AND p.table_name = e.table_name""",
    "keep_expected": f"""WITH {_FILES}
SELECT table_name, count(*) AS n_files FROM f WHERE table_name IN ('signup', 'purchase', 'view')
GROUP BY table_name""",
    "batch_update": """
SELECT c_custkey, coalesce(s_name, c_name) AS c_name, c_nationkey,
 coalesce(s_acctbal, c_acctbal) AS c_acctbal, c_mktsegment
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""",
    "upsert": """
SELECT coalesce(s_suppkey, c_custkey) AS s_suppkey, coalesce(c_name, s_name) AS s_name, s_nationkey,
 s_acctbal, CASE WHEN s_suppkey IS NULL THEN 'INSERTED' WHEN c_custkey IS NULL THEN 'KEPT'
 ELSE 'UPDATED' END AS action
FROM supplier FULL JOIN customer ON s_suppkey = c_custkey""",
    "upsert_counts": """
SELECT count(*) FILTER (WHERE s_suppkey IS NULL) AS rows_inserted,
 count(*) FILTER (WHERE s_suppkey IS NOT NULL AND c_custkey IS NOT NULL) AS rows_updated,
 count(*) FILTER (WHERE c_custkey IS NULL) AS rows_kept
FROM supplier FULL JOIN customer ON s_suppkey = c_custkey""",
    "upsert_latest": """
WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderkey DESC, o_totalprice DESC, o_orderpriority DESC) AS rn FROM orders) WHERE rn = 1)
SELECT coalesce(c_custkey, o_custkey) AS c_custkey, c_name, c_nationkey,
 coalesce(o_totalprice, c_acctbal) AS c_acctbal, coalesce(o_orderpriority, c_mktsegment) AS c_mktsegment
FROM customer FULL JOIN o ON o_custkey = c_custkey""",
    "load_with_rejects": _d(
        """SELECT count(*) FILTER (WHERE NOT bad) AS rows_loaded, count(*) FILTER (WHERE bad) AS rows_rejected
FROM (SELECT (user_ref = 'abc' OR coalesce(start_date, '') = 'not-a-date') AS bad FROM d)"""
    ),
    "rejected_rows": _d(
        """SELECT event_id, user_ref, start_date, concat_ws(',',
  CASE WHEN user_ref = 'abc' THEN 'user_ref' END,
  CASE WHEN start_date = 'not-a-date' THEN 'start_date' END) AS reject_columns
FROM d WHERE user_ref = 'abc' OR start_date = 'not-a-date'"""
    ),
    "candidate_key": """
SELECT *, n_rows = n_keys AND n_null_rows = 0 AS is_key FROM (
 SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, CAST(0 AS BIGINT) AS n_null_rows,
  'orders' AS table_name FROM orders
 UNION ALL SELECT count(*), count(DISTINCT (l_orderkey, l_linenumber)), 0, 'lineitem' FROM lineitem
 UNION ALL SELECT count(*), count(DISTINCT c_custkey), 0, 'customer' FROM customer)""",
    "distinct_values": _d("SELECT DISTINCT brand FROM d"),
    "dedup_keep_first": _d(
        """SELECT event_id, brand, user_id, filedate, kind FROM (SELECT *, row_number() OVER (
 PARTITION BY brand, user_id, filedate ORDER BY event_id) AS rn FROM d) WHERE rn = 1"""
    ),
    "dedup_keep_first_lineitem": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
 FROM lineitem) WHERE rn = 1""",
    "dedup_counts": _d(
        "SELECT brand, count(DISTINCT (user_id, filedate)) AS n_rows FROM d GROUP BY brand"
    ),
    "duplicate_count": """
SELECT n_rows, n_keys, n_rows - n_keys AS n_duplicates FROM (
 SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys FROM lineitem)""",
    "duplicate_values": """
SELECT l_orderkey || '-' || l_linenumber AS duplicate_value, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "rule_uniqueness_first": _d(
        """SELECT event_id, brand, row_number() OVER (
 PARTITION BY brand, user_id, filedate ORDER BY event_id) > 1 AS repeated FROM d"""
    ),
    "rule_uniqueness_all": _d(
        """SELECT event_id, kind, count(*) OVER (
 PARTITION BY kind, user_id, filedate) > 1 AS repeated FROM d"""
    ),
    "rule_allowed_values": _bad_per_brand("invalid_kinds"),
    "invalid_values": _d(
        f"SELECT kind, count(*) AS n_bad FROM d WHERE {_E['invalid_kinds']} GROUP BY kind"
    ),
    "rule_required_fields": _bad_per_brand("missing_fields"),
    "rule_not_empty": _bad_per_brand("missing_kind"),
    "rule_duration": _bad_per_brand("invalid_duration"),
    "rule_condition": _bad_per_brand("inconsistent_duration"),
    "rule_condition_nulls": _d(
        """, c AS (SELECT brand, count(*) FILTER (WHERE asset_duration < ex_pause) AS consistency,
 count(*) FILTER (WHERE kind IS NULL AND start_date IS NOT NULL AND user_id <> 0) AS presence
 FROM d GROUP BY brand)
SELECT brand, 'consistency' AS error_type, '' AS error_column, consistency AS n_bad FROM c
WHERE consistency > 0
UNION ALL SELECT brand, 'presence', '', presence FROM c WHERE presence > 0"""
    ),
    "rule_status": _d(
        ", c AS (SELECT brand, count(*) AS n_rows, "
        + ", ".join(f"count(*) FILTER (WHERE {sql}) AS {name}" for name, sql in _E.items())
        + """ FROM d GROUP BY brand), r AS (
SELECT brand, n_rows, 'valid_types' AS rule_name, invalid_kinds AS n_bad FROM c
UNION ALL SELECT brand, n_rows, 'required_fields', missing_fields FROM c
UNION ALL SELECT brand, n_rows, 'date_validation', invalid_dates FROM c
UNION ALL SELECT brand, n_rows, 'duration_validation', invalid_duration FROM c
UNION ALL SELECT brand, n_rows, 'duration_consistency', inconsistent_duration FROM c
UNION ALL SELECT brand, n_rows, 'kind_existence', missing_kind FROM c
UNION ALL SELECT brand, n_rows, 'required_fields', NULL FROM c
UNION ALL SELECT brand, n_rows, 'device_presence', NULL FROM c)
SELECT brand, n_rows, rule_name,
 CASE WHEN n_bad IS NULL THEN 'SKIPPED' WHEN n_bad > 0 THEN 'FAILED' ELSE 'PASSED' END AS status, n_bad
FROM r"""
    ),
    "validation_report": _d(
        "SELECT event_id, brand, concat_ws(',', "
        + ", ".join(f"CASE WHEN {sql} THEN '{name}' END" for name, sql in _E.items())
        + f") AS errors FROM d WHERE {_ANY}"
    ),
    "error_details": _d(
        ", u AS ("
        + " UNION ALL ".join(
            f"SELECT brand, '{kind}' AS error_type, '{column}' AS error_column FROM d WHERE {sql}"
            for kind, column, sql in (
                ("invalid_kinds", "", _E["invalid_kinds"]),
                ("missing_fields", "kind", _E["missing_kind"]),
                ("missing_fields", "start_date", "(start_date IS NULL OR start_date = '')"),
                ("invalid_dates", "start_date", _E["invalid_dates"]),
                ("invalid_duration", "", _E["invalid_duration"]),
                ("inconsistent_duration", "", _E["inconsistent_duration"]),
                ("missing_kind", "", _E["missing_kind"]),
            )
        )
        + """) SELECT brand, error_type, error_column, count(*) AS n_bad FROM u
GROUP BY brand, error_type, error_column"""
    ),
    "error_rows_top100": _d(
        f"""SELECT brand, event_id, CAST(row_rank AS INTEGER) AS row_rank FROM (SELECT brand, event_id,
 row_number() OVER (PARTITION BY brand ORDER BY event_id) AS row_rank FROM d WHERE {_ANY})
WHERE row_rank <= 100"""
    ),
    "silver_log": f"""WITH {_DIRTY}, c AS (SELECT *, {_FLAGS}, row_number() OVER (
  PARTITION BY brand, filedate, user_id ORDER BY event_id) > 1 AS duplicate_users FROM d),
a AS (SELECT brand, filedate, count(*) AS rows_total,
  count(*) FILTER (WHERE {" OR ".join(_E)} OR duplicate_users) AS rows_ko,
  concat_ws(',', CASE WHEN bool_or(duplicate_users) THEN 'duplicate_users' END,
  """
    + ", ".join(f"CASE WHEN bool_or({e}) THEN '{e}' END" for e in sorted(_E))
    + """) AS cols_error, concat_ws(',',
 '"invalid_kinds":' || nullif(count(*) FILTER (WHERE invalid_kinds), 0),
 '"missing_fields":{' || nullif(concat_ws(',', '"kind":' || nullif(count(*) FILTER (WHERE missing_kind), 0),
   '"start_date":' || nullif(count(*) FILTER (WHERE start_date IS NULL OR start_date = ''), 0)), '') || '}',
 '"invalid_dates":{"start_date":' || nullif(count(*) FILTER (WHERE invalid_dates), 0) || '}',
 '"invalid_duration":' || nullif(count(*) FILTER (WHERE invalid_duration), 0),
 '"inconsistent_duration":' || nullif(count(*) FILTER (WHERE inconsistent_duration), 0),
 '"missing_kind":' || nullif(count(*) FILTER (WHERE missing_kind), 0),
 '"duplicate_users":' || nullif(count(*) FILTER (WHERE duplicate_users), 0)) AS detail
 FROM c GROUP BY brand, filedate)
SELECT brand, filedate, rows_total, rows_total - rows_ko AS rows_ok, rows_ko, cols_error,
 CASE WHEN rows_ko = 0 THEN 'OK' ELSE 'KO' END AS status,
 CASE WHEN rows_ko = 0 THEN '{"info":"No additional details"}' ELSE '{' || detail || '}' END AS details
FROM a""",
    "gold_log": f"WITH {_DIRTY},"
    + _gold("brand", "user_id, filedate", _E, 8, 2, "d")
    + f" SELECT *, coalesce({_CODE}, brand) AS brand_code FROM g",
    "gold_record": f"WITH {_DIRTY},"
    + _gold("brand", "user_id, filedate", _E, 8, 2, "d")
    + """ SELECT *, '' AS reseller, CAST(1 AS BIGINT) AS brands_aggregated,
 CAST(0 AS BIGINT) AS records_warning, records_after_agg AS rows_inserted,
 CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_rejected,
 CASE WHEN status = 'OK' THEN '' ELSE checks_failed || ' checks failed with ' || records_error
   || ' records in error' END AS error_message,
 '{"validation_error_count":' || checks_failed || ',"total_error_count":' || records_error || '}'
   AS business_checks_details,
 '{"records_before":' || records_before_agg || ',"records_after":' || records_after_agg
   || ',"duplicates_removed":' || duplicates_removed || '}' AS aggregation_details,
 '{"rows_inserted":' || records_after_agg || ',"rows_updated":0,"rows_rejected":0}' AS loading_details
FROM g""",
    "gold_log_uniqueness": f"WITH {_DIRTY},"
    + _gold(
        "brand",
        "user_id, filedate",
        {
            "invalid_kinds": _E["invalid_kinds"],
            "duplicate_users": "(row_number() OVER (PARTITION BY brand, user_id ORDER BY event_id) > 1)",
        },
        2,
        0,
        "d",
    )
    + " SELECT * FROM g",
    "dq_by_table": _DQ + " SELECT * FROM q",
    "dq_gate": _GATE + " SELECT * FROM w",
    "dq_gate_overall": _DQ
    + """, o AS (SELECT CAST(sum(total_records) AS BIGINT) AS total_records,
 CAST(sum(error_records) AS BIGINT) AS error_records,
 CAST(sum(error_records) AS DOUBLE) / CAST(sum(total_records) AS DOUBLE) * 100 AS error_percentage FROM q)
SELECT *, CASE WHEN error_percentage > 5 THEN 'ERROR' ELSE 'OK' END AS status,
 CASE WHEN error_percentage > 5 THEN 'DATA QUALITY ERROR: Overall error rate is '
   || printf('%.2f', error_percentage) || '%, exceeding threshold of 5.0%'
  ELSE 'Data quality acceptable: Error rate ' || printf('%.2f', error_percentage) || '%' END AS message
FROM o""",
    "dq_alerts": _GATE
    + """ SELECT date_folder, status AS alert_type, message,
 '{"message":"' || message || '","severity":"' || status || '"}' AS details FROM w WHERE status <> 'OK'""",
    "run_log": _GATE
    + f""", r AS (SELECT {_DAY} AS date_folder, min(ts) AS s, max(ts) AS e, min(event_id) AS id
 FROM events GROUP BY 1)
SELECT CAST(id AS VARCHAR) AS process_id, r.date_folder,
 CAST(floor((epoch_us(e) - epoch_us(s)) / 1000000) AS BIGINT) AS duration_seconds,
 CASE w.status WHEN 'ERROR' THEN 'WARNING' WHEN 'WARNING' THEN 'SUCCESS_WITH_WARNINGS'
  ELSE 'SUCCESS' END AS status,
 CAST(7 AS BIGINT) AS tables_processed,
 CAST(CASE w.status WHEN 'ERROR' THEN 0 WHEN 'WARNING' THEN 4 ELSE 7 END AS BIGINT) AS tables_success,
 CAST(CASE w.status WHEN 'ERROR' THEN 7 WHEN 'WARNING' THEN 3 ELSE 0 END AS BIGINT) AS tables_warning,
 CAST(0 AS BIGINT) AS tables_error, total_records, total_records - error_records AS valid_records,
 error_records, CASE WHEN w.status = 'OK' THEN '' ELSE message END AS error_message,
 'landing_to_silver,silver_to_gold' AS steps_completed,
 '{{"status":"' || w.status || '","message":"' || message || '"}}' AS processing_details
FROM r JOIN w ON w.date_folder = r.date_folder""",
    "raw_log": f"""WITH {_FILES}, g AS (SELECT brand, filedate, count(DISTINCT table_name) AS n,
 list(DISTINCT table_name) AS present FROM f GROUP BY brand, filedate)
SELECT brand, filedate, n AS file_count, CAST(0 AS BIGINT) AS unexpected_count, CASE WHEN n = 5 THEN 'OK' ELSE 'Partial' END AS status,
 array_to_string(list_filter(['signup', 'purchase', 'view', 'click', 'error'],
  lambda x: NOT list_contains(present, x)), ',') AS missing_tables,
 '{{"files_present":' || n || ',"tables":{{' || array_to_string(list_transform(
  ['signup', 'purchase', 'view', 'click', 'error'], lambda x: '"' || x || '":{{"status":"'
  || CASE WHEN list_contains(present, x) THEN 'OK' ELSE 'NoK' END || '"}}'), ',') || '}}}}' AS details
FROM g""",
    "files_per_table_date": f"""WITH {_FILES}
SELECT filedate, table_name, count(*) AS n_files FROM f GROUP BY filedate, table_name""",
    "tables_per_date": f"""WITH {_FILES}
SELECT filedate, count(DISTINCT table_name) AS tables_processed, count(*) AS n_files
FROM f GROUP BY filedate""",
    "config_aggregate": f"""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity_sum, avg(l_quantity) AS l_quantity_mean,
 min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max, count(l_quantity) AS l_quantity_count,
 count(*) AS l_quantity_size, count(DISTINCT l_suppkey) AS l_suppkey,
 arg_min(l_partkey, {_LINE_ROW}) AS l_partkey_first, arg_max(l_partkey, {_LINE_ROW}) AS l_partkey_last
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "config_aggregate_nulls": _d(
        """SELECT kind, brand, CAST(sum(ex_pause) AS BIGINT) AS ex_pause_sum, count(ex_pause) AS ex_pause_count,
 CAST(median(ex_pause) AS DOUBLE) AS ex_pause_median,
 arg_min(start_date, event_id) FILTER (WHERE start_date IS NOT NULL) AS start_date_first,
 count(DISTINCT start_date) AS start_date_nunique
FROM d WHERE kind IS NOT NULL GROUP BY kind, brand"""
    ),
    "config_aggregate_stats": """
SELECT event_type, round(median(value), 4) AS value_median, round(stddev_samp(value), 4) AS value_std,
 round(var_samp(value), 4) AS value_var FROM events GROUP BY event_type""",
    "exact_median": """
SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS median FROM lineitem
GROUP BY l_returnflag, l_linestatus""",
    "processed_dates": _DONE + " SELECT filedate FROM done",
    "ledger_latest": f"""WITH {_LEDGER}
SELECT filedate, arg_max(status, processed_at) AS status, max(processed_at) AS last_processed
FROM l GROUP BY filedate""",
    "ledger_sticky": f"""WITH {_LEDGER}
SELECT filedate, CASE WHEN bool_or(status = 'failed') THEN 'failed'
 ELSE arg_max(status, processed_at) END AS status, max(processed_at) AS last_processed
FROM l GROUP BY filedate""",
    "pending_dates": _DONE
    + """ SELECT filedate FROM (SELECT DISTINCT filedate FROM l
WHERE filedate BETWEEN '20240111' AND '20240130' EXCEPT SELECT filedate FROM done) ORDER BY filedate""",
    "date_window_intersect": f"""WITH {_FILES}
SELECT DISTINCT filedate FROM f WHERE filedate BETWEEN '20240121' AND '20240130'""",
    "latest_n_dates": f"""WITH {_FILES}
SELECT filedate FROM (SELECT DISTINCT filedate FROM f ORDER BY filedate DESC LIMIT 7) ORDER BY filedate""",
    "late_files": f"""WITH {_FILES}
SELECT filedate, table_name, count(*) AS n_files FROM f WHERE filedate < '20240128'
GROUP BY filedate, table_name""",
    "latest_file_per_group": _d(
        """SELECT brand, filedate, table_name, event_id, user_id FROM (SELECT *, row_number() OVER (
 PARTITION BY brand, filedate, table_name ORDER BY event_id DESC) AS rn FROM d) WHERE rn = 1"""
    ),
    "retention_plan": f"""WITH {_FILES}
SELECT filedate, count(*) AS n_rows, CASE WHEN filedate < '20240120' THEN 'expire' ELSE 'keep' END AS action
FROM f GROUP BY filedate""",
    "retained_rows": _d("SELECT event_id, filedate FROM d WHERE filedate >= '20240120'"),
    "cleanup_candidates": _DONE
    + """ SELECT filedate, count(*) AS n_rows FROM l WHERE filedate IN (SELECT filedate FROM done)
GROUP BY filedate""",
    "medallion_roundtrip": _d(
        """SELECT filedate AS part_date,
 regexp_replace(regexp_replace(lower(brand), '\\s+', '_', 'g'), '[^a-z0-9_]', '', 'g') AS brand_slug,
 count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM d GROUP BY 1, 2"""
    ),
}
