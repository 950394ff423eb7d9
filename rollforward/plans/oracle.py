"""The catalogue's queries as DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

CIRC = """
WITH circ AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_partkey END AS circuit_id,
         CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE l_linenumber END AS section_id,
         l_extendedprice AS n_voltage_kv, l_quantity AS f_voltage_kv,
         l_discount AS f_max_hc, l_tax AS f_min_hc,
         CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS f_hca_date,
         l_quantity AS shape_length,
         CAST(year(l_shipdate) - 1995 AS INTEGER) AS version,
         sha256(concat_ws('||', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate)) AS row_hash
  FROM lineitem)
"""
DIRTY = CIRC + """
, dirty AS (SELECT * FROM circ UNION ALL SELECT * FROM circ WHERE substr(row_hash, 1, 1) = '0'),
fd AS (SELECT *, row_number() OVER (PARTITION BY row_hash ORDER BY version) AS copy_no FROM dirty)
"""
DQ = DIRTY + """
, kn AS (SELECT *, row_number() OVER (PARTITION BY circuit_id, section_id, version
         ORDER BY CASE WHEN copy_no > 1 THEN 1 ELSE 0 END, row_hash) AS key_no FROM fd),
dq AS (SELECT circuit_id, section_id, version, f_hca_date, shape_length, row_hash,
  CASE WHEN circuit_id IS NULL THEN 'null:circuit_id' WHEN section_id IS NULL THEN 'null:section_id'
       WHEN copy_no > 1 THEN 'full_duplicate' WHEN key_no > 1 THEN 'duplicate_key' END AS reject_reason
  FROM kn)
"""
MEASURES = """max(n_voltage_kv) AS normal_voltage, max(f_voltage_kv) AS feeder_voltage,
  max(f_max_hc) AS feeder_max_hc, min(f_min_hc) AS feeder_min_hc,
  max(f_hca_date) AS hca_refresh_date, sum(shape_length) AS shape_length"""

PART = "(1::BIGINT << 20) - 1"


def digest(h: str) -> str:
    """The aggregate of a group's row hashes that is its fingerprint."""
    terms = []
    for start in (1, 16, 31, 46, 61):
        slice_ = f"CAST('0x' || substr({h}, {start}, 15) AS BIGINT)"
        shifts = (0, 20, 40) if start < 61 else (0,)  # 4 of the 64 digits are left for the last
        terms += [f"sum(({slice_} >> {shift}) & ({PART}))" for shift in shifts]
    return f"sha256(concat_ws('||', count(*), {', '.join(terms)}))"


EVENT_FILES = f"""
WITH fp AS (
  SELECT file_name, {digest('h')} AS file_hash FROM (
    SELECT concat_ws('-', CAST(ts AS DATE), user_id) AS file_name,
           sha256(concat_ws('||', event_type)) AS h FROM events)
  GROUP BY file_name)
"""
SNAPSHOTS = """
WITH o AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderstatus <> 'O'),
n AS (SELECT o_orderkey AS k,
        CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS v
      FROM orders WHERE o_orderstatus <> 'F'),
j AS (SELECT o.k AS ok, o.v AS ov, n.k AS nk, n.v AS nv FROM o FULL OUTER JOIN n ON o.k = n.k)
"""
DAILY = """
WITH f AS (SELECT CAST(ts AS DATE) AS seq, user_id AS k, max(event_type) AS v
           FROM events GROUP BY 1, 2),
ch AS (SELECT *, lag(v) OVER (PARTITION BY k ORDER BY seq) AS pv FROM f),
fold AS (SELECT k, max_by(v, seq) AS v, min(seq) AS load_seq,
           max(CASE WHEN pv IS NULL OR pv <> v THEN seq END) AS updated_seq FROM ch GROUP BY k)
"""
LINE_RANK = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax) AS row_num
  FROM lineitem)
"""
REPLAY = DIRTY + f"""
SELECT circuit_id, version, normal_voltage, feeder_voltage, feeder_max_hc, feeder_min_hc,
       hca_refresh_date, shape_length FROM (
  SELECT *, row_number() OVER (PARTITION BY circuit_id ORDER BY version DESC) AS rn FROM (
    SELECT version, circuit_id, {MEASURES} FROM (
      SELECT *, max(f_hca_date) OVER (PARTITION BY version, circuit_id) AS m FROM fd
      WHERE circuit_id IS NOT NULL AND section_id IS NOT NULL AND copy_no = 1)
    WHERE f_hca_date = m GROUP BY version, circuit_id))
WHERE rn = 1
"""
DROP_ALL = DIRTY + """
, counted AS (SELECT *, count(*) OVER (PARTITION BY row_hash) AS copies FROM dirty
  WHERE circuit_id IS NOT NULL AND section_id IS NOT NULL),
single AS (SELECT *, row_number() OVER (PARTITION BY circuit_id, section_id, version ORDER BY row_hash) AS key_no
  FROM counted WHERE copies = 1),
da AS (
  SELECT circuit_id, section_id, version, f_hca_date, shape_length, row_hash,
    CASE WHEN circuit_id IS NULL THEN 'null:circuit_id' ELSE 'null:section_id' END AS reject_reason
  FROM dirty WHERE circuit_id IS NULL OR section_id IS NULL
  UNION ALL SELECT DISTINCT circuit_id, section_id, version, f_hca_date, shape_length, row_hash, 'full_duplicate'
  FROM counted WHERE copies > 1
  UNION ALL SELECT circuit_id, section_id, version, f_hca_date, shape_length, row_hash,
    CASE WHEN key_no > 1 THEN 'duplicate_key' END FROM single)
"""
RAW_ROLLUP = """
SELECT CIRCUIT_ID AS circuit_id, version, normal_voltage, feeder_voltage, feeder_max_hc, feeder_min_hc,
       hca_refresh_date, shape_length FROM (
  SELECT *, row_number() OVER (PARTITION BY CIRCUIT_ID ORDER BY version DESC) AS rn FROM (
    SELECT version, CIRCUIT_ID, max(l_extendedprice) AS normal_voltage, max(l_quantity) AS feeder_voltage,
      max(l_discount) AS feeder_max_hc, min(l_tax) AS feeder_min_hc, max(l_shipdate) AS hca_refresh_date,
      sum(l_quantity) AS shape_length
    FROM (SELECT *, max(l_shipdate) OVER (PARTITION BY version, CIRCUIT_ID) AS m FROM typed)
    WHERE l_shipdate = m GROUP BY version, CIRCUIT_ID))
WHERE rn = 1
"""
RAW_COLUMNS = """l_partkey AS CIRCUIT_ID, l_linenumber, l_linestatus, l_returnflag, l_suppkey, l_extendedprice,
  l_discount, l_quantity, l_tax, l_shipdate"""
VERSIONS = "SELECT event_id, user_id, CAST(day(ts) - 1 AS INTEGER) AS version FROM events"
CURRENT = """SELECT event_type AS table_name, CAST(max(day(ts) - 1) AS BIGINT) AS current_version
FROM events GROUP BY event_type"""

ORACLE: dict[str, str] = {
    "table_scan": "SELECT * FROM orders",
    "csv_scan": "SELECT * FROM orders",
    "drop_index_column": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "change_range": VERSIONS + " WHERE day(ts) - 1 >= 20 + 1",
    "change_version": VERSIONS + " WHERE day(ts) - 1 = 7",
    "latest_version": CURRENT,
    "change_feed": SNAPSHOTS + """
SELECT nk AS k, nv AS v, 'insert' AS _change_type FROM j WHERE ok IS NULL
UNION ALL SELECT ok, ov, 'delete' FROM j WHERE nk IS NULL
UNION ALL SELECT ok, ov, 'update_preimage' FROM j WHERE ok = nk AND ov IS DISTINCT FROM nv
UNION ALL SELECT nk, nv, 'update_postimage' FROM j WHERE ok = nk AND ov IS DISTINCT FROM nv
""",
    "row_hash": """
SELECT l_orderkey, l_linenumber, l_suppkey,
  sha256(concat_ws('||', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS row_hash
FROM lineitem
""",
    "row_hash_null_safe": CIRC + """
SELECT row_hash AS id, sha256(concat_ws('||',
  coalesce(length(CAST(circuit_id AS VARCHAR)) || ':' || CAST(circuit_id AS VARCHAR), 'N'),
  coalesce(length(CAST(section_id AS VARCHAR)) || ':' || CAST(section_id AS VARCHAR), 'N'))) AS safe_hash
FROM circ
""",
    "file_fingerprint": f"""
SELECT file_name, {digest('h')} AS file_hash FROM (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS file_name,
         sha256(concat_ws('||', event_id, ts, user_id, event_type, value, props)) AS h FROM events)
GROUP BY file_name
""",
    "new_files": EVENT_FILES + """
SELECT file_name, file_hash FROM fp
WHERE file_hash NOT IN (SELECT file_hash FROM fp WHERE file_name < '2024-01-03')
""",
    "load_log": EVENT_FILES + """
SELECT min(file_name) AS file_name, file_hash, TIMESTAMP '2024-02-01 00:00:00' AS load_time
FROM fp GROUP BY file_hash
""",
    "dedup_row_hash": "SELECT DISTINCT sha256(concat_ws('||', text)) AS row_hash, text FROM documents",
    "upsert_changed": SNAPSHOTS + """
SELECT coalesce(ok, nk) AS k, CASE WHEN nk IS NULL THEN ov ELSE nv END AS v,
  CASE WHEN ok IS NULL THEN '2' ELSE '1' END AS load_seq,
  CASE WHEN ok IS NULL OR ov <> nv THEN '2' ELSE '1' END AS updated_seq FROM j
""",
    "upsert_changes": SNAPSHOTS + """
SELECT nk AS k, nv AS v, '2' AS load_seq, '2' AS updated_seq, 'insert' AS _change_type
  FROM j WHERE ok IS NULL
UNION ALL SELECT ok, ov, '1', '1', 'update_preimage' FROM j WHERE ok = nk AND ov <> nv
UNION ALL SELECT nk, nv, '1', '2', 'update_postimage' FROM j WHERE ok = nk AND ov <> nv
""",
    "insert_only_merge": """
WITH e AS (SELECT event_id, day(ts) > 15 AS late,
             sha256(concat_ws('||', user_id, event_type)) AS row_hash FROM events),
t AS (SELECT event_id, row_hash FROM e WHERE NOT late),
s AS (SELECT min(event_id) AS event_id, row_hash FROM e WHERE late GROUP BY row_hash)
SELECT event_id, row_hash FROM t
UNION ALL SELECT event_id, row_hash FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.row_hash = s.row_hash)
""",
    "merge_update_all": """
WITH t AS (SELECT l_partkey, l_linenumber, sum(l_quantity) AS q FROM lineitem
           WHERE l_linestatus = 'F' GROUP BY 1, 2),
s AS (SELECT l_partkey, l_linenumber, sum(l_quantity) AS q FROM lineitem
      WHERE l_linestatus <> 'F' GROUP BY 1, 2)
SELECT coalesce(s.l_partkey, t.l_partkey) AS l_partkey,
       coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber, coalesce(s.q, t.q) AS q
FROM t FULL OUTER JOIN s ON t.l_partkey = s.l_partkey AND t.l_linenumber = s.l_linenumber
""",
    "upsert_fold": DAILY + """
SELECT k, v, CAST(load_seq AS VARCHAR) AS load_seq, CAST(updated_seq AS VARCHAR) AS updated_seq
FROM fold
""",
    "insert_only_fold": """
SELECT sha256(concat_ws('||', user_id, event_type)) AS row_hash,
       CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS load_seq
FROM events GROUP BY 1
""",
    "ingest_keyed": DAILY + """
SELECT k, v, 'first-' || CAST(load_seq AS VARCHAR) AS load_file,
       'first-' || CAST(updated_seq AS VARCHAR) AS updated_file FROM fold
""",
    "ingest_keyless": """
SELECT sha256(concat_ws('||', user_id, event_type)) AS row_hash,
       'first-' || CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS load_file
FROM events GROUP BY 1
""",
    "load_csv": SNAPSHOTS + """
SELECT k, v, sha256(concat_ws('||', k, v)) AS row_hash, load_datetime, updated_datetime FROM (
  SELECT coalesce(ok, nk) AS k, CASE WHEN nk IS NULL THEN ov ELSE nv END AS v,
    CASE WHEN ok IS NULL THEN '2024-01-02 00:00:00' ELSE '2024-01-01 00:00:00' END AS load_datetime,
    CASE WHEN ok IS NULL OR ov <> nv THEN '2024-01-02 00:00:00' ELSE '2024-01-01 00:00:00' END
      AS updated_datetime
  FROM j)
""",
    "load_changes": SNAPSHOTS + """
SELECT ok AS k, ov AS v, 0 AS version, 'insert' AS _change_type FROM j WHERE ok IS NOT NULL
UNION ALL SELECT nk, nv, 1, 'insert' FROM j WHERE ok IS NULL
UNION ALL SELECT ok, ov, 1, 'update_preimage' FROM j WHERE ok = nk AND ov <> nv
UNION ALL SELECT nk, nv, 1, 'update_postimage' FROM j WHERE ok = nk AND ov <> nv
""",
    "load_folder": """
SELECT o_orderkey AS k,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS v,
  CASE WHEN o_orderkey % 97 = 0 THEN 'bad_cast:v' END AS reject_reason
FROM orders
""",
    "load_csv_keyless": """
SELECT user_id, event_type, sha256(concat_ws('||', user_id, event_type)) AS row_hash,
  CASE WHEN min(day(ts)) > 15 THEN '2024-01-02 00:00:00' ELSE '2024-01-01 00:00:00' END AS load_datetime
FROM events GROUP BY user_id, event_type
""",
    "load_stamp": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS load_datetime,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_datetime FROM events
""",
    "rename_cast": """
SELECT TRY_CAST(CAST(l_partkey AS VARCHAR) AS BIGINT) AS CIRCUIT_ID,
  CAST(l_linenumber AS INTEGER) AS NUM_PHASES, l_linestatus AS OVERUNDER,
  l_returnflag AS PHASES_PRESENT, CAST(l_linenumber AS BIGINT) AS SECTION_ID,
  l_suppkey AS N_FEEDER_ID, l_extendedprice AS N_VOLTAGE_KV,
  TRY_CAST(CASE WHEN l_discount = 0 THEN 'none' ELSE CAST(l_discount AS VARCHAR) END AS DOUBLE) AS N_MAX_HC,
  l_returnflag AS N_MAP_COLOR, l_suppkey AS F_FEEDER_ID, l_quantity AS F_VOLTAGE_KV,
  l_discount AS F_MAX_HC, l_tax AS F_MIN_HC,
  TRY_CAST(CAST(l_shipdate AS VARCHAR) AS TIMESTAMP) AS F_HCA_DATE,
  l_linestatus AS F_NOTES, l_quantity AS SHAPE_LENGTH FROM lineitem
""",
    "conform_schema": """
SELECT l_partkey AS CIRCUIT_ID, CAST(NULL AS INTEGER) AS NUM_PHASES,
  CAST(NULL AS VARCHAR) AS OVERUNDER, CAST(NULL AS VARCHAR) AS PHASES_PRESENT,
  CAST(l_linenumber AS BIGINT) AS SECTION_ID, CAST(NULL AS BIGINT) AS N_FEEDER_ID,
  CAST(NULL AS DOUBLE) AS N_VOLTAGE_KV, CAST(NULL AS DOUBLE) AS N_MAX_HC,
  CAST(NULL AS VARCHAR) AS N_MAP_COLOR, CAST(NULL AS BIGINT) AS F_FEEDER_ID,
  l_quantity AS F_VOLTAGE_KV, CAST(NULL AS DOUBLE) AS F_MAX_HC, l_tax AS F_MIN_HC,
  l_shipdate AS F_HCA_DATE, l_returnflag AS F_NOTES, CAST(NULL AS DOUBLE) AS SHAPE_LENGTH
FROM lineitem
""",
    "conform_summary": """
SELECT l_partkey AS CIRCUIT_ID, l_quantity AS F_VOLTAGE_KV, CAST(NULL AS DOUBLE) AS F_MAX_HC,
  l_tax AS F_MIN_HC, l_shipdate AS F_HCA_DATE, CAST(NULL AS DOUBLE) AS SHAPE_LENGTH
FROM lineitem
""",
    "pk_violations": """
SELECT CASE WHEN k IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS violation,
       CAST(k AS VARCHAR) AS k, n FROM (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_orderkey END AS k, count(*) AS n
  FROM lineitem GROUP BY 1) WHERE k IS NULL OR n > 1
""",
    "dq_null_rejects": CIRC + """
SELECT row_hash, CASE WHEN circuit_id IS NULL THEN 'null:circuit_id' ELSE 'null:section_id' END AS reason
FROM circ WHERE circuit_id IS NULL OR section_id IS NULL
""",
    "dq_full_dups_drop_all": "SELECT lang, text FROM documents GROUP BY ALL HAVING count(*) = 1",
    "dq_full_dups_rejected": "SELECT lang, text FROM documents GROUP BY ALL HAVING count(*) > 1",
    "dq_pk_first": LINE_RANK + "WHERE row_num = 1",
    "dq_pk_rest": LINE_RANK + "WHERE row_num > 1",
    "dq_clean": DQ + """
SELECT circuit_id, section_id, version, f_hca_date, shape_length, row_hash
FROM dq WHERE reject_reason IS NULL
""",
    "dq_rejected": DQ + "SELECT row_hash, reject_reason FROM dq WHERE reject_reason IS NOT NULL",
    "dq_summary": DQ + """
SELECT coalesce(reject_reason, 'clean') AS outcome, count(*) AS n FROM dq GROUP BY 1
""",
    "dq_clean_two_step": DIRTY + """
SELECT circuit_id, section_id, row_hash FROM fd
WHERE circuit_id IS NOT NULL AND section_id IS NOT NULL AND copy_no = 1
""",
    "dq_rejected_two_step": DIRTY + """
SELECT row_hash, CASE WHEN circuit_id IS NULL THEN 'null:circuit_id'
  WHEN section_id IS NULL THEN 'null:section_id' ELSE 'duplicate_key' END AS reject_reason
FROM fd WHERE circuit_id IS NULL OR section_id IS NULL OR copy_no > 1
""",
    "dq_clean_drop_all": DROP_ALL + """
SELECT circuit_id, section_id, version, f_hca_date, shape_length, row_hash FROM da WHERE reject_reason IS NULL
""",
    "dq_rejected_drop_all": DROP_ALL + "SELECT row_hash, reject_reason FROM da WHERE reject_reason IS NOT NULL",
    "dq_summary_drop_all": DROP_ALL + """
SELECT coalesce(reject_reason, 'clean') AS outcome, count(*) AS n FROM da GROUP BY 1
""",
    "latest_with_ties": CIRC + """
SELECT circuit_id, CAST(section_id AS VARCHAR) AS section_id, f_hca_date, row_hash FROM (
  SELECT *, max(f_hca_date) OVER (PARTITION BY circuit_id) AS m FROM circ
  WHERE circuit_id IS NOT NULL) WHERE f_hca_date = m
""",
    "circuit_rollup": CIRC + f"""
SELECT circuit_id, {MEASURES} FROM (
  SELECT *, max(f_hca_date) OVER (PARTITION BY circuit_id) AS m FROM circ
  WHERE circuit_id IS NOT NULL AND section_id IS NOT NULL)
WHERE f_hca_date = m GROUP BY circuit_id
""",
    "section_rollup": CIRC + f"""
SELECT circuit_id, section_id, {MEASURES} FROM (
  SELECT *, max(f_hca_date) OVER (PARTITION BY circuit_id, section_id) AS m FROM circ
  WHERE circuit_id IS NOT NULL AND section_id IS NOT NULL)
WHERE f_hca_date = m GROUP BY circuit_id, section_id
""",
    "incremental_replay": REPLAY,
    "incremental_resume": REPLAY,
    "incremental_run": REPLAY,
    "stream_replay": REPLAY,
    "reset_replay": REPLAY,
    "run_rejects": DIRTY + """
SELECT row_hash, version, CASE WHEN circuit_id IS NULL THEN 'null:circuit_id'
  WHEN section_id IS NULL THEN 'null:section_id' ELSE 'duplicate_key' END AS reject_reason
FROM fd WHERE circuit_id IS NULL OR section_id IS NULL OR copy_no > 1
""",
    "run_watermark": """
SELECT 'feed' AS table_name, CAST(max(year(l_shipdate) - 1995) AS BIGINT) AS last_processed_version FROM lineitem
""",
    "files_to_rollup": f"""
WITH typed AS (
  SELECT DISTINCT {RAW_COLUMNS}, CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS version FROM lineitem)
""" + RAW_ROLLUP,
    "stream_run": f"""
WITH hashed AS (
  SELECT {RAW_COLUMNS}, CAST(year(l_shipdate) - 1995 AS INTEGER) AS version,
    sha256(concat_ws('||', l_partkey, l_linenumber, l_linestatus, l_returnflag, l_linenumber, l_suppkey, l_extendedprice,
      CASE WHEN l_discount = 0 THEN 'none' ELSE CAST(l_discount AS VARCHAR) END, l_returnflag, l_suppkey, l_quantity,
      l_discount, l_tax, l_shipdate, l_linestatus, l_quantity)) AS row_hash
  FROM lineitem WHERE l_linenumber NOT IN (6, 7)
), typed AS (
  SELECT * FROM hashed QUALIFY row_number() OVER (
    PARTITION BY version, CIRCUIT_ID, l_linenumber, l_shipdate ORDER BY l_quantity, row_hash) = 1)
""" + RAW_ROLLUP,
    "version_watermark": f"""
WITH cur AS ({CURRENT}),
seen AS (SELECT event_type AS table_name, CAST(max(day(ts) - 1) AS BIGINT) AS v FROM events
         WHERE event_type IN ('click', 'view') AND day(ts) - 1 <= 9 GROUP BY event_type)
SELECT cur.table_name, coalesce(seen.v, CAST(-1 AS BIGINT)) AS last_processed_version, current_version
FROM cur LEFT JOIN seen ON cur.table_name = seen.table_name
""",
}

ORACLE["change_feed_by_parts"] = ORACLE["change_feed"]
