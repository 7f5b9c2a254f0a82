"""SQL for ``file_queries.py``: what the files must hold after loading."""

from __future__ import annotations

from millrace.checks.file_queries import TYPED_VALUES, kind_of
from millrace.checks.oracle import ORACLE
from millrace.sources import schemas

_STOP = """
    SELECT date_trunc('second', ts) AS stamp, 'ﾊﾝｶｸ' || user_id AS code, 'line,' || event_type AS line,
           length(event_type)::DECIMAL(1,0) AS state, (props->>'$.k')::DECIMAL(3,0) AS factor
    FROM events"""
_BAD_COLUMN = "要因No."
_WIDE = """
    WITH w AS (
      SELECT l_shipdate AS stamp, l_orderkey::VARCHAR AS order_text, l_linenumber::VARCHAR AS line_text,
             l_quantity::DECIMAL(18,0) AS quantity, unnest([
               {'k': 'T不良_01', 'v': l_extendedprice::DECIMAL(18,2)::VARCHAR},
               {'k': 'T不良_02', 'v': CASE WHEN l_tax > 0.035 THEN l_partkey::VARCHAR END},
               {'k': 'T不良_04', 'v': '-' || l_suppkey}]) AS e
      FROM lineitem)
    SELECT stamp, order_text, line_text, quantity, e.k AS defect_name, e.v::DECIMAL(18,0) AS defect_value,
           e.v AS defect_value_raw
    FROM w WHERE e.v IS NOT NULL"""

# good datasets log one load, the spoilt one logs each of the given steps; only good rows are in the table
_RUN = """
    WITH e AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
    steps(clock, status) AS (VALUES {statuses})
    SELECT 'log' AS part, CASE WHEN event_type = 'error' THEN ('2024-02-01 ' || clock || ':00')::TIMESTAMP
                ELSE TIMESTAMP '2024-02-01 09:05:00' END AS run_at,
           event_type AS dataset, CASE WHEN event_type = 'error' THEN status ELSE 'LOADED' END AS status,
           event_type = 'error' AS error_flag, CASE WHEN event_type = 'error' THEN n ELSE 0 END AS n
    FROM e JOIN steps ON event_type = 'error' OR (clock = '09:05' AND status = 'LOAD_FAILED')
    UNION ALL
    SELECT 'history', ('2024-02-01 ' || clock || ':00')::TIMESTAMP, event_type,
           CASE WHEN event_type = 'error' THEN 'LOAD_FAILED' ELSE 'LOADED' END, NULL, CASE WHEN event_type = 'error' THEN 0 ELSE n END
    FROM e JOIN steps ON status = 'LOAD_FAILED' AND (event_type = 'error' OR clock = '09:05')
    UNION ALL
    SELECT 'table', NULL, event_type, NULL, NULL, n FROM e WHERE event_type <> 'error'"""



def _typed_log(name: str) -> str:
    def value(kind) -> str:
        sql = TYPED_VALUES[kind_of(kind)][1]
        return f"{sql}::{kind.simpleString()}" if kind_of(kind) == "decimal" else sql

    return "SELECT " + ", ".join(f'{value(k)} AS "{n}"' for n, k in schemas.columns(name)) + " FROM lineitem"


FILE_ORACLE = {
    "typed_load": _STOP,
    "full_refresh": _STOP,
    "file_outcomes": f"""
        SELECT event_type AS kind, CASE WHEN event_type = 'error' THEN 'LOAD_FAILED' ELSE 'LOADED' END AS status,
               count(*) AS rows_parsed, CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS rows_loaded,
               CASE WHEN event_type = 'error' THEN count(*) ELSE 0 END AS errors_seen,
               CASE WHEN event_type = 'error' THEN '{_BAD_COLUMN}' END AS bad_column,
               CASE WHEN event_type = 'error' THEN 2::BIGINT END AS first_line
        FROM events GROUP BY event_type""",
    "rows_of_good_files": f"{_STOP} WHERE event_type <> 'error'",
    "validation_errors": f"""
        SELECT '''x' || (props->>'$.k') || ''' is not a valid decimal(3,0)' AS error, '{_BAD_COLUMN}' AS column_name,
               NULL::BIGINT AS "at",
               strftime(ts, '%Y/%m/%d %H:%M:%S') || ',ﾊﾝｶｸ' || user_id || ',"line,error",5,x' || (props->>'$.k') AS rejected_record
        FROM events WHERE event_type = 'error'""",
    "pending_files": """
        WITH f AS (SELECT DISTINCT 'o' || l_orderkey || '.csv' AS file, l_linenumber::BIGINT AS file_size,
                          date_trunc('month', l_shipdate)::TIMESTAMP AS stamp, l_linestatus FROM lineitem)
        SELECT file, file_size, stamp FROM f GROUP BY file, file_size, stamp
        HAVING bool_or(l_linestatus = 'O') AND NOT bool_or(l_linestatus = 'F' AND file_size <= 5)""",
    "quoted_lines": """
        SELECT date_trunc('second', ts) AS stamp,
               CASE WHEN event_type = 'click' THEN 'N' || user_id
                    ELSE 'N' || user_id || chr(10) || 'says "' || event_type || '", then' || chr(10) || chr(10) || 'ends' END AS code,
               'line,' || event_type AS line, length(event_type)::DECIMAL(1,0) AS state, (props->>'$.k')::DECIMAL(3,0) AS factor
        FROM events""",
    "stream_redelivered": f"""
        SELECT way, defect_name, order_text, count(*) AS n, sum(defect_value)::DECIMAL(38,0) AS total, min(defect_value_raw) AS least, max(stamp) AS stamp
        FROM ({_WIDE}) CROSS JOIN (VALUES ('batch'), ('stream')) w(way) GROUP BY way, defect_name, order_text""",
    "wide_refresh": _WIDE,
    "stream_refresh": _WIDE,
    "odd_lines": """
        WITH e AS (SELECT event_type AS line, count(*) AS n, count(DISTINCT user_id) AS codes, min('N' || user_id) AS code,
                          sum(length(event_type))::BIGINT AS states, sum((props->>'$.k')::BIGINT)::BIGINT AS factors
                   FROM events GROUP BY event_type)
        SELECT line, CASE WHEN bad THEN 'LOAD_FAILED' ELSE 'LOADED' END AS status, CASE WHEN bad THEN 0 ELSE n END AS rows_loaded,
               CASE WHEN bad THEN n ELSE 0 END AS errors_seen, CASE WHEN bad THEN 'line does not have 5 columns' END AS first_error,
               CASE WHEN NOT bad THEN n END AS n, CASE WHEN NOT bad THEN codes END AS codes, CASE WHEN NOT bad THEN code END AS code,
               CASE WHEN NOT bad THEN states END AS states, CASE WHEN NOT bad THEN factors END AS factors
        FROM (SELECT *, line IN ('click', 'view') AS bad FROM e)""",
    **{f"typed_{name.lower()}": _typed_log(name) for name in ("MC_LOG", "PROD_LOG", "REEL_LOG")},
    "job_results": """
        SELECT 'no files' AS job, 'OK' AS answer, 'Copy executed with 0 files processed.' AS copy_status, NULL::INTEGER AS code
        UNION ALL VALUES ('load type', 'INVALID_LOAD_TYPE', NULL, -20001), ('target', 'INVALID_TARGET', NULL, -20002),
            ('table', 'TABLE_NOT_FOUND', NULL, -20003), ('good files', 'OK', 'LOADED', NULL), ('bad files', 'WARN', 'LOAD_FAILED', NULL),
            ('bad rows', 'BAD_ROWS', NULL, NULL), ('no system', 'RECOVERY DONE: 0', NULL, NULL)
        UNION ALL SELECT 'datasets', 'DONE: ' || count(DISTINCT event_type) || ' dataset(s)', NULL, NULL FROM events
        UNION ALL SELECT 'recovery', 'RECOVERY DONE: ' || count(DISTINCT event_type), NULL, NULL FROM events WHERE event_type = 'error'""",
    "wide_spoilt": """
        SELECT way, line, CASE WHEN line = 'L1' THEN 'LOADED' ELSE 'LOAD_FAILED' END AS status, count(*) AS rows_parsed,
               CASE WHEN line = 'L1' THEN count(*) ELSE 0 END AS rows_loaded, CASE WHEN line = 'L1' THEN 0 ELSE count(*) END AS errors_seen,
               CASE WHEN line = 'L1' THEN count(*) END AS n, CASE WHEN line = 'L1' THEN count(*) END AS places,
               CASE WHEN line = 'L1' THEN 1::BIGINT END AS first_row
        FROM lineitem CROSS JOIN (VALUES ('batch'), ('stream')) w(way) CROSS JOIN (VALUES ('L1'), ('L2')) l(line) GROUP BY way, line""",
    "dataset_run": _RUN.format(statuses="('09:05', 'LOAD_FAILED'), ('09:05', 'VALIDATION_ERROR')"),
    "recovery_queue_kept": ORACLE["recovery_queue"],
    "recovery_run": _RUN.format(
        statuses="('09:05', 'LOAD_FAILED'), ('09:05', 'VALIDATION_ERROR'), ('10:00', 'LOAD_FAILED')"
    ),
}
