"""DuckDB SQL equivalents of the catalogue, over the supplied tables as
views. Each statement restates the stand-in mapping of ``standins.py``
and the operator's meaning in plain SQL (window functions where the Spark
side uses aggregates or bucketed carry-forward), so agreement checks the
operator, not a copy of its plan."""

from __future__ import annotations

_OP = "CASE event_id % 4 WHEN 3 THEN 'delete' WHEN 2 THEN 'update' ELSE 'insert' END"

_RULES = """
rules(source_table, operate_type, sink_type, sink_table, sink_columns, pk_column) AS (
  VALUES ('purchase', 'insert', 'kafka', 'dwd_purchase', 'id,k', ''),
         ('purchase', 'update', 'KAFKA', 'dwd_purchase', 'id,k', NULL),
         ('view', 'insert', 'kafka', 'dwd_view', 'id, k', NULL),
         ('signup', 'insert', 'hbase', 'dim_user', 'id,k', ' '),
         ('signup', 'update', 'HBASE', 'dim_user', ' id , k ', 'id'))"""

_CDC = f"""
cdc AS (
  SELECT event_id, user_id, ts, event_type AS table_name, {_OP} AS op,
         json_extract_string(props, '$.k') AS k
  FROM events
  WHERE event_type IS NOT NULL AND props IS NOT NULL AND length(props) > 3)"""

_ROUTED = f"""
WITH {_RULES},
{_CDC},
routed AS (
  SELECT c.*, r.sink_table,
         CASE lower(r.sink_type) WHEN 'kafka' THEN 'fact' WHEN 'hbase' THEN 'dim' END AS route,
         coalesce(nullif(trim(r.pk_column), ''), 'id') AS pk_column,
         array_to_string(list_filter(list_transform(string_split(r.sink_columns, ','), lambda x: trim(x)),
                                     lambda x: x <> ''), ',') AS sink_columns
  FROM cdc c LEFT JOIN rules r ON c.table_name = r.source_table AND c.op = r.operate_type)"""

_FLAGGED = """
WITH e AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS part_id,
         CASE WHEN event_type = 'error' THEN '0' ELSE '1' END AS raw_new,
         CAST(ts AS DATE) AS log_date
  FROM events),
w AS (
  SELECT *, first_value(CASE WHEN raw_new = '1' THEN log_date END IGNORE NULLS) OVER (
              PARTITION BY part_id ORDER BY event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_new
  FROM e),
flagged AS (
  SELECT event_id, part_id, log_date,
         CASE WHEN raw_new = '1' AND log_date <> first_new THEN '0' ELSE raw_new END AS is_new
  FROM w)"""

_MLOG = """
WITH m AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS part_id, CAST(ts AS DATE) AS mdate FROM events)"""

_DETAIL = """
d AS (
  SELECT l_suppkey AS mid, l_partkey AS size_id, l_linestatus AS isnew, l_shipdate AS ts,
         CASE WHEN l_returnflag <> 'R' THEN '1' ELSE '0' END AS ispass,
         l_returnflag, l_linenumber
  FROM lineitem)"""

_FEEDS = f"""
WITH {_DETAIL},
u AS (
  SELECT mid, size_id, isnew, ts, 'detail' AS feed,
         CAST(CASE WHEN ispass = '1' THEN 0 ELSE 1 END AS BIGINT) AS defect_sum,
         CAST(1 AS BIGINT) AS check_sum, CAST(0 AS BIGINT) AS defect_type_count,
         CAST(0 AS BIGINT) AS double_sum, CAST(0 AS BIGINT) AS double_fail_sum
  FROM d
  UNION ALL
  SELECT mid, size_id, isnew, ts, 'per_size', 0, 0, 1, 0, 0 FROM d WHERE l_returnflag = 'R'
  UNION ALL
  SELECT mid, size_id, isnew, ts, 'recheck', 0, 0, 0, 1,
         CASE WHEN ispass = '1' THEN 0 ELSE 1 END
  FROM d WHERE l_linenumber > 1)"""


def _stats(source: str, width: str, keys: list[str], part_dim: bool = True) -> str:
    key_list = ", ".join(keys)
    part_join = "LEFT JOIN part p ON x.size_id = p.p_partkey" if part_dim else ""
    part_cols = ", p.p_brand AS lid, p.p_type AS mtype" if part_dim else ""
    return f"""
{source},
x AS (
  SELECT u.*, time_bucket(INTERVAL {width}, ts, TIMESTAMP '1970-01-01') AS wb FROM u),
e AS (
  SELECT x.*, s.s_nationkey AS fid, s.s_suppkey AS eid {part_cols}
  FROM x LEFT JOIN supplier s ON x.mid = s.s_suppkey {part_join})
SELECT strftime(wb, '%Y-%m-%d %H:%M:%S') AS wbt,
       strftime(wb + INTERVAL {width}, '%Y-%m-%d %H:%M:%S') AS wet,
       {key_list},
       CAST(sum(defect_sum) AS BIGINT) AS defect_sum,
       CAST(sum(check_sum) AS BIGINT) AS check_sum,
       CAST(sum(defect_type_count) AS BIGINT) AS defect_type_count,
       CAST(sum(double_sum) AS BIGINT) AS double_sum,
       CAST(sum(double_fail_sum) AS BIGINT) AS double_fail_sum
FROM e GROUP BY wb, {key_list}"""


def _interval(seconds: int) -> str:
    return f"""
SELECT CAST(i.user_id AS VARCHAR) AS order_id, i.event_id AS info_id, d.event_id AS detail_id,
       i.ts AS info_ts, d.ts AS detail_ts
FROM events i JOIN events d
  ON i.user_id = d.user_id
 AND d.ts >= i.ts - INTERVAL {seconds} SECOND AND d.ts <= i.ts + INTERVAL {seconds} SECOND
WHERE i.event_type = 'click' AND d.event_type = 'purchase'"""


_ASOF = _ROUTED + """,
v AS (SELECT user_id, ts AS vts, event_id AS dim_seq, k FROM routed WHERE route = 'dim'),
p AS (SELECT event_id, user_id, ts FROM events),
j AS (
  SELECT p.event_id, p.user_id, v.dim_seq, v.k,
         row_number() OVER (PARTITION BY p.event_id ORDER BY v.vts DESC, v.dim_seq DESC) AS rn
  FROM p LEFT JOIN v ON p.user_id = v.user_id AND v.vts <= p.ts)
SELECT event_id, user_id, dim_seq, k FROM j WHERE rn = 1"""


ORACLE_SQL: dict[str, str] = {
    "q_parse_filter": f"""
WITH {_CDC.strip()}
SELECT event_id, table_name, op, k FROM cdc""",
    "q_new_part_flag": _FLAGGED + """
SELECT event_id, part_id, is_new, log_date FROM flagged""",
    "q_start_split": """
SELECT route, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE event_type WHEN 'signup' THEN 'machine_start' WHEN 'click' THEN 'weld_start' END AS route
  FROM events) t
WHERE route IS NOT NULL GROUP BY route
UNION ALL
SELECT 'main' AS route, CAST(count(*) AS BIGINT) AS n FROM events""",
    "q_route": _ROUTED + """
SELECT event_id, table_name, op, sink_table, route, pk_column, sink_columns, k
FROM routed WHERE route IN ('fact', 'dim')""",
    "q_unroutable": _ROUTED + """
SELECT table_name, op, CAST(count(*) AS BIGINT) AS n
FROM routed WHERE sink_table IS NULL GROUP BY table_name, op""",
    "q_dim_upsert": _ROUTED + """,
ranked AS (
  SELECT sink_table, CAST(user_id AS VARCHAR) AS id, k, op, event_id,
         row_number() OVER (PARTITION BY sink_table, user_id ORDER BY event_id DESC) AS rn
  FROM routed WHERE route = 'dim')
SELECT sink_table, id, k, op, event_id FROM ranked WHERE rn = 1""",
    "q_dim_snapshot": _ROUTED + """,
ranked AS (
  SELECT CAST(user_id AS VARCHAR) AS id, k,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM routed WHERE route = 'dim')
SELECT id, k FROM ranked WHERE rn = 1""",
    "q_fact_topics": _ROUTED + """
SELECT sink_table AS topic, CAST(count(*) AS BIGINT) AS n FROM routed WHERE route = 'fact' GROUP BY sink_table""",
    "q_dim_merge": f"""
WITH {_CDC.strip()},
d AS (SELECT user_id, coalesce(max(event_id) FILTER (WHERE op = 'delete'), -1) AS gone, max(event_id) AS last
      FROM cdc GROUP BY user_id)
SELECT CAST(c.user_id AS VARCHAR) AS id, arg_max(k, event_id) AS k,
       arg_max(table_name, event_id) FILTER (WHERE op = 'insert') AS kind
FROM cdc c JOIN d ON c.user_id = d.user_id AND c.event_id > d.gone
GROUP BY c.user_id""",
    "q_fact_messages": _ROUTED + """
SELECT event_id, sink_table AS topic, CAST(user_id AS VARCHAR) AS id, k FROM routed WHERE route = 'fact'""",
    "q_log_texts": _FLAGGED + """
SELECT f.event_id, f.part_id, f.is_new, CAST(CAST(floor(e.value) AS BIGINT) AS VARCHAR) AS reading,
       CASE e.event_type WHEN 'signup' THEN 'MachineTool_Start' WHEN 'click' THEN 'WeldRobotStart' END AS start_type,
       json_extract_string(e.props, '$.k') AS extra_k
FROM flagged f JOIN events e USING (event_id)""",
    "q_recheck_rows": """
SELECT event_id, user_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) t
WHERE rn > 1""",
    "q_unique_part": _MLOG + """,
l AS (SELECT *, lag(mdate) OVER (PARTITION BY part_id ORDER BY event_id) AS prev FROM m)
SELECT event_id, part_id, mdate FROM l WHERE prev IS NULL OR prev <> mdate""",
    "q_unique_part_state": _MLOG + """
SELECT part_id, strftime(arg_max(mdate, event_id), '%Y-%m-%d') AS last_day FROM m GROUP BY part_id""",
    "q_unique_part_first": _MLOG + """,
r AS (SELECT *, row_number() OVER (PARTITION BY part_id, mdate ORDER BY event_id) AS rn FROM m)
SELECT event_id, part_id, mdate FROM r WHERE rn = 1""",
    "q_daily_parts": """
SELECT CAST(ts AS DATE) AS mdate, CAST(count(DISTINCT user_id) AS BIGINT) AS n_parts
FROM events GROUP BY 1""",
    "q_interval_join_5s": _interval(5),
    "q_interval_join_1h": _interval(3600),
    "q_enrich_left": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, s.s_nationkey AS fid,
       n.n_name AS factory_name, p.p_brand AS lid, p.p_type AS mtype
FROM lineitem l
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "q_enrich_asof": _ASOF,
    "q_enrich_asof_stream": _ASOF,
    "q_working_days": """
SELECT event_id, user_id,
       CAST(date_diff('day', min(CAST(ts AS DATE)) OVER (PARTITION BY user_id), CAST(ts AS DATE)) AS BIGINT)
         AS working_days
FROM events""",
    "q_size_stats_window": _stats(_FEEDS, "1 DAY", ["fid", "lid", "mtype", "eid", "isnew"]),
    "q_size_stats_7d": _stats(_FEEDS, "7 DAY", ["fid", "lid", "mtype", "eid", "isnew"]),
    "q_size_stats_coarse": _stats(_FEEDS, "7 DAY", ["fid", "isnew"], part_dim=False),
    "q_size_rollup": """
WITH r AS (
  SELECT e.ts, s.s_nationkey AS fid, p.p_brand AS lid, p.p_type AS mtype, s.s_suppkey AS eid, e.event_type
  FROM events e LEFT JOIN supplier s ON e.user_id = s.s_suppkey LEFT JOIN part p ON e.user_id = p.p_partkey),
w AS (
  SELECT *, 'hour' AS period, date_trunc('hour', ts) AS wb, date_trunc('hour', ts) + INTERVAL 1 HOUR AS we FROM r
  UNION ALL
  SELECT *, 'day' AS period, date_trunc('day', ts) AS wb, date_trunc('day', ts) + INTERVAL 1 DAY AS we FROM r)
SELECT period, strftime(wb, '%Y-%m-%d %H:%M:%S') AS wbt, strftime(we, '%Y-%m-%d %H:%M:%S') AS wet,
       CASE GROUPING(fid, lid, mtype, eid) WHEN 0 THEN 'equipment' WHEN 1 THEN 'process' WHEN 3 THEN 'line'
            WHEN 7 THEN 'factory' ELSE 'all' END AS level,
       fid, lid, mtype, eid,
       CAST(sum(CASE WHEN event_type <> 'error' THEN 0 ELSE 1 END) AS BIGINT) AS defect_sum,
       CAST(count(*) AS BIGINT) AS check_sum,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS defect_type_count,
       CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS double_sum,
       CAST(0 AS BIGINT) AS double_fail_sum
FROM w WHERE ts IS NOT NULL
GROUP BY period, wb, we, ROLLUP (fid, lid, mtype, eid)""",
    "q_tumbling_10s": """
SELECT strftime(wb, '%Y-%m-%d %H:%M:%S') AS wbt,
       strftime(wb + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS wet,
       event_type, CAST(count(*) AS BIGINT) AS n
FROM (SELECT time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') AS wb, event_type FROM events) t
GROUP BY wb, event_type""",
    "q_metric_normalise": _FEEDS + """
SELECT * FROM u""",
    "q_size_first": """
SELECT DISTINCT l_suppkey AS mid, l_partkey AS size_id, CAST(l_shipdate AS DATE) AS day
FROM lineitem WHERE NOT coalesce(l_returnflag <> 'R', false)""",
    "q_size_recheck": """
SELECT l_suppkey AS mid, l_partkey AS size_id, CAST(count(*) - 1 AS BIGINT) AS n_recheck
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "q_part_stats": _FLAGGED + """
SELECT part_id, log_date, CAST(count(*) AS BIGINT) AS n_records,
       CAST(sum(CASE WHEN is_new = '1' THEN 1 ELSE 0 END) AS BIGINT) AS n_new,
       CAST(sum(CASE WHEN is_new = '0' THEN 1 ELSE 0 END) AS BIGINT) AS n_rework
FROM flagged GROUP BY part_id, log_date""",
    "q_log_routes": """
WITH r AS (
  SELECT CASE event_type WHEN 'signup' THEN 'machine_start' WHEN 'click' THEN 'weld_start' WHEN 'error' THEN 'shutdown'
              WHEN 'view' THEN 'heartbeat'
              WHEN 'purchase' THEN CASE event_id % 3 WHEN 0 THEN 'manufacture' WHEN 1 THEN 'manufacture_detail'
                                                     ELSE 'large_part_progress' END END AS route
  FROM events)
SELECT route, CAST(count(*) AS BIGINT) AS n FROM r WHERE route IS NOT NULL GROUP BY route
UNION ALL
SELECT 'main' AS route, CAST(count(*) AS BIGINT) AS n FROM r""",
    "q_power_on": """
WITH r AS (
  SELECT CAST(user_id AS VARCHAR) AS equipment_id, epoch_us(ts) AS us, event_id,
         CASE event_type WHEN 'signup' THEN 'start' WHEN 'click' THEN 'start' WHEN 'error' THEN 'shutdown' END AS power
  FROM events),
p AS (
  SELECT *, lag(us) OVER w AS prev_us, lag(power) OVER w AS prev_power, lead(us) OVER w AS next_us
  FROM r WINDOW w AS (PARTITION BY equipment_id ORDER BY us, event_id)),
s AS (
  SELECT *, sum(CASE WHEN prev_us IS NULL OR power = 'start' OR prev_power = 'shutdown'
                       OR us - prev_us > 43200000000 THEN 1 ELSE 0 END)
              OVER (PARTITION BY equipment_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM p),
e AS (
  SELECT *, row_number() OVER (PARTITION BY equipment_id, sid ORDER BY us, event_id) AS nth,
         row_number() OVER (PARTITION BY equipment_id, sid ORDER BY us DESC, event_id DESC) AS from_end
  FROM s)
SELECT equipment_id, min(us) AS first_us, CAST(count(*) AS BIGINT) AS n_records, max(us) - min(us) AS uptime_us,
       max(CASE WHEN nth = 1 THEN CASE WHEN power = 'start' THEN 'start' ELSE 'record' END END) AS opened_by,
       max(CASE WHEN from_end = 1 THEN CASE WHEN power = 'shutdown' THEN 'shutdown' WHEN next_us IS NULL THEN 'open'
                                            WHEN next_us - us > 43200000000 THEN 'gap' ELSE 'start' END END) AS closed_by
FROM e GROUP BY equipment_id, sid""",
    "q_completion_progress": """
WITH d AS (SELECT l_orderkey AS part_id, CAST(l_shipdate AS DATE) AS day, l_linenumber AS step FROM lineitem),
days AS (SELECT part_id, day, CAST(count(*) AS BIGINT) AS n_records FROM d GROUP BY 1, 2),
f AS (SELECT part_id, step, min(day) AS day FROM d WHERE step BETWEEN 1 AND 7 GROUP BY 1, 2),
p AS (
  SELECT days.part_id, days.day, n_records, list(f.step) FILTER (WHERE f.step IS NOT NULL) AS done,
         CAST(count(*) FILTER (WHERE f.day = days.day) AS BIGINT) AS n_new
  FROM days LEFT JOIN f ON f.part_id = days.part_id AND f.day <= days.day GROUP BY days.part_id, days.day, n_records)
SELECT part_id, day, n_records, n_new, CAST(coalesce(len(done), 0) AS BIGINT) AS n_done,
       array_to_string(list_filter(range(1, 8), lambda s: NOT list_contains(coalesce(done, []), s)), ',') AS missing,
       coalesce(len(done), 0) / 7 AS progress
FROM p""",
    # a sketch of so few parts as here holds each of them, so that its estimate is the exact count
    "q_period_parts": """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events),
l AS (
  SELECT 'day' AS period, day AS start, user_id FROM e
  UNION ALL SELECT 'week', CAST(date_trunc('week', day) AS DATE), user_id FROM e
  UNION ALL SELECT 'month', CAST(date_trunc('month', day) AS DATE), user_id FROM e)
SELECT period, start, CAST(count(*) AS BIGINT) AS n_records, CAST(count(DISTINCT user_id) AS BIGINT) AS n_parts,
       CAST(count(DISTINCT user_id) AS BIGINT) AS n_estimate, true AS within_bound
FROM l GROUP BY period, start""",
    "q_uptime_sessions": """
WITH b AS (
  SELECT user_id AS equipment_id, ts,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 MINUTE
              THEN 1 ELSE 0 END AS new_session
  FROM events),
s AS (
  SELECT *, sum(new_session) OVER (PARTITION BY equipment_id ORDER BY ts
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM b)
SELECT equipment_id, min(ts) AS first_beat, max(ts) AS last_beat, CAST(count(*) AS BIGINT) AS n_beats,
       CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) AS uptime_us
FROM s GROUP BY equipment_id, sid""",
}
