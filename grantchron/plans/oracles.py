"""The same answers in plain SQL, for the queries that have one."""

from __future__ import annotations

# events as a change log
_LOG = """
typed AS (
  SELECT event_id, ts, user_id, event_type,
         lag(event_type) OVER w AS prev_type, row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
log AS (
  SELECT event_id, user_id AS grant_id,
    CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
    CASE WHEN event_type <> 'error' THEN 1 + event_id % 3 END AS role_id,
    CASE WHEN event_type <> 'error' THEN 501 + event_id % 7 END AS resource_id,
    CASE WHEN event_type <> 'error' THEN ts END AS granted_at,
    CASE WHEN event_type = 'purchase' THEN ts END AS revoked_at,
    CASE WHEN event_type <> 'error' THEN ts END AS updated_at,
    CASE WHEN event_type <> 'error' THEN event_type = 'signup' AND event_id % 11 = 0 END AS is_deleted,
    CASE WHEN event_type = 'error' THEN 'd' WHEN rn = 1 THEN 'r'
         WHEN prev_type = 'error' THEN 'c' ELSE 'u' END AS op,
    epoch_us(ts) * 1000 AS __source_ts_ns, event_type
  FROM typed)"""

_STAGED = _LOG + """,
staged AS (
  SELECT *, CASE WHEN op = 'd' THEN make_timestamp(__source_ts_ns // 1000) ELSE updated_at END AS business_ts,
    (op = 'd' OR (op = 'u' AND revoked_at IS NOT NULL)) AS closes_access
  FROM log)"""

_SPLIT = "1705363200000000000"
_ATTRIBUTES = "user_id, role_id, resource_id, granted_at, revoked_at, updated_at, is_deleted"
_BATCH = f"grant_id, {_ATTRIBUTES}, op, __source_ts_ns, event_id, business_ts, closes_access"
_PERIOD = """grant_id, user_id, role_id, resource_id, granted_at, revoked_at,
  effective_start, effective_end, is_current, is_deleted"""


def _periods(source: str, name: str, key="grant_id", order="__source_ts_ns, event_id", columns=None) -> str:
    """CTEs: every event of `source` in order, giving periods `name`."""
    columns = columns or "grant_id, user_id, role_id, resource_id, granted_at, revoked_at"
    return f"""
{name}_rel AS (
  SELECT *, lead(business_ts) OVER w AS next_ts, lead(op) OVER w AS next_op,
    row_number() OVER w = count(*) OVER (PARTITION BY {key}) AS is_last
  FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {order})),
{name} AS (
  SELECT {columns}, business_ts AS effective_start, next_ts AS effective_end, is_last AS is_current,
    CASE WHEN is_last THEN is_deleted ELSE next_op = 'd' END AS is_deleted
  FROM {name}_rel WHERE NOT closes_access)"""


def _latest(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY grant_id ORDER BY __source_ts_ns DESC, event_id DESC) AS rn
    FROM {source}) WHERE rn = 1)"""


_HIST = _STAGED + "," + _periods("staged", "hist")
_LAST = _STAGED + "," + _latest("staged", "final")

# Current state with every event taken in order: the last event's values on the row that
# the first event after the key's last delete inserted.
_STATE = _LAST + """,
last_delete AS (
  SELECT grant_id, max((__source_ts_ns, event_id)) AS pos FROM staged WHERE op = 'd' GROUP BY grant_id),
born AS (
  SELECT s.grant_id, min_by(s.user_id, (s.__source_ts_ns, s.event_id)) AS user_id,
    min_by(s.granted_at, (s.__source_ts_ns, s.event_id)) AS granted_at
  FROM staged s LEFT JOIN last_delete d ON s.grant_id = d.grant_id
  WHERE s.op <> 'd' AND (d.pos IS NULL OR (s.__source_ts_ns, s.event_id) > d.pos)
  GROUP BY s.grant_id),
state AS (
  SELECT f.grant_id, b.user_id, f.role_id, f.resource_id, b.granted_at, f.revoked_at, f.updated_at, f.is_deleted
  FROM final f JOIN born b ON f.grant_id = b.grant_id WHERE f.op <> 'd')"""


def _renamed(ctes: str, names: dict[str, str]) -> str:
    for old, new in names.items():
        ctes = ctes.replace(old, new)
    return ctes


# The same after the first of two batches.
_AFTER_EACH = _STATE + "," + _periods("staged", "hist") + f""",
half1 AS (SELECT * FROM staged WHERE __source_ts_ns < {_SPLIT}),""" + _latest("half1", "final1") + "," + _periods(
    "half1", "hist1"
)
_AFTER_EACH += _renamed(
    _STATE[len(_LAST):],
    {"FROM staged": "FROM half1", "final f": "final1 f", "last_delete": "last_delete1", "born": "born1",
     "state AS": "state1 AS"},
)


def _apart(a: str, b: str) -> str:
    """How many rows only one of two tables has."""
    return f"""(SELECT count(*) FROM (SELECT * FROM {a} EXCEPT ALL SELECT * FROM {b}))
  + (SELECT count(*) FROM (SELECT * FROM {b} EXCEPT ALL SELECT * FROM {a}))"""


_CHANGED_ROWS = f"""
SELECT 'merge' AS step, 'fact_access_grant' AS table_name, count(*) AS changed_rows FROM state1
UNION ALL SELECT 'merge', 'fact_access_grant_history', count(*) FROM hist1
UNION ALL SELECT 'merge again', 'fact_access_grant', {_apart("state1", "state")}
UNION ALL SELECT 'merge again', 'fact_access_grant_history', {_apart("hist1", "hist")}
UNION ALL SELECT 'gather', 'fact_access_grant', 0 UNION ALL SELECT 'gather', 'fact_access_grant_history', 0"""

_HALVES = _STAGED + f""",
half1 AS (SELECT * FROM staged WHERE __source_ts_ns < {_SPLIT}),
half2 AS (SELECT * FROM staged WHERE __source_ts_ns >= {_SPLIT}),""" + _latest("half1", "b1") + "," + _latest(
    "half2", "b2"
)

_SNAPSHOTS = _HALVES + "," + _latest("staged", "final") + f""",
old AS (SELECT grant_id, {_ATTRIBUTES} FROM b1 WHERE op <> 'd'),
new AS (SELECT grant_id, {_ATTRIBUTES} FROM final WHERE op <> 'd'),
changes AS (
  SELECT coalesce(o.grant_id, n.grant_id) AS grant_id, n.user_id, n.role_id, n.resource_id, n.granted_at,
    n.revoked_at, n.updated_at, n.is_deleted,
    CASE WHEN o.grant_id IS NULL THEN 'c' WHEN n.grant_id IS NULL THEN 'd' ELSE 'u' END AS __op,
    {_SPLIT}::BIGINT AS __source_ts_ns
  FROM old o FULL OUTER JOIN new n ON o.grant_id = n.grant_id
  WHERE o.grant_id IS NULL OR n.grant_id IS NULL
    OR (o.user_id, o.role_id, o.resource_id, o.granted_at, o.updated_at, o.is_deleted)
       IS DISTINCT FROM (n.user_id, n.role_id, n.resource_id, n.granted_at, n.updated_at, n.is_deleted)
    OR o.revoked_at IS DISTINCT FROM n.revoked_at)"""



def _versions(key: str, name: str, attributes: str, changed: str) -> str:
    """CTEs: versions of a dimension; keys are numbered by the half of the log that they first occur in."""
    return f"""
told AS (
  SELECT {key}, {attributes}, business_ts, __source_ts_ns, event_id,
    lag({changed}) OVER w AS before, row_number() OVER w AS rn
  FROM staged WHERE {key} IS NOT NULL WINDOW w AS (PARTITION BY {key} ORDER BY __source_ts_ns, event_id)),
keys AS (
  SELECT {key}, row_number() OVER (ORDER BY min(__source_ts_ns) >= {_SPLIT}, {key}) AS {name}_sk
  FROM told GROUP BY {key}),
versions AS (
  SELECT {name}_sk, t.{key}, {attributes}, business_ts AS effective_start, lead(business_ts) OVER w AS effective_end,
    lead(event_id) OVER w IS NULL AS is_current
  FROM told t JOIN keys k ON t.{key} = k.{key}
  WHERE rn = 1 OR {changed} IS DISTINCT FROM before
  WINDOW w AS (PARTITION BY t.{key} ORDER BY __source_ts_ns, event_id))"""


_NAMED = _STAGED.replace(
    "SELECT *, CASE",
    """SELECT *, 'user ' || user_id AS user_name, 'u' || user_id || '@d' || event_id // 50 % 3 || '.example' AS user_email,
    'role ' || role_id AS role_name,
    CASE WHEN role_id IS NOT NULL THEN CASE WHEN event_id < 500 THEN 'early' ELSE 'late' END END AS role_category,
    CASE""",
)
_USERS = _NAMED + "," + _versions("user_id", "user", "user_name, user_email", "user_email")
_ROLES = _NAMED + "," + _versions("role_id", "role", "role_name, role_category", "role_category")

# orders as a change log
_ORDERS = """
olog AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS revoked_at,
    o_orderdate AS updated_at, false AS is_deleted,
    CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 THEN 'r'
         WHEN o_orderpriority = '1-URGENT' THEN 'd' ELSE 'u' END AS op,
    epoch_us(o_orderdate) * 1000 AS __source_ts_ns,
    o_orderkey >= (SELECT count(*) // 2 FROM orders) AS arrived_late
  FROM orders),
ostaged AS (
  SELECT *, CASE WHEN op = 'd' THEN make_timestamp(__source_ts_ns // 1000) ELSE updated_at END AS business_ts,
    (op = 'd' OR (op = 'u' AND revoked_at IS NOT NULL)) AS closes_access
  FROM olog)"""
_OCOLS = "o_custkey, revoked_at"
_ARRIVED = _ORDERS + "," + _periods(
    "ostaged", "ohist", "o_custkey", "arrived_late, __source_ts_ns, o_orderkey", _OCOLS
)
_TIED = _ORDERS + "," + _periods("ostaged", "ohist", "o_custkey", "__source_ts_ns, o_orderkey", _OCOLS)

_AT = "TIMESTAMP '2024-01-15 00:00:00'"
_COVERS = f"effective_start <= {_AT} AND (effective_end IS NULL OR effective_end > {_AT})"
_ACTIVE = "revoked_at IS NULL AND is_deleted = false"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


_SCD1_TWO = f"""
SELECT b2.grant_id,
  CASE WHEN b1.op <> 'd' THEN b1.user_id ELSE b2.user_id END AS user_id, b2.role_id, b2.resource_id,
  CASE WHEN b1.op <> 'd' THEN b1.granted_at ELSE b2.granted_at END AS granted_at,
  b2.revoked_at, b2.updated_at, b2.is_deleted
FROM b2 LEFT JOIN b1 ON b1.grant_id = b2.grant_id WHERE b2.op <> 'd'
UNION ALL
SELECT grant_id, {_ATTRIBUTES} FROM b1 WHERE op <> 'd' AND grant_id NOT IN (SELECT grant_id FROM b2)"""

_SCD2_TWO = """
SELECT b1.grant_id, b1.user_id, b1.role_id, b1.resource_id, b1.granted_at, b1.revoked_at,
  b1.business_ts AS effective_start, b2.business_ts AS effective_end, b2.grant_id IS NULL AS is_current,
  CASE WHEN b2.grant_id IS NULL THEN b1.is_deleted ELSE b2.op = 'd' END AS is_deleted
FROM b1 LEFT JOIN b2 ON b1.grant_id = b2.grant_id WHERE NOT b1.closes_access
UNION ALL
SELECT grant_id, user_id, role_id, resource_id, granted_at, revoked_at, business_ts, NULL, true, is_deleted
FROM b2 WHERE NOT closes_access"""

_SUMMARY = """
SELECT 'fact' AS table_name, (SELECT count(*) FROM state) AS row_count, run,
  CASE WHEN run = 1 THEN (SELECT count(*) FROM state) ELSE 0 END AS changed_rows
FROM (VALUES (1), (2), (3)) r(run)
UNION ALL
SELECT 'history', (SELECT count(*) FROM hist), run,
  CASE WHEN run = 1 THEN (SELECT count(*) FROM hist) ELSE 0 END
FROM (VALUES (1), (2), (3)) r(run)"""

_ASSERTIONS = f"""
SELECT name, expected::BIGINT AS expected, expected::BIGINT AS actual, true AS pass FROM (
  SELECT 'subjects_with_access_at_instant' AS name, (SELECT count(*) FROM hist WHERE {_COVERS}) AS expected
  UNION ALL SELECT 'revoked_yet_current', 0
  UNION ALL SELECT 'deleted_yet_current', 0
  UNION ALL SELECT 'keys_with_two_current', 0
  UNION ALL SELECT 'keys_with_access_now', (SELECT count(*) FROM final WHERE NOT closes_access)
  UNION ALL SELECT 'keys_in_source', (SELECT count(*) FROM state)
  UNION ALL SELECT 'active_in_view', (SELECT count(*) FROM state WHERE {_ACTIVE})
  UNION ALL SELECT 'periods_ended_by_hard_delete',
    (SELECT count(*) FROM hist WHERE is_deleted AND NOT is_current)
  UNION ALL SELECT 'periods_in_history', (SELECT count(*) FROM staged WHERE NOT closes_access))"""

_CLASSIFIED = _STAGED + """,
states AS (
  SELECT event_id, op,
    {'gone': op = 'd', 'user_id': user_id, 'role_id': role_id, 'resource_id': resource_id,
     'granted_at': granted_at, 'revoked_at': revoked_at, 'is_deleted': is_deleted} AS record,
    {'gone': op = 'd', 'user_id': user_id, 'role_id': role_id, 'resource_id': resource_id,
     'revoked_at': revoked_at, 'is_deleted': is_deleted} AS access,
    grant_id, __source_ts_ns
  FROM staged),
classified AS (
  SELECT op, rn = 1 OR record::VARCHAR <> prev_record::VARCHAR AS record_changed,
    rn = 1 OR access::VARCHAR <> prev_access::VARCHAR AS access_changed
  FROM (SELECT *, lag(record) OVER w AS prev_record, lag(access) OVER w AS prev_access,
          row_number() OVER w AS rn
        FROM states WINDOW w AS (PARTITION BY grant_id ORDER BY __source_ts_ns, event_id)))"""

_CHANGED = _STAGED + """,
changed AS (
  SELECT * FROM (
    SELECT *, row_number() OVER w AS rn, lag(closes_access) OVER w AS p1, lag(role_id) OVER w AS p2,
      lag(is_deleted) OVER w AS p3, lag(user_id) OVER w AS p4, lag(resource_id) OVER w AS p5,
      lag(revoked_at) OVER w AS p6
    FROM staged WINDOW w AS (PARTITION BY grant_id ORDER BY __source_ts_ns, event_id))
  WHERE rn = 1 OR p1 IS DISTINCT FROM closes_access OR p2 IS DISTINCT FROM role_id
    OR p3 IS DISTINCT FROM is_deleted OR p4 IS DISTINCT FROM user_id
    OR p5 IS DISTINCT FROM resource_id OR p6 IS DISTINCT FROM revoked_at),""" + _periods("changed", "hist")

_LATER = _STAGED + """,
seen AS (
  SELECT *, revoked_at + INTERVAL 1 DAY AS revoked, lead(business_ts) OVER w AS next_ts,
    lead(op) OVER w AS next_op
  FROM staged WINDOW w AS (PARTITION BY grant_id ORDER BY __source_ts_ns, event_id)),
later AS (
  SELECT grant_id, user_id, role_id, resource_id, granted_at, revoked AS revoked_at,
    business_ts AS effective_start,
    CASE WHEN revoked < next_ts OR next_ts IS NULL THEN revoked ELSE next_ts END AS effective_end,
    revoked IS NULL AND next_ts IS NULL AS is_current,
    CASE WHEN next_ts IS NULL OR revoked < next_ts THEN is_deleted ELSE next_op = 'd' END AS is_deleted
  FROM seen WHERE NOT closes_access)"""

_LAST_PERIOD = _HIST + """,
one AS (SELECT * FROM hist ORDER BY effective_start DESC, grant_id LIMIT 1)"""

ORACLES: dict[str, str] = {
    "scd2_prerevoked_later": _with(_LATER, "SELECT * FROM later"),
    "prerevoked_two_merges": _with(_LATER, "SELECT * FROM later"),
    "seed_then_stream": _with(_HIST, "SELECT * FROM hist"),
    "stream_new_checkpoint": _with(_HIST, "SELECT * FROM hist"),
    "cursor_table": "SELECT 'fact_access_grant_history' AS target_table, "
    "max(epoch_us(ts)) * 1000 AS last_processed_ts FROM events",
    "asof_one_subject": _with(
        _LAST_PERIOD,
        "SELECT h.* FROM hist h, one WHERE h.user_id = one.user_id AND h.effective_start <= "
        "one.effective_start AND (h.effective_end IS NULL OR h.effective_end > one.effective_start)",
    ),
    "asof_one_resource": _with(
        _LAST_PERIOD,
        f"SELECT * FROM hist WHERE resource_id = (SELECT resource_id FROM one) AND {_COVERS}",
    ),
    "existed_at": "SELECT * FROM (VALUES ('within', true), ('before', false)) t(asked, existed)",
    "asof_user_resource": _with(
        _LAST_PERIOD,
        "SELECT h.* FROM hist h, one WHERE h.user_id = one.user_id AND h.resource_id = "
        "one.resource_id AND h.effective_start <= one.effective_start "
        "AND (h.effective_end IS NULL OR h.effective_end > one.effective_start)",
    ),
    "event_trail_of_key": _with(
        _LOG,
        "SELECT grant_id, event_id, op FROM log "
        "WHERE grant_id = (SELECT user_id FROM events ORDER BY event_id DESC LIMIT 1)",
    ),
    "version_trail_of_key": _with(
        _LAST_PERIOD, "SELECT * FROM hist WHERE grant_id = (SELECT grant_id FROM one)"
    ),
    "quarantined_envelopes": _with(
        _LOG + """,
bad AS (
  SELECT event_id, ts, CASE WHEN event_id % 7 = 0 THEN 't' WHEN op <> 'r' THEN op END AS op2
  FROM log JOIN events USING (event_id)),
judged AS (
  SELECT CASE WHEN event_id % 23 <> 0 THEN op2 END AS op, event_id % 23 <> 0 AND event_id % 13 <> 0 AS has_capture,
    event_id % 23 <> 0 AND event_id % 19 <> 0 AND op2 IS NOT NULL AS has_key,
    event_id % 23 <> 0 AND op2 IS NOT NULL
      AND CASE WHEN op2 = 'd' THEN event_id % 13 <> 0
               ELSE event_id % 17 <> 0 AND event_id NOT IN (SELECT event_id FROM log WHERE updated_at IS NULL) END
      AS has_time
  FROM bad)""",
        """SELECT concat_ws(',', CASE WHEN op IS NULL OR op = 't' THEN 'op' END,
  CASE WHEN NOT has_key THEN 'key' END, CASE WHEN NOT has_time THEN 'business_time' END,
  CASE WHEN NOT has_capture THEN 'capture_time' END) AS reason, op, count(*) AS events
FROM judged GROUP BY ALL""",
    ),
    "schema_inventory": """
SELECT step, table_name, step = 'made' AS present
FROM (VALUES ('made'), ('reset')) a(step), (VALUES ('dim_user'), ('dim_role'), ('dim_resource'),
  ('fact_access_grant'), ('fact_access_grant_history'), ('gold_merge_watermark'),
  ('current_active_access')) t(table_name)""",
    "named_history": _with(_HIST, "SELECT * FROM hist"),
    "named_state": _with(_STATE, "SELECT * FROM state"),
    "named_active": _with(_STATE, f"SELECT * FROM state WHERE {_ACTIVE}"),
    "named_cursor": "SELECT 'fact_access_grant_history' AS target_table, "
    "max(epoch_us(ts)) * 1000 AS last_processed_ts FROM events",
    "dim_two_loads": """
WITH last AS (
  SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus,
    min(o_orderkey) >= (SELECT count(*) // 2 FROM orders) AS is_new
  FROM orders GROUP BY o_custkey)
SELECT o_custkey, o_orderstatus, row_number() OVER (ORDER BY is_new, o_custkey) AS user_sk FROM last""",
    "dim_hashed_keys": """
SELECT count(*) AS customers_with_orders, count(*) AS same_customer
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    "routed_by_table": """SELECT CASE event_id % 4 WHEN 0 THEN 'grants' WHEN 1 THEN 'logins' ELSE 'rejected' END
  AS table_name, count(*) AS row_count FROM events GROUP BY ALL""",
    "completeness_gate": """SELECT count(*) AS least, true AS passed FROM events
UNION ALL SELECT count(*) + 1, false FROM events""",
    "cdc_op_profile": _with(
        _STAGED, "SELECT op, closes_access, count(*) AS events FROM staged GROUP BY ALL"
    ),
    "cdc_batch_latest": _with(_LAST, f"SELECT {_BATCH} FROM final"),
    "cdc_second_batch": _with(_HALVES, f"SELECT {_BATCH} FROM b2"),
    "cursor_advance": _with(
        _HALVES,
        "SELECT 1 AS run, max(__source_ts_ns) AS last_processed_ts FROM half1 "
        "UNION ALL SELECT 2, max(__source_ts_ns) FROM staged",
    ),
    "cursor_empty_batch_keeps": _with(
        _LOG,
        "SELECT run, 0::BIGINT AS new_events, (SELECT max(__source_ts_ns) FROM log) AS last_processed_ts "
        "FROM (VALUES (1), (2), (3)) r(run)",
    ),
    "scd1_one_batch": _with(_LAST, f"SELECT grant_id, {_ATTRIBUTES} FROM final WHERE op <> 'd'"),
    "scd1_two_batches": _with(_HALVES, _SCD1_TWO),
    "scd1_all_events": _with(_STATE, "SELECT * FROM state"),
    "scd1_all_two_batches": _with(_STATE, "SELECT * FROM state"),
    "scd2_latest_two_batches": _with(_HALVES, _SCD2_TWO),
    "scd2_all_events": _with(_HIST, "SELECT * FROM hist"),
    "scd2_all_two_batches": _with(_HIST, "SELECT * FROM hist"),
    "scd2_prerevoked_closed": _with(
        _HIST,
        f"SELECT {_PERIOD} FROM hist WHERE revoked_at IS NULL "
        "OR revoked_at > effective_start",
    ),
    "merge_runs_in_store": _with(_HIST, "SELECT * FROM hist"),
    "stream_merge_equals_batch": _with(_HIST, "SELECT * FROM hist"),
    "active_access": _with(_STATE, f"SELECT * FROM state WHERE {_ACTIVE} ORDER BY grant_id"),
    "current_state": _with(_STATE, "SELECT * FROM state ORDER BY grant_id"),
    "asof_subject": _with(_HIST, f"SELECT * FROM hist WHERE {_COVERS}"),
    "asof_resource": _with(
        _HIST, f"SELECT resource_id, user_id, role_id, effective_start FROM hist WHERE {_COVERS}"
    ),
    "asof_exists": _with(
        _HIST, f"SELECT user_id, bool_or({_COVERS}) AS existed FROM hist GROUP BY user_id"
    ),
    "asof_pair": _with(
        _HIST,
        f"SELECT user_id, resource_id, count(*) FILTER (WHERE {_COVERS}) AS live_periods, "
        "count(*) AS periods FROM hist GROUP BY user_id, resource_id",
    ),
    "asof_batched": _with(
        _HIST + """,
probes AS (
  SELECT o_orderkey AS probe_id, o_custkey AS grant_id,
    make_timestamp(1704067200000000 + (date_diff('day', DATE '1970-01-01', o_orderdate::DATE) % 30 * 86400
      + o_orderkey * 7919 % 86400) * 1000000) AS probe_ts
  FROM orders)""",
        """SELECT p.probe_id, p.grant_id, p.probe_ts, h.user_id, h.role_id, h.resource_id, h.granted_at,
  h.revoked_at, h.effective_start, h.effective_end, h.is_current, h.is_deleted
FROM probes p JOIN hist h ON p.grant_id = h.grant_id AND h.effective_start <= p.probe_ts
  AND (h.effective_end IS NULL OR h.effective_end > p.probe_ts)""",
    ),
    "asof_resource_daily": _with(
        _HIST + """,
probes AS (SELECT DISTINCT resource_id, date_trunc('day', effective_start)::TIMESTAMP AS probe_ts FROM hist)""",
        """SELECT p.resource_id, p.probe_ts, h.grant_id, h.user_id, h.role_id, h.effective_start
FROM probes p JOIN hist h ON p.resource_id = h.resource_id AND h.effective_start <= p.probe_ts
  AND (h.effective_end IS NULL OR h.effective_end > p.probe_ts)""",
    ),
    "closed_in_range": _with(
        _HIST,
        f"SELECT * FROM hist WHERE effective_end >= {_AT} "
        "AND effective_end < TIMESTAMP '2024-01-16 00:00:00'",
    ),
    "changes_at_instant": _with(
        _HIST, "SELECT * FROM hist WHERE effective_end = (SELECT max(effective_end) FROM hist)"
    ),
    "removal_kind": _with(
        _HIST,
        f"""SELECT {_PERIOD}, CASE WHEN is_current THEN 'open' WHEN is_deleted THEN 'hard_delete'
  WHEN lead(effective_start) OVER (PARTITION BY grant_id ORDER BY effective_start, is_current, effective_end)
    = effective_end THEN 'replaced' ELSE 'revoked' END AS ending FROM hist""",
    ),
    "removal_kind_stored": _with(
        _HIST,
        f"""SELECT {_PERIOD}, CASE WHEN is_current THEN 'open' WHEN is_deleted THEN 'hard_delete'
  WHEN lead(effective_start) OVER (PARTITION BY grant_id ORDER BY effective_start, is_current, effective_end)
    = effective_end THEN 'replaced' ELSE 'revoked' END AS ending FROM hist""",
    ),
    "event_trail": _with(
        _LOG,
        """SELECT grant_id, event_id, op, __source_ts_ns AS source_ts_ns,
  lag(event_id) OVER w AS previous_event_id, lag(op) OVER w AS previous_op
FROM log WINDOW w AS (PARTITION BY grant_id ORDER BY __source_ts_ns, event_id)""",
    ),
    "version_trail": _with(
        _HIST,
        """SELECT grant_id, role_id, effective_start, effective_end,
  lag(role_id) OVER w AS previous_role_id, lag(effective_end) OVER w AS previous_end
FROM hist WINDOW w AS (PARTITION BY grant_id ORDER BY effective_start, is_current, effective_end)""",
    ),
    "dup_current_guard": _with(
        _HIST,
        "SELECT grant_id, count(*) AS current_version_count FROM hist WHERE is_current "
        "GROUP BY grant_id HAVING count(*) > 1",
    ),
    "dup_current_summary": _with(
        _HIST,
        """SELECT count(*) AS keys_with_current, sum(n)::BIGINT AS current_rows,
  count(*) FILTER (WHERE n > 1) AS violations
FROM (SELECT grant_id, count(*) AS n FROM hist WHERE is_current GROUP BY grant_id)""",
    ),
    "idempotency_diff": _with(
        _STATE + "," + _periods("staged", "hist"), _SUMMARY
    ),
    "bronze_immutable": _with(
        _HALVES,
        """SELECT 'before' AS table_name, count(*) AS row_count FROM half1
UNION ALL SELECT 'after', count(*) FROM staged UNION ALL SELECT 'lost', 0""",
    ),
    "row_count_report": _with(
        _STATE + "," + _periods("staged", "hist"),
        f"""SELECT 'bronze' AS table_name, count(*) AS row_count FROM log
UNION ALL SELECT 'fact_access_grant', count(*) FROM state
UNION ALL SELECT 'fact_access_grant_history', count(*) FROM hist
UNION ALL SELECT 'current_active_access', count(*) FROM state WHERE {_ACTIVE}""",
    ),
    "row_count_stored": _with(
        _STATE + "," + _periods("staged", "hist"),
        f"""SELECT 'bronze' AS table_name, count(*) AS row_count FROM log
UNION ALL SELECT 'fact_access_grant', count(*) FROM state
UNION ALL SELECT 'fact_access_grant_history', count(*) FROM hist
UNION ALL SELECT 'current_active_access', count(*) FROM state WHERE {_ACTIVE}""",
    ),
    "rewritten_without_change": _with(_AFTER_EACH, _CHANGED_ROWS),
    "period_sanity": _with(
        _ARRIVED,
        """SELECT problem, count(*) AS periods FROM (
  SELECT concat_ws(',', CASE WHEN effective_end < effective_start THEN 'inverted' END,
    CASE WHEN effective_end = effective_start THEN 'zero_length' END,
    CASE WHEN endless OR reach > effective_start THEN 'overlap' END) AS problem
  FROM (SELECT *, max(effective_end) OVER w AS reach, bool_or(effective_end IS NULL) OVER w AS endless FROM ohist
        WINDOW w AS (PARTITION BY o_custkey ORDER BY effective_start, is_current, effective_end
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
WHERE problem <> '' GROUP BY problem""",
    ),
    "period_overlaps": _with(
        _ARRIVED,
        """SELECT o_custkey, effective_start, effective_end,
  concat_ws(',', CASE WHEN effective_end < effective_start THEN 'inverted' END,
    CASE WHEN effective_end = effective_start THEN 'zero_length' END, 'overlap') AS problem
FROM (SELECT *, max(effective_end) OVER w AS reach, bool_or(effective_end IS NULL) OVER w AS endless FROM ohist
      WINDOW w AS (PARTITION BY o_custkey ORDER BY effective_start, is_current, effective_end
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
WHERE endless OR reach > effective_start""",
    ),
    "period_sanity_clean": _with(
        _HIST,
        f"""SELECT {_PERIOD}, 'bad' AS problem FROM (
  SELECT *, max(effective_end) OVER (PARTITION BY grant_id ORDER BY effective_start
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM hist)
WHERE effective_end <= effective_start OR reach > effective_start""",
    ),
    "view_vs_history": _with(
        _STATE + "," + _periods("staged", "hist"),
        f"""SELECT grant_id, bool_or(v) AS in_view, bool_or(h) AS in_history FROM (
  SELECT grant_id, true AS v, false AS h FROM state WHERE {_ACTIVE}
  UNION ALL SELECT grant_id, false, true FROM hist WHERE is_current)
GROUP BY grant_id HAVING bool_or(v) <> bool_or(h)""",
    ),
    "event_quarantine": _with(
        _LOG + """,
broken AS (
  SELECT CASE WHEN event_type = 'view' THEN 't' WHEN op = 'r' THEN NULL ELSE op END AS op FROM log)""",
        """SELECT CASE WHEN op IN ('r', 'c', 'u', 'd') THEN '' ELSE 'op' END AS reason, op,
  count(*) AS events FROM broken GROUP BY ALL""",
    ),
    "double_load": _with(
        _LOG,
        f"""SELECT event_id, grant_id, op, __source_ts_ns AS source_ts_ns, count(*) AS copies
FROM (SELECT * FROM log UNION ALL SELECT * FROM log WHERE __source_ts_ns >= {_SPLIT})
GROUP BY ALL HAVING count(*) > 1""",
    ),
    "business_assertions": _with(_STATE + "," + _periods("staged", "hist"), _ASSERTIONS),
    "flatten_envelope": _with(
        _LOG,
        f"""SELECT event_id, grant_id, {_ATTRIBUTES}, op AS __op, __source_ts_ns,
  'iam_denormalized' AS __table, 'iam_source' AS __db,
  CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted FROM log""",
    ),
    "route_tables": """SELECT 'bronze_dev_iam_public_iam_denormalized' AS bronze_table,
  'iam_source' AS db, count(*) AS events FROM events""",
    "snapshot_then_live": _with(
        _HALVES
        + f""",
seeded AS (
  SELECT grant_id, user_id, role_id, resource_id, granted_at, revoked_at, is_deleted, 'r' AS op,
    {_SPLIT} - 1 AS __source_ts_ns, -1 AS event_id, updated_at AS business_ts, false AS closes_access
  FROM b1 WHERE op <> 'd'
  UNION ALL
  SELECT grant_id, user_id, role_id, resource_id, granted_at, revoked_at, is_deleted, op,
    __source_ts_ns, event_id, business_ts, closes_access FROM half2),"""
        + _periods("seeded", "hist"),
        "SELECT * FROM hist",
    ),
    "snapshot_diff": _with(_SNAPSHOTS, "SELECT * FROM changes"),
    "incremental_missed": _with(
        _SNAPSHOTS,
        """SELECT grant_id, __op AS op FROM changes WHERE grant_id NOT IN (
  SELECT grant_id FROM new WHERE updated_at > TIMESTAMP '2024-01-16 00:00:00')""",
    ),
    "changes_applied": _with(_SNAPSHOTS, "SELECT * FROM new"),
    "seed_missing_keys": _with(
        _SNAPSHOTS, "SELECT * FROM new WHERE grant_id NOT IN (SELECT grant_id FROM old)"
    ),
    "late_skipped": _with(
        _ORDERS + """,
reached AS (
  SELECT max(__source_ts_ns) AS ts, max((__source_ts_ns, o_orderkey)) AS pos, max(o_orderkey) AS id
  FROM olog WHERE NOT arrived_late)""",
        """SELECT 'capture_time' AS cursor, count(*) AS arrived,
  count(*) FILTER (WHERE __source_ts_ns <= ts) AS skipped FROM olog, reached WHERE arrived_late
UNION ALL
SELECT 'capture_time_and_sequence', count(*), count(*) FILTER (WHERE (__source_ts_ns, o_orderkey) <= pos)
FROM olog, reached WHERE arrived_late
UNION ALL
SELECT 'arrival_position', count(*), count(*) FILTER (WHERE o_orderkey <= id)
FROM olog, reached WHERE arrived_late""",
    ),
    "late_merged": _with(_ARRIVED, "SELECT * FROM ohist"),
    "tie_order": """SELECT o_custkey, o_orderdate AS tied_at, count(*) AS events,
  max(o_orderkey) AS last_event FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1""",
    "scd2_tied_events": _with(_TIED, "SELECT * FROM ohist"),
    "dim_user_latest": """SELECT c_custkey AS user_id, c_name AS user_name, n_name AS nation, r_name AS region,
  o_orderstatus, o_orderpriority, row_number() OVER (ORDER BY c_custkey) AS user_sk
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders)
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE rn = 1""",
    "dim_attribute_history": """SELECT o_custkey, o_orderstatus, o_orderdate AS effective_start,
  lead(o_orderdate) OVER w AS effective_end,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_current
FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p
      FROM orders)
WHERE p IS DISTINCT FROM o_orderstatus WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "record_vs_access_change": _with(
        _CLASSIFIED,
        "SELECT op, record_changed, access_changed, count(*) AS events FROM classified GROUP BY ALL",
    ),
    "access_change_history": _with(_CHANGED, "SELECT * FROM hist"),
    "access_change_two_batches": _with(_CHANGED, "SELECT * FROM hist"),
    "dim_user_in_schema": _with(_USERS, "SELECT * FROM versions"),
    "dim_role_in_schema": _with(_ROLES, "SELECT * FROM versions"),
    "history_with_user": _with(
        _USERS + "," + _periods("staged", "hist"),
        """SELECT h.grant_id, h.role_id, h.effective_start, v.user_id, user_sk, user_name, user_email
FROM hist h JOIN versions v ON h.user_id = v.user_id AND v.effective_start <= h.effective_start
  AND (v.effective_end IS NULL OR v.effective_end > h.effective_start)""",
    ),
    "sql_as_of": _with(_HIST, f"SELECT * FROM hist WHERE {_COVERS}"),
    "sql_ended_between": _with(
        _HIST,
        f"SELECT * FROM hist WHERE effective_end >= {_AT} "
        "AND effective_end < TIMESTAMP '2024-01-16 00:00:00'",
    ),
    "snapshot_diff_stored": _with(_SNAPSHOTS, "SELECT * FROM changes"),
    "business_assertions_stored": _with(_STATE + "," + _periods("staged", "hist"), _ASSERTIONS),
}
