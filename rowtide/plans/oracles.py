"""DuckDB oracle SQL for the registered queries.

The oracles restate the packet rules directly in SQL (unchunked windows, ``last_value IGNORE
NULLS``, ``arg_max_null``), independent of the Spark code path. Fixture derivations mirror
``fixtures.py``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from rowtide.plans import fixtures as fx
from rowtide.plans.fixtures import (
    DEFAULT_SEGMENT, LINE_ADD_PRIORITIES, LINE_ADDED, LINE_ADDED_TAX, LINE_FLAT_PRIORITY, LINE_FLAT_TAX,
)

MIN_SEQ = "(-9223372036854775807 - 1)"


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@dataclass
class FoldSpec:
    """What the generic fold oracle needs to know about a table."""

    key: list[str]
    cols: list[str]  # non-key columns
    not_null: list[str] = field(default_factory=list)  # NOT NULL non-key columns
    defaults: dict[str, str] = field(default_factory=dict)  # column -> SQL literal


ACCOUNTS_SPEC = FoldSpec(key=["user_id"], cols=["value", "segment"], not_null=["value"], defaults={"segment": f"'{DEFAULT_SEGMENT}'"})

ACCOUNTS_BASE_SQL = f"""
SELECT CAST(c_custkey AS BIGINT) AS user_id, c_acctbal AS value, c_mktsegment AS segment
FROM customer
"""

# flat log: seq, action, ts, key, p_<col>, v_<col>
ACCOUNTS_LOG_SQL = f"""
SELECT event_id AS seq,
       CASE event_type WHEN 'signup' THEN 'add' WHEN 'click' THEN 'set' WHEN 'purchase' THEN 'set'
                       WHEN 'view' THEN 'update' WHEN 'error' THEN 'delete' END AS action,
       ts, CASE WHEN CAST(json_extract(props, '$.k') AS INT) % {fx.NEW_ACCOUNT_K} = 0 THEN -user_id ELSE user_id END AS user_id, TRUE AS key_ok,
       event_type IN ('signup', 'click', 'view') AS p_value,
       value AS v_value,
       (event_type = 'purchase' OR (event_type = 'signup' AND value >= 50)) AS p_segment,
       CASE WHEN CAST(json_extract(props, '$.k') AS INT) % 7 = 0 THEN NULL
            ELSE 'S' || CAST(CAST(json_extract(props, '$.k') AS INT) % 5 AS VARCHAR) END AS v_segment
FROM events
"""


def _or(parts: list[str]) -> str:
    return "(" + " OR ".join(parts) + ")" if parts else "FALSE"


def fold_ctes(spec: FoldSpec, base_sql: str, log_sql: str) -> str:
    """CTEs ``base``, ``log``, ``cl`` (class), ``oc`` (outcome per packet), ``fin`` (final state per key)."""
    k = ", ".join(spec.key)
    kjoin = " AND ".join(f"b.{c} = l.{c}" for c in spec.key)
    nn_null = _or([f"(p_{c} AND v_{c} IS NULL)" for c in spec.not_null])
    nn_missing = _or([f"NOT p_{c}" for c in spec.not_null if c not in spec.defaults])
    per_col = ",\n       ".join(
        f"max(CASE WHEN outcome IN ('inserted','updated') AND p_{c} THEN seq END) AS ws_{c},\n"
        f"       arg_max_null(v_{c}, CASE WHEN outcome IN ('inserted','updated') AND p_{c} THEN seq END) AS wv_{c}"
        for c in spec.cols
    )
    fin_cols = ",\n       ".join(
        f"(ws_{c} IS NOT NULL AND ws_{c} >= COALESCE(e_max, {MIN_SEQ})) AS has_{c}, wv_{c} AS val_{c}" for c in spec.cols
    )
    return f"""
base AS MATERIALIZED ({base_sql}),
log AS ({log_sql}),
cl AS (
  SELECT l.*,
    CASE WHEN action = 'add' AND NOT {nn_null} AND NOT {nn_missing} THEN 'ins'
         WHEN action = 'add' THEN 'add_bad'
         WHEN action = 'set' AND {nn_null} THEN 'halt'
         WHEN action = 'set' AND ({nn_missing} OR NOT key_ok) THEN 'upd_only'
         WHEN action = 'set' THEN 'ins'
         WHEN action = 'update' AND {nn_null} THEN 'halt'
         WHEN action = 'update' THEN 'upd'
         ELSE 'del' END AS cls,
    EXISTS (SELECT 1 FROM base b WHERE {kjoin}) AS b_live
  FROM log l),
lb AS (
  SELECT *, COALESCE(last_value(CASE cls WHEN 'ins' THEN TRUE WHEN 'del' THEN FALSE END IGNORE NULLS)
             OVER (PARTITION BY {k} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), b_live) AS live
  FROM cl),
oc AS (
  SELECT *,
    CASE WHEN cls = 'add_bad' THEN 'rejected'
         WHEN cls = 'ins' AND action = 'add' AND live THEN 'rejected'
         WHEN cls = 'ins' AND NOT live THEN 'inserted'
         WHEN cls IN ('ins', 'upd_only', 'upd') AND live THEN 'updated'
         WHEN cls = 'upd_only' THEN 'rejected'
         WHEN cls = 'upd' THEN 'noop'
         WHEN cls = 'del' AND live THEN 'deleted'
         WHEN cls = 'del' THEN 'noop'
         WHEN cls = 'halt' AND live THEN 'quarantined'
         WHEN cls = 'halt' AND action = 'set' THEN 'rejected'
         ELSE 'noop' END AS outcome,
    CASE WHEN cls = 'add_bad' THEN 'not_null'
         WHEN cls = 'ins' AND action = 'add' AND live THEN 'duplicate_key'
         WHEN cls = 'upd_only' AND NOT live THEN CASE WHEN {nn_missing} THEN 'not_null' ELSE 'partial_key' END
         WHEN cls = 'halt' AND (live OR action = 'set') THEN 'not_null' END AS reason
  FROM lb),
sm AS (
  SELECT {k}, bool_or(b_live) AS b_live,
       max(CASE WHEN outcome IN ('inserted','deleted') THEN seq END) AS e_max,
       arg_max(outcome = 'deleted', CASE WHEN outcome IN ('inserted','deleted') THEN seq END) AS last_del,
       {per_col}
  FROM oc GROUP BY {k}),
fin AS (
  SELECT {k}, b_live, CASE WHEN e_max IS NULL THEN b_live ELSE NOT last_del END AS live, e_max IS NULL AS base_epoch,
       {fin_cols}
  FROM sm)"""


def fold_table_sql(spec: FoldSpec, base_sql: str, log_sql: str) -> str:
    k = ", ".join(spec.key)
    dflt = lambda c: spec.defaults.get(c, "NULL")
    old_cols = ", ".join(
        f"CASE WHEN f.live IS NULL THEN b.{c} WHEN f.has_{c} THEN f.val_{c} WHEN f.base_epoch THEN b.{c} ELSE {dflt(c)} END AS {c}"
        for c in spec.cols
    )
    new_cols = ", ".join(f"CASE WHEN has_{c} THEN val_{c} ELSE {dflt(c)} END AS {c}" for c in spec.cols)
    bkeys = ", ".join(f"b.{c}" for c in spec.key)
    return f"""WITH {fold_ctes(spec, base_sql, log_sql)}
SELECT {bkeys}, {old_cols} FROM base b LEFT JOIN fin f USING ({k}) WHERE f.live IS NULL OR f.live
UNION ALL
SELECT {k}, {new_cols} FROM fin WHERE NOT b_live AND live"""


def fold_outcomes_sql(spec: FoldSpec, base_sql: str, log_sql: str, select: str, where: str = "TRUE") -> str:
    return f"WITH {fold_ctes(spec, base_sql, log_sql)}\nSELECT {select} FROM oc WHERE {where}"


def _only(log_sql: str, actions: tuple[str, ...]) -> str:
    return f"SELECT * FROM ({log_sql}) WHERE action IN ({_in_list(actions)})"


LINES_SPEC = FoldSpec(key=["l_orderkey", "l_linenumber"], cols=["tax"], not_null=["tax"])

LINES_BASE_SQL = f"""
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS INT) AS l_linenumber, min(l_tax) AS tax
FROM lineitem GROUP BY l_orderkey, l_linenumber
"""

# packets: seq, action, l_orderkey (given), full (whole key given), l_linenumber, p_tax, v_tax
LINES_PACKETS_SQL = f"""
SELECT o_orderkey * 10 AS seq, 'set' AS action, o_orderkey AS l_orderkey, TRUE AS full_key,
       {LINE_ADDED} AS l_linenumber, TRUE AS p_tax, CAST({LINE_ADDED_TAX} AS DOUBLE) AS v_tax
FROM orders WHERE o_orderpriority IN ({_in_list(LINE_ADD_PRIORITIES)})
UNION ALL
SELECT o_orderkey * 10 + 1, CASE o_orderstatus WHEN 'F' THEN 'delete' WHEN 'P' THEN 'update' ELSE 'set' END,
       o_orderkey, FALSE, NULL, o_orderstatus <> 'F', o_totalprice
FROM orders
UNION ALL
SELECT o_orderkey * 10 + 2, 'set', o_orderkey, FALSE, NULL, TRUE, CAST({LINE_FLAT_TAX} AS DOUBLE)
FROM orders WHERE o_orderpriority = '{LINE_FLAT_PRIORITY}'
"""

# effects: full-key packets as they are; partial ones joined with the key universe on l_orderkey
LINES_EFFECTS_SQL = f"""
WITH pk AS ({LINES_PACKETS_SQL}),
universe AS (
  SELECT l_orderkey, l_linenumber FROM ({LINES_BASE_SQL})
  UNION SELECT l_orderkey, l_linenumber FROM pk WHERE full_key AND p_tax AND v_tax IS NOT NULL)
SELECT seq, action, l_orderkey, l_linenumber, TRUE AS key_ok, p_tax, v_tax FROM pk WHERE full_key
UNION ALL
SELECT p.seq, p.action, u.l_orderkey, u.l_linenumber, FALSE, p.p_tax, p.v_tax
FROM pk p JOIN universe u ON u.l_orderkey = p.l_orderkey WHERE NOT p.full_key
"""


ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
SNAP_OLD_SQL = f"SELECT {ORDER_COLS} FROM orders"
SNAP_NEW_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderpriority = '{fx.SNAP_CHANGE[0]}' AND o_orderstatus = '{fx.SNAP_CHANGE[1]}' THEN o_totalprice + 1
            ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE NOT (o_orderpriority = '{fx.SNAP_DROP[0]}' AND o_orderstatus = '{fx.SNAP_DROP[1]}')
UNION ALL
SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders), o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderpriority = '{fx.SNAP_COPY[0]}' AND o_orderstatus = '{fx.SNAP_COPY[1]}'
"""
ORDER_IMAGES_SQL = f"""
SELECT COALESCE(n.o_orderkey, o.o_orderkey) AS seq,
       CASE WHEN o.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op,
       o.o_orderkey AS old_key, n.*
FROM ({SNAP_OLD_SQL}) o FULL OUTER JOIN ({SNAP_NEW_SQL}) n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL
   OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
   OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderdate IS DISTINCT FROM n.o_orderdate
   OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority
"""

# the encoded accounts log with its injected corruptions, flattened
JSON_FLAT_SQL = f"""
SELECT l.seq AS pos, l.*, CAST(json_extract(e.props, '$.k') AS INT) AS k,
       CAST(json_extract(e.props, '$.k') AS INT) = {fx.JSON_MALFORMED_K} AS malformed
FROM ({ACCOUNTS_LOG_SQL}) l JOIN events e ON e.event_id = l.seq
"""
JSON_VIEW_SQL = f"""
SELECT pos, malformed,
  CASE WHEN malformed THEN NULL ELSE seq END AS seq,
  CASE WHEN malformed THEN NULL WHEN k = {fx.JSON_UNKNOWN_ACTION_K} THEN '{fx.UNKNOWN_ACTION}' ELSE action END AS action,
  action AS orig_action,
  NOT malformed AND action IN ('add', 'set') AS dp_user_id,
  NOT malformed AND p_value AS dp_value,
  NOT malformed AND p_segment AS dp_segment,
  CASE WHEN NOT malformed AND p_segment THEN v_segment END AS d_segment,
  NOT malformed AND k = {fx.JSON_BAD_VALUE_K} AND action IN ('add', 'set') AND p_value AS bad_value,
  CASE WHEN NOT malformed AND p_value AND NOT (k = {fx.JSON_BAD_VALUE_K} AND action IN ('add', 'set')) THEN v_value END AS d_value,
  CASE WHEN NOT malformed AND action IN ('add', 'set') THEN user_id END AS d_user_id,
  NOT malformed AND action IN ('update', 'delete') AND NOT (k = {fx.JSON_EMPTY_RESTRICTION_K}) AS rp_user_id,
  CASE WHEN malformed OR action IN ('add', 'set') THEN NULL
       WHEN k = {fx.JSON_EMPTY_RESTRICTION_K} THEN 0
       WHEN k = {fx.JSON_UNKNOWN_RESTRICTION_K} AND action = 'update' THEN 2 ELSE 1 END AS n_restriction,
  CASE WHEN action = 'update' THEN 1 ELSE 0 END AS n_unknown_data,
  CASE WHEN k = {fx.JSON_UNKNOWN_RESTRICTION_K} AND action = 'update' THEN 1 ELSE 0 END AS n_unknown_restriction,
  k
FROM ({JSON_FLAT_SQL})
"""


def oracle_sql() -> dict[str, str]:
    A, B, L = ACCOUNTS_SPEC, ACCOUNTS_BASE_SQL, ACCOUNTS_LOG_SQL
    q = {
        "apply_mixed_log": fold_table_sql(A, B, L),
        "packet_outcomes": fold_outcomes_sql(A, B, L, "seq, action, user_id, outcome, reason"),
        "apply_add": fold_table_sql(A, B, _only(L, ("add",))),
        "apply_delete": fold_table_sql(A, B, _only(L, ("delete",))),
        "apply_update": fold_table_sql(A, B, _only(L, ("update",))),
        "apply_set": fold_table_sql(A, B, _only(L, ("set",))),
        "reject_duplicate": fold_outcomes_sql(A, B, L, "seq, user_id", "reason = 'duplicate_key'"),
        "reject_not_null": fold_outcomes_sql(A, B, L, "seq, action, user_id", "reason = 'not_null'"),
        "restrict_full_key": fold_outcomes_sql(
            A, B, L, "seq, action, user_id, outcome IN ('updated','deleted') AS hit", "action IN ('update','delete')"
        ),
        "fill_defaults": f"""WITH {fold_ctes(A, B, L)}
SELECT seq, user_id, v_value AS value, CASE WHEN p_segment THEN v_segment ELSE '{DEFAULT_SEGMENT}' END AS segment
FROM oc WHERE outcome = 'inserted'""",
    }
    LS, LB, LE = LINES_SPEC, LINES_BASE_SQL, LINES_EFFECTS_SQL
    q["apply_partial_log"] = fold_table_sql(LS, LB, LE)
    q["restrict_partial_key"] = fold_outcomes_sql(
        LS, LB, LE, "seq, l_orderkey, l_linenumber, outcome", "NOT key_ok AND outcome IN ('updated', 'deleted')"
    )
    q["apply_set_partial"] = f"""WITH pk AS ({LINES_PACKETS_SQL}),
agg AS ({fold_outcomes_sql(LS, LB, LE, "seq, outcome", "NOT key_ok")})
SELECT p.seq, CASE WHEN count(a.seq) FILTER (WHERE a.outcome = 'updated') > 0 THEN 'updated' ELSE 'rejected' END AS outcome,
       count(a.seq) FILTER (WHERE a.outcome = 'updated') AS rows
FROM pk p LEFT JOIN agg a ON a.seq = p.seq
WHERE p.action = 'set' AND NOT p.full_key GROUP BY p.seq"""

    q["capture_insert"] = f"""SELECT seq, 'add' AS action, CAST(NULL AS BIGINT) AS r_o_orderkey, {ORDER_COLS}
FROM ({ORDER_IMAGES_SQL}) WHERE op = 'INSERT'"""
    q["capture_update"] = f"""SELECT seq, 'update' AS action, old_key AS r_o_orderkey, {ORDER_COLS}
FROM ({ORDER_IMAGES_SQL}) WHERE op = 'UPDATE'"""
    q["capture_delete"] = f"""SELECT seq, 'delete' AS action, old_key AS r_o_orderkey FROM ({ORDER_IMAGES_SQL}) WHERE op = 'DELETE'"""
    q["capture_diff"] = SNAP_NEW_SQL
    q["route_changes"] = f"""SELECT 'public' AS schema_name, 'orders' AS table_name, seq, op, '/queue/public.orders' AS queue,
       'o_orderkey' AS key_columns, CAST(NULL AS VARCHAR) AS reason FROM ({ORDER_IMAGES_SQL})
UNION ALL
SELECT 'public', 'customer', CAST(c_custkey AS BIGINT), 'UPDATE', NULL, NULL, 'missing_registry'
FROM customer WHERE c_mktsegment = '{fx.CUSTOMER_CHANGED_SEGMENT}'"""
    q["parse_packets"] = f"""SELECT pos, v.seq, v.action,
       CASE WHEN dp_value AND NOT bad_value THEN d_value END AS value,
       dp_segment AS has_segment, d_segment AS segment,
       CASE WHEN rp_user_id THEN l.user_id END AS r_user_id, n_restriction
FROM ({JSON_VIEW_SQL}) v JOIN ({ACCOUNTS_LOG_SQL}) l ON l.seq = v.pos"""
    q["validate_packets"] = f"""SELECT pos, seq,
  CASE WHEN malformed OR action NOT IN ('add', 'set', 'update', 'delete') THEN NULL
       WHEN action IN ('add', 'set') THEN 'pk'
       WHEN rp_user_id THEN 'pk' ELSE 'none' END AS match_kind,
  CASE WHEN malformed THEN 'malformed'
       WHEN action NOT IN ('add', 'set', 'update', 'delete') THEN 'unknown_action'
       WHEN bad_value THEN 'bad_value'
       WHEN action IN ('update', 'delete') AND n_restriction = 0 THEN 'empty_restriction'
       WHEN action IN ('update', 'delete') AND n_unknown_restriction > 0 THEN 'unknown_column' END AS reject_reason
FROM ({JSON_VIEW_SQL})"""
    q["align_columns"] = f"""SELECT pos, dp_user_id AS dp__user_id, dp_value AS dp__value, dp_segment AS dp__segment,
       d_segment AS d__segment, rp_user_id AS rp__user_id, n_unknown_data, n_unknown_restriction
FROM ({JSON_VIEW_SQL}) WHERE NOT malformed"""
    q["typed_values"] = f"""SELECT pos, d_user_id AS d__user_id, d_value AS d__value, bad_value
FROM ({JSON_VIEW_SQL}) WHERE NOT malformed"""
    q["encode_packets"] = f"""SELECT seq, action, p_segment AS has_segment, CASE WHEN p_segment THEN v_segment END AS segment,
       CASE WHEN p_value THEN v_value END AS value FROM ({ACCOUNTS_LOG_SQL})"""
    q["read_packets"] = f"""SELECT seq, action, malformed FROM ({JSON_VIEW_SQL})"""
    q["packets_from_frame"] = f"""
SELECT CAST(c_custkey AS BIGINT) AS user_id, c_acctbal AS value, c_mktsegment AS segment FROM customer
WHERE c_mktsegment NOT IN ('{fx.VERB_DELETE_SEGMENT}', '{fx.VERB_UPDATE_SEGMENT}')
UNION ALL
SELECT CAST(c_custkey AS BIGINT), c_acctbal + 1, c_mktsegment FROM customer WHERE c_mktsegment = '{fx.VERB_UPDATE_SEGMENT}'"""

    acc_oc = fold_outcomes_sql(A, B, L, "*")
    q["accepted_stream"] = fold_outcomes_sql(A, B, L, "seq, action, user_id, outcome", "outcome NOT IN ('rejected', 'quarantined')")
    lines_po = f"""WITH pk AS ({LINES_PACKETS_SQL}), ef AS ({fold_outcomes_sql(LS, LB, LE, "seq, key_ok, outcome")})
SELECT p.seq, p.action,
  CASE WHEN p.full_key THEN max(e.outcome)
       WHEN bool_or(e.outcome IN ('updated', 'deleted')) THEN max(CASE WHEN e.outcome IN ('updated', 'deleted') THEN e.outcome END)
       WHEN p.action = 'set' THEN 'rejected' ELSE 'noop' END AS outcome
FROM pk p LEFT JOIN ef e ON e.seq = p.seq GROUP BY p.seq, p.action, p.full_key"""
    targets = "SELECT * FROM (VALUES " + ", ".join(f"('{d}', '{t}', '{qn}', {str(en).upper()})" for d, t, qn, _, en in fx.ROUTES) + ") r(destination, target, queue, enabled)"
    q["fan_out"] = f"""WITH r AS ({targets})
SELECT r.destination, r.target, r.queue, a.seq, a.action FROM ({acc_oc}) a JOIN r ON r.destination = 'accounts'
WHERE a.outcome NOT IN ('rejected', 'quarantined')
UNION ALL
SELECT r.destination, r.target, r.queue, l.seq, l.action FROM ({lines_po}) l JOIN r ON r.destination = 'lines'
WHERE l.outcome NOT IN ('rejected', 'quarantined')"""
    fwd_log = f"""SELECT l.* FROM ({L}) l WHERE l.seq IN (SELECT seq FROM ({acc_oc}) WHERE outcome NOT IN ('rejected', 'quarantined'))"""
    empty_base = f"SELECT * FROM ({B}) WHERE FALSE"
    rep_a = fold_table_sql(A, B, fwd_log)
    rep_b = fold_table_sql(A, empty_base, fwd_log)
    cols = "user_id, value, segment"
    q["routes_enabled"] = f"SELECT 'replica_a' AS target, {cols} FROM ({rep_a})"
    q["apply_targets"] = f"SELECT 'replica_a' AS target, {cols} FROM ({rep_a}) UNION ALL SELECT 'replica_b', {cols} FROM ({rep_b})"
    q["pipeline_batch"] = f"SELECT 'accounts' AS worker, {cols} FROM ({fold_table_sql(A, B, L)}) UNION ALL SELECT 'replica_a', {cols} FROM ({rep_a})"
    soft = f"""SELECT seq, CASE WHEN action = 'delete' THEN 'update' ELSE action END AS action, ts, user_id, key_ok,
       CASE WHEN action = 'delete' THEN FALSE ELSE p_value END AS p_value, v_value,
       CASE WHEN action = 'delete' THEN TRUE ELSE p_segment END AS p_segment,
       CASE WHEN action = 'delete' THEN '{fx.SOFT_DELETE_SEGMENT}' ELSE v_segment END AS v_segment FROM ({L})"""
    q["custom_processor"] = fold_table_sql(A, B, soft)
    stamped = FoldSpec(key=A.key, cols=[*A.cols, "timestamp"], not_null=A.not_null, defaults=A.defaults)
    stamp_log = f"SELECT *, action = 'update' AS p_timestamp, CAST(ts AS TIMESTAMP) AS v_timestamp FROM ({fwd_log})"
    soft_fwd = soft.replace(f"FROM ({L})", f"FROM ({fwd_log})")
    none = "CAST(NULL AS TIMESTAMP) AS timestamp"
    q["target_tables"] = f"""SELECT 'replica_a' AS target, {cols}, {none} FROM ({rep_a})
UNION ALL SELECT 'replica_b', {cols}, timestamp FROM ({fold_table_sql(stamped, f"SELECT *, {none} FROM ({B})", stamp_log)})
UNION ALL SELECT 'replica_c', {cols}, {none} FROM ({fold_table_sql(A, B, soft_fwd)})"""
    counters = """count(*) FILTER (WHERE action = 'add') AS "add", count(*) FILTER (WHERE action = 'delete') AS "delete",
       count(*) FILTER (WHERE action = 'set') AS "set", count(*) FILTER (WHERE action = 'update') AS "update",
       count(*) FILTER (WHERE action = 'add' AND outcome = 'rejected') AS errors,
       count(*) FILTER (WHERE outcome IN ('rejected', 'quarantined')) AS rejects"""
    q["worker_stats"] = f"""SELECT 'accounts' AS worker, {counters} FROM ({acc_oc})
UNION ALL SELECT 'replica_a', {counters} FROM ({fold_outcomes_sql(A, B, fwd_log, '*')})"""
    names = ["add", "delete", "set", "update", "errors", "rejects"]
    samples = f"""WITH per AS (
  SELECT 'w' || CAST(user_id % {fx.STATS_WORKERS} AS VARCHAR) AS worker,
         time_bucket(INTERVAL '{fx.STATS_INTERVAL}', ts) + INTERVAL '{fx.STATS_INTERVAL}' AS sample_ts, {counters}
  FROM ({acc_oc}) GROUP BY ALL)
SELECT worker, sample_ts, """ + ", ".join(
        f'CAST(sum("{c}") OVER (PARTITION BY worker ORDER BY sample_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "{c}"'
        for c in names) + " FROM per"
    q["sampled_counters"] = samples
    deltas = f"""SELECT * FROM (SELECT worker, sample_ts, """ + ", ".join(
        f'"{c}" - lag("{c}") OVER (PARTITION BY worker ORDER BY sample_ts) AS "{c}"' for c in names) + f""" FROM ({samples})) WHERE "add" IS NOT NULL"""
    q["counter_deltas"] = deltas
    q["recent_samples"] = f"""SELECT worker, sample_ts, {", ".join(chr(34) + c + chr(34) for c in names)} FROM (
  SELECT *, row_number() OVER (PARTITION BY worker ORDER BY sample_ts DESC) AS rn FROM ({deltas})) WHERE rn <= 300"""

    def prof(cols):
        nul = " OR ".join(f"{c} IS NULL" for c in cols)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        return f"""SELECT '{",".join(cols)}' AS candidate, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (WHERE {nul}) AS BIGINT) AS null_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT 1 FROM lineitem WHERE {nn} GROUP BY {", ".join(cols)} HAVING count(*) > 1)) AS duplicate_groups
FROM lineitem"""
    from rowtide.plans.queries import PROFILE_CANDIDATES
    q["profile_keys"] = "SELECT *, null_rows = 0 AND duplicate_groups = 0 AS is_key FROM (" + " UNION ALL ".join(prof(c) for c in PROFILE_CANDIDATES) + ")"
    miss = f"contains(url, '{fx.PAGE_MISS_MARK}')"
    by_pk = f"(contains(url, '{fx.PAGE_PK_MARK}') AND NOT {miss})"
    q["resolve_key"] = f"""SELECT 'pages' AS log, CAST(page_id AS BIGINT) AS seq, CASE WHEN {by_pk} THEN 'pk' ELSE 'unique' END AS match_kind FROM pages
UNION ALL SELECT 'lines', seq, CASE WHEN full_key THEN 'pk' ELSE 'pk_partial' END FROM ({LINES_PACKETS_SQL})
UNION ALL SELECT 'documents', doc_id, 'none' FROM documents"""
    q["apply_set_unique"] = f"""
SELECT CAST(page_id AS BIGINT) AS page_id, url, CASE WHEN {miss} THEN html ELSE html || '{fx.PAGE_HTML_SUFFIX}' END AS html FROM pages
UNION ALL
SELECT (SELECT max(page_id) FROM pages) + row_number() OVER (ORDER BY page_id), url || '{fx.PAGE_URL_SUFFIX}', html || '{fx.PAGE_HTML_SUFFIX}'
FROM pages WHERE {miss}"""
    alloc = "SELECT doc_id AS seq, CAST((SELECT max(item_id) FROM benchmark) + row_number() OVER (ORDER BY doc_id) AS BIGINT) AS note_id, text FROM documents"
    q["allocate_surrogate"] = f"SELECT seq, note_id FROM ({alloc})"
    q["enrich_returned_key"] = f"SELECT seq, note_id FROM ({alloc})"
    q["apply_set_insert"] = f"""SELECT CAST(item_id AS BIGINT) AS note_id, text AS body FROM benchmark
UNION ALL SELECT note_id, text FROM ({alloc})"""
    parents = f"SELECT doc_id FROM documents WHERE lang <> '{fx.PARENT_MISSING_LANG}'"
    child = f"SELECT CAST(doc_id AS BIGINT) AS doc_id, quality, toxic FROM labels WHERE doc_id IN ({parents})"
    q["reject_fk"] = f"SELECT doc_id AS seq, CAST(doc_id AS BIGINT) AS doc_id FROM labels WHERE doc_id NOT IN ({parents})"
    q["restrict_parent_delete"] = f"""SELECT doc_id AS seq, doc_id,
  CASE WHEN doc_id IN (SELECT doc_id FROM ({child})) THEN 'refused' ELSE 'deleted' END AS outcome
FROM documents"""
    q["cascade_parent_key"] = f"""SELECT CAST(COALESCE(m.new_doc_id, c.doc_id) AS BIGINT) AS doc_id, c.quality, c.toxic FROM ({child}) c
LEFT JOIN (SELECT doc_id AS old_doc_id, doc_id + (SELECT max(doc_id) + 1 FROM documents) AS new_doc_id
           FROM documents) m ON m.old_doc_id = c.doc_id"""
    doc_off = "(SELECT max(doc_id) + 1 FROM documents)"
    q["fk_two_tables"] = f"""SELECT CAST(doc_id AS BIGINT) AS label_id, CAST(doc_id + {doc_off} AS BIGINT) AS doc_id, quality
FROM labels WHERE doc_id % 2 = 0 AND doc_id IN (SELECT doc_id FROM documents)"""
    q["fk_two_tables_outcomes"] = f"""WITH kept AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0 AND doc_id IN (SELECT doc_id FROM labels))
SELECT doc_id * 10 + 3 AS seq, 'delete' AS action, CASE WHEN doc_id IN (FROM kept) THEN 'quarantined' ELSE 'deleted' END AS outcome,
  CASE WHEN doc_id IN (FROM kept) THEN 'restrict' END AS reason FROM documents
UNION ALL SELECT doc_id * 10 + 7, 'update', CASE WHEN doc_id IN (FROM kept) THEN 'updated' ELSE 'noop' END, NULL FROM documents
UNION ALL SELECT doc_id * 10 + CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 5 END, 'add',
  CASE WHEN doc_id % 2 = 0 AND doc_id IN (SELECT doc_id FROM documents) THEN 'inserted' ELSE 'rejected' END,
  CASE WHEN NOT (doc_id % 2 = 0 AND doc_id IN (SELECT doc_id FROM documents)) THEN 'foreign_key' END FROM labels"""
    q["quarantine"] = f"""SELECT pos, CASE WHEN malformed THEN 'malformed'
       WHEN action NOT IN ('add', 'set', 'update', 'delete') THEN 'unknown_action'
       WHEN bad_value THEN 'bad_value'
       WHEN action IN ('update', 'delete') AND n_restriction = 0 THEN 'empty_restriction'
       WHEN action IN ('update', 'delete') AND n_unknown_restriction > 0 THEN 'unknown_column' END AS reason
FROM ({JSON_VIEW_SQL})
WHERE malformed OR action NOT IN ('add', 'set', 'update', 'delete') OR bad_value
   OR (action IN ('update', 'delete') AND (n_restriction = 0 OR n_unknown_restriction > 0))"""
    lenient = f"""SELECT * FROM ({JSON_FLAT_SQL})
WHERE NOT malformed AND k <> {fx.JSON_UNKNOWN_ACTION_K}
  AND NOT (k = {fx.JSON_BAD_VALUE_K} AND action IN ('add', 'set') AND p_value)
  AND NOT (k = {fx.JSON_EMPTY_RESTRICTION_K} AND action IN ('update', 'delete'))"""
    q["restrict_unknown_col"] = fold_outcomes_sql(A, B, lenient, "pos, seq, outcome", f"k = {fx.JSON_UNKNOWN_RESTRICTION_K} AND action = 'update'")

    C = FoldSpec(key=["c_custkey"], cols=["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    cust = "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS INT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"
    sets = f"""SELECT o_orderkey * 10 AS seq, 'set' AS action, CAST(o_custkey AS BIGINT) AS c_custkey, TRUE AS key_ok,
  FALSE AS p_c_name, CAST(NULL AS VARCHAR) AS v_c_name, FALSE AS p_c_nationkey, CAST(NULL AS INT) AS v_c_nationkey,
  FALSE AS p_c_acctbal, CAST(NULL AS DOUBLE) AS v_c_acctbal, TRUE AS p_c_mktsegment, o_orderpriority AS v_c_mktsegment
FROM orders"""
    top = "(SELECT max(o_orderkey) FROM orders)"

    def barrier_sql(on: str, state: str = cust) -> str:
        for r in range(5):
            b = f"((2 * {r} + 1) * {top} * 10 + 5)"
            lo = f"((2 * {r - 1} + 1) * {top} * 10 + 5)" if r > 0 else None
            seg = f"SELECT * FROM ({sets}) WHERE seq < {b}" + (f" AND seq > {lo}" if lo else "")
            state = fold_table_sql(C, state, seg)
            if on == "nation":
                cond = f"c_nationkey = (SELECT min(n_nationkey) FROM nation WHERE n_regionkey = {r})"
                val = "0.0"
            else:
                cond = f"c_mktsegment = '{fx.BARRIER_SEGMENTS[r]}'"
                val = "-1.0"
            if r % 2 == 0:
                state = f"SELECT c_custkey, c_name, c_nationkey, CASE WHEN ({cond}) IS TRUE THEN {val} ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM ({state})"
            else:
                state = f"SELECT * FROM ({state}) WHERE ({cond}) IS NOT TRUE"
        last = f"((2 * 4 + 1) * {top} * 10 + 5)"
        return fold_table_sql(C, state, f"SELECT * FROM ({sets}) WHERE seq > {last}")

    q["restrict_non_key"] = barrier_sql("nation")
    q["apply_barriers"] = barrier_sql("segment")
    off = "(SELECT max(o_orderkey) + 1 FROM orders)"
    q["apply_key_move"] = f"""SELECT CASE WHEN o_orderstatus = '{fx.MOVE_STATUS}'
  THEN o_orderkey + {off} ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders"""
    q["key_move_partial"] = f"""SELECT CASE WHEN o_orderstatus = '{fx.MOVE_STATUS}' THEN o_orderkey + {off} ELSE o_orderkey END AS o_orderkey,
  o_custkey, o_orderstatus, o_totalprice, o_orderdate, '{fx.MOVED_PRIORITY}' AS o_orderpriority FROM orders"""
    q["pipeline_key_move"] = f"""SELECT w.worker, t.* FROM ({q["key_move_partial"]}) t, (VALUES ('orders'), ('replica_a')) w(worker)"""
    q["pipeline_barriers"] = f"""SELECT w.worker, t.* FROM ({q["apply_barriers"]}) t, (VALUES ('customers'), ('replica_a')) w(worker)
UNION ALL SELECT 'replica_b', t.* FROM ({barrier_sql("segment", f"SELECT * FROM ({cust}) WHERE c_nationkey % 2 = 0")}) t"""
    q["restrict_null"] = "SELECT n_nationkey + 2000 AS seq, 'noop' AS outcome FROM nation"
    held = f"SELECT *, count(*) OVER (PARTITION BY c_nationkey) = 1 AS renamed, c_nationkey % 2 = 1 AS dropped FROM ({cust})"
    q["unique_all_tiers"] = f"""SELECT c_custkey, CASE WHEN renamed THEN (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) ELSE c_name END AS c_name,
  c_nationkey, c_acctbal, c_mktsegment FROM ({held}) WHERE NOT dropped
UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM ({held}) WHERE dropped OR renamed"""
    q["unique_all_tiers_outcomes"] = f"""WITH per AS (SELECT n_nationkey AS n, count(c_custkey) AS c FROM nation LEFT JOIN ({cust}) ON c_nationkey = n_nationkey GROUP BY 1)
SELECT CAST(n AS BIGINT) AS seq, 'update' AS action, CASE c WHEN 0 THEN 'noop' WHEN 1 THEN 'updated' ELSE 'quarantined' END AS outcome,
  CASE WHEN c > 1 THEN 'duplicate_unique' END AS reason, CASE WHEN c = 1 THEN 1 ELSE 0 END AS rows FROM per
UNION ALL SELECT n + 1000, 'delete', CASE c WHEN 0 THEN 'noop' ELSE 'deleted' END, NULL, c FROM per WHERE n % 2 = 1
UNION ALL SELECT n + 2000, 'delete', 'noop', NULL, 0 FROM per
UNION ALL SELECT c_custkey + 10000, 'add', CASE WHEN dropped OR renamed THEN 'inserted' ELSE 'rejected' END,
  CASE WHEN NOT (dropped OR renamed) THEN 'duplicate_unique' END, CASE WHEN dropped OR renamed THEN 1 ELSE 0 END FROM ({held})"""
    strict_valid = f"""SELECT * FROM ({lenient}) WHERE NOT (k = {fx.JSON_UNKNOWN_RESTRICTION_K} AND action = 'update')"""
    q["pipeline_stream"] = fold_table_sql(A, B, strict_valid)
    q["key_move_outcomes"] = f"""SELECT o_orderkey AS seq, CASE WHEN o_orderstatus = '{fx.GHOST_STATUS}' THEN 'noop' ELSE 'updated' END AS outcome
FROM orders"""
    q["outcomes_complete"] = "SELECT event_id AS pos, 1 AS outcomes FROM events"
    q["stream_late_packets"] = fold_table_sql(A, B, f"""SELECT * REPLACE (seq + CASE WHEN seq < (SELECT (min(event_id) + max(event_id)) // 2 FROM events)
  THEN 1000000000000 ELSE 0 END AS seq) FROM ({strict_valid})""")
    q["stream_restart"] = q["pipeline_stream"]
    sent = f"""SELECT l.* FROM ({strict_valid}) l WHERE l.seq IN (
  SELECT seq FROM ({fold_outcomes_sql(A, B, strict_valid, "seq, outcome")}) WHERE outcome NOT IN ('rejected', 'quarantined'))"""
    q["target_catch_up"] = f"""SELECT 'replica_a' AS target, {cols} FROM ({fold_table_sql(A, B, sent)})
UNION ALL SELECT 'replica_b', {cols} FROM ({fold_table_sql(A, empty_base, sent)})"""
    made = f"""SELECT page_id * 10 AS seq, url || '{fx.TWIN_SUFFIX}' AS url, 'n' || page_id || 's' AS html FROM pages WHERE page_id % 3 = 0
UNION ALL SELECT page_id * 10 + 1, url || '{fx.TWIN_SUFFIX}', 'n' || page_id || 's' FROM pages WHERE page_id % 3 <> 0
UNION ALL SELECT page_id * 10 + 3, url, 'n' || page_id FROM pages WHERE page_id % 3 = 1"""
    q["apply_unique_mixed"] = f"""SELECT CAST(page_id AS BIGINT) AS page_id, CASE WHEN page_id % 3 = 1 THEN url || '{fx.GONE_SUFFIX}' ELSE url END AS url, html FROM pages
UNION ALL SELECT (SELECT max(page_id) FROM pages) + row_number() OVER (ORDER BY seq), url, html FROM ({made})"""
    q["reject_duplicate_unique"] = "SELECT page_id * 10 + 4 AS seq, 'add' AS action FROM pages"
    return q
