"""ANSI-style SQL for every registered query, run by DuckDB on the same tables.

Each statement is assembled from named sub-queries; only those it needs (directly or not) are
put in front of it.
"""

import re

FIELDS = ("click", "view", "purchase", "signup", "error")
CELLS = (*FIELDS, "note")
BLOCKS = {}
SQL = {}


def block(name, body):
    BLOCKS[name] = body
    return name


def oracle(name, body):
    """Register ``WITH <needed blocks> body`` for a query."""
    needed = set()

    def visit(text):
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in BLOCKS and word not in needed:
                needed.add(word)
                visit(BLOCKS[word])

    visit(body)
    parts = [f"{n} AS ({BLOCKS[n]})" for n in BLOCKS if n in needed]
    SQL[name] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# --- derived logs ------------------------------------------------------------------------------

block("edits", """
  SELECT event_id + 1 AS event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         'u' || CAST(user_id AS VARCHAR) AS uid,
         'app.' || CASE WHEN user_id % 4 = 0 THEN 'alerts' ELSE 'users' END AS ident
  FROM events""")

block("base", """
  SELECT ident, uid, user_id AS id, {}, CAST(NULL AS VARCHAR) AS note
  FROM edits GROUP BY ident, uid, user_id
  HAVING arg_min(event_type, event_id) <> 'signup'""".format(", ".join(
    f"'b' || max(event_id) FILTER (WHERE event_type = '{f}') AS {f}" for f in FIELDS)))
block("base_cells", " UNION ALL ".join(
    f"SELECT ident, uid, '{c}' AS field, {c} AS value FROM base" for c in CELLS))
block("cell_names", "SELECT unnest(['{}']) AS field".format("', '".join(CELLS)))

# The star: rows that the centre inserts are not in the base, a log inserts a row once, and events
# before that are statements.
block("added_rows", """
  SELECT uid, min(event_id) AS event_id FROM edits
  WHERE user_id % 3 = 0 AND k BETWEEN 1 AND 4 AND event_id > 200 AND ts > TIMESTAMP '2024-01-05'
  GROUP BY uid""")
block("start_rows", "SELECT * FROM base WHERE uid NOT IN (SELECT uid FROM added_rows)")
block("start_cells", """
  SELECT * FROM base_cells WHERE uid NOT IN (SELECT uid FROM added_rows)""")
block("own_rows", """
  SELECT uid, min(event_id) AS event_id FROM edits
  WHERE k BETWEEN 50 AND 53 AND uid NOT IN (SELECT uid FROM start_rows)
    AND (user_id % 4 = 0 OR uid NOT IN (SELECT uid FROM added_rows)) GROUP BY uid""")

for name, action in (
    ("central_ev", "WHEN k < 5 THEN 'I' WHEN k >= 5 AND k < 8 THEN 'D' WHEN k = 99 THEN 'T'"),
    ("star_ev", """WHEN event_id IN (SELECT event_id FROM added_rows) THEN 'I'
      WHEN k = 99 OR event_id < (SELECT a.event_id FROM added_rows a WHERE a.uid = edits.uid)
      THEN 'T' WHEN k >= 5 AND k < 8 THEN 'D'"""),
):
    block(name, f"""
  SELECT event_id, ts AS tstamp, user_id, event_type, k, ident, event_id AS tag, action,
         CASE WHEN action <> 'T' THEN uid END AS uid,
         CASE WHEN k % 7 = 0 THEN 'clone_a' WHEN k % 7 = 1 THEN 'clone_b' END AS origin,
         epoch_us(CASE WHEN k % 7 IN (0, 1) AND k % 2 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END)
           AS orig_micros
  FROM (SELECT *, CASE {action} ELSE 'U' END AS action FROM edits)""")

for name, action in (
    ("clone_ev", "WHEN k BETWEEN 50 AND 53 THEN 'I' WHEN k BETWEEN 54 AND 55 THEN 'D'"),
    ("star_clone_ev", """WHEN event_id IN (SELECT event_id FROM own_rows) THEN 'I'
      WHEN uid NOT IN (SELECT uid FROM start_rows) AND event_id < coalesce(
        (SELECT o.event_id FROM own_rows o WHERE o.uid = edits.uid), CAST(1152921504606846976 AS BIGINT)) THEN 'T'
      WHEN k BETWEEN 54 AND 55 THEN 'D'"""),
):
    block(name, f"""
  SELECT event_id, ts + (k % 5 - 2) * INTERVAL 1 HOUR AS tstamp, user_id, event_type, k, ident,
         event_id AS tag, CASE WHEN action <> 'T' THEN uid END AS uid, NULL AS origin, action,
         epoch_us(ts + (k % 5 - 2) * INTERVAL 1 HOUR) AS orig_micros
  FROM (SELECT *, CASE {action} ELSE 'U' END AS action FROM edits)""")

# Logged row values, one per column (the note is NULL for even k).
block("row_values", " UNION ALL ".join(
    ["SELECT event_id, 'id' AS field, CAST(user_id AS VARCHAR) AS value FROM edits",
     "SELECT event_id, 'uid', uid FROM edits",
     "SELECT event_id, 'note', CASE WHEN k % 2 = 1 THEN 'n' || k END FROM edits"]
    + [f"SELECT event_id, '{f}', 'o' || event_id FROM edits" for f in FIELDS]))

# New values of updates.
for ev, out in (("central_ev", "central_new"), ("star_ev", "star_new")):
    block(out, f"""
  SELECT event_id, event_type AS field, 'v' || event_id AS value FROM {ev}
  WHERE action = 'U' AND k <> 98
  UNION ALL SELECT event_id, 'id', CAST(event_id AS VARCHAR) FROM {ev}
  WHERE action = 'U' AND k = 98
  UNION ALL SELECT event_id, 'note', CASE WHEN k % 20 <> 0 THEN 'n' || k END FROM {ev}
  WHERE action = 'U' AND k % 10 = 0""")
for ev, out in (("clone_ev", "clone_new"), ("star_clone_ev", "star_clone_new")):
    block(out, f"""
  SELECT event_id, event_type AS field, 'c' || event_id AS value FROM {ev} WHERE action = 'U'
  UNION ALL SELECT event_id, 'note', 'm' || k FROM {ev}
  WHERE action = 'U' AND k % 15 = 0""")

block("seen", "SELECT event_id FROM edits WHERE k % 11 = 0")
for ev, out in (("central_ev", "pending_ev"), ("star_ev", "pending_star")):
    block(out, f"""
  SELECT * FROM {ev}
  WHERE (origin <> 'clone_a' OR origin IS NULL) AND ident = 'app.users'
    AND tstamp > TIMESTAMP '2024-01-05' AND event_id > 200
    AND event_id NOT IN (SELECT event_id FROM seen)""")


def grain(out, ev, new):
    """Field grain of a log."""
    block(out, f"""
  SELECT e.event_id, e.ident, e.action, n.field, n.value, e.uid, e.tstamp, e.orig_micros,
         CASE WHEN e.origin IS NULL THEN 'central' ELSE 'clone' END AS origin_label,
         e.action = 'T' OR coalesce(n.field = 'id', false) AS noop
  FROM {ev} e LEFT JOIN {new} n ON e.event_id = n.event_id""")


grain("all_fc", "central_ev", "central_new")
grain("central_fc", "pending_ev", "central_new")
grain("clone_fc", "clone_ev", "clone_new")
grain("star_all_fc", "star_ev", "star_new")
grain("star_fc", "pending_star", "star_new")
grain("star_clone_fc", "star_clone_ev", "star_clone_new")


def compacted(out, changes, updates_only):
    last = f"""
  SELECT * FROM {changes} {{}} QUALIFY row_number() OVER (
    PARTITION BY ident, action, field, uid ORDER BY event_id DESC) = 1"""
    if updates_only:
        block(out, last.format("WHERE action = 'U'")
              + f" UNION ALL SELECT * FROM {changes} WHERE action <> 'U'")
    else:
        block(out, last.format(""))


compacted("central_ref", "central_fc", False)
compacted("central_last", "central_fc", True)
compacted("clone_last", "clone_fc", True)
compacted("star_news", "star_fc", True)
compacted("star_clone_news", "star_clone_fc", True)


def fought(out, central, clone):
    block(out, f"""
  SELECT c.ident, c.uid, c.field, c.event_id AS central_event_id, k.event_id AS clone_event_id,
         c.value AS central_value, k.value AS clone_value, c.tstamp AS central_tstamp,
         c.orig_micros AS central_orig_micros, k.orig_micros AS clone_orig_micros,
         CASE WHEN k.orig_micros <= c.orig_micros THEN 'clone' ELSE 'central' END AS rejected
  FROM {central} c JOIN {clone} k ON c.ident = k.ident AND c.uid = k.uid
    AND c.field = k.field AND c.action = 'U' AND k.action = 'U'""")


fought("conflicts", "central_last", "clone_last")
fought("star_conflicts", "star_news", "star_clone_news")


def kept(out, changes, lost, side):
    block(out, f"""
  SELECT a.* FROM {changes} a WHERE NOT EXISTS (
    SELECT 1 FROM {lost} x WHERE x.rejected = '{side}' AND a.action = 'U' AND x.ident = a.ident
      AND x.uid = a.uid AND x.field = a.field)""")


kept("central_kept", "central_last", "conflicts", "central")
kept("clone_kept", "clone_last", "conflicts", "clone")
kept("star_kept", "star_news", "star_conflicts", "central")
kept("star_clone_kept", "star_clone_news", "star_conflicts", "clone")

def folded(prefix, changes, rows="base", cells="base_cells"):
    """The changes applied to ``rows`` with their ``cells``: blocks <prefix>_st (statuses), <prefix>_rows (surviving rows) and <prefix>_cells."""
    block(f"{prefix}_prev", f"""
  SELECT *, last_value(CASE WHEN NOT noop AND action IN ('I', 'D') THEN action END IGNORE NULLS)
    OVER (PARTITION BY ident, uid ORDER BY event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {changes}""")
    block(f"{prefix}_st", f"""
  SELECT p.*, CASE WHEN noop THEN 'noop'
    WHEN action = 'I' AND coalesce(prev = 'I', b.uid IS NOT NULL) THEN 'unique_violation'
    WHEN action <> 'I' AND NOT coalesce(prev = 'I', b.uid IS NOT NULL) THEN 'no_match'
    ELSE 'applied' END AS status
  FROM {prefix}_prev p LEFT JOIN {rows} b ON p.ident = b.ident AND p.uid = b.uid""")
    block(f"{prefix}_life", f"""
  SELECT ident, uid, max(event_id) FILTER (WHERE action = 'I') AS birth,
         max(event_id) FILTER (WHERE action = 'D') AS death
  FROM {prefix}_st WHERE status = 'applied' GROUP BY ident, uid""")
    block(f"{prefix}_rows", f"""
  SELECT coalesce(b.ident, l.ident) AS ident, coalesce(b.uid, l.uid) AS uid, l.birth, l.death,
         b.uid IS NOT NULL AS in_base,
         CASE WHEN l.death IS NULL THEN b.uid IS NOT NULL OR l.birth IS NOT NULL
              ELSE coalesce(l.birth > l.death, false) END AS alive
  FROM {rows} b FULL JOIN {prefix}_life l ON b.ident = l.ident AND b.uid = l.uid""")
    block(f"{prefix}_last", f"""
  SELECT ident, uid, field, event_id, value, orig_micros FROM {changes}
  WHERE action = 'U' AND NOT noop QUALIFY row_number() OVER (
    PARTITION BY ident, uid, field ORDER BY event_id DESC) = 1""")
    block(f"{prefix}_cells", f"""
  SELECT r.ident, r.uid, f.field,
    CASE WHEN u.event_id IS NOT NULL AND (r.birth IS NULL OR u.event_id > r.birth) THEN u.value
         WHEN r.birth IS NOT NULL THEN v.value ELSE b.value END AS value
  FROM {prefix}_rows r CROSS JOIN cell_names f
  LEFT JOIN {prefix}_last u ON u.ident = r.ident AND u.uid = r.uid AND u.field = f.field
  LEFT JOIN row_values v ON v.event_id = r.birth AND v.field = f.field
  LEFT JOIN {cells} b ON b.ident = r.ident AND b.uid = r.uid AND b.field = f.field
  WHERE r.alive""")


folded("fold", "all_fc")
folded("up", "clone_last")
folded("down", "star_news", "start_rows", "start_cells")
folded("centre", "star_all_fc", "start_rows", "start_cells")
folded("leaf", "star_clone_fc", "start_rows", "start_cells")
for side in ("centre", "leaf"):
    block(f"{side}_alive", f"SELECT ident, uid FROM {side}_rows WHERE alive")
folded("sync_down", "star_kept", "leaf_alive", "leaf_cells")
folded("sync_up", "star_clone_kept", "centre_alive", "centre_cells")

# --- orders as two snapshots -------------------------------------------------------------------

ORDER_COLUMNS = ("uid", "id", "custkey", "status", "priority", "cents", "batch")
block("orders_old", """
  SELECT md5(CAST(o_orderkey AS VARCHAR)) AS uid, o_orderkey AS id, o_custkey AS custkey,
         o_orderstatus AS status, o_orderpriority AS priority,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(1 AS BIGINT) AS batch
  FROM orders""")
block("orders_new", """
  SELECT uid, id, custkey,
         CASE WHEN status = 'O' AND priority = '2-HIGH' THEN 'F' ELSE status END AS status,
         CASE WHEN status = 'P' AND priority = '1-URGENT' THEN NULL ELSE priority END AS priority,
         cents, CAST(CASE WHEN priority = '3-MEDIUM' THEN 2 ELSE batch END AS BIGINT) AS batch
  FROM orders_old WHERE NOT (status = 'F' AND priority = '5-LOW')
  UNION ALL
  SELECT md5('c' || CAST(c_custkey AS VARCHAR)), c_custkey + 1000000000, c_custkey, 'O', NULL,
         CAST(round(c_acctbal * 100) AS BIGINT), CAST(2 AS BIGINT) FROM customer""")


def diffed(out, columns):
    changed = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in columns)
    both = ", ".join(f"o.{c} AS o_{c}, n.{c} AS n_{c}" for c in ORDER_COLUMNS)
    block(out, f"""
  SELECT coalesce(o.uid, n.uid) AS uid, {both},
         CASE WHEN o.uid IS NULL THEN 'I' WHEN n.uid IS NULL THEN 'D' ELSE 'U' END AS action
  FROM orders_old o FULL JOIN orders_new n ON o.uid = n.uid
  WHERE o.uid IS NULL OR n.uid IS NULL OR {changed}""")


KEPT_COLUMNS = tuple(c for c in ORDER_COLUMNS if c not in ("batch", "cents"))
diffed("diff_all", ORDER_COLUMNS)
diffed("diff_kept", KEPT_COLUMNS)
diffed("diff_no_batch", tuple(c for c in ORDER_COLUMNS if c != "batch"))

oracle("capture_changes", " UNION ALL ".join(
    [f"""SELECT uid, action, '{c}' AS field,
         CAST(CASE WHEN action = 'I' THEN n_{c} ELSE o_{c} END AS VARCHAR) AS value,
         'row' AS part FROM diff_all""" for c in ORDER_COLUMNS]
    + [f"""SELECT uid, action, '{c}', CAST(n_{c} AS VARCHAR), 'changed' FROM diff_all
         WHERE action = 'U' AND o_{c} IS DISTINCT FROM n_{c}""" for c in ORDER_COLUMNS]))
oracle("capture_ignored", " UNION ALL ".join(
    [f"""SELECT uid, action, {len(KEPT_COLUMNS)} AS n_row_values, NULL AS field, NULL AS value
         FROM diff_kept WHERE action <> 'U'"""]
    + [f"""SELECT uid, action, {len(KEPT_COLUMNS)}, '{c}', CAST(n_{c} AS VARCHAR) FROM diff_kept
         WHERE action = 'U' AND o_{c} IS DISTINCT FROM n_{c}""" for c in KEPT_COLUMNS]))
oracle("capture_noop", """
  SELECT action, count(*) AS n_events, 'nothing' AS ignoring FROM diff_all GROUP BY action
  UNION ALL SELECT action, count(*), 'batch' FROM diff_no_batch GROUP BY action""")
oracle("capture_statements", """
  SELECT 'edited' AS run, action, true AS statement_only, true AS no_values
  FROM (SELECT DISTINCT action FROM diff_all)
  UNION ALL SELECT 'emptied', 'T', true, true FROM orders_old HAVING count(*) > 0""")
oracle("stamp_provenance", """
  SELECT event_id, 'clone_a' AS origin, epoch_us(tstamp) AS orig_micros, 'centre' AS server_id,
         'round-1' AS sync_id FROM clone_ev""")
oracle("order_events", """
  SELECT row_number() OVER (ORDER BY tstamp, event_id)
         + (SELECT max(event_id) FROM central_ev) AS event_id, event_id AS old_event_id
  FROM clone_ev""")

block("returned_parts", """
  SELECT * FROM part WHERE p_partkey IN (
    SELECT l_partkey FROM lineitem GROUP BY l_partkey
    HAVING sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) * 3 > sum(l_quantity))""")
oracle("insert_if_absent", """
  SELECT p_brand, p_type, p_size, max(p_partkey) AS first_part FROM returned_parts
  GROUP BY p_brand, p_type, p_size
  UNION ALL
  SELECT p_brand, p_type, p_size, min(p_partkey) FROM part p
  WHERE NOT EXISTS (SELECT 1 FROM returned_parts r WHERE r.p_brand = p.p_brand
                    AND r.p_type = p.p_type AND r.p_size = p.p_size)
  GROUP BY p_brand, p_type, p_size""")
block("inventory", """
  SELECT DISTINCT p_brand AS schema_name, p_type || '_' || p_size AS table_name FROM part""")
block("registered", """
  SELECT DISTINCT p_brand || '.' || p_type || '_' || p_size AS relation_name
  FROM returned_parts""")
for name, word in (("missing_capture", "NOT IN"), ("captured_tables", "IN")):
    oracle(name, f"""
  SELECT *, schema_name || '.' || table_name AS relation_name FROM inventory
  WHERE schema_name || '.' || table_name {word} (SELECT relation_name FROM registered)""")
UUID = "regexp_replace({}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"
oracle("add_uid", """
  SELECT c_custkey, {} AS uid, true AS added, false AS added_again FROM customer""".format(
    UUID.format("md5(CAST(c_custkey AS VARCHAR) || '|' || c_name)")))
block("without_uid", """
  SELECT c_mktsegment AS schema_name, 'nation_' || c_nationkey AS table_name FROM customer
  GROUP BY ALL HAVING count(*) FILTER (WHERE c_acctbal < 0) = 0""")
oracle("missing_uid", "SELECT * FROM without_uid")
oracle("check_uid_unique", """
  SELECT uid, count(*) AS n_rows FROM (
    SELECT CASE WHEN l_quantity < 50 THEN md5(l_orderkey || '|' || l_linenumber) END AS uid
    FROM lineitem) GROUP BY uid HAVING uid IS NULL OR count(*) > 1""")

# --- orders as sync rounds ---------------------------------------------------------------------

block("round_servers", """
  SELECT l_orderkey AS orderkey, min(1 + l_partkey * 8 + l_linenumber) AS seq,
         'clone_' || s_nationkey AS server FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY l_orderkey, s_nationkey
  UNION ALL
  SELECT o_orderkey, 0, 'clone_' || c_nationkey FROM orders
  JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW'""")
block("round_lists", """
  SELECT orderkey, list(server ORDER BY seq, server) AS servers FROM round_servers
  GROUP BY orderkey""")
block("rounds", """
  SELECT md5(CAST(coalesce(o_orderkey, orderkey) AS VARCHAR)) AS sync_id,
         CASE WHEN o_orderkey IS NOT NULL THEN 'centre' END AS server_from, servers,
         CASE WHEN o_orderkey IS NOT NULL THEN CAST(1 AS BIGINT) END AS min_event_id,
         o_orderkey AS max_event_id, epoch_us(o_orderdate) AS sync_micros,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'full'
              WHEN o_orderkey IS NOT NULL THEN 'partial' END AS sync_type,
         CASE WHEN o_orderstatus = 'P' THEN 'pending'
              WHEN o_orderkey IS NOT NULL THEN 'done' END AS sync_status,
         epoch_us(TIMESTAMP '2024-01-01' + (o_custkey % 720) * INTERVAL 1 HOUR) AS max_micros
  FROM orders FULL JOIN round_lists ON o_orderkey = orderkey""")
oracle("fold_history", """
  SELECT sync_id, server_from, array_to_string(servers, ',') AS server_to, min_event_id,
         max_event_id, sync_micros, sync_type, sync_status FROM rounds""")
block("clone_marks", """
  SELECT clone_id, sync_id, max_event_id, sync_micros, max_micros
  FROM (SELECT *, unnest(servers) AS clone_id FROM rounds
        WHERE server_from = 'centre' AND sync_status = 'done')
  QUALIFY row_number() OVER (PARTITION BY clone_id
    ORDER BY sync_micros DESC, max_event_id DESC, sync_id DESC) = 1""")
oracle("last_sync", "SELECT * FROM clone_marks")
oracle("sync_lag", """
  SELECT m.clone_id, m.max_event_id, count(e.event_id) AS n_events
  FROM clone_marks m LEFT JOIN central_ev e
    ON e.event_id > m.max_event_id AND epoch_us(e.tstamp) > m.max_micros
  GROUP BY m.clone_id, m.max_event_id""")
oracle("deploy_guard", """
  SELECT clone_id, count(*) FILTER (WHERE late) AS newer_syncs,
         count(*) FILTER (WHERE late) = 0 AS allowed
  FROM (SELECT unnest(servers) AS clone_id,
               sync_micros > epoch_us(TIMESTAMP '2001-07-01') AS late
        FROM rounds WHERE server_from = 'centre') GROUP BY clone_id""")
block("server_tables", """
  SELECT DISTINCT 'clone_' || s_nationkey AS server_id,
         '"' || p_brand || '"."' || p_type || '"' AS table_name, l_returnflag
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""")
oracle("whitelist", """
  SELECT DISTINCT table_name FROM server_tables WHERE server_id = 'clone_0'""")
block("lists", """
  SELECT server_id, l_returnflag = 'R' AS is_new,
         list(DISTINCT table_name ORDER BY table_name) AS tables
  FROM server_tables GROUP BY ALL""")
oracle("merge_whitelist", """
  SELECT server_id, len(tables) AS n_tables, array_to_string(tables, ',') AS tables FROM (
    SELECT coalesce(o.server_id, n.server_id) AS server_id,
           coalesce(n.tables, []) || coalesce(o.tables, []) AS tables
    FROM (SELECT * FROM lists WHERE NOT is_new) o
    FULL JOIN (SELECT * FROM lists WHERE is_new) n ON o.server_id = n.server_id)""")
oracle("tables_by_schema", """
  SELECT replace(split_part(table_name, '.', 1), '"', '') AS schema_name,
         string_agg(DISTINCT split_part(table_name, '.', 2), ','
                    ORDER BY split_part(table_name, '.', 2)) AS tables
  FROM server_tables GROUP BY ALL""")

# --- pending -----------------------------------------------------------------------------------

oracle("pending_central", """
  SELECT event_id, ident, action, uid, epoch_us(tstamp) AS tx_micros FROM pending_ev""")
oracle("pending_by_receipts", """
  SELECT event_id, action FROM central_ev
  WHERE (origin <> 'clone_a' OR origin IS NULL) AND ident = 'app.users'
    AND event_id NOT IN (SELECT event_id FROM seen)""")
block("given_receipts", """
  SELECT 'clone_a' AS server_id, event_id FROM seen
  UNION SELECT 'clone_' || (o_custkey % 3), o_orderkey FROM orders""")
oracle("receipt_ranges", """
  SELECT server_id, min(event_id) AS lo, max(event_id) AS hi FROM (
    SELECT *, event_id - row_number() OVER (PARTITION BY server_id ORDER BY event_id) AS island
    FROM given_receipts) GROUP BY server_id, island""")
SQL["pending_by_ranges"] = SQL["pending_by_receipts"]
oracle("late_events", """
  SELECT event_id, action, epoch_us(tstamp) AS tx_micros FROM central_ev
  WHERE (origin <> 'clone_a' OR origin IS NULL) AND ident = 'app.users'
    AND (tstamp <= TIMESTAMP '2024-01-05' OR event_id <= 200)
    AND event_id NOT IN (SELECT event_id FROM seen)""")
oracle("pending_clone", """
  SELECT e.event_id, ident, action, epoch_us(tstamp) AS tx_micros,
         nullif(count(n.event_id), 0) AS n_changed
  FROM clone_ev e LEFT JOIN clone_new n ON e.event_id = n.event_id GROUP BY ALL""")
oracle("field_grain", """
  SELECT event_id, ident, action, origin_label, field, value, uid, orig_micros, noop
  FROM all_fc""")
oracle("effective_time", "SELECT event_id, orig_micros FROM central_ev")
oracle("origin_label", """
  SELECT event_id, CASE WHEN origin IS NULL THEN 'central' ELSE 'clone' END AS origin_label
  FROM central_ev""")


def rendered(out, changes, hidden):
    keys = "', '".join(hidden)
    block(f"{out}_inserts", f"""
  SELECT event_id,
    string_agg('"' || field || '"', ',' ORDER BY length(field), field) AS names,
    string_agg(CASE WHEN value IS NULL THEN 'NULL'
      ELSE '''' || replace(value, '''', '''''') || '''' END, ',' ORDER BY length(field), field)
      AS vals
  FROM row_values WHERE field NOT IN ('{keys}') GROUP BY event_id""")
    block(out, f"""
  SELECT c.event_id, c.field, c.noop OR coalesce(c.field IN ('{keys}'), false) AS noop,
    CASE WHEN c.action = 'I' THEN 'INSERT INTO ' || t || ' (' || i.names || ') VALUES ( '
           || i.vals || ')'
         WHEN c.action = 'D' THEN 'DELETE FROM ' || t || ' WHERE "uid" = ''' || c.uid || ''''
         WHEN c.action = 'U' AND c.field NOT IN ('{keys}') THEN
           'UPDATE ' || t || ' SET "' || c.field || '" = '
           || coalesce('''' || replace(c.value, '''', '''''') || '''', 'NULL')
           || ' WHERE "uid" = ''' || c.uid || ''''
         ELSE '' END AS statement
  FROM (SELECT *, '"' || replace(ident, '.', '"."') || '"' AS t FROM {changes}) c
  LEFT JOIN {out}_inserts i ON c.event_id = i.event_id""")


rendered("statements", "all_fc", ("id",))
rendered("partial_statements", "all_fc", ("id", "note", "click"))
oracle("render_statements", "SELECT event_id, field, statement FROM statements")
oracle("exclude_columns", "SELECT event_id, field, noop, statement FROM partial_statements")
oracle("export_sql_script", """
  SELECT statement || ';' AS line FROM statements WHERE statement <> ''""")

# --- analysis ----------------------------------------------------------------------------------

oracle("sync_bounds", """
  SELECT count(*) AS n_events, min(event_id) AS min_event_id, max(event_id) AS max_event_id,
         epoch_us(max(tstamp)) AS max_micros FROM pending_ev""")
FLAT = "event_id, ident, action, field, value, uid"
oracle("compact_central", f"SELECT {FLAT} FROM central_ref")
oracle("compact_clone", f"SELECT {FLAT} FROM clone_last")
oracle("detect_conflicts", """
  SELECT ident, uid, field, central_event_id, clone_event_id, central_value, clone_value,
         central_orig_micros, clone_orig_micros FROM conflicts""")
oracle("resolve_conflicts", """
  SELECT ident, uid, field, rejected, 'last_modified' AS rule_applied FROM conflicts""")
for name in ("drop_rejected", "reconcile"):
    oracle(name, f"""
  SELECT {FLAT}, 'central' AS side FROM central_kept
  UNION ALL SELECT {FLAT}, 'clone' FROM clone_kept""")
UPDATE_TEXT = """'UPDATE "' || replace(ident, '.', '"."') || '" SET "' || field || '" = '
         || coalesce('''' || {} || '''', 'NULL') || ' WHERE "uid" = ''' || uid || ''''"""
block("ledger", """
  SELECT ident, uid, field, 'clone_a' AS clone_id, central_event_id,
         epoch_us(TIMESTAMP '2024-03-01') AS conflict_micros,
         epoch_us(central_tstamp) AS central_micros,
         CASE WHEN field = 'id' THEN '' ELSE {} END AS central_sql,
         CASE WHEN field = 'id' THEN '' ELSE {} END AS clone_sql,
         rejected, 'last_modified' AS rule_applied FROM conflicts""".format(
    UPDATE_TEXT.format("central_value"), UPDATE_TEXT.format("clone_value")))
oracle("conflict_ledger", "SELECT * FROM ledger")
oracle("conflict_report", """
  SELECT ident, clone_id, rejected, count(*) AS n_conflicts FROM ledger GROUP BY ALL""")

# --- replay ------------------------------------------------------------------------------------

oracle("replay_fold", "SELECT * FROM fold_cells")
oracle("replay_status", "SELECT event_id, ident, action, field, status FROM fold_st")
oracle("replay_to_clone", "SELECT * FROM down_cells")
oracle("assign_local_ids", """
  SELECT r.ident, r.uid, CASE WHEN birth IS NULL THEN b.id ELSE
           (SELECT max(id) FROM base) + row_number() OVER (
             PARTITION BY birth IS NULL ORDER BY birth) END AS id
  FROM fold_rows r LEFT JOIN base b ON b.ident = r.ident AND b.uid = r.uid WHERE r.alive""")
block("up_ended", "SELECT * FROM up_rows WHERE in_base AND (NOT alive OR birth IS NOT NULL)")
oracle("replay_to_central", """
  SELECT u.event_id AS order_key, 'U' AS action, u.uid, substr(u.uid, 2)::BIGINT AS row_id,
         b.value AS row_click, 'clone_a' AS origin, u.orig_micros, u.field, u.value
  FROM up_last u JOIN up_rows r ON u.ident = r.ident AND u.uid = r.uid
  JOIN base_cells b ON b.ident = u.ident AND b.uid = u.uid AND b.field = 'click'
  JOIN base_cells o ON o.ident = u.ident AND o.uid = u.uid AND o.field = u.field
  WHERE r.in_base AND r.alive AND r.birth IS NULL AND u.value IS DISTINCT FROM o.value
  UNION ALL
  SELECT r.death, 'D', r.uid, substr(r.uid, 2)::BIGINT, b.value, 'clone_a', e.orig_micros, NULL, NULL
  FROM up_ended r JOIN base_cells b ON b.ident = r.ident AND b.uid = r.uid AND b.field = 'click'
  JOIN clone_ev e ON e.event_id = r.death
  UNION ALL
  SELECT r.birth, 'I', r.uid,
         (SELECT max(substr(uid, 2)::BIGINT) FROM base)
           + row_number() OVER (ORDER BY r.birth, r.ident, r.uid),
         CASE WHEN u.event_id > r.birth THEN u.value ELSE v.value END,
         'clone_a', e.orig_micros, NULL, NULL
  FROM up_rows r JOIN clone_ev e ON e.event_id = r.birth
  LEFT JOIN up_last u ON u.ident = r.ident AND u.uid = r.uid AND u.field = 'click'
  LEFT JOIN row_values v ON v.event_id = r.birth AND v.field = 'click'
  WHERE r.alive""")
oracle("retain_failed", """
  SELECT event_id, action FROM clone_ev WHERE event_id IN (
    SELECT event_id FROM up_st WHERE status = 'unique_violation')""")
oracle("mark_replayed", """
  SELECT event_id, 'clone_a' AS server_id, 'round-2' AS sync_id FROM pending_ev""")

# By primary key: rows are found by id, which stands for the uid here, and an insert keeps it.
block("chosen_fc", """
  SELECT c.* REPLACE (c.action = 'T' AS noop) FROM all_fc c JOIN edits e USING (event_id)
  WHERE e.event_type = 'purchase' AND c.field IS DISTINCT FROM 'id'""")
folded("chosen", "chosen_fc")
BY_ID = """
  SELECT substr(uid, 2)::BIGINT AS id, field, value, ident FROM {0}_cells
  UNION ALL SELECT substr(uid, 2)::BIGINT, 'uid', uid, ident FROM {0}_rows WHERE alive"""
oracle("replay_events", BY_ID.format("chosen"))
block("latest_ev", """
  SELECT ident, uid, arg_max(event_id, (epoch_us(tstamp), event_id)) AS latest
  FROM central_ev WHERE uid IS NOT NULL GROUP BY ident, uid""")
oracle("rollback_guard", """
  SELECT e.event_id, e.ident, substr(e.uid, 2) AS id,
         coalesce(e.event_id = l.latest, false) AS allowed,
         CASE WHEN e.event_id <> l.latest THEN l.latest END AS newer_event_id
  FROM central_ev e LEFT JOIN latest_ev l ON l.ident = e.ident AND l.uid = e.uid""")
block("undone_fc", """
  SELECT c.event_id, c.ident, c.uid, c.tstamp, c.orig_micros, c.field, v.value,
         CASE c.action WHEN 'I' THEN 'D' WHEN 'D' THEN 'I' ELSE c.action END AS action,
         false AS noop
  FROM all_fc c JOIN latest_ev l ON l.latest = c.event_id
  LEFT JOIN row_values v ON v.event_id = c.event_id AND v.field = c.field
  WHERE c.field IS DISTINCT FROM 'id'""")
folded("undone", "undone_fc")
oracle("rollback_events", BY_ID.format("undone"))
oracle("cast_row", """
  SELECT o_orderkey, o_custkey AS customer, CAST(o_orderdate AS DATE) AS "day",
         CASE WHEN o_orderstatus = 'O' THEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END
           AS "rank", o_orderstatus AS status, CAST(NULL AS BIGINT) AS absent,
         CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'rank' END AS bad_columns
  FROM orders""")

# --- whole tables and jobs ---------------------------------------------------------------------

COMPARED = tuple(c for c in ORDER_COLUMNS if c != "id")
diffed("compared", COMPARED)
STATUS = """CASE action WHEN 'I' THEN 'not in table 1' WHEN 'D' THEN 'not in table 2'
         ELSE 'table 1 != table 2' END AS status"""
# A side with no row shows every compared column as NULL; only differing pairs are listed.
oracle("compare_tables", " UNION ALL ".join(
    f"""SELECT uid, {STATUS}, '{c}' AS field, CAST({s[0]}_{c} AS VARCHAR) AS value,
         '{s[1]}' AS side FROM compared WHERE o_{c} IS DISTINCT FROM n_{c}"""
    for c in COMPARED for s in (("o", "left"), ("n", "right"))))
block("fold_changed", """
  SELECT r.ident, r.uid, CASE WHEN NOT r.in_base THEN 'not in table 1'
           WHEN NOT r.alive THEN 'not in table 2' ELSE 'table 1 != table 2' END AS status
  FROM fold_rows r WHERE (r.in_base OR r.alive) AND (
    r.in_base <> r.alive OR EXISTS (
      SELECT 1 FROM fold_cells c JOIN base_cells b USING (ident, uid, field)
      WHERE c.ident = r.ident AND c.uid = r.uid AND c.value IS DISTINCT FROM b.value))""")
oracle("compare_all", f"""
  SELECT 'orders' AS label, status, count(*) AS n_rows FROM (SELECT {STATUS} FROM compared)
  GROUP BY status
  UNION ALL SELECT 'rows', status, count(*) FROM fold_changed GROUP BY status""")
oracle("synchronize", """
  SELECT 'centre' AS node, ident, uid, field, value FROM sync_up_cells
  UNION ALL SELECT 'clone_a', ident, uid, field, value FROM sync_down_cells""")
oracle("synchronize_counts", """
  SELECT 'to_central' AS what, count(*) FILTER (WHERE status <> 'unique_violation') AS n
  FROM sync_up_st
  UNION ALL SELECT 'to_clone', count(*) FROM star_kept
  UNION ALL SELECT 'conflicts', count(*) FROM star_conflicts
  UNION ALL SELECT 'failed_changes', count(*) FROM sync_up_st WHERE status = 'unique_violation'
  UNION ALL SELECT 'ledger_rows', count(*) FROM star_conflicts
  UNION ALL SELECT 'kept_in_clone_log', count(DISTINCT event_id) FROM sync_up_st
    WHERE status = 'unique_violation'""")
oracle("package", """
  SELECT ident, count(uid) AS n_rows, (SELECT min(event_id) FROM star_ev) AS min_event_id,
         (SELECT max(event_id) FROM star_ev) AS max_event_id,
         (SELECT epoch_us(max(tstamp)) FROM star_ev) AS max_micros
  FROM (VALUES ('app.alerts'), ('app.users')) t(ident)
  LEFT JOIN centre_alive USING (ident) GROUP BY ident""")
oracle("deploy", """
  SELECT ident, uid, field,
         CASE WHEN ident = 'app.alerts' AND field = 'note' THEN 'deployed' ELSE value END AS value,
         (SELECT max(event_id) FROM star_ev) AS mark FROM centre_cells""")
oracle("preflight", """
  SELECT 'not captured' AS problem, schema_name, table_name FROM inventory
  WHERE schema_name || '.' || table_name NOT IN (SELECT relation_name FROM registered)
  UNION ALL SELECT 'no uid column', schema_name, table_name FROM without_uid""")

# --- sources, sinks, streams -------------------------------------------------------------------

oracle("feature_collection", """
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment,
         '{"type":"Point","coordinates":[' || c_custkey || ',' || c_nationkey || ']}' AS geometry
  FROM customer""")
oracle("feature_files", """
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment,
         '{"type":"Point","coordinates":[' || c_custkey || ',' || c_nationkey || ']}' AS geometry
  FROM customer""")
oracle("snapshot_roundtrip", "SELECT *, CAST(2 AS BIGINT) AS version FROM orders_new")
oracle("export_csv_dump", "SELECT * FROM orders_old")
oracle("stream_pending", """
  SELECT event_id, action, field, value, uid, noop FROM all_fc c
  WHERE ident = 'app.users' AND event_id IN (
    SELECT event_id FROM central_ev WHERE origin <> 'clone_a' OR origin IS NULL)""")
oracle("stream_dedup", """
  SELECT event_id, action, epoch_us(tstamp) AS tx_micros FROM central_ev""")
oracle("stream_latest", """
  SELECT ident, uid, field, event_id, value FROM all_fc WHERE action = 'U'
  QUALIFY row_number() OVER (PARTITION BY ident, uid, field ORDER BY event_id DESC) = 1""")
oracle("stream_retry", """
  SELECT ident, uid, field, value, CAST(NULL AS BIGINT) AS event_id FROM fold_cells
  UNION ALL SELECT NULL, NULL, NULL, NULL, event_id FROM fold_st
  WHERE status = 'unique_violation'""")
oracle("activity_tumbling", """
  SELECT ident, epoch_us(tstamp) // 3600000000 * 3600000000 AS start_micros,
         count(*) AS n_events FROM central_ev GROUP BY ALL""")
oracle("activity_sliding", """
  SELECT ident, h - back AS start_micros, count(*) AS n_events
  FROM (SELECT ident, epoch_us(tstamp) // 3600000000 * 3600000000 AS h FROM central_ev),
       (SELECT CAST(unnest([0, 1, 2, 3, 4, 5]) AS BIGINT) * 3600000000 AS back)
  GROUP BY ALL""")
block("gaps", """
  SELECT ident, uid, epoch_us(tstamp) AS t, coalesce(epoch_us(tstamp) - lag(epoch_us(tstamp))
    OVER (PARTITION BY ident, uid ORDER BY tstamp) > 14400000000, true) AS opens
  FROM central_ev""")
block("bursts", """
  SELECT *, sum(CAST(opens AS INTEGER)) OVER (
    PARTITION BY ident, uid ORDER BY t ROWS UNBOUNDED PRECEDING) AS burst FROM gaps""")
oracle("activity_sessions", """
  SELECT ident, uid, min(t) AS first_micros, max(t) AS last_micros, count(*) AS n_events
  FROM bursts GROUP BY ident, uid, burst""")

block("ended", """
  SELECT max(epoch_us(tstamp)) // 1000 * 1000 - 3600000000 AS watermark FROM central_ev""")
oracle("stream_sessions", """
  SELECT ident, uid, min(t) AS first_micros, max(t) AS last_micros, count(*) AS n_events
  FROM bursts GROUP BY ident, uid, burst
  HAVING max(t) + 14400000001 <= (SELECT watermark FROM ended)""")
block("first_delivery", """
  SELECT max(epoch_us(tstamp)) // 1000 * 1000 - 86400000000 AS watermark FROM central_ev
  WHERE event_id % 10 <> 3""")
oracle("stream_late", """
  SELECT event_id, CASE WHEN event_id % 10 = 3 AND epoch_us(tstamp) <= watermark THEN 'late'
                        ELSE 'in time' END AS came
  FROM central_ev, first_delivery""")

# The star: the node that edits a cell last wins it, wherever the row is not removed.
block("star_edits", """
  SELECT ident, uid, user_id, event_type AS field, event_id % 3 AS node, max(event_id) AS event_id
  FROM edits GROUP BY ALL""")
block("star_rows", """
  SELECT ident, uid, user_id, in_base FROM (
    SELECT ident, uid, substr(uid, 2)::BIGINT AS user_id, true AS in_base FROM base
    UNION ALL
    SELECT DISTINCT ident, uid, user_id, false FROM star_edits e WHERE node = user_id % 3
      AND NOT EXISTS (SELECT 1 FROM base b WHERE b.ident = e.ident AND b.uid = e.uid))
  WHERE NOT (in_base AND user_id % 20 < 3)""")
block("star_last", """
  SELECT ident, uid, field, max_by('n' || node || '_' || event_id, node) AS value
  FROM star_edits e JOIN star_rows r USING (ident, uid)
  WHERE r.in_base OR e.node = e.user_id % 3 GROUP BY ident, uid, field""")
oracle("synchronize_star", """
  SELECT n.node, r.ident, r.uid, f.field, coalesce(l.value, b.value) AS value
  FROM star_rows r CROSS JOIN (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('error'), ('note')) f(field)
  CROSS JOIN (VALUES ('centre'), ('clone_a'), ('clone_b')) n(node)
  LEFT JOIN star_last l ON l.ident = r.ident AND l.uid = r.uid AND l.field = f.field
  LEFT JOIN base_cells b ON b.ident = r.ident AND b.uid = r.uid AND b.field = f.field""")
oracle("compact_store", """
  SELECT priority, count(*) AS n_rows, sum(cents)::BIGINT AS cents, 5 AS "before", 1 AS "after"
  FROM orders_old WHERE priority IN (
    '1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') GROUP BY priority""")
oracle("compare_added_column", """
  SELECT uid, 'table 1 != table 2' AS status, 'urgent' AS field, 'yes' AS value
  FROM orders_old WHERE priority = '1-URGENT'""")
oracle("capture_added_column", """
  SELECT 'U' AS action, uid, 'urgent' AS field, 'yes' AS value
  FROM orders_old WHERE priority = '1-URGENT'""")
