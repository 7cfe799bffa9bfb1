"""SQL for the queries over the change log."""

from __future__ import annotations

LOG = """
n AS (SELECT count(*) AS n FROM customer),
raw AS (
  SELECT event_id AS seq, ts, value, props,
    CASE WHEN event_id % 41 = 0 THEN NULL
         ELSE CAST(event_id // 6 AS VARCHAR) || ':' || CAST(1000 + event_id AS VARCHAR) END AS raw_txn,
    CASE WHEN event_id % 97 = 0 OR event_type = 'signup' THEN 'customers'
         WHEN event_type = 'view' THEN 'customer_profiles'
         WHEN event_type = 'purchase' THEN 'customer_addresses'
         WHEN event_type = 'click' OR event_id % 2 = 0 THEN 'customer_contacts'
         ELSE 'customer_preferences' END AS source,
    CASE WHEN event_id % 97 = 0 OR event_id % 31 = 0
              OR (event_type = 'error' AND event_id % 2 = 0) THEN 'd'
         WHEN event_id % 41 = 0 THEN 'r' ELSE 'u' END AS op,
    (event_id // 3) % (SELECT n FROM n) AS cid,
    (event_id // 3 + 1) % (SELECT n FROM n) AS neighbour,
    CASE WHEN event_type = 'purchase' THEN 8 + event_id % 5 ELSE 95 + event_id % 10 END AS row_id
  FROM events),
log AS (
  SELECT *, split_part(raw_txn, ':', 1) AS txn,
    source IN ('customer_addresses', 'customer_contacts') AS many,
    CASE WHEN op = 'd' THEN NULL ELSE cid END AS after_cid,
    CASE WHEN op = 'u' AND source IN ('customer_addresses', 'customer_contacts') AND seq % 53 = 0
         THEN neighbour WHEN op <> 'r' THEN cid END AS before_cid
  FROM raw),
counted AS (
  SELECT txn, count(*) AS seen, min(seq) AS first_seq, max(seq) AS last_seq, min(ts) AS first_at
  FROM log WHERE txn IS NOT NULL GROUP BY txn),
markers AS (
  SELECT txn, last_seq AS seq,
    seen + CASE WHEN CAST(txn AS BIGINT) % 13 = 0 THEN 1 WHEN CAST(txn AS BIGINT) % 17 = 0 THEN -1
                ELSE 0 END AS expected
  FROM counted WHERE CAST(txn AS BIGINT) % 10 <> 9),
progress AS (
  SELECT c.txn, c.seen, m.expected, c.first_at,
    CASE WHEN m.expected IS NULL THEN 'open' WHEN m.expected = c.seen THEN 'complete'
         WHEN c.seen < m.expected THEN 'short' ELSE 'surplus' END AS status
  FROM counted c LEFT JOIN markers m ON m.txn = c.txn)
"""

AFFECTED = """,
affected AS (
  SELECT seq, txn, source, ts, value, props, cid, row_id AS raw_row, 0 AS pos,
    CASE WHEN op = 'd' THEN cid ELSE after_cid END AS owner,
    CASE WHEN op = 'd' THEN 'remove' ELSE 'put' END AS action, many
  FROM log
  UNION ALL
  SELECT seq, txn, source, ts, value, props, cid, row_id, 1, before_cid, 'remove', many
  FROM log WHERE many AND before_cid <> after_cid),
acts_all AS (
  SELECT seq, txn, source, ts, value, props, pos, action, CAST(owner AS VARCHAR) AS entity_id,
    CASE WHEN many THEN CAST(raw_row AS VARCHAR) ELSE CAST(owner AS VARCHAR) END AS row_id
  FROM affected)
"""

COMMITTED = """,
acts AS (
  SELECT a.*, coalesce('txn:' || a.txn, 'row:' || CAST(a.seq AS VARCHAR) || ':' || a.source || ':' || coalesce(CAST(a.row_id AS VARCHAR), '')) AS bundle_id
  FROM acts_all a
  WHERE a.txn IS NULL OR a.txn IN (SELECT txn FROM progress WHERE status = 'complete'))
"""

FOLD = """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY entity_id, source, row_id ORDER BY seq DESC) AS rn,
    max(CASE WHEN action = 'remove' THEN seq END)
      OVER (PARTITION BY entity_id, source, row_id) AS removed_seq
  FROM {acts}),
latest AS (SELECT * FROM ranked WHERE rn = 1),
lifetimes AS (
  SELECT entity_id,
    coalesce(max(CASE WHEN source = 'customers' THEN removed_seq END), -1) AS dead_before,
    coalesce(bool_or(source = 'customers' AND action = 'put'), false) AS root_lives
  FROM latest GROUP BY entity_id),
live AS (
  SELECT l.*, t.root_lives FROM latest l JOIN lifetimes t ON t.entity_id = l.entity_id
  WHERE l.action = 'put' AND l.seq > t.dead_before)
"""


def _iso(micros: str) -> str:
    ts = f"make_timestamp({micros} // 1000 * 1000)"
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {micros} // 1000 % 1000 = 0 THEN ''"
        f" ELSE strftime({ts}, '.%g') END || 'Z'"
    )


DOCS = f"""
SELECT r.entity_id AS _id, false AS deleted,
  'CUS-' || r.entity_id AS customer_number, 'F' || CAST(r.seq AS VARCHAR) AS first_name,
  CASE r.seq % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' ELSE 'suspended' END AS status,
  CASE WHEN r.seq % 5 <> 0
       THEN CAST(DATE '1970-01-01' + CAST(r.seq % 20000 AS INTEGER) AS VARCHAR) END AS date_of_birth,
  CASE p.seq % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' END AS preferred_language,
  CAST(CAST(p.value AS DECIMAL(14,2)) AS VARCHAR) AS annual_income,
  coalesce(a.addresses, '') AS addresses, coalesce(c.contacts, '') AS contacts,
  f.seq % 2 = 0 AS email_opt_in, f.props AS channels,
  {_iso("epoch_us(r.ts)")} AS created_at,
  {_iso("u.at")} AS updated_at
FROM (SELECT * FROM live WHERE source = 'customers') r
LEFT JOIN (SELECT * FROM live WHERE source = 'customer_profiles') p ON p.entity_id = r.entity_id
LEFT JOIN (SELECT * FROM live WHERE source = 'customer_preferences') f ON f.entity_id = r.entity_id
LEFT JOIN (
  SELECT entity_id, string_agg(kind || ':L' || CAST(seq AS VARCHAR) || ':'
    || CAST(DATE '1970-01-01' + CAST(seq % 20000 AS INTEGER) AS VARCHAR), ',' ORDER BY kind, row_id)
    AS addresses
  FROM (SELECT *, CASE seq % 3 WHEN 0 THEN 'residential' WHEN 1 THEN 'mailing' ELSE 'work' END AS kind
        FROM live WHERE source = 'customer_addresses') GROUP BY entity_id) a ON a.entity_id = r.entity_id
LEFT JOIN (
  SELECT entity_id, string_agg(kind || ':v' || CAST(seq AS VARCHAR) || ':'
    || CASE WHEN seq % 2 = 1 THEN 'true' ELSE 'false' END, ',' ORDER BY kind, row_id) AS contacts
  FROM (SELECT *, CASE seq % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'mobile_phone' ELSE 'home_phone' END
          AS kind FROM live WHERE source = 'customer_contacts') GROUP BY entity_id) c
  ON c.entity_id = r.entity_id
JOIN (SELECT entity_id, max(epoch_us(ts)) AS at FROM live GROUP BY entity_id) u
  ON u.entity_id = r.entity_id
UNION ALL
SELECT entity_id, true, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM lifetimes WHERE dead_before >= 0 AND NOT root_lives
"""

STATE = "WITH" + LOG + AFFECTED + COMMITTED + FOLD.format(acts="acts")

SQL = {
    "txn_routing": "WITH"
    + LOG
    + """
SELECT source, seq, txn AS txn_id, coalesce(txn, 'snapshot:' || source || ':{"' ||
  CASE WHEN many OR source = 'customers' THEN 'id' ELSE 'customer_id' END || '":' ||
  CAST(CASE WHEN many THEN row_id ELSE cid END AS VARCHAR) || '}') AS routing_key FROM log
UNION ALL SELECT 'transaction', seq, txn, txn FROM markers""",
    "affected_customers": "WITH"
    + LOG
    + AFFECTED
    + "SELECT seq, pos, entity_id, source, row_id, action FROM acts_all",
    "transaction_progress": "WITH" + LOG + "SELECT txn AS txn_id, seen, expected, status FROM progress",
    "complete_transactions": "WITH"
    + LOG
    + AFFECTED
    + """
SELECT a.txn AS txn_id, count(DISTINCT entity_id) AS n_entities, count(*) AS n_bundle_events,
  min(seq) AS first_seq
FROM acts_all a JOIN progress p ON p.txn = a.txn AND p.status = 'complete' GROUP BY a.txn""",
    "stalled_transactions": "WITH"
    + LOG
    + """
SELECT txn AS txn_id, seen, expected, status,
  CAST(epoch(TIMESTAMP '2030-01-01 00:00:00') AS BIGINT) - epoch_us(first_at) // 1000000 AS age_seconds
FROM progress WHERE status <> 'complete'""",
    "customer_bundles": "WITH"
    + LOG
    + AFFECTED
    + COMMITTED
    + """
SELECT txn AS txn_id, entity_id, count(*) AS n_events, min(seq) AS first_seq, max(seq) AS bundle_seq
FROM acts WHERE txn IS NOT NULL GROUP BY txn, entity_id""",
    "bundle_events": "WITH"
    + LOG
    + AFFECTED
    + COMMITTED
    + "SELECT bundle_id, entity_id, seq, source, action FROM acts",
    "passthrough_bundles": "WITH"
    + LOG
    + AFFECTED
    + COMMITTED
    + "SELECT bundle_id, entity_id, seq, source FROM acts WHERE txn IS NULL",
    "document_log": "WITH"
    + LOG
    + AFFECTED
    + COMMITTED
    + """,
b AS (
  SELECT bundle_id, entity_id, count(*) AS n_events, max(seq) AS bundle_seq,
    max(CASE WHEN source = 'customers' THEN seq END) AS root_seq,
    arg_max(action, seq) FILTER (WHERE source = 'customers') AS root_action,
    coalesce(bool_or(source = 'customers' AND action = 'remove'), false) AS root_removed
  FROM acts GROUP BY bundle_id, entity_id),
roots AS (SELECT entity_id, seq, action FROM acts WHERE source = 'customers'),
known AS (
  SELECT *, max(root_seq) OVER (PARTITION BY entity_id ORDER BY bundle_seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known_seq FROM b)
SELECT k.bundle_id, k.entity_id, k.n_events, k.bundle_seq,
  CASE WHEN r.action = 'put' THEN 'document' WHEN k.root_removed THEN 'marker' ELSE 'nothing' END AS emits
FROM known k LEFT JOIN roots r ON r.entity_id = k.entity_id AND r.seq = k.known_seq""",
    "latest_rows": STATE
    + "SELECT entity_id, source, row_id, seq, action, removed_seq FROM latest",
    "live_children": STATE
    + "SELECT entity_id, source, row_id, seq, root_lives FROM live WHERE source <> 'customers'",
    "moved_children": STATE
    + "SELECT seq, source, row_id, entity_id AS left_entity FROM acts WHERE pos = 1",
    "row_history": "WITH"
    + LOG
    + AFFECTED
    + COMMITTED
    + """,
v AS (
  SELECT *, lead(seq) OVER (PARTITION BY entity_id, source, row_id ORDER BY seq) AS next_seq,
    min(CASE WHEN source = 'customers' AND action = 'remove' THEN seq END) OVER (
      PARTITION BY entity_id ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS root_end
  FROM acts)
SELECT entity_id, source, row_id, seq AS valid_from, least(next_seq, root_end) AS valid_to
FROM v WHERE action = 'put'""",
    "final_documents": STATE + DOCS,
    "documents_as_of": "WITH"
    + LOG
    + AFFECTED
    + """,
cut AS (SELECT max(event_id) / 2 AS c FROM events),
early_counted AS (
  SELECT txn, count(*) AS seen FROM log, cut WHERE txn IS NOT NULL AND seq <= c GROUP BY txn),
early_complete AS (
  SELECT k.txn FROM early_counted k JOIN markers m ON m.txn = k.txn AND m.expected = k.seen, cut
  WHERE m.seq <= c),
early AS (
  SELECT a.* FROM acts_all a, cut
  WHERE a.seq <= c AND (a.txn IS NULL OR a.txn IN (SELECT txn FROM early_complete)))"""
    + FOLD.format(acts="early")
    + DOCS,
    "document_history": "WITH"
    + LOG
    + AFFECTED
    + COMMITTED
    + """,
placed AS (SELECT *, max(seq) OVER (PARTITION BY bundle_id, entity_id) AS place FROM acts),
bundles AS (
  SELECT bundle_id, entity_id, max(place) AS bundle_seq,
    bool_or(source = 'customers' AND action = 'remove') AS root_removed
  FROM placed GROUP BY bundle_id, entity_id),
-- The state after each bundle: all events of the entity's bundles up to its position.
upto AS (
  SELECT b.entity_id || '@' || b.bundle_id AS entity_id, p.seq, p.source, p.ts, p.value, p.props,
    p.action, p.row_id
  FROM bundles b JOIN placed p ON p.entity_id = b.entity_id AND p.place <= b.bundle_seq)"""
    + FOLD.format(acts="upto")
    + """,
states AS ("""
    + DOCS
    + """)
SELECT b.bundle_id, b.bundle_seq, b.entity_id AS _id, deleted,
  split_part(customer_number, '@', 1) AS customer_number, first_name, status, date_of_birth,
  preferred_language, annual_income, addresses, contacts, email_opt_in, channels, created_at, updated_at
FROM states JOIN bundles b ON b.entity_id || '@' || b.bundle_id = _id
WHERE NOT deleted OR b.root_removed""",
    "delete_markers": STATE
    + "SELECT entity_id AS _id, dead_before FROM lifetimes WHERE dead_before >= 0 AND NOT root_lives",
    "document_updated_at": STATE
    + """
SELECT entity_id, max(epoch_us(ts) // 1000) AS updated_millis FROM live WHERE root_lives
GROUP BY entity_id""",
}
