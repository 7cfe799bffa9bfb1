"""SQL for the queries over sinks, feeds, parity and workload."""

from __future__ import annotations

from docfold.plans.log_sql import AFFECTED, COMMITTED, DOCS, LOG, SQL as LOG_SQL, STATE
from docfold.plans.table_sql import BASE

_EMITTED = (
    "WITH"
    + LOG
    + AFFECTED
    + COMMITTED
    + """,
b AS (
  SELECT bundle_id, entity_id, max(seq) AS bundle_seq, max(ts) AS at_ts,
    max(CASE WHEN source = 'customers' THEN seq END) AS root_seq,
    coalesce(bool_or(source = 'customers' AND action = 'remove'), false) AS root_removed
  FROM acts GROUP BY bundle_id, entity_id),
roots AS (SELECT entity_id, seq, action FROM acts WHERE source = 'customers'),
known AS (
  SELECT *, max(root_seq) OVER (PARTITION BY entity_id ORDER BY bundle_seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known_seq FROM b),
emitted AS (
  SELECT k.bundle_id, k.entity_id, k.bundle_seq, k.at_ts,
    CASE WHEN r.action = 'put' THEN 'document' ELSE 'marker' END AS emits
  FROM known k LEFT JOIN roots r ON r.entity_id = k.entity_id AND r.seq = k.known_seq
  WHERE coalesce(r.action = 'put', false) OR k.root_removed)
"""
)

_DAY = "CAST(DATE '1970-01-01' + CAST({0} % 20000 AS INTEGER) AS VARCHAR)"


def _pairs(*members: tuple[str, str]) -> str:
    """JSON members, each left out when its value is null."""
    return "concat_ws(',', " + ", ".join(f"'\"{name}\":' || {value}" for name, value in members) + ")"


_ADDRESS = _pairs(
    ("type", "'\"' || CASE seq % 3 WHEN 0 THEN 'residential' WHEN 1 THEN 'mailing' ELSE 'work' END || '\"'"),
    ("line1", "'\"L' || CAST(seq AS VARCHAR) || '\"'"),
    ("validFrom", f"'\"' || {_DAY.format('seq')} || '\"'"),
)
_CONTACT = _pairs(
    ("type", "'\"' || CASE seq % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'mobile_phone' ELSE 'home_phone' END || '\"'"),
    ("value", "'\"v' || CAST(seq AS VARCHAR) || '\"'"),
    ("isPrimary", "CASE WHEN seq % 2 = 1 THEN 'true' ELSE 'false' END"),
)
_PROFILE = _pairs(
    ("preferredLanguage", "'\"' || CASE seq % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' END || '\"'"),
    ("annualIncome", "'\"' || CAST(CAST(value AS DECIMAL(14,2)) AS VARCHAR) || '\"'"),
)
_PREFS = _pairs(
    ("marketingEmailOptIn", "CASE WHEN seq % 2 = 0 THEN 'true' ELSE 'false' END"),
    ("notificationChannels", "props"),
)
_JSON = (
    STATE
    + f""",
flat AS ({DOCS}),
kids AS (
  SELECT entity_id,
    string_agg('{{' || {_ADDRESS} || '}}', ',' ORDER BY CASE seq % 3 WHEN 0 THEN 'residential'
      WHEN 1 THEN 'mailing' ELSE 'work' END, row_id) FILTER (WHERE source = 'customer_addresses') AS a,
    string_agg('{{' || {_CONTACT} || '}}', ',' ORDER BY CASE seq % 3 WHEN 0 THEN 'email'
      WHEN 1 THEN 'mobile_phone' ELSE 'home_phone' END, row_id)
      FILTER (WHERE source = 'customer_contacts') AS c,
    max({_PROFILE}) FILTER (WHERE source = 'customer_profiles') AS p,
    max({_PREFS}) FILTER (WHERE source = 'customer_preferences') AS f
  FROM live GROUP BY entity_id),
texts AS (
  SELECT _id, CASE WHEN deleted THEN '{{"_id":"' || _id || '","deleted":true}}' ELSE
    '{{"_id":"' || _id || '","id":' || _id || ',"customer_number":"' || customer_number
    || '","first_name":"' || first_name || '","last_name":"L' || _id || '","date_of_birth":'
    || coalesce('"' || date_of_birth || '"', 'null') || ',"status":"' || status || '","profile":{{'
    || coalesce(p, '') || '}},"addresses":[' || coalesce(a, '') || '],"contacts":[' || coalesce(c, '')
    || '],"preferences":{{' || coalesce(f, '') || '}},"created_at":"' || created_at
    || '","updated_at":"' || updated_at || '"}}' END AS json
  FROM flat LEFT JOIN kids ON kids.entity_id = flat._id)
"""
)

_FEED = (
    _EMITTED
    + """,
feed AS (
  SELECT 'source' AS feed, CASE op WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' END AS operation,
    CAST(cid AS VARCHAR) AS id, CASE WHEN op <> 'd' THEN 'CUS-' || CAST(cid AS VARCHAR) END
      AS customer_number, epoch_us(ts) // 1000 AS at_ms
  FROM log WHERE source = 'customers' AND op <> 'r'
  UNION ALL
  SELECT 'replica', CASE WHEN bundle_seq = min(bundle_seq) OVER (PARTITION BY entity_id)
    THEN 'insert' ELSE 'replace' END, entity_id, NULL, epoch_us(at_ts) // 1000 FROM emitted)
"""
)

# Every field of a document.
_FIELDS = (
    "customer_number", "first_name", "last_name", "date_of_birth", "status", "created_at",
    "profile_preferredLanguage", "profile_occupation", "profile_annualIncome",
    "profile_taxResidencyCountry", "profile_riskRating", "preferences_marketingEmailOptIn",
    "preferences_marketingSmsOptIn", "preferences_paperlessStatements",
    "preferences_notificationChannels", "addresses", "contacts",
)
_DIFF = (
    "WITH"
    + BASE
    + """,
diff AS (
  SELECT id, 'missing' AS difference FROM customers WHERE id % 101 = 0
  UNION ALL SELECT id, 'unlike:' || field FROM customers
    JOIN (SELECT * FROM (VALUES """
    + ", ".join(f"({i}, '{name}')" for i, name in enumerate(_FIELDS))
    + """) AS t(i, field)) ON id % 41 = i WHERE id % 101 <> 0
  UNION ALL SELECT id + 1000000000, 'extra' FROM customers WHERE id % 109 = 0)
"""
)

_MS = "CAST(epoch_us(ts) // 1000 AS VARCHAR)"
_TRUTH = "CASE WHEN {0} THEN 'true' ELSE 'false' END"
_RECORDS = (
    "WITH"
    + LOG
    + f""",
images AS (
  SELECT *, CAST(cid AS VARCHAR) AS c, CAST(row_id AS VARCHAR) AS r, CAST(seq AS VARCHAR) AS s FROM log),
records AS (
  SELECT source, CASE WHEN many THEN '{{"id":' || r || '}}' WHEN source = 'customers'
      THEN '{{"id":' || c || '}}' ELSE '{{"customer_id":' || c || '}}' END AS key,
    '{{"op":"' || op || '","before":' || CASE
        WHEN many AND before_cid IS NOT NULL
          THEN '{{"id":' || r || ',"customer_id":' || CAST(before_cid AS VARCHAR) || '}}'
        WHEN op = 'd' AND source = 'customers' THEN '{{"id":' || c || '}}'
        WHEN op = 'd' AND NOT many THEN '{{"customer_id":' || c || '}}' ELSE 'null' END
      || ',"after":' || CASE WHEN op = 'd' THEN 'null' ELSE CASE source
        WHEN 'customers' THEN '{{"id":' || c || ',"customer_number":"CUS-' || c || '","first_name":"F' || s
          || '","last_name":"L' || c || '","date_of_birth":' || CASE WHEN seq % 5 <> 0
          THEN CAST(seq % 20000 AS VARCHAR) ELSE 'null' END || ',"status":"' || CASE seq % 3
          WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' ELSE 'suspended' END
          || '","created_at":' || {_MS}
        WHEN 'customer_profiles' THEN '{{"customer_id":' || c || ',"preferred_language":' || CASE seq % 4
          WHEN 0 THEN '"en"' WHEN 1 THEN '"fr"' WHEN 2 THEN '"de"' ELSE 'null' END
          || ',"annual_income":"' || CAST(CAST(value AS DECIMAL(14,2)) AS VARCHAR) || '"'
        WHEN 'customer_addresses' THEN '{{"id":' || r || ',"customer_id":' || c || ',"address_type":"'
          || CASE seq % 3 WHEN 0 THEN 'residential' WHEN 1 THEN 'mailing' ELSE 'work' END
          || '","line_1":"L' || s || '","valid_from":' || CAST(seq % 20000 AS VARCHAR)
        WHEN 'customer_contacts' THEN '{{"id":' || r || ',"customer_id":' || c || ',"contact_type":"'
          || CASE seq % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'mobile_phone' ELSE 'home_phone' END
          || '","contact_value":"v' || s || '","is_primary":' || {_TRUTH.format("seq % 2 = 1")}
        ELSE '{{"customer_id":' || c || ',"marketing_email_opt_in":' || {_TRUTH.format("seq % 2 = 0")}
          || ',"notification_channels":"' || replace(props, '"', chr(92) || '"') || '"'
        END || ',"updated_at":' || {_MS} || '}}' END
      || coalesce(',"transaction":{{"id":"' || raw_txn || '"}}', '') || '}}' AS value
  FROM images
  UNION ALL
  SELECT 'transaction', txn, '{{"status":"END","id":"' || txn || ':999","event_count":'
    || CAST(expected AS VARCHAR) || '}}' FROM markers)
"""
)

_CHANGES = _FEED + 'SELECT feed, operation, id, customer_number, at_ms AS "at" FROM feed'

SQL = {
    "workload_profile": _RECORDS
    + """
SELECT source, count(*) AS records, CAST(sum(strlen(value) + strlen(key)) AS BIGINT) AS total_bytes,
  CAST(max(strlen(value) + strlen(key)) AS BIGINT) AS largest,
  CAST(sum(strlen(value) + strlen(key)) AS BIGINT) // count(*) AS average_bytes
FROM records GROUP BY source""",
    "document_json": _JSON + "SELECT _id, json FROM texts",
    "dead_letters": _JSON
    + """
SELECT _id, CASE WHEN strlen(json) > 700 THEN 'dead' ELSE 'stored' END AS outcome,
  CASE WHEN strlen(json) > 700 THEN 'document is too large' END AS error, strlen(json) AS json_bytes
FROM texts""",
    "sink_latest": _EMITTED
    + """
SELECT entity_id AS _id, emits, bundle_id, bundle_seq FROM emitted
QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY bundle_seq DESC) = 1""",
    "final_documents_stream": LOG_SQL["final_documents"],
    "rebuilt_documents": LOG_SQL["final_documents"],
    "change_feed": _CHANGES,
    # In whatever runs the events come, they are the same.
    "change_feed_stream": _CHANGES,
    "latest_feed_event": _FEED
    + """,
both_feeds AS (SELECT feed AS name, * FROM feed UNION ALL SELECT 'any', * FROM feed)
SELECT name AS feed, operation, id, at_ms AS "at" FROM both_feeds
QUALIFY row_number() OVER (PARTITION BY name ORDER BY at_ms DESC, id DESC, operation DESC) = 1""",
    "count_parity": """
SELECT s AS source_count, r AS replica_count, s - r AS delta, s = r AS in_parity
FROM (SELECT count(*) AS s, count(*) FILTER (WHERE c_custkey % 101 <> 0)
  + count(*) FILTER (WHERE c_custkey % 109 = 0) AS r FROM customer)""",
    "field_parity": _DIFF + "SELECT id, difference FROM diff",
    "stale_mismatches": _DIFF
    + """
SELECT id, difference, age AS age_seconds FROM (
  SELECT d.id, d.difference, epoch_us(TIMESTAMP '2024-01-25') // 1000000 - epoch_us(t.stamp) // 1000000 AS age
  FROM diff d JOIN (
    SELECT id, updated_at AS stamp FROM customers
    UNION ALL SELECT id + 1000000000, max(stamp) FROM (
      SELECT id, updated_at AS stamp FROM customers
      UNION ALL SELECT customer_id, updated_at FROM customer_profiles
      UNION ALL SELECT customer_id, updated_at FROM customer_addresses
      UNION ALL SELECT customer_id, updated_at FROM customer_contacts
      UNION ALL SELECT customer_id, updated_at FROM customer_preferences) GROUP BY id) t ON t.id = d.id)
WHERE age > 864000""",
    "sampled_parity": _DIFF + "SELECT id, difference FROM diff WHERE id % 7 = 0",
    "repair_list": _DIFF
    + """
SELECT CAST(id AS VARCHAR) AS _id, false AS deleted, status FROM customers
WHERE id IN (SELECT id FROM diff)
UNION ALL SELECT CAST(id AS VARCHAR), true, NULL FROM diff WHERE difference = 'extra'""",
    "replication_lag": STATE
    + """,
times AS (SELECT entity_id, max(epoch_us(ts)) // 1000 AS at FROM acts GROUP BY entity_id),
lags AS (
  SELECT epoch_ms(TIMESTAMP '2024-03-01 00:00:00') - t.at AS l
  FROM times t JOIN lifetimes USING (entity_id) WHERE root_lives OR dead_before >= 0)
SELECT count(*) AS n, quantile_disc(l, 0.5) AS p50, quantile_disc(l, 0.95) AS p95,
  quantile_disc(l, 0.99) AS p99, max(l) AS longest
FROM lags""",
    "transaction_sizes": "WITH"
    + LOG
    + """
SELECT count(*) AS transactions, CAST(sum(seen) AS BIGINT) AS rows, quantile_disc(seen, 0.5) AS p50,
  quantile_disc(seen, 0.95) AS p95, quantile_disc(seen, 0.99) AS p99, max(seen) AS largest
FROM counted""",
    "write_rate_hourly": """
SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, count(*) AS writes
FROM events GROUP BY ALL""",
    "record_sizes": _RECORDS
    + """
SELECT count(*) AS records, CAST(sum(n) AS BIGINT) AS total_bytes, quantile_disc(n, 0.5) AS p50,
  quantile_disc(n, 0.95) AS p95, quantile_disc(n, 0.99) AS p99, max(n) AS largest
FROM (SELECT CAST(strlen(value) + strlen(key) AS BIGINT) AS n FROM records)""",
    "write_rate_summary": """
SELECT CAST((epoch(max(h)) - epoch(min(h))) / 3600 + 1 AS BIGINT) AS hours,
  CAST(sum(n) AS BIGINT) AS writes, max(n) AS peak,
  CAST(sum(n) AS BIGINT) // CAST((epoch(max(h)) - epoch(min(h))) / 3600 + 1 AS BIGINT) AS sustained
FROM (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY ALL)""",
    "hot_keys": "WITH"
    + LOG
    + AFFECTED
    + """
SELECT entity_id, count(*) AS n_events FROM acts_all GROUP BY entity_id
ORDER BY n_events DESC, entity_id LIMIT 20""",
}
