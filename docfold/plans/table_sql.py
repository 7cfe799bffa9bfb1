"""SQL for the queries over the base tables."""

from __future__ import annotations

BASE = """
customers AS (
  SELECT c_custkey AS id, c_name AS customer_number, c_mktsegment AS first_name,
    'N' || CAST(c_nationkey AS VARCHAR) AS last_name,
    CASE WHEN c_custkey % 7 <> 0 THEN DATE '1970-01-01' + CAST(c_custkey % 20000 AS INTEGER) END
      AS date_of_birth,
    CASE c_custkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' ELSE 'suspended' END AS status,
    TIMESTAMP '2024-01-01' + to_seconds(c_custkey) AS created_at,
    TIMESTAMP '2024-01-01' + to_seconds(c_custkey + c_nationkey * 86400) AS updated_at
  FROM customer),
customer_profiles AS (
  SELECT c_custkey AS customer_id,
    CASE c_nationkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' ELSE 'de' END AS preferred_language,
    CASE WHEN c_custkey % 5 <> 0 THEN n_name END AS occupation,
    CAST(c_acctbal AS DECIMAL(14,2)) AS annual_income,
    upper(substr(r_name, 1, 2)) AS tax_residency_country,
    CASE r_regionkey % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'standard' ELSE 'high' END AS risk_rating,
    TIMESTAMP '2024-01-01' + to_seconds(c_custkey + c_nationkey * 86400) AS updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_acctbal >= 0),
customer_addresses AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'residential' WHEN '2' THEN 'mailing'
      WHEN '3' THEN 'mailing' ELSE 'work' END AS address_type,
    'Street ' || CAST(o_orderkey AS VARCHAR) AS line_1,
    CAST(o_orderdate AS DATE) AS valid_from,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 30 END AS valid_to,
    o_orderdate AS updated_at
  FROM orders),
customer_contacts AS (
  SELECT event_id AS id, user_id AS customer_id,
    CASE event_type WHEN 'view' THEN 'email' WHEN 'click' THEN 'mobile_phone' ELSE 'home_phone' END
      AS contact_type,
    'v' || CAST(event_id AS VARCHAR) AS contact_value, event_id % 50 = 1 AS is_primary,
    CASE WHEN event_id % 3 = 0 THEN ts END AS verified_at, ts AS updated_at
  FROM events),
customer_preferences AS (
  SELECT c_custkey AS customer_id, c_custkey % 2 = 0 AS marketing_email_opt_in,
    c_custkey % 5 <> 0 AS paperless_statements,
    '{"email":' || CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END || ',"sms":'
      || CASE WHEN c_custkey % 7 = 0 THEN '"yes"' ELSE 'false' END || '}' AS notification_channels,
    TIMESTAMP '2024-01-01' + to_seconds(c_custkey + c_nationkey * 86400) AS updated_at
  FROM customer WHERE c_custkey % 4 <> 3)
"""

_TRUTH = "CASE WHEN {0} THEN 'true' ELSE 'false' END"


def _iso3(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def _iso(micros: str, digits: int = 3) -> str:
    ts = f"make_timestamp({micros})"
    six = f"WHEN {micros} % 1000 <> 0 THEN strftime({ts}, '.%f')" if digits == 6 else ""
    return (
        f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE {six} WHEN {micros} // 1000 % 1000 = 0 THEN ''"
        f" ELSE strftime({ts}, '.%g') END || 'Z')"
    )


GROUPED = f"""
adr AS (
  SELECT customer_id, count(*) AS n,
    string_agg(address_type || ':' || line_1 || ':' || CAST(valid_from AS VARCHAR), ','
      ORDER BY address_type, id) AS by_number,
    string_agg(address_type || ':' || line_1 || ':' || CAST(valid_from AS VARCHAR), ','
      ORDER BY address_type, CAST(id AS VARCHAR)) AS by_text,
    string_agg(address_type || ':' || line_1 || ':' || CAST(valid_from AS VARCHAR)
      || coalesce(':' || CAST(valid_to AS VARCHAR), ''), ',' ORDER BY address_type, id) AS model,
    max(epoch_us(updated_at) // 1000) AS updated
  FROM customer_addresses GROUP BY customer_id),
con AS (
  SELECT customer_id, count(*) AS n,
    string_agg(contact_type || ':' || contact_value || ':' || {_TRUTH.format("is_primary")}, ','
      ORDER BY contact_type, id) AS by_number,
    string_agg(contact_type || ':' || contact_value || ':' || {_TRUTH.format("is_primary")}, ','
      ORDER BY contact_type, CAST(id AS VARCHAR)) AS by_text,
    string_agg(contact_value, ',' ORDER BY contact_type, id) AS values_by_number,
    string_agg(contact_value, ',' ORDER BY contact_type, CAST(id AS VARCHAR)) AS values_by_text,
    string_agg(contact_type || ':' || contact_value || ':' || {_TRUTH.format("is_primary")}
      || coalesce(':' || {_iso3("verified_at")}, ''), ',' ORDER BY contact_type, id) AS model,
    max(epoch_us(updated_at) // 1000) AS updated
  FROM customer_contacts GROUP BY customer_id),
docs AS (
  SELECT c.*, p.preferred_language, p.occupation, CAST(p.annual_income AS VARCHAR) AS annual_income,
    p.risk_rating, a.n AS n_addresses, t.n AS n_contacts,
    coalesce(a.by_number, '') AS a_number, coalesce(a.by_text, '') AS a_text,
    coalesce(a.model, '') AS a_model,
    coalesce(t.by_number, '') AS c_number, coalesce(t.by_text, '') AS c_text,
    coalesce(t.model, '') AS c_model,
    coalesce(t.values_by_number, '') AS v_number, coalesce(t.values_by_text, '') AS v_text,
    f.marketing_email_opt_in, f.paperless_statements, f.notification_channels,
    greatest(epoch_us(c.updated_at) // 1000, epoch_us(p.updated_at) // 1000,
      epoch_us(f.updated_at) // 1000, a.updated, t.updated) AS newest
  FROM customers c
  LEFT JOIN customer_profiles p ON p.customer_id = c.id
  LEFT JOIN customer_preferences f ON f.customer_id = c.id
  LEFT JOIN adr a ON a.customer_id = c.id
  LEFT JOIN con t ON t.customer_id = c.id)
"""

DOCS = "WITH" + BASE + "," + GROUPED

FLAT = """
SELECT id, customer_number, first_name || ' ' || last_name AS name,
  CAST(date_of_birth AS VARCHAR) AS date_of_birth, status, preferred_language, occupation,
  annual_income, risk_rating, a_number AS addresses, c_number AS contacts,
  marketing_email_opt_in AS email_opt_in, notification_channels AS channels,
  epoch_us(updated_at) // 1000 AS updated_millis
FROM docs
"""

STORE = """
WITH s AS (SELECT *, c_custkey AS k FROM customer WHERE c_custkey % 10 <> 9)
SELECT CAST(k AS VARCHAR) AS id, c_name AS "customerNumber", c_mktsegment AS "firstName",
  CASE WHEN k % 4 = 0 THEN '' ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS "lastName",
  CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL
    WHEN 2 THEN CASE WHEN k % 20000 = 0 THEN NULL
      ELSE CAST(DATE '1970-01-01' + CAST(k % 20000 AS INTEGER) AS VARCHAR) END
    ELSE '2001-02-03' END AS "dateOfBirth",
  CASE WHEN k % 6 = 0 THEN 'active' ELSE 'suspended' END AS status,
  CASE k % 4 WHEN 1 THEN 'fr' ELSE 'en' END AS language,
  CASE k % 4 WHEN 2 THEN 'Engineer' END AS occupation,
  CASE k % 4 WHEN 2 THEN '12.50' END AS income,
  CASE k % 4 WHEN 2 THEN 'low' WHEN 3 THEN 'high' ELSE 'standard' END AS risk,
  CASE k % 3 WHEN 0 THEN '' ELSE 'work:A:2024-01-01,mailing:C:2020-01-02:2021-01-01' END AS addresses,
  'email:e' || CAST(k AS VARCHAR) || CASE k % 2 WHEN 0 THEN ':true' ELSE ':false' END
    || ':2024-01-01T00:00:00.000Z' AS contacts,
  k % 3 = 0 AS "emailOptIn", true AS paperless, 'email:true,push:false' AS channels,
  '2024-01-01T00:00:00.123Z' AS "createdAt",
  CASE WHEN k % 7 = 0 THEN '' ELSE '2024-05-06T07:08:09.000Z' END AS "updatedAt"
FROM s
"""

ERRORS = """
i AS (SELECT *, c_custkey AS id, CASE
  WHEN c_custkey % 41 = 0 THEN 'A customer payload is required.'
  WHEN c_custkey % 37 = 0 THEN 'Customer number, first name, and last name are required.'
  WHEN c_custkey % 31 = 0 THEN 'Date of birth must use YYYY-MM-DD.'
  WHEN c_custkey % 29 = 0 THEN 'Status must be active, inactive, or suspended.'
  WHEN c_custkey % 23 = 0 THEN 'Profile language and a valid risk rating are required.'
  WHEN c_custkey % 19 = 0 THEN 'Annual income must be a positive currency amount.'
  WHEN c_custkey % 17 = 0 THEN 'Tax residency country must be a two-letter code.'
  WHEN c_custkey % 43 = 0 THEN 'Addresses must be an array.'
  WHEN c_custkey % 13 = 0 THEN
    'Each address needs a unique type, street, city, postal code, country, and valid-from date.'
  WHEN c_custkey % 47 = 0 THEN 'Contacts must be an array.'
  WHEN c_custkey % 11 = 0 THEN
    'Each contact needs a type and value, with at most one primary contact per type.'
  WHEN c_custkey % 53 = 0 OR c_custkey % 59 = 0 THEN
    'All preference switches must be true or false.' END AS error FROM customer)
"""



def _unique(table: str, columns: str, where: str = "true", suffix: str = "") -> str:
    names = [c.strip() for c in columns.split(",")]
    key = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in names)
    return (
        f"SELECT 'unique:{'+'.join(names)}{suffix}' AS rule, '{table}' AS table_name, {key} AS key,"
        f" count(*) AS n_rows FROM {table} WHERE {where} GROUP BY {columns} HAVING count(*) > 1"
    )


def _owner(table: str) -> str:
    return (
        f"SELECT 'owner:customer_id', '{table}', CAST(customer_id AS VARCHAR), count(*) FROM {table} t"
        f" WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.id = t.customer_id) GROUP BY customer_id"
    )


FAULTY = (
    "WITH"
    + BASE.replace("customers AS (", "customers0 AS (", 1)
    .replace("customer_profiles AS (", "customer_profiles0 AS (", 1)
    .replace("customer_addresses AS (", "customer_addresses0 AS (", 1)
    + """,
customers AS (SELECT * REPLACE (CASE WHEN id % 211 = 0 THEN 'unknown' ELSE status END AS status,
  CASE WHEN id % 301 = 1 THEN 'SAME' ELSE customer_number END AS customer_number) FROM customers0),
customer_profiles AS (SELECT * REPLACE (CASE WHEN customer_id % 97 = 0 THEN 'USA'
  ELSE tax_residency_country END AS tax_residency_country) FROM customer_profiles0),
customer_addresses AS (SELECT * REPLACE (
  CASE WHEN id % 501 = 0 THEN 1000000000 + id % 7 ELSE customer_id END AS customer_id,
  CASE WHEN id % 307 = 0 THEN NULL ELSE line_1 END AS line_1) FROM customer_addresses0)
"""
)

_TOO_LARGE = """
WITH a AS (
  SELECT 'addresses' AS part, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS id, o_orderkey AS k,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'residential' WHEN '2' THEN 'mailing'
      WHEN '3' THEN 'mailing' ELSE 'work' END AS kind,
    'Street ' || CAST(o_orderkey AS VARCHAR) AS shown,
    strlen('City ' || o_orderstatus) + 5 + 2
      + CASE WHEN o_orderkey % 4 = 0 THEN strlen(o_orderpriority) ELSE 0 END AS more
  FROM orders),
c AS (
  SELECT 'contacts' AS part, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS id, event_id AS k,
    CASE event_type WHEN 'view' THEN 'email' WHEN 'click' THEN 'mobile_phone' ELSE 'home_phone' END AS kind,
    'v' || CAST(event_id AS VARCHAR) AS shown, 0 AS more
  FROM events),
e AS (SELECT * FROM a UNION ALL SELECT * FROM c),
sizes AS (
  SELECT id, CAST(sum(128 + strlen(kind) + strlen(shown) + more) AS BIGINT) AS total_bytes,
    count(*) FILTER (part = 'addresses') AS n_a, count(*) FILTER (part = 'contacts') AS n_c
  FROM e GROUP BY id)
SELECT CAST(c_custkey AS BIGINT) AS id, 'root' AS part, CAST(0 AS BIGINT) AS place,
  CASE WHEN coalesce(total_bytes, 0) <= 65536
    THEN CAST(coalesce(n_a, 0) AS VARCHAR) || ':' || CAST(coalesce(n_c, 0) AS VARCHAR) END AS shown,
  CASE WHEN total_bytes > 65536 THEN total_bytes END AS total_bytes,
  CASE WHEN total_bytes > 65536 THEN 'document is too large' END AS error
FROM customer LEFT JOIN sizes ON sizes.id = c_custkey
UNION ALL
SELECT CAST(id AS BIGINT), part, row_number() OVER (PARTITION BY id, part ORDER BY kind, k) - 1,
  kind || ':' || shown, NULL, NULL
FROM e WHERE id IN (SELECT id FROM sizes WHERE total_bytes > 65536)
"""

SQL = {
    "relational_documents": DOCS + FLAT,
    "oversized_relational": _TOO_LARGE,
    "snapshot_documents": DOCS
    + f"""
SELECT CAST(id AS VARCHAR) AS _id, customer_number, CAST(date_of_birth AS VARCHAR) AS date_of_birth,
  annual_income, a_text AS addresses, c_text AS contacts, {_iso("(newest * 1000)")} AS updated_at
FROM docs""",
    "collection_order_text_vs_number": DOCS
    + """
SELECT CAST(id AS VARCHAR) AS _id, v_number AS by_number, v_text AS by_text, v_number = v_text AS same
FROM docs""",
    "source_page": DOCS + FLAT + "ORDER BY updated_at DESC, id DESC LIMIT 10 OFFSET 20",
    "replica_page": DOCS
    + f"""
SELECT id, {_iso("(newest * 1000)")} AS updated_at, coalesce(n_addresses, 0) AS n_addresses,
  coalesce(n_contacts, 0) AS n_contacts
FROM docs ORDER BY 2 DESC, id DESC LIMIT 10 OFFSET 10""",
    "page_counts": """
SELECT side, total, greatest(1, CAST(ceil(total / 10.0) AS BIGINT)) AS total_pages
FROM (SELECT count(*) AS total FROM customer), (VALUES ('source'), ('replica')) v(side)""",
    "point_lookup": DOCS + FLAT + "WHERE id = 42",
    "read_model_from_tables": DOCS
    + f"""
SELECT CAST(id AS VARCHAR) AS id, customer_number AS "customerNumber", first_name AS "firstName",
  last_name AS "lastName", CAST(date_of_birth AS VARCHAR) AS "dateOfBirth", status,
  coalesce(preferred_language, 'en') AS language, occupation,
  regexp_replace(annual_income, '\\.?0+$', '') AS income,
  coalesce(risk_rating, 'standard') AS risk, a_model AS addresses, c_model AS contacts,
  coalesce(marketing_email_opt_in, false) AS "emailOptIn",
  coalesce(paperless_statements, true) AS paperless,
  CASE WHEN notification_channels IS NULL THEN '' ELSE
    'email:' || {_TRUTH.format("id % 2 = 0")} || CASE WHEN id % 7 = 0 THEN '' ELSE ',sms:false' END END
    AS channels,
  {_iso3("created_at")} AS "createdAt", {_iso3("updated_at")} AS "updatedAt"
FROM docs""",
    "read_model_from_store": STORE,
    "customer_summary": DOCS
    + f"""
SELECT CAST(id AS VARCHAR) AS id, customer_number AS "customerNumber",
  first_name || ' ' || last_name AS name, coalesce(risk_rating, 'standard') AS risk,
  coalesce(n_addresses, 0) AS n_addresses, coalesce(n_contacts, 0) AS n_contacts, status,
  {_iso3("updated_at")} AS changed
FROM docs""",
    "date_decode": """
SELECT event_id, CASE event_id % 3
  WHEN 0 THEN CAST(DATE '1970-01-01' + CAST(event_id % 40000 - 10000 AS INTEGER) AS VARCHAR)
  WHEN 1 THEN '2024-02-30' ELSE 'on day ' || CAST(event_id AS VARCHAR) END AS shown FROM events""",
    "instant_decode": f"""
SELECT event_id, CASE event_id % 5
    WHEN 0 THEN {_iso("(epoch_us(ts) // 1000 * 1000)")}
    WHEN 1 THEN {_iso("epoch_us(ts)", 6)}
    WHEN 2 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 3 THEN strftime(ts, '%Y-%m-%d') ELSE 'not-a-time' END AS shown,
  CASE event_id % 5 WHEN 0 THEN epoch_us(ts) // 1000 WHEN 1 THEN epoch_us(ts) // 1000
    WHEN 2 THEN epoch_us(ts) // 1000000 * 1000 - 7200000 END AS millis
FROM events""",
    "json_channels": """
SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'a:false,b:true'
  WHEN 4 THEN 'x' || CAST(event_id AS VARCHAR) || ':true' ELSE '' END AS channels FROM events""",
    "validated_inputs": "WITH"
    + ERRORS
    + """
SELECT id, c_name AS customer_number, c_mktsegment AS first_name,
  CASE WHEN id % 2 = 0 THEN '1990-01-02' END AS date_of_birth,
  CASE WHEN id % 3 = 0 THEN '1200.5' ELSE '77.10' END AS annual_income, 'GB' AS country,
  'work:L' || CAST(id AS VARCHAR) || ':' || CAST(id AS VARCHAR) || ':US,mailing:M:P:DE:2025-02-02'
    AS addresses,
  'email:e' || CAST(id AS VARCHAR) || ':true:2024-01-01T05:00:00.000Z,home_phone:p:true' AS contacts
FROM i WHERE error IS NULL""",
    "rejected_inputs": "WITH" + ERRORS + "SELECT id, error FROM i WHERE error IS NOT NULL",
    "duplicate_inputs": """
WITH i AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN c_name
  ELSE 'NEW-' || CAST(c_custkey // 3 AS VARCHAR) END AS customer_number FROM customer)
SELECT id, customer_number, CASE WHEN customer_number IN (SELECT c_name FROM customer)
    OR id > min(id) OVER (PARTITION BY customer_number)
  THEN 'Customer number must be unique.' END AS error FROM i""",
    "constraint_violations": FAULTY
    + " UNION ALL ".join(
        [
            "SELECT 'check:status' AS rule, 'customers' AS table_name, CAST(id AS VARCHAR) AS key,"
            " CAST(1 AS BIGINT) AS n_rows FROM customers WHERE status = 'unknown'",
            "SELECT 'length:tax_residency_country', 'customer_profiles', CAST(customer_id AS VARCHAR), 1"
            " FROM customer_profiles WHERE length(tax_residency_country) > 2",
            "SELECT 'not_null:line_1', 'customer_addresses', CAST(id AS VARCHAR), 1"
            " FROM customer_addresses WHERE line_1 IS NULL",
            _unique("customers", "id"),
            _unique("customers", "customer_number"),
            _unique("customer_profiles", "customer_id"),
            _unique("customer_addresses", "id"),
            _unique("customer_addresses", "customer_id, address_type"),
            _unique("customer_contacts", "id"),
            _unique("customer_contacts", "customer_id, contact_type, contact_value"),
            _unique("customer_contacts", "customer_id, contact_type", "is_primary", ":is_primary"),
            _unique("customer_preferences", "customer_id"),
            _owner("customer_profiles"),
            _owner("customer_addresses"),
            _owner("customer_contacts"),
            _owner("customer_preferences"),
        ]
    ),
    "upsert_singleton": "WITH"
    + BASE
    + """
SELECT customer_id, CASE WHEN customer_id % 10 = 0 THEN 'high' ELSE risk_rating END AS risk_rating,
  occupation, CASE WHEN customer_id % 10 = 0 THEN 1893456000
    ELSE epoch_us(updated_at) // 1000000 END AS updated
FROM customer_profiles
UNION ALL
SELECT customer_id + 1000000000, risk_rating, occupation, epoch_us(updated_at) // 1000000
FROM customer_profiles WHERE customer_id % 10 = 1""",
    "replace_collection": "WITH"
    + BASE
    + """
SELECT id, customer_id, address_type FROM customer_addresses WHERE customer_id % 10 <> 0
UNION ALL SELECT id + 1000000000, customer_id, address_type FROM customer_addresses
WHERE customer_id % 10 = 0 AND address_type = 'work'""",
    "insert_roots": """
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS id,
  s_name AS customer_number, 'active' AS status, CAST(1893456000 AS BIGINT) AS created FROM supplier""",
    "update_roots": "WITH"
    + BASE
    + """
SELECT id, CASE WHEN id % 10 = 0 THEN customer_number || '-x' ELSE customer_number END AS customer_number,
  status, CASE WHEN id % 10 = 0 THEN 1893456000 ELSE epoch_us(updated_at) // 1000000 END AS updated
FROM customers""",
    "cascade_delete": "WITH"
    + BASE
    + """
SELECT 'deleted roots' AS table_name, count(*) AS key FROM customers WHERE id % 11 = 0
UNION ALL SELECT 'customers', id FROM customers WHERE id % 11 <> 0
UNION ALL SELECT 'customer_profiles', customer_id FROM customer_profiles WHERE customer_id % 11 <> 0
UNION ALL SELECT 'customer_addresses', id FROM customer_addresses WHERE customer_id % 11 <> 0
UNION ALL SELECT 'customer_contacts', id FROM customer_contacts WHERE customer_id % 11 <> 0
UNION ALL SELECT 'customer_preferences', customer_id FROM customer_preferences
  WHERE customer_id % 11 <> 0""",
    "changes_between": "WITH"
    + BASE
    + """,
ch AS (
  SELECT 'customers' AS source, id AS key, CASE WHEN id % 11 = 0 THEN 'd' ELSE 'u' END AS op, id AS owner
  FROM customers WHERE id % 11 = 0 OR id % 10 = 0
  UNION ALL SELECT 'customer_profiles', customer_id, 'd', customer_id FROM customer_profiles
    WHERE customer_id % 11 = 0
  UNION ALL SELECT 'customer_addresses', id, 'd', customer_id FROM customer_addresses
    WHERE customer_id % 11 = 0
  UNION ALL SELECT 'customer_contacts', id, 'd', customer_id FROM customer_contacts
    WHERE customer_id % 11 = 0
  UNION ALL SELECT 'customer_preferences', customer_id, 'd', customer_id FROM customer_preferences
    WHERE customer_id % 11 = 0)
SELECT source, key, op, CAST(0 AS BIGINT) AS n FROM ch
UNION ALL SELECT 'transaction', owner, 'END', count(*) FROM ch GROUP BY owner""",
    "shred_inputs": "WITH"
    + ERRORS
    + """,
ok AS (SELECT * FROM i WHERE error IS NULL)
SELECT 'customer_addresses' AS table_name, id AS customer_id, 0 AS pos, 'work' AS kind,
  'L' || CAST(id AS VARCHAR) || ':2024-01-01' AS content FROM ok
UNION ALL SELECT 'customer_addresses', id, 1, 'mailing', 'M:2024-02-02:2025-02-02' FROM ok
UNION ALL SELECT 'customer_contacts', id, 0, 'email', 'e' || CAST(id AS VARCHAR) FROM ok
UNION ALL SELECT 'customer_contacts', id, 1, 'home_phone', 'p' FROM ok
UNION ALL SELECT 'customer_profiles', id, 0, 'low',
  CASE WHEN id % 3 = 0 THEN '1200.50' ELSE '77.10' END FROM ok
UNION ALL SELECT 'customer_preferences', id, 0, 'true', '{"email":true}' FROM ok
UNION ALL SELECT 'customers', id, 0, 'active', c_name FROM ok""",
}
