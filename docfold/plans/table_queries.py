"""Queries over the base tables: relational documents, pages, read model, writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.functions.values import boolean_entries, instant, instant_text, iso_date, iso_instant
from docfold.operators import constraints, engine, readmodel, relational, validation, writes
from docfold.plans import mapping
from docfold.session import materialize
from docfold.sources.changelog import snapshot_log
from docfold.spec import CUSTOMER_SPEC as SPEC

NOW = "2030-01-01 00:00:00"


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def joined(array: Column, *names: str) -> Column:
    """An array of structs as text: members joined by ``:``, elements by ``,``."""
    return F.array_join(
        F.transform(array, lambda e: F.concat_ws(":", *[e[n].cast("string") for n in names])), ","
    )


def flat(docs: DataFrame) -> DataFrame:
    """Relational documents as scalar columns."""
    return docs.select(
        "id",
        "customer_number",
        F.concat_ws(" ", "first_name", "last_name").alias("name"),
        F.col("date_of_birth").cast("string").alias("date_of_birth"),
        "status",
        F.col("profile.preferredLanguage").alias("preferred_language"),
        F.col("profile.occupation").alias("occupation"),
        F.col("profile.annualIncome").cast("string").alias("annual_income"),
        F.col("profile.riskRating").alias("risk_rating"),
        joined(F.col("addresses"), "type", "line1", "validFrom").alias("addresses"),
        joined(F.col("contacts"), "type", "value", "isPrimary").alias("contacts"),
        F.col("preferences.marketingEmailOptIn").alias("email_opt_in"),
        F.col("preferences.notificationChannels").alias("channels"),
        F.unix_millis("updated_at").alias("updated_millis"),
    )


def snapshot_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents folded from the read events of all base rows."""
    tables = mapping.base_tables(spark, sf_dir)
    keys = {name: frame.columns[0] for name, frame in tables.items()}
    wide = {name: mapping.spread(frame, keys[name]) for name, frame in tables.items()}
    return engine.final_outputs(snapshot_log(wide, SPEC), SPEC)


def relational_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(relational.relational_documents(mapping.base_tables(spark, sf_dir), SPEC))


def oversized_relational(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all children belong to root 1, whose collections then come in chunks.

    One row per root, and one per element of a collection above the limit.
    """
    tables = mapping.base_tables(spark, sf_dir)
    for name in ("customer_addresses", "customer_contacts"):
        owner = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("customer_id")).cast("bigint")
        tables[name] = tables[name].withColumn("customer_id", owner)
    limit = 65_536
    docs = relational.relational_documents(tables, SPEC, limit)
    roots = docs.select(
        F.col("id").cast("bigint").alias("id"),
        F.lit("root").alias("part"),
        F.lit(0).cast("bigint").alias("place"),
        F.concat(F.size("addresses").cast("string"), F.lit(":"), F.size("contacts").cast("string")).alias("shown"),
        "total_bytes",
        "error",
    )
    chunks = relational.collection_chunks(tables, SPEC, limit, chunk_bytes=4_096)
    frames = [roots]
    for part, value in (("addresses", "line1"), ("contacts", "value")):
        places = chunks.filter(F.col("part") == part).select(
            "customer_id", "part", "first_place", F.posexplode(part).alias("at", "e")
        )
        frames.append(
            places.select(
                F.col("customer_id").alias("id"),
                "part",
                (F.col("first_place") + F.col("at")).alias("place"),
                F.concat_ws(":", F.col("e.type"), F.col(f"e.{value}")).alias("shown"),
            )
        )
    return (
        frames[0]
        .unionByName(frames[1], allowMissingColumns=True)
        .unionByName(frames[2], allowMissingColumns=True)
    )


def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("document")
    return snapshot_outputs(spark, sf_dir).select(
        "_id",
        doc["customer_number"].alias("customer_number"),
        doc["date_of_birth"].alias("date_of_birth"),
        doc["profile"]["annualIncome"].alias("annual_income"),
        joined(doc["addresses"], "type", "line1", "validFrom").alias("addresses"),
        joined(doc["contacts"], "type", "value", "isPrimary").alias("contacts"),
        doc["updated_at"].alias("updated_at"),
    )


def collection_order_text_vs_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = relational.relational_documents(mapping.base_tables(spark, sf_dir), SPEC)
    by_number = docs.select(
        F.col("id").cast("string").alias("_id"), joined(F.col("contacts"), "value").alias("by_number")
    )
    by_text = snapshot_outputs(spark, sf_dir).select(
        "_id", joined(F.col("document.contacts"), "value").alias("by_text")
    )
    return by_number.join(by_text, "_id").withColumn(
        "same", F.col("by_number") == F.col("by_text")
    )


def source_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(relational.source_page(mapping.base_tables(spark, sf_dir), SPEC, "3"))


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = mapping.table(spark, sf_dir, "customer")
    replica = snapshot_outputs(spark, sf_dir).filter("not deleted")
    return (
        relational.page_info(source)
        .withColumn("side", F.lit("source"))
        .unionByName(relational.page_info(replica).withColumn("side", F.lit("replica")))
    )


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = mapping.base_tables(spark, sf_dir)
    return flat(relational.documents_of(tables, SPEC, tables["customers"].filter("id = 42")))


def flat_model(model: DataFrame) -> DataFrame:
    channels = F.array_sort(F.map_entries("preferences.notificationChannels"))
    return model.select(
        "id",
        "customerNumber",
        "firstName",
        "lastName",
        "dateOfBirth",
        "status",
        F.col("profile.preferredLanguage").alias("language"),
        F.col("profile.occupation").alias("occupation"),
        F.col("profile.annualIncome").alias("income"),
        F.col("profile.riskRating").alias("risk"),
        joined(F.col("addresses"), "type", "line1", "validFrom", "validTo").alias("addresses"),
        joined(F.col("contacts"), "type", "value", "isPrimary", "verifiedAt").alias("contacts"),
        F.col("preferences.marketingEmailOptIn").alias("emailOptIn"),
        F.col("preferences.paperlessStatements").alias("paperless"),
        joined(channels, "key", "value").alias("channels"),
        "createdAt",
        "updatedAt",
    )


def read_model_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = relational.relational_documents(mapping.base_tables(spark, sf_dir), SPEC)
    return flat_model(readmodel.from_tables(docs))


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as stored JSON documents of several shapes: plain, below ``after``, deleted."""
    return mapping.table(spark, sf_dir, "customer").select(
        F.expr(
            """
concat('{', case c_custkey % 3 when 0 then concat('"_id":"', c_custkey, '","id":', c_custkey)
    when 1 then concat('"_id":{"id":', c_custkey, '},"after":{"id":null')
    else concat('"_id":"', c_custkey, '"') end,
  ',"customer_number":"', c_name, '","first_name":"', c_mktsegment, '"',
  case when c_custkey % 4 = 0 then '' else concat(',"last_name":"N', c_nationkey, '"') end,
  ',"date_of_birth":', case c_custkey % 5 when 0 then 'null' when 1 then '0'
    when 2 then cast(c_custkey % 20000 as string) when 3 then '"2001-02-03"'
    else '"2001-02-03T23:59:00.5Z"' end,
  case when c_custkey % 6 = 0 then '' else ',"status":"suspended"' end,
  ',"profile":', case c_custkey % 4 when 0 then '{}'
    when 1 then '{"preferredLanguage":"fr","occupation":"  ","riskRating":"extreme"}'
    when 2 then '{"occupation":" Engineer ","annualIncome":"12.50","riskRating":"low"}'
    else '"{\\\\"riskRating\\\\":\\\\"high\\\\"}"' end,
  ',"addresses":', case c_custkey % 3 when 0 then '"none"'
    else '[{"type":"work","line1":"A","validFrom":19723},{"type":"boat","line1":"B"},
           {"type":"mailing","line1":"C","validFrom":"2020-01-02","validTo":"2021-01-01T10:00:00Z"}]' end,
  ',"contacts":[{"type":"email","value":"e', c_custkey, '","isPrimary":', case c_custkey % 2
    when 0 then 'true' else '"yes"' end, ',"verifiedAt":"2024-01-01T00:00:00Z"},{"type":"fax"}]',
  ',"preferences":{"marketingEmailOptIn":', case c_custkey % 3 when 0 then 'true' else '1' end,
  ',"notificationChannels":{"email":true,"sms":"no","push":false}}',
  ',"created_at":"2024-01-01T00:00:00.123Z"',
  case when c_custkey % 7 = 0 then '' else ',"updated_at":"2024-05-06T07:08:09Z"' end,
  case c_custkey % 3 when 1 then '}' else '' end,
  case when c_custkey % 10 = 9 then ',"deleted":true' else '' end, '}')
"""
        ).alias("json")
    )


def read_model_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_model(readmodel.from_store(stored_documents(spark, sf_dir)))


def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = relational.relational_documents(mapping.base_tables(spark, sf_dir), SPEC)
    return readmodel.summary(readmodel.from_tables(docs))


def date_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(
        "case event_id % 3 when 0 then cast(event_id % 40000 - 10000 as string)"
        " when 1 then '2024-02-30' else concat('on day ', event_id) end"
    )
    events = mapping.table(spark, sf_dir, "events")
    return events.select("event_id", raw.alias("raw")).select(
        "event_id", iso_date(F.col("raw")).alias("shown")
    )


def instant_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        F.when(F.col("event_id") % 5 == 0, F.unix_millis("ts").cast("string"))
        .when(F.col("event_id") % 5 == 1, iso_instant(F.col("ts")))
        .when(
            F.col("event_id") % 5 == 2,
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")),
        )
        .when(F.col("event_id") % 5 == 3, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise("not-a-time")
    )
    events = mapping.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return events.select(
        "event_id",
        instant_text(F.col("raw")).alias("shown"),
        F.unix_millis(instant(F.col("raw"))).alias("millis"),
    )


def json_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(
        "case event_id % 5 when 0 then props when 1 then '{\"b\":true,\"a\":false,\"c\":1}'"
        " when 2 then '{bad' when 3 then '[true]' else concat('{\"x', event_id, '\":true}') end"
    )
    events = mapping.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    entries = F.array_sort(F.map_entries(boolean_entries(F.col("raw"))))
    return events.select("event_id", joined(entries, "key", "value").alias("channels"))


def input_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as nested inputs; most are valid, the others break one rule or several."""
    return mapping.spread(mapping.table(spark, sf_dir, "customer"), "c_custkey").select(
        F.col("c_custkey").alias("id"),
        F.expr(
            """
case when c_custkey % 41 = 0 then '[1]' else concat(
  '{"customerNumber":" ', c_name, ' ","firstName":"', case when c_custkey % 37 = 0 then ' '
    else c_mktsegment end, '","lastName":"N', c_nationkey, '"',
  ',"dateOfBirth":', case when c_custkey % 31 = 0 then '"1.2.2000"' when c_custkey % 2 = 0
    then '"1990-01-02"' else 'null' end,
  ',"status":"', case when c_custkey % 29 = 0 then 'gone' else 'active' end, '"',
  ',"profile":{"preferredLanguage":"en","riskRating":"', case when c_custkey % 23 = 0 then 'odd'
    else 'low' end, '","annualIncome":', case when c_custkey % 19 = 0 then '"12.345"'
    when c_custkey % 3 = 0 then '1200.5' else '" 77.10 "' end,
  ',"taxResidencyCountry":"', case when c_custkey % 17 = 0 then 'GBR' else 'gb' end, '"}',
  ',"addresses":', case when c_custkey % 43 = 0 then '{}' else concat(
    '[{"type":"work","line1":" L', c_custkey, '","city":"C","postalCode":', c_custkey,
    ',"countryCode":"us","validFrom":"2024-01-01"},{"type":"', case when c_custkey % 13 = 0
    then 'work' else 'mailing' end, '","line1":"M","line2":" ","city":"D","postalCode":"P",
    "countryCode":"DE","validFrom":"2024-02-02","validTo":"2025-02-02"}]') end,
  ',"contacts":', case when c_custkey % 47 = 0 then 'null' else concat(
    '[{"type":"email","value":"e', c_custkey, '","isPrimary":true,"verifiedAt":"2024-01-01T05:00:00Z"},
     {"type":"', case when c_custkey % 11 = 0 then 'email' else 'home_phone' end,
    '","value":"p","isPrimary":true}]') end,
  ',"preferences":{"marketingEmailOptIn":true,"marketingSmsOptIn":false,"paperlessStatements":',
    case when c_custkey % 53 = 0 then '"yes"' else 'true' end,
  ',"notificationChannels":{"email":', case when c_custkey % 59 = 0 then '1' else 'true' end,
  '}}}') end
"""
        ).alias("payload"),
    )


def validated_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validation.checked(input_payloads(spark, sf_dir)).filter("error is null")
    d = F.col("data")
    return checked.select(
        "id",
        d["customerNumber"].alias("customer_number"),
        d["firstName"].alias("first_name"),
        d["dateOfBirth"].alias("date_of_birth"),
        d["profile"]["annualIncome"].alias("annual_income"),
        d["profile"]["taxResidencyCountry"].alias("country"),
        joined(d["addresses"], "type", "line1", "line2", "postalCode", "countryCode", "validTo").alias(
            "addresses"
        ),
        joined(d["contacts"], "type", "value", "isPrimary", "verifiedAt").alias("contacts"),
    )


def rejected_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validation.checked(input_payloads(spark, sf_dir))
    return checked.filter("error is not null").select("id", "error")


def duplicate_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.when(F.col("id") % 4 == 0, F.col("customer_number")).otherwise(
        F.concat(F.lit("NEW-"), F.floor(F.col("id") / 3))
    )
    customers = mapping.base_tables(spark, sf_dir)["customers"]
    inputs = customers.select("id", F.struct(number.alias("customerNumber")).alias("data"))
    marked = validation.without_duplicates(inputs, customers, "id")
    return marked.select("id", "customer_number", "error")


def faulty_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The base tables with broken rules put in by id."""
    tables = dict(mapping.base_tables(spark, sf_dir))
    c, p, a = (tables[t] for t in ("customers", "customer_profiles", "customer_addresses"))
    tables["customers"] = c.withColumns(
        {
            "status": F.expr("case when id % 211 = 0 then 'unknown' else status end"),
            "customer_number": F.expr("case when id % 301 = 1 then 'SAME' else customer_number end"),
        }
    )
    tables["customer_profiles"] = p.withColumn(
        "tax_residency_country",
        F.expr("case when customer_id % 97 = 0 then 'USA' else tax_residency_country end"),
    )
    tables["customer_addresses"] = a.withColumns(
        {
            "customer_id": F.expr("case when id % 501 = 0 then 1000000000 + id % 7 else customer_id end"),
            "line_1": F.expr("case when id % 307 = 0 then null else line_1 end"),
        }
    )
    return tables


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.violations(faulty_tables(spark, sf_dir), constraints.CUSTOMER_RULES)


def upsert_singleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = mapping.base_tables(spark, sf_dir)["customer_profiles"]
    changed = base.filter("customer_id % 10 = 0").withColumn("risk_rating", F.lit("high"))
    fresh = base.filter("customer_id % 10 = 1").withColumn(
        "customer_id", F.col("customer_id") + 1_000_000_000
    )
    merged = writes.upsert(base, changed.unionByName(fresh), "customer_id", now())
    return merged.select(
        "customer_id", "risk_rating", "occupation", F.unix_seconds("updated_at").alias("updated")
    )


def replace_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = mapping.base_tables(spark, sf_dir)
    base = tables["customer_addresses"]
    parents = tables["customers"].filter("id % 10 = 0").select(F.col("id").alias("customer_id"))
    rows = base.filter("customer_id % 10 = 0 and address_type = 'work'").withColumn(
        "id", F.col("id") + 1_000_000_000
    )
    return writes.replace_collection(base, parents, rows).select("id", "customer_id", "address_type")


def insert_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = mapping.base_tables(spark, sf_dir)["customers"]
    rows = mapping.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("position"),
        F.col("s_name").alias("customer_number"),
        F.lit("New").alias("first_name"),
        F.lit("Name").alias("last_name"),
        F.lit(None).cast("date").alias("date_of_birth"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    added = writes.insert_roots(base, rows, "position", now())
    return added.select(
        "id", "customer_number", "status", F.unix_seconds("created_at").alias("created")
    )


def _update(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    updates = (
        mapping.base_tables(spark, sf_dir)["customers"]
        .filter("id % 10 = 0")
        .select("id", F.concat("customer_number", F.lit("-x")).alias("customer_number"))
    )
    unknown = updates.withColumn("id", F.col("id") + 1_000_000_000)
    return writes.update_roots(base, updates.unionByName(unknown), now())


def update_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = mapping.base_tables(spark, sf_dir)["customers"]
    return _update(spark, sf_dir, base).select(
        "id", "customer_number", "status", F.unix_seconds("updated_at").alias("updated")
    )


def _deleted(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    tables = mapping.base_tables(spark, sf_dir)
    return writes.delete_roots(tables, tables["customers"].filter("id % 11 = 0"), SPEC)


def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, removed = _deleted(spark, sf_dir)
    rows = removed.select(F.lit("deleted roots").alias("table_name"), F.col("deleted").alias("key"))
    for name, frame in left.items():
        key = "id" if "id" in frame.columns else "customer_id"
        rows = rows.unionByName(frame.select(F.lit(name).alias("table_name"), F.col(key).alias("key")))
    return rows


def changed_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The base tables after updates and cascading deletes."""
    left, _ = _deleted(spark, sf_dir)
    return {**left, "customers": _update(spark, sf_dir, left["customers"])}


def changes_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = mapping.base_tables(spark, sf_dir)
    log = writes.changes_between(old, changed_tables(spark, sf_dir), SPEC, 1)
    event = F.from_json("value", "op string, status string, event_count bigint")
    return log.withColumn("e", event).select(
        "source",
        F.regexp_extract("key", r"([0-9]+)(\D*)$", 1).cast("bigint").alias("key"),
        F.coalesce("e.op", "e.status").alias("op"),
        F.coalesce("e.event_count", F.lit(0)).alias("n"),
    )


def shred_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validation.checked(input_payloads(spark, sf_dir)).filter("error is null")
    rows = writes.shred(materialize(checked.drop("payload"), "inputs"), now())
    addresses = rows["customer_addresses"].select(
        F.lit("customer_addresses").alias("table_name"),
        "customer_id",
        "pos",
        F.col("address_type").alias("kind"),
        F.concat_ws(":", "line_1", "valid_from", "valid_to").alias("content"),
    )
    contacts = rows["customer_contacts"].select(
        F.lit("customer_contacts").alias("table_name"),
        "customer_id",
        "pos",
        F.col("contact_type").alias("kind"),
        F.col("contact_value").alias("content"),
    )
    singles = rows["customer_profiles"].select(
        F.lit("customer_profiles").alias("table_name"),
        "customer_id",
        F.lit(0).alias("pos"),
        F.col("risk_rating").alias("kind"),
        F.col("annual_income").cast("string").alias("content"),
    )
    prefs = rows["customer_preferences"].select(
        F.lit("customer_preferences").alias("table_name"),
        "customer_id",
        F.lit(0).alias("pos"),
        F.col("paperless_statements").cast("string").alias("kind"),
        F.col("notification_channels").alias("content"),
    )
    roots = rows["customers"].select(
        F.lit("customers").alias("table_name"),
        F.col("id").alias("customer_id"),
        F.lit(0).alias("pos"),
        F.col("status").alias("kind"),
        F.col("customer_number").alias("content"),
    )
    return (
        addresses.unionByName(contacts).unionByName(singles).unionByName(prefs).unionByName(roots)
    )


QUERIES = {
    "relational_documents": relational_documents,
    "oversized_relational": oversized_relational,
    "snapshot_documents": snapshot_documents,
    "collection_order_text_vs_number": collection_order_text_vs_number,
    "source_page": source_page,
    "page_counts": page_counts,
    "point_lookup": point_lookup,
    "read_model_from_tables": read_model_from_tables,
    "read_model_from_store": read_model_from_store,
    "customer_summary": customer_summary,
    "date_decode": date_decode,
    "instant_decode": instant_decode,
    "json_channels": json_channels,
    "validated_inputs": validated_inputs,
    "rejected_inputs": rejected_inputs,
    "duplicate_inputs": duplicate_inputs,
    "constraint_violations": constraint_violations,
    "upsert_singleton": upsert_singleton,
    "replace_collection": replace_collection,
    "insert_roots": insert_roots,
    "update_roots": update_roots,
    "cascade_delete": cascade_delete,
    "changes_between": changes_between,
    "shred_inputs": shred_inputs,
}
