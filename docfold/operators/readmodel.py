"""The read model: one normalized shape for documents from the tables and from the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.functions.values import (
    ISO_DATE,
    NUMBER,
    boolean_entries,
    instant,
    iso_date,
    iso_millis,
    json_object,
    text_or_null,
)
from docfold.spec import ADDRESS_TYPES, CONTACT_TYPES, RISK_RATINGS

# Stored members are read as text; nested ones as their JSON text.
MEMBERS = (
    "id string, customer_number string, first_name string, last_name string,"
    " date_of_birth string, status string, profile string, addresses string, contacts string,"
    " preferences string, created_at string, updated_at string"
)
STORED = f"_id string, deleted boolean, {MEMBERS}, after struct<{MEMBERS.replace(' string', ': string')}>"
ADDRESS = (
    "type string, line1 string, line2 string, city string, region string,"
    " postalCode string, countryCode string, validFrom string, validTo string"
)
CONTACT = "type string, value string, isPrimary boolean, verifiedAt string"


def to_instant(value: Column) -> Column:
    """Instant or date text, or epoch milliseconds, as a timestamp."""
    return F.when(value.rlike(ISO_DATE), value.try_cast("timestamp")).otherwise(instant(value))


def to_iso(value: Column) -> Column:
    """ISO text with milliseconds; empty text when there is nothing."""
    return F.when(_falsy(value), F.lit("")).otherwise(iso_millis(to_instant(value)))


def to_date(value: Column) -> Column:
    """ISO date from an epoch day, a date or an instant; null when empty. Day 0 counts as empty."""
    return (
        F.when(_falsy(value), F.lit(None).cast("string"))
        .when(value.rlike(NUMBER), iso_date(value))
        .when(value.rlike(ISO_DATE), value)
        .otherwise(F.substring(iso_millis(to_instant(value)), 1, 10))
    )


def _falsy(value: Column) -> Column:
    return value.isNull() | (value == "") | value.rlike(r"^-?0+(\.0+)?$")


def profile(value: Column) -> Column:
    """Profile members with defaults; an unknown risk rating becomes ``standard``."""
    p = F.from_json(
        value,
        "preferredLanguage string, occupation string, annualIncome string,"
        " taxResidencyCountry string, riskRating string",
    )
    risk = p["riskRating"]
    return F.struct(
        F.coalesce(p["preferredLanguage"], F.lit("en")).alias("preferredLanguage"),
        text_or_null(p["occupation"]).alias("occupation"),
        text_or_null(p["annualIncome"]).alias("annualIncome"),
        text_or_null(p["taxResidencyCountry"]).alias("taxResidencyCountry"),
        F.when(risk.isin(*RISK_RATINGS), risk).otherwise("standard").alias("riskRating"),
    )


def _objects(value: Column, schema: str) -> Column:
    """The objects of a JSON array; elements of other kinds are dropped, and so is no array."""
    items = F.coalesce(F.from_json(value, "array<string>"), F.array())
    objects = F.filter(items, lambda e: json_object(e).isNotNull())
    return F.transform(objects, lambda e: F.from_json(e, schema))


def addresses(value: Column) -> Column:
    """Addresses of known types."""
    parsed = _objects(value, ADDRESS)

    def shape(a: Column) -> Column:
        return F.struct(
            a["type"].alias("type"),
            F.coalesce(a["line1"], F.lit("")).alias("line1"),
            text_or_null(a["line2"]).alias("line2"),
            F.coalesce(a["city"], F.lit("")).alias("city"),
            text_or_null(a["region"]).alias("region"),
            F.coalesce(a["postalCode"], F.lit("")).alias("postalCode"),
            F.coalesce(a["countryCode"], F.lit("")).alias("countryCode"),
            F.coalesce(to_date(a["validFrom"]), F.lit("")).alias("validFrom"),
            to_date(a["validTo"]).alias("validTo"),
        )

    return F.transform(F.filter(parsed, lambda a: a["type"].isin(*ADDRESS_TYPES)), shape)


def contacts(value: Column) -> Column:
    """Contacts of known types."""
    parsed = _objects(value, CONTACT)

    def shape(c: Column) -> Column:
        verified = c["verifiedAt"]
        return F.struct(
            c["type"].alias("type"),
            F.coalesce(c["value"], F.lit("")).alias("value"),
            F.coalesce(c["isPrimary"], F.lit(False)).alias("isPrimary"),
            F.when(~_falsy(verified), iso_millis(to_instant(verified))).alias("verifiedAt"),
        )

    return F.transform(F.filter(parsed, lambda c: c["type"].isin(*CONTACT_TYPES)), shape)


def preferences(value: Column) -> Column:
    """Preference switches with defaults; only boolean channels stay."""
    p = F.from_json(
        value,
        "marketingEmailOptIn boolean, marketingSmsOptIn boolean, paperlessStatements boolean,"
        " notificationChannels string",
    )
    return F.struct(
        F.coalesce(p["marketingEmailOptIn"], F.lit(False)).alias("marketingEmailOptIn"),
        F.coalesce(p["marketingSmsOptIn"], F.lit(False)).alias("marketingSmsOptIn"),
        F.coalesce(p["paperlessStatements"], F.lit(True)).alias("paperlessStatements"),
        boolean_entries(p["notificationChannels"]).alias("notificationChannels"),
    )


def from_store(stored: DataFrame, column: str = "json") -> DataFrame:
    """Read model of stored documents (JSON text); delete markers are hidden.

    A member may sit at the top or below ``after``; the id may be a member, or ``_id`` as a value
    or as an object with an ``id``.
    """
    parsed = stored.withColumn("_d", F.from_json(column, STORED)).filter(
        ~F.coalesce(F.col("_d.deleted"), F.lit(False))
    )

    def member(name: str) -> Column:
        return F.coalesce(f"_d.{name}", f"_d.after.{name}")

    doc_id = F.col("_d._id")
    inner = F.get_json_object(json_object(doc_id), "$.id")
    return parsed.select(
        F.coalesce(member("id"), inner, doc_id).alias("id"),
        F.coalesce(member("customer_number"), F.lit("")).alias("customerNumber"),
        F.coalesce(member("first_name"), F.lit("")).alias("firstName"),
        F.coalesce(member("last_name"), F.lit("")).alias("lastName"),
        to_date(member("date_of_birth")).alias("dateOfBirth"),
        F.coalesce(member("status"), F.lit("active")).alias("status"),
        profile(member("profile")).alias("profile"),
        addresses(member("addresses")).alias("addresses"),
        contacts(member("contacts")).alias("contacts"),
        preferences(member("preferences")).alias("preferences"),
        to_iso(member("created_at")).alias("createdAt"),
        to_iso(member("updated_at")).alias("updatedAt"),
    )


def from_tables(docs: DataFrame) -> DataFrame:
    """Read model of ``relational.relational_documents``.

    The income is a number there, so it shows without trailing zeros; stored documents hold text.
    """
    income = F.col("profile.annualIncome").cast("string")
    shortened = F.regexp_replace(F.regexp_replace(income, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    docs = docs.withColumn("profile", F.col("profile").withField("annualIncome", shortened))

    def as_json(name: str) -> Column:
        return F.to_json(F.col(name), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})

    return docs.select(
        F.col("id").cast("string").alias("id"),
        F.col("customer_number").alias("customerNumber"),
        F.col("first_name").alias("firstName"),
        F.col("last_name").alias("lastName"),
        F.col("date_of_birth").cast("string").alias("dateOfBirth"),
        "status",
        profile(as_json("profile")).alias("profile"),
        addresses(as_json("addresses")).alias("addresses"),
        contacts(as_json("contacts")).alias("contacts"),
        preferences(as_json("preferences")).alias("preferences"),
        iso_millis(F.col("created_at")).alias("createdAt"),
        iso_millis(F.col("updated_at")).alias("updatedAt"),
    )


def summary(customers: DataFrame) -> DataFrame:
    """One listing row per customer of the read model."""
    return customers.select(
        "id",
        "customerNumber",
        F.concat_ws(" ", "firstName", "lastName").alias("name"),
        F.col("profile.riskRating").alias("risk"),
        F.size("addresses").alias("n_addresses"),
        F.size("contacts").alias("n_contacts"),
        "status",
        F.col("updatedAt").alias("changed"),
    )
