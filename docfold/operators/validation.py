"""Customer inputs (JSON text): the first broken rule, and the cleaned input when none is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.functions.values import ISO_DATE, computed_once, iso_millis, text_or_null
from docfold.operators.readmodel import to_instant
from docfold.operators.skew import attach
from docfold.session import materialize
from docfold.spec import ADDRESS_TYPES, CONTACT_TYPES, RISK_RATINGS, STATUSES

# The messages a caller sees, in the order the rules are checked.
PAYLOAD = "A customer payload is required."
NAMES = "Customer number, first name, and last name are required."
BIRTH = "Date of birth must use YYYY-MM-DD."
STATUS = "Status must be active, inactive, or suspended."
PROFILE = "Profile language and a valid risk rating are required."
INCOME = "Annual income must be a positive currency amount."
COUNTRY = "Tax residency country must be a two-letter code."
ADDRESSES = "Addresses must be an array."
ADDRESS = (
    "Each address needs a unique type, street, city, postal code, country, and valid-from date."
)
CONTACTS = "Contacts must be an array."
CONTACT = "Each contact needs a type and value, with at most one primary contact per type."
SWITCHES = "All preference switches must be true or false."
DUPLICATE = "Customer number must be unique."

# Fixed patterns.
MONEY = r"^\d+(\.\d{1,2})?$"
TWO_LETTERS = r"^[A-Za-z]{2}$"
DATE_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?$"


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY, BOOLEAN, ... of a variant; empty when it is missing."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0), F.lit(""))


def _get(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _trimmed(value: Column, path: str) -> Column:
    return text_or_null(_get(value, path))


def _date_ok(value: Column) -> Column:
    return value.isNull() | value.rlike(ISO_DATE)


def _moment(value: Column) -> Column:
    """Date or date-time text as an instant, read as UTC when it names no zone."""
    return F.coalesce(to_instant(value), F.when(value.rlike(DATE_TIME), value.try_cast("timestamp")))


def _all(array: Column, rule) -> Column:
    return F.coalesce(F.forall(array, lambda x: F.coalesce(rule(x), F.lit(False))), F.lit(False))


def _distinct(array: Column) -> Column:
    return F.size(F.array_distinct(array)) == F.size(array)


def _read(root: Column) -> dict[str, Column]:
    """Every member a rule looks at, taken out of the parsed input once."""
    prof, prefs = _get(root, "$.profile", "variant"), _get(root, "$.preferences", "variant")
    channels = _get(root, "$.preferences.notificationChannels", "variant")
    switch_names = ("marketingEmailOptIn", "marketingSmsOptIn", "paperlessStatements")

    def address(a: Column) -> Column:
        return F.struct(
            _kind(a).alias("kind"),
            F.coalesce(_get(a, "$.type"), F.lit("")).alias("type"),
            F.coalesce(_get(a, "$.countryCode"), F.lit("")).alias("raw_country"),
            *[
                _trimmed(a, f"$.{name}").alias(name)
                for name in (
                    "line1",
                    "line2",
                    "city",
                    "region",
                    "postalCode",
                    "countryCode",
                    "validFrom",
                    "validTo",
                )
            ],
        )

    def contact(c: Column) -> Column:
        flag = _get(c, "$.isPrimary", "variant")
        primary = (_kind(flag) == "BOOLEAN") & F.coalesce(
            _get(c, "$.isPrimary", "boolean"), F.lit(False)
        )
        return F.struct(
            _kind(c).alias("kind"),
            F.coalesce(_get(c, "$.type"), F.lit("")).alias("type"),
            _trimmed(c, "$.value").alias("value"),
            primary.alias("isPrimary"),
            _trimmed(c, "$.verifiedAt").alias("verifiedAt"),
        )

    return {
        "kind": _kind(root),
        "number": _trimmed(root, "$.customerNumber"),
        "first": _trimmed(root, "$.firstName"),
        "last": _trimmed(root, "$.lastName"),
        "birth": _trimmed(root, "$.dateOfBirth"),
        "status": F.coalesce(_get(root, "$.status"), F.lit("")),
        "profile_kind": _kind(prof),
        "language": _trimmed(root, "$.profile.preferredLanguage"),
        "occupation": _trimmed(root, "$.profile.occupation"),
        "income": _trimmed(root, "$.profile.annualIncome"),
        "country": F.upper(_trimmed(root, "$.profile.taxResidencyCountry")),
        "risk": F.coalesce(_get(root, "$.profile.riskRating"), F.lit("")),
        "addresses_kind": _kind(_get(root, "$.addresses", "variant")),
        "addresses": F.transform(_get(root, "$.addresses", "array<variant>"), address),
        "contacts_kind": _kind(_get(root, "$.contacts", "variant")),
        "contacts": F.transform(_get(root, "$.contacts", "array<variant>"), contact),
        "preferences_kind": _kind(prefs),
        "channels_kind": _kind(channels),
        "channel_kinds": F.transform(
            F.map_values(_get(channels, "$", "map<string,variant>")), _kind
        ),
        "channels": _get(channels, "$", "map<string,boolean>"),
        "switch_kinds": F.array(
            *[_kind(_get(root, f"$.preferences.{name}", "variant")) for name in switch_names]
        ),
        "switches": F.struct(
            *[_get(root, f"$.preferences.{name}", "boolean").alias(name) for name in switch_names]
        ),
    }


def checked(inputs: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``error`` (first broken rule or null) and ``data`` (cleaned input, null on error)."""
    parsed = computed_once(inputs, {"_v": F.try_parse_json(payload)})
    members = _read(F.col("_v"))
    frame = computed_once(parsed, {f"_{name}": c for name, c in members.items()})
    i = {name: F.col(f"_{name}") for name in members}

    def address_ok(a: Column) -> Column:
        return (
            (a["kind"] == "OBJECT")
            & a["type"].isin(*ADDRESS_TYPES)
            & a["line1"].isNotNull()
            & a["city"].isNotNull()
            & a["postalCode"].isNotNull()
            & a["raw_country"].rlike(TWO_LETTERS)
            & a["validFrom"].isNotNull()
            & _date_ok(a["validFrom"])
            & _date_ok(a["validTo"])
        )

    def contact_ok(c: Column) -> Column:
        return (
            (c["kind"] == "OBJECT")
            & c["type"].isin(*CONTACT_TYPES)
            & c["value"].isNotNull()
            & (c["verifiedAt"].isNull() | _moment(c["verifiedAt"]).isNotNull())
        )

    primaries = F.filter(i["contacts"], lambda c: c["isPrimary"])
    address_types = F.transform(i["addresses"], lambda a: a["type"])
    primary_types = F.transform(primaries, lambda c: c["type"])
    switches_ok = (
        (i["preferences_kind"] == "OBJECT")
        & (i["channels_kind"] == "OBJECT")
        & _all(i["switch_kinds"], lambda k: k == "BOOLEAN")
        & _all(i["channel_kinds"], lambda k: k == "BOOLEAN")
    )
    error = (
        F.when(i["kind"] != "OBJECT", PAYLOAD)
        .when(i["number"].isNull() | i["first"].isNull() | i["last"].isNull(), NAMES)
        .when(~_date_ok(i["birth"]), BIRTH)
        .when(~i["status"].isin(*STATUSES), STATUS)
        .when(
            (i["profile_kind"] != "OBJECT")
            | i["language"].isNull()
            | ~i["risk"].isin(*RISK_RATINGS),
            PROFILE,
        )
        .when(i["income"].isNotNull() & ~i["income"].rlike(MONEY), INCOME)
        .when(i["country"].isNotNull() & ~i["country"].rlike(TWO_LETTERS), COUNTRY)
        .when(i["addresses_kind"] != "ARRAY", ADDRESSES)
        .when(~_all(i["addresses"], address_ok) | ~_distinct(address_types), ADDRESS)
        .when(i["contacts_kind"] != "ARRAY", CONTACTS)
        .when(~_all(i["contacts"], contact_ok) | ~_distinct(primary_types), CONTACT)
        .when(~switches_ok, SWITCHES)
    )

    def address(a: Column) -> Column:
        plain = ("type", "line1", "line2", "city", "region", "postalCode")
        return F.struct(
            *[a[name].alias(name) for name in plain],
            F.upper(a["countryCode"]).alias("countryCode"),
            a["validFrom"].alias("validFrom"),
            a["validTo"].alias("validTo"),
        )

    def contact(c: Column) -> Column:
        return F.struct(
            c["type"].alias("type"),
            c["value"].alias("value"),
            c["isPrimary"].alias("isPrimary"),
            iso_millis(_moment(c["verifiedAt"])).alias("verifiedAt"),
        )

    data = F.struct(
        i["number"].alias("customerNumber"),
        i["first"].alias("firstName"),
        i["last"].alias("lastName"),
        i["birth"].alias("dateOfBirth"),
        i["status"].alias("status"),
        F.struct(
            i["language"].alias("preferredLanguage"),
            i["occupation"].alias("occupation"),
            i["income"].alias("annualIncome"),
            i["country"].alias("taxResidencyCountry"),
            i["risk"].alias("riskRating"),
        ).alias("profile"),
        F.transform(i["addresses"], address).alias("addresses"),
        F.transform(i["contacts"], contact).alias("contacts"),
        i["switches"].withField("notificationChannels", i["channels"]).alias("preferences"),
    )
    judged = computed_once(frame, {"error": error})
    return judged.withColumn("data", F.when(F.col("error").isNull(), data)).select(
        *inputs.columns, "error", "data"
    )


def without_duplicates(accepted: DataFrame, existing: DataFrame, order: str) -> DataFrame:
    """Mark inputs whose customer number is taken: in the table, or by an earlier input."""
    numbered = materialize(
        accepted.withColumn("customer_number", F.col("data.customerNumber")), "inputs"
    )
    first = numbered.groupBy("customer_number").agg(
        F.min(order).alias("first_order"), F.count("*").alias("n_inputs")
    )
    taken = existing.select("customer_number").distinct().withColumn("taken", F.lit(True))
    facts = materialize(first.join(taken, "customer_number", "left"), "numbers")
    joined = attach(numbered, facts, "customer_number", "n_inputs", [order])
    duplicate = F.coalesce("taken", F.lit(False)) | (F.col(order) > F.col("first_order"))
    return joined.withColumn("error", F.when(duplicate, DUPLICATE)).drop(
        "first_order", "n_inputs", "taken"
    )
