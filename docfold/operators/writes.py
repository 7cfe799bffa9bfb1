"""Writes on the base tables as table-to-table operators, and the change rows they cause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.operators.numbering import dense_number
from docfold.session import materialize
from docfold.sources.changelog import wire
from docfold.spec import MARKER_SOURCE, DocumentSpec

# Column defaults of the five tables.
DEFAULTS = {
    "customers": {"status": "active"},
    "customer_profiles": {"preferred_language": "en", "risk_rating": "standard"},
    "customer_addresses": {},
    "customer_contacts": {"is_primary": False},
    "customer_preferences": {
        "marketing_email_opt_in": False,
        "marketing_sms_opt_in": False,
        "paperless_statements": True,
        "notification_channels": '{"email": true, "sms": false}',
    },
}


def with_defaults(frame: DataFrame, table: str, now: Column) -> DataFrame:
    """Fill columns that have a default; time columns get ``now``, ``valid_from`` its date."""
    filled = {c: F.coalesce(c, F.lit(v)) for c, v in DEFAULTS[table].items() if c in frame.columns}
    for column in ("created_at", "updated_at"):
        if column in frame.columns:
            filled[column] = F.coalesce(column, now)
    if "valid_from" in frame.columns:
        filled["valid_from"] = F.coalesce("valid_from", now.cast("date"))
    return frame.withColumns(filled)


def shred(inputs: DataFrame, now: Column, key: str = "id") -> dict[str, DataFrame]:
    """Cleaned nested inputs (``data``) with their root id as rows of the five tables.

    The two arrays give one row per element, numbered by ``pos``; row ids are given on insert.
    """
    owner = F.col(key).alias("customer_id")
    d = F.col("data")
    address = inputs.select(owner, F.posexplode(d["addresses"]).alias("pos", "a"))
    contact = inputs.select(owner, F.posexplode(d["contacts"]).alias("pos", "c"))
    prof, prefs = d["profile"], d["preferences"]
    return {
        "customers": inputs.select(
            F.col(key).alias("id"),
            d["customerNumber"].alias("customer_number"),
            d["firstName"].alias("first_name"),
            d["lastName"].alias("last_name"),
            d["dateOfBirth"].try_cast("date").alias("date_of_birth"),
            d["status"].alias("status"),
            now.alias("created_at"),
            now.alias("updated_at"),
        ),
        "customer_profiles": inputs.select(
            owner,
            prof["preferredLanguage"].alias("preferred_language"),
            prof["occupation"].alias("occupation"),
            prof["annualIncome"].try_cast("decimal(14,2)").alias("annual_income"),
            prof["taxResidencyCountry"].alias("tax_residency_country"),
            prof["riskRating"].alias("risk_rating"),
            now.alias("updated_at"),
        ),
        "customer_addresses": address.select(
            "customer_id",
            "pos",
            F.col("a.type").alias("address_type"),
            F.col("a.line1").alias("line_1"),
            F.col("a.line2").alias("line_2"),
            F.col("a.city").alias("city"),
            F.col("a.region").alias("region"),
            F.col("a.postalCode").alias("postal_code"),
            F.col("a.countryCode").alias("country_code"),
            F.col("a.validFrom").try_cast("date").alias("valid_from"),
            F.col("a.validTo").try_cast("date").alias("valid_to"),
            now.alias("created_at"),
            now.alias("updated_at"),
        ),
        "customer_contacts": contact.select(
            "customer_id",
            "pos",
            F.col("c.type").alias("contact_type"),
            F.col("c.value").alias("contact_value"),
            F.col("c.isPrimary").alias("is_primary"),
            F.col("c.verifiedAt").try_cast("timestamp").alias("verified_at"),
            now.alias("created_at"),
            now.alias("updated_at"),
        ),
        "customer_preferences": inputs.select(
            owner,
            prefs["marketingEmailOptIn"].alias("marketing_email_opt_in"),
            prefs["marketingSmsOptIn"].alias("marketing_sms_opt_in"),
            prefs["paperlessStatements"].alias("paperless_statements"),
            F.to_json(prefs["notificationChannels"]).alias("notification_channels"),
            now.alias("updated_at"),
        ),
    }


def upsert(base: DataFrame, updates: DataFrame, key: str, now: Column) -> DataFrame:
    """Insert new keys and replace known ones; a replaced row gets ``now`` as its update time."""
    old = base.withColumn("_old", F.lit(True))
    new = updates.withColumn("_new", F.lit(True))
    joined = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    is_new, is_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    columns = []
    for c in base.columns:
        value = F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        if c == "updated_at":
            value = F.when(is_new & is_old, now).otherwise(value)
        columns.append(value.alias(c))
    return joined.select(*columns)


def replace_collection(
    base: DataFrame, parents: DataFrame, rows: DataFrame, owner: str = "customer_id"
) -> DataFrame:
    """Delete all rows of the given parents, then insert the new ones."""
    gone = parents.select(F.col(owner).alias("_p")).distinct()
    kept = base.join(gone, base[owner] == gone["_p"], "left_anti")
    return kept.unionByName(rows.select(*base.columns))


def insert_roots(base: DataFrame, rows: DataFrame, order: str, now: Column) -> DataFrame:
    """New root rows with generated ids above the highest one, in the given order."""
    top = base.agg(F.max("id")).first()[0]
    numbered = dense_number(rows, [F.col(order)], "id", (-1 if top is None else top) + 1)
    return with_defaults(numbered, "customers", now).select(*base.columns)


def update_roots(base: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """Replace the given columns of known ids; ids that do not exist change nothing."""
    changed = [c for c in updates.columns if c not in ("id", "created_at", "updated_at")]
    patch = updates.select(
        F.col("id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in changed], F.lit(True).alias("_hit")
    )
    joined = base.join(patch, base["id"] == patch["_id"], "left")
    hit = F.col("_hit").isNotNull()
    columns = []
    for c in base.columns:
        value = F.col(c)
        if c in changed:
            value = F.when(hit, F.col(f"_{c}")).otherwise(value)
        elif c == "updated_at":
            value = F.when(hit, now).otherwise(value)
        columns.append(value.alias(c))
    return joined.select(*columns)


def delete_roots(
    tables: dict[str, DataFrame], ids: DataFrame | None, spec: DocumentSpec
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Delete roots by id (all when ``ids`` is null) with their children.

    Returns the tables left, and one row with the number of roots removed.
    """
    root = tables[spec.root]
    if ids is None:
        empty = {name: frame.filter(F.lit(False)) for name, frame in tables.items()}
        return empty, root.agg(F.count("*").alias("deleted"))
    gone = ids.select(F.col(spec.root_key).alias("_gone")).distinct()
    left = {}
    for name, frame in tables.items():
        column = spec.root_key if name == spec.root else spec.owner_key
        left[name] = frame.join(gone, frame[column] == gone["_gone"], "left_anti")
    removed = root.join(gone, root[spec.root_key] == gone["_gone"], "left_semi")
    return left, removed.agg(F.count("*").alias("deleted"))


def changes_between(
    old: dict[str, DataFrame], new: dict[str, DataFrame], spec: DocumentSpec, seq: int
) -> DataFrame:
    """The change log that leads from one set of tables to the next, END markers included.

    Each entity's changes are one transaction ``<seq>.<entity>``; all rows carry ``seq`` as their
    order, since no row changes twice in one step. Collections log full before-images, the other
    tables log the key.
    """
    parts = []
    for table in spec.tables:
        child = next((c for c in spec.children if c.table == table), None)
        key = spec.row_key if child is None or child.is_collection else spec.owner_key
        owner = spec.root_key if child is None else spec.owner_key
        full = child is not None and child.is_collection
        parts.append(_table_changes(table, old[table], new[table], key, owner, full))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = materialize(
        rows.withColumn("txn", F.concat(F.lit(f"{seq}."), F.col("owner").cast("string"))), "changes"
    )
    order = F.lit(seq).cast("bigint").alias("seq")
    records = rows.select(
        "source",
        "key",
        F.concat(
            F.lit('{"op":"'),
            "op",
            F.lit('","before":'),
            F.coalesce("before", F.lit("null")),
            F.lit(',"after":'),
            F.coalesce("after", F.lit("null")),
            F.lit(',"transaction":{"id":"'),
            "txn",
            F.lit(f':{seq}"}}}}'),
        ).alias("value"),
        order,
        "at",
    )
    ends = rows.groupBy("txn").agg(F.count("*").alias("n"), F.max("at").alias("at"))
    markers = ends.select(
        F.lit(MARKER_SOURCE).alias("source"),
        F.col("txn").alias("key"),
        F.to_json(
            F.struct(
                F.lit("END").alias("status"),
                F.concat("txn", F.lit(":end")).alias("id"),
                F.col("n").alias("event_count"),
            )
        ).alias("value"),
        order,
        "at",
    )
    return records.unionByName(markers)


def _table_changes(
    table: str, old: DataFrame, new: DataFrame, key: str, owner: str, full_before: bool
) -> DataFrame:
    columns = old.columns
    left = old.select(F.struct(*columns).alias("o"))
    right = new.select(*columns).select(F.struct(*columns).alias("n"))
    joined = left.join(right, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    # Unchanged rows give no event; a moved row counts for its new owner's transaction.
    op = (
        F.when(F.col("o").isNull(), "c")
        .when(F.col("n").isNull(), "d")
        .when(~F.col("o").eqNullSafe(F.col("n")), "u")
    )
    wired = {
        side: F.to_json(
            F.struct(*[wire(old, c, f"{side}.{c}") for c in columns]), {"ignoreNullFields": "false"}
        )
        for side in ("o", "n")
    }
    before = wired["o"] if full_before else F.to_json(F.struct(F.col(f"o.{key}").alias(key)))
    logs_before = F.col("o").isNotNull() & (F.lit(full_before) | F.col("n").isNull())
    return joined.withColumn("op", op).filter("op is not null").select(
        F.lit(table).alias("source"),
        F.to_json(F.struct(F.coalesce(f"n.{key}", f"o.{key}").alias(key))).alias("key"),
        "op",
        F.when(logs_before, before).alias("before"),
        F.when(F.col("n").isNotNull(), wired["n"]).alias("after"),
        F.coalesce(f"n.{owner}", f"o.{owner}").alias("owner"),
        F.coalesce("n.updated_at", "o.updated_at").cast("timestamp").alias("at"),
    )
