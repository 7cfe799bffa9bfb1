"""Table rules of the base tables as one violations frame: ``rule, table_name, key, n_rows``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.spec import ADDRESS_TYPES, CONTACT_TYPES, RISK_RATINGS, STATUSES


@dataclass(frozen=True)
class TableRules:
    """Rules of one table."""

    key: str
    not_null: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    unique_where: tuple[tuple[str, tuple[str, ...]], ...] = ()
    owner: str | None = None


# The rules of the five tables.
CUSTOMER_RULES = {
    "customers": TableRules(
        key="id",
        not_null=(
            "id",
            "customer_number",
            "first_name",
            "last_name",
            "status",
            "created_at",
            "updated_at",
        ),
        domains={"status": STATUSES},
        unique=(("id",), ("customer_number",)),
    ),
    "customer_profiles": TableRules(
        key="customer_id",
        not_null=("customer_id", "preferred_language", "risk_rating", "updated_at"),
        domains={"risk_rating": RISK_RATINGS},
        lengths={"tax_residency_country": 2},
        unique=(("customer_id",),),
        owner="customer_id",
    ),
    "customer_addresses": TableRules(
        key="id",
        not_null=(
            "id",
            "customer_id",
            "address_type",
            "line_1",
            "city",
            "postal_code",
            "country_code",
            "valid_from",
            "created_at",
            "updated_at",
        ),
        domains={"address_type": ADDRESS_TYPES},
        lengths={"country_code": 2},
        unique=(("id",), ("customer_id", "address_type")),
        owner="customer_id",
    ),
    "customer_contacts": TableRules(
        key="id",
        not_null=(
            "id",
            "customer_id",
            "contact_type",
            "contact_value",
            "is_primary",
            "created_at",
            "updated_at",
        ),
        domains={"contact_type": CONTACT_TYPES},
        unique=(("id",), ("customer_id", "contact_type", "contact_value")),
        unique_where=(("is_primary", ("customer_id", "contact_type")),),
        owner="customer_id",
    ),
    "customer_preferences": TableRules(
        key="customer_id",
        not_null=(
            "customer_id",
            "marketing_email_opt_in",
            "marketing_sms_opt_in",
            "paperless_statements",
            "notification_channels",
            "updated_at",
        ),
        unique=(("customer_id",),),
        owner="customer_id",
    ),
}


def row_rules(frame: DataFrame, name: str, rules: TableRules) -> DataFrame:
    """Rules on single rows, all in one pass over the table."""
    found = [F.when(F.col(c).isNull(), f"not_null:{c}") for c in rules.not_null]
    found += [
        F.when(~F.col(c).isin(*members), f"check:{c}") for c, members in rules.domains.items()
    ]
    found += [F.when(F.length(c) > n, f"length:{c}") for c, n in rules.lengths.items()]
    broken = F.array_compact(F.array(*found))
    return frame.select(
        F.explode(broken).alias("rule"),
        F.lit(name).alias("table_name"),
        F.col(rules.key).cast("string").alias("key"),
        F.lit(1).cast("bigint").alias("n_rows"),
    )


def unique_rule(
    frame: DataFrame, name: str, columns: tuple[str, ...], where: str | None = None
) -> DataFrame:
    """Keys that occur more than once; a null in a key never collides."""
    rows = frame.filter(where) if where else frame
    for column in columns:
        rows = rows.filter(F.col(column).isNotNull())
    label = f"unique:{'+'.join(columns)}" + (f":{where}" if where else "")
    return (
        rows.groupBy(*columns)
        .agg(F.count("*").alias("n_rows"))
        .filter("n_rows > 1")
        .select(
            F.lit(label).alias("rule"),
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("key"),
            "n_rows",
        )
    )


def owner_rule(frame: DataFrame, name: str, owner: str, roots: DataFrame) -> DataFrame:
    """Owners without a root row; children are counted per owner before the join."""
    owners = frame.groupBy(owner).agg(F.count("*").alias("n_rows"))
    return (
        owners.filter(F.col(owner).isNotNull())
        .join(roots.select(F.col("id").alias(owner)), owner, "left_anti")
        .select(
            F.lit(f"owner:{owner}").alias("rule"),
            F.lit(name).alias("table_name"),
            F.col(owner).cast("string").alias("key"),
            "n_rows",
        )
    )


def violations(tables: dict[str, DataFrame], rules: dict[str, TableRules]) -> DataFrame:
    """All rule breaches of all tables."""
    found = []
    for name, rule in rules.items():
        frame = tables[name]
        found.append(row_rules(frame, name, rule))
        found += [unique_rule(frame, name, columns) for columns in rule.unique]
        found += [unique_rule(frame, name, cols, where) for where, cols in rule.unique_where]
        if rule.owner:
            found.append(owner_rule(frame, name, rule.owner, tables["customers"]))
    union = found[0]
    for frame in found[1:]:
        union = union.unionByName(frame)
    return union
