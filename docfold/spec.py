"""The document model as plain data: which table feeds which part of the document.

Routing, assembly and the fold read this description alone. Documents also know two members by name
(``created_at`` stands behind the parts, ``preferences`` holds JSON text), and the read model,
validation, table rules and writes know the customer model.
"""

from __future__ import annotations

from dataclasses import dataclass

# Source name of transaction markers, beside the table names.
MARKER_SOURCE = "transaction"

# Allowed enumeration members of the customer model.
STATUSES = ("active", "inactive", "suspended")
RISK_RATINGS = ("low", "standard", "high")
ADDRESS_TYPES = ("residential", "mailing", "work")
CONTACT_TYPES = ("email", "mobile_phone", "home_phone")

# Fixed value: a document store rejects a document above this size (16 MiB).
DOCUMENT_LIMIT_BYTES = 16 * 1024 * 1024
# What a store takes is decided by the rendered document. Row images carry more than that, so an
# entity is rendered up to this many times the limit; beyond it is an error without being rendered.
RENDER_SLACK = 4
TOO_LARGE = "document is too large"


@dataclass(frozen=True)
class Field:
    """One document field: its name, the column it comes from and how it is rendered."""

    name: str
    column: str
    kind: str = "plain"  # plain | date | instant


@dataclass(frozen=True)
class Child:
    """A child table: a singleton (0..1 row) or a collection (0..N rows) of the root."""

    table: str
    part: str
    image: str  # DDL of the row image on the change log
    fields: tuple[Field, ...]
    sort_column: str | None = None  # set for collections

    @property
    def is_collection(self) -> bool:
        return self.sort_column is not None


@dataclass(frozen=True)
class DocumentSpec:
    """Root table, its document fields and its children."""

    root: str
    root_image: str
    root_fields: tuple[Field, ...]
    children: tuple[Child, ...]
    root_key: str = "id"
    owner_key: str = "customer_id"
    row_key: str = "id"

    @property
    def tables(self) -> list[str]:
        return [self.root, *(c.table for c in self.children)]

    @property
    def singletons(self) -> list[Child]:
        return [c for c in self.children if not c.is_collection]

    @property
    def collections(self) -> list[Child]:
        return [c for c in self.children if c.is_collection]


# On the change log dates are epoch days or ISO text, instants epoch milliseconds or ISO text and
# decimals text, so these columns are read as text and rendered by functions.values.
CUSTOMER_SPEC = DocumentSpec(
    root="customers",
    root_image=(
        "id bigint, customer_number string, first_name string, last_name string,"
        " date_of_birth string, status string, created_at string, updated_at string"
    ),
    root_fields=(
        Field("id", "id"),
        Field("customer_number", "customer_number"),
        Field("first_name", "first_name"),
        Field("last_name", "last_name"),
        Field("date_of_birth", "date_of_birth", "date"),
        Field("status", "status"),
        Field("created_at", "created_at", "instant"),
    ),
    children=(
        Child(
            table="customer_profiles",
            part="profile",
            image=(
                "customer_id bigint, preferred_language string, occupation string,"
                " annual_income string, tax_residency_country string, risk_rating string,"
                " updated_at string"
            ),
            fields=(
                Field("preferredLanguage", "preferred_language"),
                Field("occupation", "occupation"),
                Field("annualIncome", "annual_income"),
                Field("taxResidencyCountry", "tax_residency_country"),
                Field("riskRating", "risk_rating"),
            ),
        ),
        Child(
            table="customer_addresses",
            part="addresses",
            image=(
                "id string, customer_id bigint, address_type string, line_1 string,"
                " line_2 string, city string, region string, postal_code string,"
                " country_code string, valid_from string, valid_to string, updated_at string"
            ),
            fields=(
                Field("type", "address_type"),
                Field("line1", "line_1"),
                Field("line2", "line_2"),
                Field("city", "city"),
                Field("region", "region"),
                Field("postalCode", "postal_code"),
                Field("countryCode", "country_code"),
                Field("validFrom", "valid_from", "date"),
                Field("validTo", "valid_to", "date"),
            ),
            sort_column="address_type",
        ),
        Child(
            table="customer_contacts",
            part="contacts",
            image=(
                "id string, customer_id bigint, contact_type string, contact_value string,"
                " is_primary boolean, verified_at string, updated_at string"
            ),
            fields=(
                Field("type", "contact_type"),
                Field("value", "contact_value"),
                Field("isPrimary", "is_primary"),
                Field("verifiedAt", "verified_at", "instant"),
            ),
            sort_column="contact_type",
        ),
        Child(
            table="customer_preferences",
            part="preferences",
            image=(
                "customer_id bigint, marketing_email_opt_in boolean,"
                " marketing_sms_opt_in boolean, paperless_statements boolean,"
                " notification_channels string, updated_at string"
            ),
            fields=(
                Field("marketingEmailOptIn", "marketing_email_opt_in"),
                Field("marketingSmsOptIn", "marketing_sms_opt_in"),
                Field("paperlessStatements", "paperless_statements"),
                Field("notificationChannels", "notification_channels"),
            ),
        ),
    ),
)
