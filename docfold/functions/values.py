"""Scalar rules for values read from the change log and from stored documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns.
NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_INSTANT = (
    r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}(:\d{2}(:\d{2})?)?)$"
)


def text(value: Column) -> Column:
    """The value itself, or null when it is null or blank."""
    return F.when(value.rlike(r"\S"), value)


def text_or_null(value: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    trimmed = F.regexp_replace(value.cast("string"), r"^\s+|\s+$", "")
    return F.when(trimmed != "", trimmed)


def whole_number(value: Column) -> Column:
    """Number text cut to a whole number, or null. Plain digits take the short way."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("decimal(38,9)").try_cast("bigint"))


def iso_date(value: Column) -> Column:
    """Epoch-day text becomes an ISO date; any other text stays as it is."""
    days = whole_number(value).try_cast("int")
    return F.when(value.rlike(NUMBER), F.date_from_unix_date(days).cast("string")).otherwise(value)


def instant(value: Column) -> Column:
    """Epoch milliseconds or strict ISO-8601 instant text as a timestamp; otherwise null."""
    return F.when(value.rlike(NUMBER), F.timestamp_millis(whole_number(value))).when(
        value.rlike(ISO_INSTANT), value.try_cast("timestamp")
    )


def iso_instant(ts: Column) -> Column:
    """A timestamp as ISO text in UTC with no, three or six fraction digits."""
    micros = F.unix_micros(ts)
    fraction = (
        F.when(F.pmod(micros, F.lit(1_000_000)) == 0, F.lit(""))
        .when(F.pmod(micros, F.lit(1_000)) == 0, F.date_format(ts, ".SSS"))
        .otherwise(F.date_format(ts, ".SSSSSS"))
    )
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def iso_millis(ts: Column) -> Column:
    """A timestamp as ISO text with exactly three fraction digits."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def instant_text(value: Column) -> Column:
    """Canonical instant text, or the raw text when it is no instant."""
    return F.coalesce(iso_instant(instant(value)), value)


def json_object(value: Column) -> Column:
    """The JSON text when it holds an object, else null."""
    return F.when(F.ltrim(value).startswith("{"), value)


def boolean_entries(value: Column) -> Column:
    """The boolean-valued entries of a JSON object held as text; anything else is dropped."""
    parsed = F.from_json(value, "map<string,variant>")
    typed = F.transform_values(parsed, lambda _, v: F.try_variant_get(v, "$", "string"))
    switches = F.map_filter(
        F.transform_values(parsed, lambda _, v: F.schema_of_variant(v) == F.lit("BOOLEAN")),
        lambda _, ok: ok,
    )
    return F.coalesce(
        F.transform_values(
            F.map_filter(typed, lambda k, _: F.map_contains_key(switches, k)),
            lambda _, v: v == F.lit("true"),
        ),
        F.create_map().cast("map<string,boolean>"),
    )


def render(value: Column, kind: str) -> Column:
    """A stored column as the document shows it."""
    if kind == "date":
        return iso_date(value)
    if kind == "instant":
        return instant_text(value)
    return value


def computed_once(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns that many later expressions and filters read.

    A plain column would be copied into each of them by the optimizer and evaluated every time; the
    output of a generator is not.
    """
    members = F.struct(*[c.alias(name) for name, c in columns.items()])
    return frame.select("*", F.inline(F.array(members)))
