"""Document assembly: row images to one nested document per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.functions.values import computed_once, instant, iso_instant, render
from docfold.operators.skew import sized, split_hot
from docfold.session import materialize
from docfold.spec import (
    DOCUMENT_LIMIT_BYTES,
    RENDER_SLACK,
    TOO_LARGE,
    Child,
    DocumentSpec,
)


def part(child: Child, image: Column) -> Column:
    """The document part made from one row image (JSON text) of a child table."""
    row = F.from_json(image, child.image)
    return _layout(child, row)


def _layout(child: Child, row: Column) -> Column:
    fields = [render(row[f.column], f.kind).alias(f.name) for f in child.fields]
    return F.struct(*fields)


def keyed_part(child: Child, image: Column) -> Column:
    """A collection element made from one row image, with its sort keys."""
    return _keyed(child, F.from_json(image, child.image))


def _keyed(child: Child, row: Column) -> Column:
    # Sorted by type text, then by row id as text.
    return F.struct(
        F.coalesce(row[child.sort_column], F.lit("")).alias("k1"),
        F.coalesce(row["id"], F.lit("")).alias("k2"),
        _layout(child, row).alias("part"),
    )


def in_order(elements: Column) -> Column:
    """Elements of ``keyed_part`` sorted, without their keys."""
    return F.transform(F.array_sort(elements), lambda e: e["part"])


def updated_at(image: Column) -> Column:
    """The update instant of any row image, or null when it does not parse."""
    return instant(F.from_json(image, "updated_at string")["updated_at"])


def document(spec: DocumentSpec, entity_id: Column, root_image: Column, latest: Column) -> Column:
    """The nested document. Parts are read from columns named like them; empty ones are kept."""
    root = F.from_json(root_image, spec.root_image)
    before, after = [], []
    for f in spec.root_fields:
        target = after if f.name == "created_at" else before
        target.append(render(root[f.column], f.kind).alias(f.name))
    parts = [F.col(c.part).alias(c.part) for c in spec.children]
    return F.struct(
        entity_id.alias("_id"),
        *before,
        *parts,
        *after,
        iso_instant(latest).alias("updated_at"),
    )


def element_bytes(spec: DocumentSpec, source: Column, image: Column) -> Column:
    """JSON bytes a row adds to its document."""
    size = F.octet_length(image)
    for child in spec.children:
        size = F.when(source == child.table, F.octet_length(F.to_json(part(child, image)))).otherwise(
            size
        )
    return size + 1


def nest(rows: DataFrame, spec: DocumentSpec, keys: list[str] | None = None) -> DataFrame:
    """Group the live rows of entities that fit in one document; those without a root give none.

    Every image is parsed once, before the grouping. ``keys`` are the entity and what else tells
    documents of one entity apart; the latter are kept.
    """
    keys = keys or ["entity_id"]
    image, source = F.col("image"), F.col("source")
    parsed = {"_root": F.when(source == spec.root, F.from_json(image, spec.root_image))}
    for child in spec.children:
        parsed[f"_{child.part}"] = F.when(source == child.table, F.from_json(image, child.image))
    ready = computed_once(rows.filter("root_lives"), parsed)
    changed = F.coalesce(*[F.col(f"{name}.updated_at") for name in parsed])
    aggregates = [
        F.max(F.when(source == spec.root, image)).alias("root_image"),
        F.max(instant(changed)).alias("latest"),
    ]
    for child in spec.children:
        if child.is_collection:
            row = F.col(f"_{child.part}")
            found = F.collect_list(F.when(row.isNotNull(), _keyed(child, row)))
            aggregates.append(found.alias(child.part))
        else:
            found = F.max(F.when(source == child.table, image))
            aggregates.append(found.alias(child.part))
    return shaped(ready.groupBy(*keys).agg(*aggregates), spec, keys[1:])


def shaped(
    grouped: DataFrame, spec: DocumentSpec, keep: list[str] | None = None
) -> DataFrame:
    """Grouped images (``entity_id, root_image, latest`` and one column per part) as documents."""
    parts = {}
    for child in spec.children:
        if child.is_collection:
            parts[child.part] = in_order(F.col(child.part))
        else:
            parts[child.part] = part(child, F.coalesce(child.part, F.lit("{}")))
    ready = grouped.withColumns(parts)
    return ready.select(
        F.col("entity_id").alias("_id"),
        F.lit(False).alias("deleted"),
        document(spec, F.col("entity_id"), F.col("root_image"), F.col("latest")).alias("document"),
        "root_image",
        *(keep or []),
    )


def measured(large: DataFrame, spec: DocumentSpec) -> DataFrame:
    """Exact JSON bytes of the entities that may not fit in one document."""
    rooted = large.filter("root_lives")
    size = element_bytes(spec, F.col("source"), F.col("image"))
    return sized(rooted.withColumn("size", size), "entity_id", "size")


def documents(
    small: DataFrame,
    large: DataFrame | None,
    spec: DocumentSpec,
    limit: int = DOCUMENT_LIMIT_BYTES,
) -> DataFrame:
    """One output per entity with a living root: a nested document, or an error (``error``).

    The frames come from ``fold.live_rows``. Entities of the second one are measured; one whose rows
    exceed ``RENDER_SLACK`` times the limit is not rendered: its output has the error and
    ``total_bytes``, and its rows stay in the long form. Whether a rendered document fits is the
    sink's to say, by the document.
    """
    none = {"error": F.lit(None).cast("string"), "total_bytes": F.lit(None).cast("bigint")}
    docs = nest(small, spec).withColumns(none)
    if large is None:
        return docs
    sizes = materialize(measured(large, spec), "sizes")
    fitting, _ = split_hot(large, sizes, "entity_id", "total_bytes", limit * RENDER_SLACK)
    docs = docs.unionByName(nest(fitting, spec).withColumns(none))
    return docs.unionByName(errors(sizes, limit), allowMissingColumns=True)


def errors(sizes: DataFrame, limit: int) -> DataFrame:
    """Outputs of entities that are too large to be rendered."""
    return sizes.filter(F.col("total_bytes") > limit * RENDER_SLACK).select(
        F.col("entity_id").alias("_id"),
        F.lit(False).alias("deleted"),
        F.lit(TOO_LARGE).alias("error"),
        "total_bytes",
    )


def with_markers(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """Documents and delete markers as one output."""
    markers = removed.select(
        F.col("entity_id").alias("_id"),
        F.lit(True).alias("deleted"),
        F.lit(None).cast(docs.schema["document"].dataType).alias("document"),
        F.lit(None).cast("string").alias("root_image"),
    )
    return docs.unionByName(markers, allowMissingColumns=True)


def document_json(spec: DocumentSpec) -> Column:
    """JSON text of an output row (``_id, deleted, document, root_image``); null without either.

    Root fields keep an explicit null and their JSON type, and are left out when the row never had
    them; dates and instants of the root are always there. Inside the parts nulls are left out.
    """
    doc, present = F.col("document"), F.json_object_keys("root_image")
    root = F.try_parse_json("root_image")

    def member(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    def scalar(name: str) -> Column:
        inner = F.to_json(F.array(doc[name]), {"ignoreNullFields": "false"})
        return F.substr(inner, F.lit(2), F.length(inner) - 2)

    def raw_channels(value: Column) -> Column:
        quoted = F.to_json(F.array(value))
        shown = F.when(F.try_parse_json(value).isNotNull(), value).otherwise(
            F.substr(quoted, F.lit(2), F.length(quoted) - 2)
        )
        return F.when(value.isNotNull(), shown)

    members = [member("_id", scalar("_id"))]
    tail = []
    for f in spec.root_fields:
        shown = member(f.name, scalar(f.name))
        if f.kind == "plain":
            own = F.to_json(F.try_variant_get(root, f"$['{f.column}']", "variant"))
            shown = member(f.name, F.coalesce(own, F.lit("null")))
            shown = F.when(F.array_contains(present, f.column), shown)
        (tail if f.name == "created_at" else members).append(shown)
    for child in spec.children:
        value = doc[child.part]
        if child.part == "preferences":
            channels = value["notificationChannels"]
            switches = F.to_json(value.dropFields("notificationChannels"))
            inside = F.substr(switches, F.lit(2), F.length(switches) - 2)
            pieces = F.concat_ws(
                ",",
                F.when(inside != "", inside),
                member("notificationChannels", raw_channels(channels)),
            )
            members.append(member(child.part, F.concat(F.lit("{"), pieces, F.lit("}"))))
        else:
            members.append(member(child.part, F.to_json(value)))
    latest = F.when(doc["updated_at"].isNotNull(), member("updated_at", scalar("updated_at")))
    full = F.concat(F.lit("{"), F.concat_ws(",", *members, *tail, latest), F.lit("}"))
    marker = F.to_json(F.struct("_id", F.lit(True).alias("deleted")))
    return F.when(F.col("deleted"), marker).otherwise(full)
