"""The same documents straight from the base tables, and paged reads of them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.operators.numbering import dense_number
from docfold.operators.skew import MAX_HOT_KEYS, sized
from docfold.session import materialize
from docfold.spec import DOCUMENT_LIMIT_BYTES, RENDER_SLACK, TOO_LARGE, Child, DocumentSpec

PAGE_SIZE = 10
# The collections of one root are gathered in one row up to this size.
GATHER_BYTES = DOCUMENT_LIMIT_BYTES * RENDER_SLACK
# What an element is counted with beside its texts.
ELEMENT_BYTES = 128
CHUNK_BYTES = 1024 * 1024
# Up to here a page is a top-k; further on the rows are numbered, so the driver never holds them.
TOP_ROWS = 10_000


def _element(child: Child, spec: DocumentSpec) -> Column:
    """A collection element with its sort keys: type, then row id as a number."""
    return F.struct(
        F.col(child.sort_column).alias("k1"),
        F.col(spec.row_key).alias("k2"),
        _renamed(child).alias("part"),
    )


def _renamed(child: Child) -> Column:
    return F.struct(*[F.col(f.column).alias(f.name) for f in child.fields])


def _n_bytes(child: Child, table: DataFrame) -> Column:
    """What gathering an element takes: its texts, and a fixed part for all the rest."""
    size = F.lit(ELEMENT_BYTES).cast("bigint")
    for f in child.fields:
        kind = table.schema[f.column].dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size += F.coalesce(F.octet_length(f.column), F.lit(0))
        elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            size += F.coalesce(F.octet_length(F.to_json(F.struct(f.column))), F.lit(0))
    return size


def elements(tables: dict[str, DataFrame], spec: DocumentSpec) -> DataFrame:
    """The rows of all collections in one frame, one column per collection, and their ``n_bytes``."""
    frames = []
    for child in spec.collections:
        table = tables[child.table]
        frames.append(
            table.select(
                F.col(spec.owner_key),
                F.col(spec.row_key).alias("row_id"),
                _n_bytes(child, table).alias("n_bytes"),
                _element(child, spec).alias(child.part),
            )
        )
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)
    return union


def _split_large(
    rows: DataFrame, spec: DocumentSpec, limit: int
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Elements of owners within the limit; those of the others, and these owners, if there are any.

    Owners are measured first, with partial sums before the shuffle, so nothing is gathered that has not been
    measured. Only a list of at most ``MAX_HOT_KEYS`` large owners is broadcast.
    """
    key = spec.owner_key
    large = sized(rows, key, "n_bytes").filter(F.col("total_bytes") > limit)
    listed = large.limit(MAX_HOT_KEYS + 1).collect()
    if not listed:
        return rows, None, None
    if len(listed) > MAX_HOT_KEYS:
        large = materialize(large, "large-owners")
        keys = large.select(key)
    else:
        large = rows.sparkSession.createDataFrame(listed, large.schema)
        keys = F.broadcast(large.select(key))
    return rows.join(keys, key, "left_anti"), rows.join(keys, key, "left_semi"), large


def relational_documents(
    tables: dict[str, DataFrame], spec: DocumentSpec, limit: int = GATHER_BYTES
) -> DataFrame:
    """One row per root row with its singletons as structs and its collections as ordered arrays.

    Collections are grouped before the join, both in one shuffle. A part without rows is there and
    empty. Every root is there. One whose collections take more than ``limit`` bytes has null for them, an ``error``
    and ``total_bytes``; ``collection_chunks`` has these collections whole. Children without an owner are
    left out. Whether a document fits in the store is for ``oversized_roots`` to say.
    """
    parts = [c.part for c in spec.collections]
    rows = elements(tables, spec).filter(F.col(spec.owner_key).isNotNull())
    light, _, large = _split_large(rows, spec, limit)
    grouped = light.groupBy(spec.owner_key).agg(*[F.collect_list(p).alias(p) for p in parts])
    ordered = grouped.select(
        spec.owner_key,
        *[
            F.transform(F.array_sort(p), lambda e: e["part"]).alias(p)
            for p in parts
        ],
    )
    docs = tables[spec.root]
    for child in spec.singletons:
        single = tables[child.table].select(spec.owner_key, _renamed(child).alias(child.part))
        kind = single.schema[child.part].dataType
        docs = docs.join(single, docs[spec.root_key] == single[spec.owner_key], "left").drop(
            spec.owner_key
        )
        nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind])
        docs = docs.withColumn(child.part, F.coalesce(child.part, nothing))
    docs = docs.join(ordered, docs[spec.root_key] == ordered[spec.owner_key], "left").drop(
        spec.owner_key
    )
    if large is None:
        docs = docs.withColumn("total_bytes", F.lit(None).cast("bigint"))
    else:
        sizes = large.select(F.col(spec.owner_key).alias("_owner"), "total_bytes")
        docs = docs.join(sizes, docs[spec.root_key] == sizes["_owner"], "left").drop("_owner")
    fits = F.col("total_bytes").isNull()
    for child in spec.collections:
        docs = docs.withColumn(child.part, F.when(fits, F.coalesce(child.part, F.array())))
    return docs.withColumn("error", F.when(~fits, F.lit(TOO_LARGE)))


def collection_chunks(
    tables: dict[str, DataFrame],
    spec: DocumentSpec,
    limit: int = GATHER_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The collections of roots above ``limit`` bytes, in order, as chunks of about ``chunk_bytes``.

    Columns: the owner, ``part``, ``chunk`` (from 0), ``first_place`` (how many elements come before it), ``n_rows``
    and one array per collection, of which that of ``part`` is filled. The arrays of a collection, chunk after chunk,
    are what ``relational_documents`` would have gathered. A chunk passes ``chunk_bytes`` by less than one element.

    Rows are ranged by owner and place in the collection, so an owner with most of all rows takes many tasks.
    """
    parts = [c.part for c in spec.collections]
    owner = spec.owner_key
    rows = elements(tables, spec).filter(F.col(owner).isNotNull())
    _, kept, large = _split_large(rows, spec, limit)
    spark, total = rows.sparkSession, 0
    if large is not None:
        total = large.agg(F.sum("total_bytes")).first()[0]
    else:
        kept = rows.limit(0)
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / GATHER_BYTES))
    named = F.coalesce(*[F.when(F.col(p).isNotNull(), F.lit(p)) for p in parts])
    keyed = kept.withColumns(
        {
            "part": named,
            "_k1": F.coalesce(*[F.col(p)["k1"] for p in parts]),
            "_k2": F.coalesce(*[F.col(p)["k2"] for p in parts]),
        }
    )
    order = [owner, "part", "_k1", "_k2"]
    ranged = keyed.repartitionByRange(n_ranges, *order).withColumn("_p", F.spark_partition_id())
    ranged = materialize(ranged, "ranged-elements")
    inside = W.partitionBy("_p", owner, "part")
    before = inside.orderBy("_k1", "_k2").rowsBetween(W.unboundedPreceding, -1)
    bytes_before = F.coalesce(F.sum("n_bytes").over(before), F.lit(0))
    cut = ranged.withColumn("_cut", F.floor(bytes_before / chunk_bytes))
    chunks = cut.groupBy("_p", owner, "part", "_cut").agg(
        F.count("*").alias("n_rows"),
        *[F.transform(F.array_sort(F.collect_list(p)), lambda e: e["part"]).alias(p) for p in parts],
    )
    chunks = materialize(chunks, "chunks")
    # One row per range of a collection: what the ranges before it hold.
    ranges = chunks.groupBy("_p", owner, "part").agg(
        F.count("*").alias("_chunks"), F.sum("n_rows").alias("_rows")
    )
    earlier = W.partitionBy(owner, "part").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.select(
        "_p",
        owner,
        "part",
        F.coalesce(F.sum("_chunks").over(earlier), F.lit(0)).alias("_chunk0"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_row0"),
    )
    by_cut = inside.orderBy("_cut")
    rows_before = F.sum("n_rows").over(by_cut.rowsBetween(W.unboundedPreceding, -1))
    return (
        chunks.withColumn("_i", F.row_number().over(by_cut) - 1)
        .withColumn("_rows_before", F.coalesce(rows_before, F.lit(0)))
        .join(offsets, ["_p", owner, "part"])
        .select(
            owner,
            "part",
            (F.col("_chunk0") + F.col("_i")).alias("chunk"),
            (F.col("_row0") + F.col("_rows_before")).alias("first_place"),
            "n_rows",
            *parts,
        )
    )


def oversized_roots(
    tables: dict[str, DataFrame], spec: DocumentSpec, limit: int = DOCUMENT_LIMIT_BYTES
) -> DataFrame:
    """Roots whose collections alone exceed one document of the store."""
    shown = [F.octet_length(F.to_json(f"{c.part}.part")) for c in spec.collections]
    rows = elements(tables, spec).withColumn("size", F.coalesce(*shown) + 1)
    return sized(rows, spec.owner_key, "size").filter(F.col("total_bytes") > limit)


def page_number(value: object) -> int:
    """A page number from request text: the leading integer, at least 1, else 1."""
    digits = ""
    for char in str(value or "").strip():
        if not (char.isdigit() or (char in "+-" and not digits)):
            break
        digits += char
    return max(1, int(digits)) if digits.strip("+-") else 1


def page(frame: DataFrame, order: list[str], number: object, size: int = PAGE_SIZE) -> DataFrame:
    """One page, newest first by the order columns."""
    skipped = (page_number(number) - 1) * size
    newest = [F.col(c).desc() for c in order]
    if skipped + size <= TOP_ROWS:
        return frame.orderBy(*newest).offset(skipped).limit(size)
    places = dense_number(frame, newest, "_place")
    return places.filter(F.col("_place").between(skipped, skipped + size - 1)).drop("_place")


def page_info(frame: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """One row: how many rows and how many pages, at least one page."""
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / size)).cast("bigint")
    return frame.agg(F.count("*").alias("total")).withColumn("total_pages", pages)


def source_page(
    tables: dict[str, DataFrame], spec: DocumentSpec, number: object, size: int = PAGE_SIZE
) -> DataFrame:
    """A page of documents from the base tables, ordered by the root's own update time.

    The page is picked on the two sort columns, and only its documents are assembled.
    """
    root = tables[spec.root]
    keys = page(root.select(spec.root_key, "updated_at"), ["updated_at", spec.root_key], number, size)
    return documents_of(tables, spec, keys.select(spec.root_key))


def documents_of(
    tables: dict[str, DataFrame], spec: DocumentSpec, keys: DataFrame
) -> DataFrame:
    """Documents of the given root ids only (a point lookup or one page)."""
    wanted = keys.select(F.col(spec.root_key).alias("_want"))
    some = {}
    for name, frame in tables.items():
        column = spec.root_key if name == spec.root else spec.owner_key
        some[name] = frame.join(wanted, frame[column] == wanted["_want"], "left_semi")
    return relational_documents(some, spec)
