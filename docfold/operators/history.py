"""Document history: the document of an entity after each of its bundles.

A row version becomes visible at its bundle's position, not at its own, so that no point of the history shows half a
transaction; it ends where a newer event of its row, or of its root's deletion, becomes visible. Newer is by
``seq``, so an event that became complete late never replaces a newer one. Positions of bundles are numbered densely per
entity, and a version's interval is a range of numbers: it is written out per number, and the rows of one
number are one document. Nothing compares versions with bundles pairwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.operators import documents, fold
from docfold.operators.numbering import dense_number
from docfold.operators.skew import attach, split_hot
from docfold.session import materialize
from docfold.spec import DOCUMENT_LIMIT_BYTES, RENDER_SLACK, TOO_LARGE, DocumentSpec

# Points a version's range is written out for at a time; longer ranges are cut first.
SLICE_POINTS = 4_096


def versions(events: DataFrame, spec: DocumentSpec, ranges: int | None = None) -> DataFrame:
    """Row images with the positions ``[valid_from, valid_to)`` at which their entity shows them."""
    keys = ["entity_id", "source", "row_id"]
    acts = events.filter("action <> 'none'")
    placed = events.groupBy("bundle_id", "entity_id").agg(F.max("seq").alias("place"))
    acts = acts.join(placed, ["bundle_id", "entity_id"])
    order = ["seq", "source", "row_id"]
    acts = acts.select(*keys, "seq", "place", "action", "image")
    acts = fold.in_ranges(acts, order, "placed", ranges)
    removed = (F.col("source") == spec.root) & (F.col("action") == "remove")
    root_end = F.when(removed, F.col("place"))
    ended = fold.running(acts, ["entity_id"], order, root_end, "root_end", back=True)
    hidden = fold.running(ended, keys, order, F.col("place"), "hidden_at", back=True)
    shown = hidden.filter("action = 'put'").withColumn("valid_to", F.least("hidden_at", "root_end"))
    return shown.filter("valid_to is null or valid_to > place").select(
        *keys, F.col("place").alias("valid_from"), "valid_to", "image"
    )


def _ranges(found: DataFrame, points: DataFrame) -> DataFrame:
    """Add ``first`` and ``stop``: the numbers of a version's points, without the last."""
    starts = points.select("entity_id", F.col("bundle_seq").alias("valid_from"), F.col("point").alias("first"))
    stops = points.select("entity_id", F.col("bundle_seq").alias("valid_to"), F.col("point").alias("stop"))
    ranged = found.join(starts, ["entity_id", "valid_from"]).join(stops, ["entity_id", "valid_to"], "left")
    sizes = points.groupBy("entity_id").agg(F.max("point").alias("last"))
    weights = found.groupBy("entity_id").agg(F.count("*").alias("n_versions"))
    facts = materialize(sizes.join(weights, "entity_id"), "history-entities")
    ranged = attach(ranged, facts, "entity_id", "n_versions", ["row_id", "valid_from"])
    ranged = ranged.withColumn("stop", F.coalesce("stop", F.col("last") + 1))
    return ranged.drop("last", "n_versions", "valid_from", "valid_to")


def _per_point(ranged: DataFrame, slice_points: int) -> DataFrame:
    """A row per version and point."""
    first, last = F.col("first"), F.col("stop") - 1
    numbers = F.sequence(F.floor(first / slice_points), F.floor(last / slice_points))
    cut = ranged.withColumn("slice", F.explode(numbers))
    # Slices of one long range go to many tasks before they are written out.
    cut = cut.repartition("entity_id", "slice")
    start = F.greatest(first, F.col("slice") * slice_points)
    end = F.least(last, (F.col("slice") + 1) * slice_points - 1)
    return cut.withColumn("point", F.explode(F.sequence(start, end))).drop("slice", "first", "stop")


def document_history(
    events: DataFrame,
    spec: DocumentSpec,
    limit: int = DOCUMENT_LIMIT_BYTES,
    ranges: int | None = None,
    slice_points: int = SLICE_POINTS,
) -> DataFrame:
    """One output per bundle that makes the fold emit something, in the layout of final outputs.

    Adds ``bundle_id`` and ``bundle_seq``. Bundles of one entity with one position show the same state, that after
    all of them. ``events`` are the committed bundle events. A point whose rows exceed
    ``RENDER_SLACK`` times the limit has an error instead of a document.
    """
    log = materialize(fold.document_log(events, spec, ranges).filter("bundle_seq is not null"), "emissions")
    places = log.select("entity_id", "bundle_seq").distinct()
    order = [F.col("entity_id"), F.col("bundle_seq")]
    points = materialize(dense_number(places, order, "point"), "points")
    found = materialize(versions(events, spec, ranges), "versions")
    ranged = materialize(_ranges(found, points), "ranges")
    emitted = log.filter("emits <> 'nothing'").join(points, ["entity_id", "bundle_seq"])
    wanted = materialize(emitted.filter("emits = 'document'").select("point").distinct(), "wanted")

    # What all versions of an entity take together bounds each of its documents.
    size = F.octet_length("image") + fold.ROW_OVERHEAD_BYTES
    sizes = ranged.groupBy("entity_id").agg(F.sum(size).alias("bytes"))
    sizes = materialize(sizes, "history-sizes")
    small, large = split_hot(ranged, sizes, "entity_id", "bytes", limit)
    rows = lambda frame: (
        _per_point(frame.drop("bytes"), slice_points)
        .join(wanted, "point", "left_semi")
        .withColumn("root_lives", F.lit(True))
    )
    keys = ["entity_id", "point"]
    none = {"error": F.lit(None).cast("string"), "total_bytes": F.lit(None).cast("bigint")}
    docs = documents.nest(rows(small), spec, keys).withColumns(none)
    if large is not None:
        shown = rows(large)
        element = documents.element_bytes(spec, F.col("source"), F.col("image"))
        measured = shown.groupBy("point").agg(F.sum(element).alias("total_bytes"))
        measured = materialize(measured, "history-measured")
        fits = F.col("total_bytes") <= limit * RENDER_SLACK
        fitting = shown.join(measured.filter(fits).select("point"), "point", "left_semi")
        docs = docs.unionByName(documents.nest(fitting, spec, keys).withColumns(none))
        errors = measured.filter(~fits).select("point", F.lit(TOO_LARGE).alias("error"), "total_bytes")
        docs = docs.unionByName(errors, allowMissingColumns=True)
    docs = docs.drop("_id", "deleted")
    joined = emitted.select("bundle_id", "bundle_seq", "entity_id", "emits", "point").join(
        docs, "point", "left"
    )
    return joined.select(
        "bundle_id",
        "bundle_seq",
        F.col("entity_id").alias("_id"),
        (F.col("emits") == "marker").alias("deleted"),
        *[F.when(F.col("emits") == "document", F.col(c)).alias(c) for c in docs.columns if c != "point"],
    )
