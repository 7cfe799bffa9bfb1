"""Source against replica: counts, fields, lag, and what to repair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.functions.values import iso_instant, json_object
from docfold.operators.metrics import ranked_summary
from docfold.spec import Child, DocumentSpec, Field


def count_parity(source: DataFrame, replica: DataFrame) -> DataFrame:
    """One row: both counts, their difference and whether they agree."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = source.select(one.alias("s"), none.alias("r")).unionByName(
        replica.select(none.alias("s"), one.alias("r"))
    )
    counts = both.agg(
        F.coalesce(F.sum("s"), none).alias("source_count"),
        F.coalesce(F.sum("r"), none).alias("replica_count"),
    )
    return counts.withColumn("delta", F.col("source_count") - F.col("replica_count")).withColumn(
        "in_parity", F.col("delta") == 0
    )


def canonical_tables(docs: DataFrame, spec: DocumentSpec) -> DataFrame:
    """Every field of ``relational.relational_documents`` as text, one row per root."""
    return _canonical(docs, spec, lambda f: F.col(f.column))


def canonical_store(outputs: DataFrame, spec: DocumentSpec) -> DataFrame:
    """Every field of stored documents as text; delete markers and errors are none."""
    docs = outputs.filter("not deleted and document is not null").select("document.*")
    return _canonical(docs, spec, lambda f: F.col(f.name))


def _canonical(
    docs: DataFrame, spec: DocumentSpec, root_column: Callable[[Field], Column]
) -> DataFrame:
    """Root id, then root fields, ``part_field`` of singletons, and collections in one order.

    ``updated_at`` is left out: the tables have the root's own, a document the newest of all rows.
    """
    kinds = {f.name: f.dataType for f in docs.schema}
    fields = [
        _text(root_column(f), docs.select(root_column(f)).schema[0].dataType).alias(f.name)
        for f in spec.root_fields
        if f.column != spec.root_key
    ]
    for child in spec.singletons:
        inner = kinds[child.part]
        fields += [
            _text(F.col(child.part)[f.name], inner[f.name].dataType).alias(f"{child.part}_{f.name}")
            for f in child.fields
        ]
    for child in spec.collections:
        elements = F.array_sort(F.transform(child.part, _element(child, kinds[child.part])))
        fields.append(F.array_join(elements, ",").alias(child.part))
    return docs.select(F.col(spec.root_key).cast("bigint").alias(spec.root_key), *fields)


def _element(child: Child, kind: T.ArrayType) -> Callable[[Column], Column]:
    inner = kind.elementType

    def shown(e: Column) -> Column:
        texts = [_text(e[f.name], inner[f.name].dataType).alias(f.name) for f in child.fields]
        return F.to_json(F.struct(*texts))

    return shown


def _text(value: Column, kind: T.DataType) -> Column:
    """One text for a value, whichever side it comes from: instants in milliseconds, JSON in one form."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return iso_instant(F.timestamp_millis(F.unix_millis(value.cast("timestamp"))))
    if isinstance(kind, T.StringType):
        as_json = F.to_json(F.try_parse_json(json_object(value)))
        return F.coalesce(as_json, value)
    return value.cast("string")


def field_diff(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """One row per difference: ``missing``, ``extra`` or ``unlike`` with the field name.

    Both frames must have the same canonical columns; compare values, not JSON text.
    """
    fields = [c for c in expected.columns if c != key]
    left = expected.select(F.col(key), F.struct(*fields).alias("e"))
    right = actual.select(F.col(key), F.struct(*fields).alias("a"))
    joined = left.join(right, key, "full_outer")
    unlike = F.array_compact(
        F.array(
            *[F.when(~F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}")), F.lit(c)) for c in fields]
        )
    )
    kinds = (
        F.when(F.col("a").isNull(), F.array(F.lit("missing")))
        .when(F.col("e").isNull(), F.array(F.lit("extra")))
        .otherwise(F.transform(unlike, lambda c: F.concat(F.lit("unlike:"), c)))
    )
    return joined.select(key, F.explode(kinds).alias("difference"))


def stale(
    differences: DataFrame,
    source: DataFrame,
    replica: DataFrame,
    key: str,
    changed: str,
    as_of: Column,
    lag_seconds: int,
) -> DataFrame:
    """Differences older than the allowed lag, with their age.

    The age is that of the source row, or of the replica's document where the source has none.
    ``changed`` names the time in both frames; a difference without a time stays, with no age.
    """
    found = differences.join(source.select(key, F.col(changed).alias("_s")), key, "left")
    found = found.join(replica.select(key, F.col(changed).alias("_r")), key, "left")
    age = F.unix_seconds(as_of) - F.unix_seconds(F.coalesce("_s", "_r"))
    aged = found.withColumn("age_seconds", age).drop("_s", "_r")
    return aged.filter(F.col("age_seconds").isNull() | (F.col("age_seconds") > lag_seconds))


def sample(frame: DataFrame, key: str, one_in: int) -> DataFrame:
    """A repeatable sample by key number, for a cheap parity check."""
    return frame.filter(F.pmod(F.col(key).cast("bigint"), F.lit(one_in)) == 0)


def repair_list(differences: DataFrame, key: str) -> DataFrame:
    """Ids whose document is missing, unlike or extra, each once."""
    return differences.select(key).distinct()


def repair_outputs(outputs: DataFrame, repairs: DataFrame, key: str = "_id") -> DataFrame:
    """The next batch of the sink: the fold's outputs for the ids to repair, markers for extra ones.

    An id the fold has no output for does not exist in the source, so its document has to go.
    """
    wanted = repairs.select(F.col(repairs.columns[0]).cast("string").alias(key))
    extra = wanted.join(outputs.select(key), key, "left_anti").select(
        key, F.lit(True).alias("deleted")
    )
    found = outputs.join(wanted, key, "left_semi")
    return found.unionByName(extra, allowMissingColumns=True)


def lag(source: DataFrame, replica: DataFrame, key: str) -> DataFrame:
    """Milliseconds from the source commit (``committed_at``) to the replica (``stored_at``)."""
    return source.join(replica, key).select(
        key, (F.unix_millis("stored_at") - F.unix_millis("committed_at")).alias("lag_millis")
    )


def sink_lag(content: DataFrame) -> DataFrame:
    """The lag of every id in a sink, by the times its files hold; ids without a source time are left out."""
    millis = F.unix_millis("stored_at") - F.unix_millis("committed_at")
    return content.filter("committed_at is not null").select("_id", millis.alias("lag_millis"))


def lag_summary(lags: DataFrame) -> DataFrame:
    """One row: count, median, 95th and 99th percentile (exact ranks) and maximum of the lag."""
    quantiles = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return ranked_summary(lags, "lag_millis", quantiles).select(
        "n", *quantiles, F.col("largest").alias("longest")
    )
