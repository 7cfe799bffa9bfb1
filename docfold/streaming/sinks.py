"""Replace-by-id sink on plain files, with a dead-letter table beside it.

``log`` holds one folder per outcome, micro-batch and bucket of ids, written in overwrite mode, so a replayed batch
leaves the sink unchanged. ``compact`` writes the newest output per id as a base in the same buckets, with an index of
its documents in page order, and publishes both in ``manifest``; it runs beside the query, because it leaves
the newest batch, the only one that can be replayed, to the log. Readers take the newest output per id
of the published base and the batches after it, so that their cost depends on the content and on
what came since, not on how many batches there have been. ``expire`` removes what nobody reads any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.operators.documents import document_json, nest
from docfold.operators.relational import PAGE_SIZE, page_number
from docfold.session import materialize
from docfold.spec import CUSTOMER_SPEC, DOCUMENT_LIMIT_BYTES, TOO_LARGE, DocumentSpec

#: Fixed for the life of a sink: ids are dealt into this many buckets.
BUCKETS = 32
MANIFEST = "generation bigint, folder string, through bigint"


def bucket_of(id_: Column) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(BUCKETS)).cast("int")


def judged(outputs: DataFrame, spec: DocumentSpec, limit: int = DOCUMENT_LIMIT_BYTES) -> DataFrame:
    """Add ``error``, ``json_bytes`` and ``outcome``: ``stored``, or ``dead`` for rejected outputs."""
    for name, kind in (("error", "string"), ("version", "bigint"), ("committed_at", "timestamp")):
        if name not in outputs.columns:
            outputs = outputs.withColumn(name, F.lit(None).cast(kind))
    measured = outputs.withColumn("json_bytes", F.octet_length(document_json(spec)))
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.coalesce(F.trim("_id"), F.lit("")) == "", "document has no id")
        .when(F.col("json_bytes") > limit, TOO_LARGE)
    )
    return measured.withColumn("error", error).withColumn(
        "outcome", F.when(F.col("error").isNull(), "stored").otherwise("dead")
    )


def newest_per_id(outputs: DataFrame, *order: str) -> DataFrame:
    """The newest output of every id."""
    rest = [c for c in outputs.columns if c != "_id"]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return outputs.groupBy("_id").agg(newest.alias("w")).select(
        "_id", *[F.col("w")[c].alias(c) for c in rest]
    )


def upsert_batch(
    path: str,
    spec: DocumentSpec,
    limit: int = DOCUMENT_LIMIT_BYTES,
    clock: Column | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: one write per batch, good and rejected outputs together.

    A batch makes one file per outcome and bucket, ordered by id. ``stored_at`` is the time of the write, or ``clock``.
    """

    def write(outputs: DataFrame, batch_id: int) -> None:
        (
            judged(outputs, spec, limit)
            .withColumns(
                {
                    "stored_at": F.current_timestamp() if clock is None else clock,
                    "batch_id": F.lit(batch_id).cast("bigint"),
                    "bucket": bucket_of(F.col("_id")),
                }
            )
            .repartition("outcome", "bucket")
            .sortWithinPartitions("outcome", "bucket", "_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("outcome", "batch_id", "bucket")
            .parquet(f"{path}/log")
        )

    return write


def schema(spark: SparkSession, spec: DocumentSpec = CUSTOMER_SPEC) -> T.StructType:
    """Columns of the sink's files, with the two its folders are named by."""
    rows = "entity_id string, source string, row_id string, image string, root_lives boolean"
    docs = nest(spark.createDataFrame([], rows), spec).schema
    more = (
        "error string, version bigint, committed_at timestamp, total_bytes bigint, json_bytes int,"
        " stored_at timestamp, outcome string, batch_id bigint, bucket int"
    )
    return T.StructType([*docs, *T.StructType.fromDDL(more)])


def read_folder(spark: SparkSession, folder: str, columns: T.StructType) -> DataFrame:
    """A folder's rows; one that is not there yet is empty."""
    try:
        return spark.read.schema(columns).parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], columns)


def published(spark: SparkSession, path: str) -> tuple[str | None, int]:
    """Folder of the newest base, and the last batch it holds; without one all batches count."""
    rows = read_folder(spark, f"{path}/manifest", T.StructType.fromDDL(MANIFEST))
    newest = rows.agg(F.max(F.struct("generation", "folder", "through")).alias("m")).first()["m"]
    return (newest["folder"], newest["through"]) if newest else (None, -(1 << 62))


def _layers(spark: SparkSession, path: str, spec: DocumentSpec) -> tuple[DataFrame, DataFrame]:
    """The stored rows of the published base, and those of the batches after it."""
    columns = schema(spark, spec)
    folder, through = published(spark, path)
    log = read_folder(spark, f"{path}/log", columns).filter("outcome = 'stored'")
    base = spark.createDataFrame([], columns)
    if folder:
        base = read_folder(spark, f"{folder}/base", columns)
    return base, log.filter(F.col("batch_id") > through)


def _newest(layers: tuple[DataFrame, DataFrame], chosen: Column | None = None) -> DataFrame:
    both = [layer if chosen is None else layer.filter(chosen) for layer in layers]
    return newest_per_id(both[0].unionByName(both[1]), "batch_id", "version")


def replica(spark: SparkSession, path: str, spec: DocumentSpec = CUSTOMER_SPEC) -> DataFrame:
    """Current content of the sink: the newest stored output per id, delete markers included."""
    return _newest(_layers(spark, path, spec))


def lookup(
    spark: SparkSession, path: str, ids: list[str], spec: DocumentSpec = CUSTOMER_SPEC
) -> DataFrame:
    """Current content of a few ids; only the folders of their buckets are read."""
    found = spark.createDataFrame([(i,) for i in ids], "id string").select(bucket_of(F.col("id")))
    buckets = sorted({r[0] for r in found.collect()})
    chosen = F.col("bucket").isin(*buckets) & F.col("_id").isin(*ids)
    return _newest(_layers(spark, path, spec), chosen)


def dead_letters(spark: SparkSession, path: str, spec: DocumentSpec = CUSTOMER_SPEC) -> DataFrame:
    """Rejected outputs with their error and batch."""
    rows = read_folder(spark, f"{path}/log", schema(spark, spec))
    return rows.filter("outcome = 'dead'").drop("outcome", "bucket")


def _page_keys(outputs: DataFrame) -> DataFrame:
    live = outputs.filter("not deleted")
    return live.select("_id", F.col("document.updated_at").alias("updated_at"), F.col("document.id").alias("id"))


def compact(
    spark: SparkSession,
    path: str,
    spec: DocumentSpec = CUSTOMER_SPEC,
    through: int | None = None,
) -> bool:
    """Write and publish a base of all batches up to ``through``; by default all but the newest.

    Batches up to there must be complete, as all but the newest are. Returns whether there was anything to do.
    One compaction of a sink runs at a time.
    """
    folder, before = published(spark, path)
    log = read_folder(spark, f"{path}/log", schema(spark, spec))
    if through is None:
        newest = log.agg(F.max("batch_id")).first()[0]
        through = before if newest is None else newest - 1
    if through <= before:
        return False
    base, fresh = _layers(spark, path, spec)
    target = f"{path}/generations/{uuid.uuid4().hex}"
    content = _newest((base, fresh.filter(F.col("batch_id") <= through)))
    (
        content.repartition("bucket")
        .sortWithinPartitions("bucket", "_id")
        .write.partitionBy("bucket")
        .parquet(f"{target}/base")
    )
    # The keys of all documents in page order: range 0 holds the newest.
    written = read_folder(spark, f"{target}/base", schema(spark, spec))
    order = [F.desc("updated_at"), F.desc("id")]
    keys = _page_keys(written).repartitionByRange(*order).sortWithinPartitions(*order)
    keys = keys.withColumn("range", F.spark_partition_id())
    keys.write.partitionBy("range").parquet(f"{target}/index")
    generations = read_folder(spark, f"{path}/manifest", T.StructType.fromDDL(MANIFEST))
    number = (generations.agg(F.max("generation")).first()[0] or 0) + 1
    row = spark.createDataFrame([(number, target, through)], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return True


def page(
    spark: SparkSession,
    path: str,
    number: object,
    size: int = PAGE_SIZE,
    spec: DocumentSpec = CUSTOMER_SPEC,
) -> DataFrame:
    """One page of documents, newest first by their update time and id.

    The keys come from the index: only its first ranges, enough for the page and for every id that a later batch may
    have taken out of them. Then the page's own documents are looked up.
    """
    skipped = (page_number(number) - 1) * size
    folder, _ = published(spark, path)
    _, log = _layers(spark, path, spec)
    fresh = materialize(newest_per_id(log, "batch_id", "version"), "page-fresh")
    keys = _page_keys(fresh)
    if folder:
        index = read_folder(spark, f"{folder}/index", T.StructType([*keys.schema, T.StructField("range", T.IntegerType())]))
        needed = skipped + size + fresh.count()
        sizes = index.groupBy("range").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1))
        read = sizes.withColumn("before", F.coalesce(upto, F.lit(0))).filter(F.col("before") < needed)
        last = read.agg(F.max("range")).first()[0]
        kept = index.filter(F.col("range") <= F.lit(-1 if last is None else last)).drop("range")
        keys = keys.unionByName(kept.join(fresh.select("_id"), "_id", "left_anti"))
    order = [F.desc("updated_at"), F.desc("id")]
    ids = [r["_id"] for r in keys.orderBy(*order).offset(skipped).limit(size).collect()]
    found = lookup(spark, path, ids, spec) if ids else replica(spark, path, spec).limit(0)
    return found.orderBy(F.desc("document.updated_at"), F.desc("document.id"))


def expire(spark: SparkSession, path: str, spec: DocumentSpec = CUSTOMER_SPEC) -> int:
    """Remove stored batches and bases that the published base replaces; dead letters stay.

    Call it when no reader is left that began before the last ``compact``. Returns the number of folders.
    """
    folder, through = published(spark, path)
    if not folder:
        return 0
    rows = read_folder(spark, f"{path}/log", schema(spark, spec)).filter("outcome = 'stored'")
    old = rows.filter(F.col("batch_id") <= through).select("batch_id").distinct()
    gone = [f"{path}/log/outcome=stored/batch_id={r[0]}" for r in old.collect()]
    known = read_folder(spark, f"{path}/manifest", T.StructType.fromDDL(MANIFEST)).select("folder").distinct()
    gone += [r[0] for r in known.collect() if r[0] != folder]
    return remove(spark, gone)


def remove(spark: SparkSession, folders: list[str]) -> int:
    """Delete folders; returns how many were there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    for name in folders:
        target = jvm.org.apache.hadoop.fs.Path(name)
        removed += bool(target.getFileSystem(conf).delete(target, True))
    return removed
