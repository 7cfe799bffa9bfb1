"""The sink: buckets, published bases, replays beside a compaction, pages and times."""

import random
import re

import pytest
from conftest import Log
from pyspark.sql import functions as F

from docfold.operators import engine
from docfold.session import work_folder
from docfold.sources.changelog import BRONZE, read_log
from docfold.spec import CUSTOMER_SPEC as SPEC
from docfold.streaming import pipeline, sinks


def outputs(spark, ids, millis, deleted=()):
    """Documents with the given update time, and markers."""
    log = Log()
    for i in ids:
        log.root(i, "r", updated_at=millis + (i * 7919) % 50 * 1000)
    found = engine.final_outputs(log.frame(spark), SPEC)
    gone = F.col("_id").isin(*[str(i) for i in deleted])
    for c in ("document", "root_image"):
        found = found.withColumn(c, F.when(~gone, F.col(c)))
    return found.withColumn("deleted", gone).withColumn("version", F.lit(millis).cast("bigint"))


def store(spark, sink, batch, ids, millis, deleted=()):
    sinks.upsert_batch(sink, SPEC)(outputs(spark, ids, millis, deleted), batch)


def shown(frame):
    return [(r["_id"], r["deleted"], r["document"] and r["document"]["updated_at"]) for r in frame.collect()]


@pytest.fixture(scope="module")
def sink(spark):
    """Four batches, the first two compacted while the third was the newest, one more since."""
    path = work_folder(spark, "test-sink")
    store(spark, path, 0, range(60), 0)
    store(spark, path, 1, range(0, 60, 3), 3_600_000, deleted=range(0, 60, 9))
    store(spark, path, 2, range(0, 60, 5), 7_200_000, deleted=range(0, 60, 25))
    assert sinks.compact(spark, path)
    store(spark, path, 3, [1, 9, 70], 1_000, deleted=[1])
    return path


def expected():
    content = {}
    batches = [(range(60), 0, ()), (range(0, 60, 3), 3_600_000, range(0, 60, 9))]
    batches += [(range(0, 60, 5), 7_200_000, range(0, 60, 25)), ([1, 9, 70], 1_000, [1])]
    for ids, millis, deleted in batches:
        for i in ids:
            content[i] = None if i in deleted else millis + (i * 7919) % 50 * 1000
    return content


def test_content_is_that_of_the_newest_batches(spark, sink):
    rows = sinks.replica(spark, sink).select(
        "_id", "deleted", F.unix_millis(F.col("document.updated_at").cast("timestamp")).alias("at")
    )
    assert {int(r["_id"]): None if r["deleted"] else r["at"] for r in rows.collect()} == expected()


def test_only_old_batches_are_in_the_base(spark, sink):
    folder, through = sinks.published(spark, sink)
    assert through == 1
    assert spark.read.parquet(f"{folder}/base").count() == 60
    assert not sinks.compact(spark, sink, through=1)


def test_a_replay_beside_a_compaction(spark, sink):
    before = sorted(shown(sinks.replica(spark, sink)))
    store(spark, sink, 3, [1, 9, 70], 1_000, deleted=[1])
    assert sorted(shown(sinks.replica(spark, sink))) == before


def test_a_lookup_opens_one_bucket(spark, sink):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    found = sinks.lookup(spark, sink, ["9"])
    assert shown(found) == [r for r in shown(sinks.replica(spark, sink)) if r[0] == "9"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[[^\]]*\]", plan)
    bucket = spark.sql(f"SELECT pmod(xxhash64('9'), {sinks.BUCKETS})").first()[0]
    # The base's and the log's scan both.
    assert len(filters) >= 2
    assert all(re.search(rf"bucket#\d+ = {bucket}\)", f) for f in filters)


def test_all_pages_are_the_replica_in_order(spark, sink):
    live = sinks.replica(spark, sink).filter("not deleted")
    order = [F.desc("document.updated_at"), F.desc("document.id")]
    want = shown(live.orderBy(*order))
    got = []
    for number in range(1, len(want) // 7 + 3):
        got += shown(sinks.page(spark, sink, number, 7))
    assert got == want


def test_a_page_reads_few_ranges(spark):
    path = work_folder(spark, "test-ranges")
    rows = outputs(spark, range(40), 0)
    sinks.upsert_batch(path, SPEC)(rows, 0)
    sinks.upsert_batch(path, SPEC)(rows.limit(0), 1)
    assert sinks.compact(spark, path, through=0)
    assert len(shown(sinks.page(spark, path, "2"))) == 10
    assert sinks.page(spark, path, "9").count() == 0


def test_cost_does_not_grow_with_batches(spark):
    """After a compaction and an expiry, what was batches is one file per bucket."""
    path = work_folder(spark, "test-expire")
    for batch in range(6):
        store(spark, path, batch, range(12), batch)
    before = sorted(shown(sinks.replica(spark, path)))
    assert sinks.compact(spark, path)
    assert sinks.expire(spark, path) == 5
    assert sorted(shown(sinks.replica(spark, path))) == before
    assert len(sinks.replica(spark, path).inputFiles()) <= 2 * 12
    store(spark, path, 6, range(12), 9)
    assert sinks.compact(spark, path)
    assert sinks.expire(spark, path) == 2
    assert len(shown(sinks.replica(spark, path))) == 12


def test_files_per_batch_are_bounded(spark):
    path = work_folder(spark, "test-files")
    rows = outputs(spark, range(50), 0).repartition(16)
    sinks.upsert_batch(path, SPEC)(rows, 0)
    assert len(spark.read.parquet(f"{path}/log").inputFiles()) <= sinks.BUCKETS


def test_the_stream_stores_source_and_write_times(spark):
    base = work_folder(spark, "test-times")
    records = [(*r[:4], None) for r in Log().root(1, "r").root(2, "r").root(2, "u").records]
    times = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]
    frame = spark.createDataFrame(random.Random(1).sample(records, 3), BRONZE)
    at = F.element_at(F.array(*[F.lit(t).cast("timestamp") for t in times]), (F.col("seq") + 1).cast("int"))
    frame.withColumn("at", at).repartition(3).write.parquet(f"{base}/log")
    pipeline.start(
        read_log(spark, f"{base}/log", streaming=True), SPEC, f"{base}/sink", f"{base}/check", available_now=True
    ).awaitTermination()
    rows = sinks.replica(spark, f"{base}/sink").select("_id", F.date_format("committed_at", "dd").alias("d"), "stored_at")
    found = {r["_id"]: r for r in rows.collect()}
    assert {i: r["d"] for i, r in found.items()} == {"1": "01", "2": "03"}
    assert all(r["stored_at"].year >= 2025 for r in found.values())


def test_an_empty_sink(spark):
    path = work_folder(spark, "test-none")
    assert sinks.page(spark, path, 1).count() == 0
    assert not sinks.compact(spark, path)
    assert sinks.expire(spark, path) == 0
    assert sinks.lookup(spark, path, ["1"]).count() == 0
