"""Feeds as streams: kinds of replica changes over runs and replays, order and late events of the joint feed."""

import datetime
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.operators import feed
from docfold.session import work_folder
from docfold.spec import CUSTOMER_SPEC as SPEC
from docfold.streaming import feeds, sinks

STORED = "_id string, deleted boolean, version bigint, committed_at timestamp, outcome string, batch_id bigint"


def at(second):
    return None if second is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second)


def store(spark, base, rows):
    """Write batches of a sink, over those that are there."""
    frame = spark.createDataFrame(rows, STORED).withColumn("bucket", sinks.bucket_of(F.col("_id")))
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "outcome", "batch_id", "bucket"
    ).parquet(f"{base}/sink/log")


def read_changes(spark, base):
    query = (
        feeds.replica_stream(spark, f"{base}/sink", SPEC)
        .writeStream.option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .format("parquet")
        .start(f"{base}/out")
    )
    query.awaitTermination()


def test_replica_changes_over_runs_with_a_replay_equal_the_batch(spark):
    pick = random.Random(2)
    rows = []
    for version in range(300):
        id_ = "hot" if version % 3 == 0 else str(pick.randrange(40))
        outcome = "dead" if version % 50 == 7 else "stored"
        rows.append((id_, version % 11 == 0, version, at(version), outcome, version // 60))
    base = work_folder(spark, "test-replica-changes")
    store(spark, base, [r for r in rows if r[5] <= 1])
    read_changes(spark, base)
    store(spark, base, [r for r in rows if r[5] in (1, 2)])  # batch 1 comes again
    read_changes(spark, base)
    store(spark, base, [r for r in rows if r[5] == 2])  # nothing but a replay
    read_changes(spark, base)
    store(spark, base, [r for r in rows if r[5] >= 3])
    read_changes(spark, base)
    columns = ["id", "operation", "deleted", "version", "batch_id", "at"]
    got = sorted(tuple(r) for r in spark.read.parquet(f"{base}/out").select(columns).collect())
    stored = spark.createDataFrame([r for r in rows if r[4] == "stored"], STORED)
    batch = feed.replica_changes(stored.withColumnsRenamed({"_id": "id", "committed_at": "at"}), "id", "version")
    assert got == sorted(tuple(r) for r in batch.select(columns).collect())


def events(spark, *rows):
    full = [(f, "change", i, None, at(s)) for f, i, s in rows]
    return spark.createDataFrame(full, T.StructType.fromDDL(feeds.EVENT))


def shown(frame):
    return [r["id"] for r in frame.orderBy("batch_id", *feeds.ORDER).collect()]


def test_order_late_events_and_replay(spark):
    path = work_folder(spark, "test-feed")
    write = feeds.order_batch(path, 5)
    write(events(spark, ("source", "a", 30), ("source", "b", 10)), 0)
    # One feed has not come yet: nothing is in order so far.
    assert shown(feeds.ordered(spark, path)) == [] and feeds.waiting(spark, path).count() == 2
    second = events(spark, ("replica", "c", 25), ("replica", "d", 12), ("source", "e", None))
    for _ in range(2):  # the batch comes again
        write(second, 1)
        assert shown(feeds.ordered(spark, path)) == ["b", "d"]  # before 25 - 5
        assert shown(feeds.late(spark, path)) == ["e"]
        assert {r["id"] for r in feeds.waiting(spark, path).collect()} == {"a", "c"}
    third = events(spark, ("source", "late", 19), ("source", "intime", 20), ("replica", "f", 90))
    write(third, 2)
    write(events(spark), 3)
    write(events(spark, ("source", "g", 200)), 4)
    assert shown(feeds.ordered(spark, path)) == ["b", "d", "intime", "c", "a"]
    assert shown(feeds.late(spark, path)) == ["e", "late"]
    assert {r["id"] for r in feeds.waiting(spark, path).collect()} == {"f", "g"}
