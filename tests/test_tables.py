"""Base tables: the write loop, skew helpers, pages and parity."""

import json
import os

import oracle_check
import pytest
from pyspark.sql import functions as F

from docfold.operators import documents, engine, metrics, numbering, parity, relational, skew, writes
from docfold.plans import mapping, table_queries
from docfold.session import materialize
from docfold.sources.changelog import include_tables, snapshot_log
from docfold.spec import CUSTOMER_SPEC as SPEC

SF_DIR = f"{oracle_check.ROOT}/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def as_json(outputs):
    rows = outputs.select("_id", documents.document_json(SPEC).alias("json")).collect()
    return {r["_id"]: json.loads(r["json"]) for r in rows}


@needs_data
def test_writes_reach_the_documents(spark):
    """Snapshot plus the changes of a write batch folds to the documents of the new tables."""
    old = {t: materialize(f, t) for t, f in mapping.base_tables(spark, SF_DIR).items()}
    new = {t: materialize(f, t) for t, f in table_queries.changed_tables(spark, SF_DIR).items()}
    moved = new["customer_addresses"].withColumn(
        "customer_id", F.when(F.col("id") % 50 == 3, 1).otherwise(F.col("customer_id"))
    )
    new["customer_addresses"] = moved
    log = snapshot_log(old, SPEC).unionByName(writes.changes_between(old, new, SPEC, 1))
    folded = as_json(engine.final_outputs(log, SPEC))
    expected = as_json(engine.final_outputs(snapshot_log(new, SPEC), SPEC))
    gone = {key for key, doc in folded.items() if doc.get("deleted")}
    assert gone == {str(r["id"]) for r in old["customers"].filter("id % 11 = 0").collect()}
    assert {key: doc for key, doc in folded.items() if key not in gone} == expected


@needs_data
def test_relational_documents_have_every_root(spark):
    tables = mapping.base_tables(spark, SF_DIR)
    everything = relational.relational_documents(tables, SPEC)
    assert relational.oversized_roots(tables, SPEC, limit=1_500).count() > 0
    ids = everything.select("id")
    assert ids.exceptAll(tables["customers"].select("id")).count() == 0
    assert ids.count() == tables["customers"].count()
    assert everything.filter("profile is null or preferences is null").count() == 0
    assert everything.filter("addresses is null or contacts is null").count() == 0


@needs_data
def test_large_collections_come_in_chunks(spark, monkeypatch):
    """Chunks put together are what gathering would have given, in both ways to tell large owners."""
    tables = mapping.base_tables(spark, SF_DIR)
    for name in ("customer_addresses", "customer_contacts"):
        owner = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 != 0, F.col("customer_id"))
        tables[name] = materialize(tables[name].withColumn("customer_id", owner), "hot")
    whole = {r["id"]: r for r in relational.relational_documents(tables, SPEC).collect()}
    assert all(r["error"] is None and r["total_bytes"] is None for r in whole.values())
    for max_hot in (10_000, 1):
        monkeypatch.setattr(relational, "MAX_HOT_KEYS", max_hot)
        docs = {r["id"]: r for r in relational.relational_documents(tables, SPEC, 3_000).collect()}
        assert set(docs) == set(whole)
        large = {i for i, r in docs.items() if r["error"]}
        assert 1 in large and 1 < len(large) < len(docs)
        chunks = relational.collection_chunks(tables, SPEC, 3_000, chunk_bytes=1_000).collect()
        for i, row in docs.items():
            for part in ("addresses", "contacts"):
                if i not in large:
                    assert row[part] == whole[i][part]
                    continue
                assert row[part] is None
                own = sorted(
                    (c for c in chunks if c["customer_id"] == i and c["part"] == part), key=lambda c: c["chunk"]
                )
                assert [c["chunk"] for c in own] == list(range(len(own)))
                put_together = []
                for c in own:
                    assert c["first_place"] == len(put_together) and c["n_rows"] == len(c[part]) <= 8
                    put_together += c[part]
                assert put_together == whole[i][part]
    assert relational.collection_chunks(tables, SPEC).count() == 0


def test_attach_equals_a_plain_join(spark):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    facts = materialize(rows.groupBy("k").agg(F.count("*").alias("n")), "facts")
    plain = rows.join(facts, "k").select("k", "id", "n")
    for unit in (10, 100, 10_000):
        got = skew.attach(rows, facts, "k", "n", ["id"], unit).select("k", "id", "n")
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    assert skew.hot_unit(facts, "n", 10_000) is None
    assert skew.hot_unit(facts, "n", 100) == 100


def test_split_hot_keeps_every_row(spark, monkeypatch):
    rows = spark.range(1_000).select((F.col("id") % 20).alias("k"), F.col("id").alias("row_id"))
    facts = materialize(
        rows.groupBy("k").agg((F.count("*") + F.col("k")).alias("bytes")), "facts"
    )
    for max_hot in (10_000, 3):
        monkeypatch.setattr(skew, "MAX_HOT_KEYS", max_hot)
        small, large = skew.split_hot(rows, facts, "k", "bytes", 60)
        assert {r["k"] for r in small.select("k").distinct().collect()} == set(range(11))
        assert {r["k"] for r in large.select("k").distinct().collect()} == set(range(11, 20))
        assert small.count() + large.count() == 1_000


def test_numbers_and_deep_pages(spark, monkeypatch):
    frame = spark.range(500).select((F.col("id") * 7 % 500).alias("id"), F.lit(1).alias("at"))
    numbered = numbering.dense_number(frame, [F.col("id")], "n", 5).collect()
    assert all(r["n"] == r["id"] + 5 for r in numbered) and len(numbered) == 500
    top = relational.page(frame, ["at", "id"], "4").collect()
    monkeypatch.setattr(relational, "TOP_ROWS", 0)
    deep = relational.page(frame, ["at", "id"], "4").collect()
    assert sorted(top) == sorted(deep) and {r["id"] for r in top} == set(range(460, 470))
    info = relational.page_info(frame.limit(0)).first()
    assert (info["total"], info["total_pages"]) == (0, 1)


def test_defaults(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    frame = spark.createDataFrame(
        [(1, None, None, None)],
        "customer_id bigint, preferred_language string, risk_rating string, updated_at timestamp",
    )
    row = writes.with_defaults(frame, "customer_profiles", now).first()
    assert row["preferred_language"] == "en" and row["risk_rating"] == "standard"
    assert str(row["updated_at"]) == "2024-01-01 00:00:00"


def test_delete_all(spark):
    tables = {
        "customers": spark.range(5).toDF("id"),
        "customer_profiles": spark.range(3).toDF("customer_id"),
    }
    left, removed = writes.delete_roots(tables, None, SPEC)
    assert removed.first()["deleted"] == 5
    assert all(frame.count() == 0 for frame in left.values())


def test_parity_without_faults(spark):
    frame = spark.createDataFrame([(1, None, "a"), (2, 5, "b")], "id int, n int, s string")
    assert parity.field_diff(frame, frame, "id").count() == 0
    assert parity.count_parity(frame, frame).first().asDict() == {
        "source_count": 2,
        "replica_count": 2,
        "delta": 0,
        "in_parity": True,
    }


def test_workload_profile(spark, log):
    log.root(1).root(2).end("1", 2).add("customers", None, None)
    frame = include_tables(log.frame(spark), SPEC)
    rows = {r["source"]: r for r in metrics.workload_profile(frame).collect()}
    sizes = [len(r[1]) + len(r[2]) for r in log.records if r[0] == "customers" and r[2]]
    assert rows["customers"]["records"] == 2
    assert rows["customers"]["total_bytes"] == sum(sizes)
    assert rows["customers"]["largest"] == max(sizes)
    assert rows["transaction"]["records"] == 1
