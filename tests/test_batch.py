import json
import os

import pytest
import scenarios
from pyspark.sql import Window
from pyspark.sql import functions as F

from docfold import session
from docfold.operators import assembly, documents, engine, fold, routing
from docfold.session import materialize
from docfold.sources import changelog
from docfold.spec import CUSTOMER_SPEC as SPEC
from docfold.streaming import sinks


def as_json(outputs):
    rows = outputs.select("_id", documents.document_json(SPEC).alias("json")).collect()
    assert len(rows) == len({r["_id"] for r in rows})
    return {r["_id"]: json.loads(r["json"]) for r in rows}


def test_scenarios(spark):
    scenarios.check(as_json(engine.final_outputs(scenarios.build().frame(spark), SPEC)))


def test_key_order_of_the_document(spark):
    outputs = engine.final_outputs(scenarios.build().frame(spark), SPEC)
    assert list(as_json(outputs)["7"]) == [
        "_id",
        "id",
        "customer_number",
        "first_name",
        "last_name",
        "date_of_birth",
        "status",
        "profile",
        "addresses",
        "contacts",
        "preferences",
        "created_at",
        "updated_at",
    ]


def test_progress_of_open_transactions(spark):
    decoded = materialize(routing.decode(scenarios.build().frame(spark), SPEC), "decoded")
    rows = routing.row_events(decoded)
    progress = assembly.progress(rows, routing.marker_events(decoded))
    waiting = {r["txn_id"]: r["status"] for r in assembly.stalled(progress).collect()}
    assert waiting == scenarios.PENDING
    bad = routing.malformed(decoded).collect()
    assert [r["bad_value"] for r in bad] == ["{not json"]


def test_small_limits_give_the_same_result(spark):
    """Every key is hot: rows are sliced and entities measured, with the same documents."""
    frame = scenarios.build().frame(spark)
    plain = as_json(engine.final_outputs(frame, SPEC))
    events = assembly.actions(frame, SPEC, slice_rows=1)
    state = engine.state_of(events, SPEC, limit=300)
    assert state.large is not None
    outputs = materialize(engine.outputs_of(state, SPEC, limit=100), "outputs")
    found = as_json(outputs.filter("error is null"))
    over = {r["_id"]: r for r in outputs.filter("error is not null").collect()}
    assert over and set(over) == set(plain) - set(found)
    assert all(found[key] == plain[key] for key in found)
    assert all(r["total_bytes"] > 400 and r["document"] is None for r in over.values())
    # Nothing is lost: the rows of the large entities are still there in long form.
    assert state.live.count() == engine.state_of(events, SPEC).live.count()


def test_hot_entity_and_hot_transaction(spark, log):
    """One transaction with most rows, one customer with most contacts."""
    n = 400
    log.root(1, "c", "5:1")
    for i in range(n):
        log.row(
            "customer_contacts",
            {"id": i},
            "c",
            after={"id": i, "customer_id": 1, "contact_type": "email", "contact_value": f"v{i}"},
            txn=f"5:{i}",
        )
    log.end("5", n + 1)
    for cid in range(2, 30):
        log.root(cid, "c", f"{cid}00:1").end(f"{cid}00", 1)
    events = assembly.actions(log.frame(spark), SPEC, slice_rows=10)
    assert events.count() == n + 1 + 28
    state = engine.state_of(events, SPEC, limit=2_000)
    outputs = materialize(engine.outputs_of(state, SPEC, limit=2_000), "outputs")
    docs = as_json(outputs.filter("error is null"))
    assert set(docs) == {str(c) for c in range(2, 30)}
    assert [r["_id"] for r in outputs.filter("error is not null").collect()] == ["1"]
    dead = sinks.judged(outputs, SPEC, 2_000).filter("outcome = 'dead'").collect()
    assert [(r["_id"], r["error"]) for r in dead] == [("1", "document is too large")]
    whole = as_json(engine.final_outputs(log.frame(spark), SPEC))
    assert len(whole["1"]["contacts"]) == n


def test_document_log_follows_every_bundle(spark):
    events = assembly.actions(scenarios.build().frame(spark), SPEC)
    emitted = fold.document_log(events, SPEC, ranges=3).orderBy("bundle_seq").collect()
    kinds = {}
    for row in emitted:
        kinds.setdefault(row["entity_id"], []).append(row["emits"])
    assert kinds["7"] == ["document"] * 5
    assert kinds["8"] == ["document", "marker", "nothing"]
    assert kinds["29"] == ["document", "document", "document"]
    assert kinds["30"] == ["nothing", "document"]
    assert kinds["31"] == ["nothing"]
    assert kinds["32"] == ["marker"]
    wide = fold.document_log(events, SPEC).select("bundle_id", "entity_id", "emits")
    narrow = fold.document_log(events, SPEC, ranges=3).select("bundle_id", "entity_id", "emits")
    assert wide.exceptAll(narrow).count() == 0


def test_history_ends_with_the_current_state(spark):
    events = materialize(assembly.actions(scenarios.build().frame(spark), SPEC), "events")
    history = fold.row_history(events, SPEC, ranges=4)
    state = engine.state_of(events, SPEC)
    current = history.filter("valid_to is null").select("entity_id", "source", "row_id")
    live = state.live.select("entity_id", "source", "row_id")
    assert current.exceptAll(live).count() == 0 and live.exceptAll(current).count() == 0
    assert fold.row_history(events, SPEC).exceptAll(history).count() == 0


def test_ranges_are_of_equal_depth(spark):
    """Neither a burst of positions, nor rows of one position, nor one entity with most rows make a deep range."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("e"), F.col("id") % 97)).otherwise("hot").alias("entity_id"),
        F.when(F.col("id") < 9_000, 0).when(F.col("id") < 19_000, F.col("id")).otherwise(F.col("id") * 10**9).alias("seq"),
        F.lit("t").alias("source"),
        F.col("id").cast("string").alias("row_id"),
    )
    order = ["seq", "source", "row_id"]
    ranged = fold.in_ranges(rows, order, "depth", ranges=16)
    depths = sorted(r["count"] for r in ranged.groupBy("_p").count().collect())
    assert sum(depths) == 20_000 and depths[-1] <= 2 * depths[len(depths) // 2]
    after = fold.running(ranged, ["entity_id"], order, F.col("seq"), "next_seq", back=True)
    w = Window.partitionBy("entity_id").orderBy(*order)
    want = rows.withColumn("next_seq", F.lead("seq").over(w))
    got = after.select(*rows.columns, "next_seq")
    assert got.exceptAll(want).count() == 0 and got.count() == 20_000


def test_past_state(spark, log):
    log.root(1, "r", status="first").root(1, "u", status="second").root(1, "d")
    status = [
        as_json(engine.final_outputs(fold.as_of(log.frame(spark), seq), SPEC))["1"]
        for seq in (0, 1, 2)
    ]
    assert [s.get("status") for s in status] == ["first", "second", None]
    assert status[2] == {"_id": "1", "deleted": True}


def test_past_state_shows_no_half_transactions(spark, log):
    log.root(1, "c", "5:1", seq=10)
    log.root(2, "c", "5:2", seq=20).end("5", 2, seq=21)
    shown = [
        set(as_json(engine.final_outputs(fold.as_of(log.frame(spark), seq), SPEC)))
        for seq in (10, 15, 20, 21)
    ]
    assert shown == [set(), set(), set(), {"1", "2"}]


def test_snapshot_rows_are_bundles_of_their_own(spark, log):
    for i in range(5):
        log.row("customer_contacts", {"id": i}, "r", after={"id": i, "customer_id": 1}, seq=0)
    log.root(1, "r", seq=0)
    events = assembly.actions(log.frame(spark), SPEC)
    assert events.select("bundle_id").distinct().count() == 6


def test_records_without_a_source_are_set_aside(spark, log):
    log.root(1, "c", "5:1").end("5", 1)
    log.add(None, {"id": 1}, {"op": "c", "after": {"id": 9}, "transaction": {"id": "5:2"}})
    decoded = routing.decode(log.frame(spark), SPEC)
    assert [r["error"] for r in routing.malformed(decoded).collect()] == ["record has no source"]
    assert set(as_json(engine.final_outputs(log.frame(spark), SPEC))) == {"1"}


def test_log_positions_order_all_partitions(spark):
    """The source's own position counts, for rows and markers; without one a record is set aside."""
    values = [
        '{"op":"u","after":{"id":1,"first_name":"late"},"source":{"lsn":9007199254740993}}',
        '{"op":"u","after":{"id":1,"first_name":"early"},"source":{"lsn":9007199254740992}}',
        '{"status":"END","id":"5:77","event_count":0}',
        '{"op":"u","after":{"id":2}}',
    ]
    sources = ["customers", "customers", "transaction", "customers"]
    raw = spark.createDataFrame(list(zip(sources, values)), "source string, value string")
    log = raw.select(
        "source",
        F.lit(None).cast("string").alias("key"),
        "value",
        changelog.log_position(F.col("value")).alias("seq"),
        F.lit(None).cast("timestamp").alias("at"),
    )
    assert [r.seq for r in log.collect()] == [9007199254740993, 9007199254740992, 77, None]
    assert as_json(engine.final_outputs(log, SPEC))["1"]["first_name"] == "late"
    assert [r["error"] for r in engine.rejected(log, SPEC).collect()] == ["no log position"]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        bad = log.withColumn("value", F.lit("{bad"))
        engine.final_outputs(bad, SPEC, strict=True).collect()


def test_discarded_work_is_gone(spark):
    folder = materialize(spark.range(3), "test").inputFiles()[0]
    assert session.discard_work(spark) > 0 and not os.path.exists(folder.removeprefix("file://"))


def test_plain_values_keep_their_json_type(spark, log):
    log.row("customers", {"id": 1}, "c", after={"id": 1, "customer_number": 42, "first_name": True, "status": "7"})
    doc = as_json(engine.final_outputs(log.frame(spark), SPEC))["1"]
    assert (doc["id"], doc["customer_number"], doc["first_name"], doc["status"]) == (1, 42, True, "7")


def test_bundles_keep_first_seen_order(spark):
    events = assembly.actions(scenarios.build().frame(spark), SPEC).filter("txn_id = 't61'")
    rows = assembly.bundles(events).orderBy("first_seq").collect()
    assert [r["entity_id"] for r in rows] == ["11", "12"]


def test_ids_are_read_from_text_before_the_colon(spark):
    frame = spark.createDataFrame([("b5:100",), ("b5",), (":9",), ("  ",), (None,)], "t string")
    got = [r[0] for r in frame.select(routing.normalized_transaction(F.col("t"))).collect()]
    assert got == ["b5", "b5", "", None, None]


def test_strict_decoding_fails_on_bad_input(spark, log):
    log.root(1, "r").add("customers", None, "{bad")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        routing.decode(log.frame(spark), SPEC, strict=True).collect()


def test_marker_counts_may_be_text(spark, log):
    log.root(1, "c", "5:1").add("transaction", "5", {"status": "END", "id": "5:9", "event_count": "1"})
    assert set(as_json(engine.final_outputs(log.frame(spark), SPEC))) == {"1"}
