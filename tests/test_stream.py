import json
import os
import random

import scenarios
from conftest import Log

from docfold.operators import assembly, documents, engine, routing
from docfold.session import work_folder
from docfold.sources.changelog import BRONZE, read_log
from docfold.spec import CUSTOMER_SPEC as SPEC
from docfold.streaming import pipeline, rebuild, sinks, state


def append(spark, base, records, files=8):
    """Append records to the log, dealt over several files, so that one micro-batch has many tasks."""
    frame = spark.createDataFrame(records, BRONZE).repartition(files)
    frame.write.mode("append").parquet(f"{base}/log")


def run(spark, base, records, limit=16 * 1024 * 1024, files=8):
    """Append records to the log and let the query take them, from its checkpoint."""
    append(spark, base, records, files)
    go_on(spark, base, read_log(spark, f"{base}/log", streaming=True), limit)


def go_on(spark, base, log, limit=16 * 1024 * 1024, seed=None):
    query = pipeline.start(
        log,
        SPEC,
        f"{base}/sink",
        f"{base}/checkpoint",
        limit=limit,
        available_now=True,
        seed=seed,
    )
    query.awaitTermination()


def content(spark, base):
    rows = sinks.replica(spark, f"{base}/sink").select(
        "_id", documents.document_json(SPEC).alias("json")
    )
    return {r["_id"]: json.loads(r["json"]) for r in rows.collect()}


def test_scenarios_in_three_shuffled_runs(spark):
    """Rows and markers in any order over several runs, surplus markers last, give one result."""
    records = scenarios.build().records
    random.Random(3).shuffle(records)
    last = [r for r in records if r[0] == "transaction" and r[1] == "903"]
    rest = [r for r in records if r not in last]
    third = len(rest) // 3
    base = work_folder(spark, "test-stream")
    run(spark, base, rest[:third])
    run(spark, base, rest[third : 2 * third])
    run(spark, base, rest[2 * third :] + last)
    scenarios.check(content(spark, base))

    # A replayed batch leaves the sink as it is.
    sink = f"{base}/sink"
    before = content(spark, base)
    stored = spark.read.parquet(f"{sink}/log").filter("batch_id = 0 and outcome = 'stored'")
    again = stored.drop("outcome", "batch_id", "json_bytes", "bucket", "stored_at")
    kept = spark.createDataFrame(again.collect(), again.schema)
    sinks.upsert_batch(sink, SPEC)(kept, 0)
    assert content(spark, base) == before


def test_large_entity_goes_to_dead_letters_and_the_rest_passes(spark):
    log = Log().root(1, "r").root(2, "r")
    for i in range(30):
        log.row(
            "customer_contacts",
            {"id": i},
            "r",
            after={"id": i, "customer_id": 1, "contact_type": "email", "contact_value": "x" * 50},
        )
    base = work_folder(spark, "test-dead")
    run(spark, base, log.records, limit=600)
    assert set(content(spark, base)) == {"2"}
    dead = sinks.dead_letters(spark, f"{base}/sink").collect()
    assert [(r["_id"], r["error"]) for r in dead] == [("1", "document is too large")]


def test_malformed_input_is_set_aside(spark):
    log = Log().root(1, "r").add("customers", None, "{bad").add("customers", None, "[1]")
    base = work_folder(spark, "test-malformed")
    log.frame(spark).write.parquet(f"{base}/log")
    query = pipeline.start_malformed(
        read_log(spark, f"{base}/log", streaming=True),
        SPEC,
        f"{base}/bad",
        f"{base}/checkpoint",
        available_now=True,
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{base}/bad").orderBy("seq").collect()
    assert [(r["seq"], r["bad_value"]) for r in rows] == [(1, "{bad"), (2, "[1]")]


def test_size_is_that_of_the_document(spark):
    """Raw rows above the limit, the rendered document below it: stored, in batch and stream."""
    log = Log().root(1, "r")
    for i in range(20):
        more = {"id": i, "customer_id": 1, "contact_type": "email", "contact_value": f"{i}", "note": "x" * 90}
        log.row("customer_contacts", {"id": i}, "r", after=more)
    base = work_folder(spark, "test-size")
    run(spark, base, log.records, limit=2_000)
    outputs = engine.outputs_of(
        engine.state_of(assembly.actions(log.frame(spark), SPEC), SPEC, 2_000), SPEC, 2_000
    )
    batch = sinks.judged(outputs, SPEC, 2_000).select("_id", "outcome").collect()
    assert [tuple(r) for r in batch] == [("1", "stored")]
    assert set(content(spark, base)) == {"1"}


def test_positions_of_a_broker_stay_exact(spark):
    """A child that is older than its root's delete by less than a float can tell stays dead."""
    top = 1_700_000_000_000_000_000
    log = Log().root(1, "r", seq=top)
    child = {"id": 5, "customer_id": 1, "contact_type": "email"}
    log.row("customer_contacts", {"id": 5}, "r", after=child, seq=top + 50)
    log.root(1, "d", seq=top + 100).root(1, "c", seq=top + 150)
    base = work_folder(spark, "test-exact")
    run(spark, base, log.records)
    found = content(spark, base)
    assert found["1"]["contacts"] == []


def test_replaced_rows_and_late_events(spark):
    """Deleted rows stay deleted for older events, and come back for newer ones."""
    child = lambda i, v: {"id": i, "customer_id": 1, "contact_type": "email", "contact_value": v}
    log = Log().root(1, "r", seq=0)
    for i in range(40):
        log.row("customer_contacts", {"id": i}, "c", after=child(i, "a"), seq=10 + 2 * i)
        log.row("customer_contacts", {"id": i}, "d", before=child(i, "a"), seq=11 + 2 * i)
    first = list(log.records)
    late = Log().row("customer_contacts", {"id": 3}, "c", after=child(3, "late"), seq=5)
    late.row("customer_contacts", {"id": 4}, "c", after=child(4, "new"), seq=1_000)
    late.root(1, "u", seq=1_001)
    base = work_folder(spark, "test-late")
    run(spark, base, first)
    run(spark, base, late.records)
    assert [c["value"] for c in content(spark, base)["1"]["contacts"]] == ["new"]


def test_a_removal_before_its_put_in_one_micro_batch(spark):
    """Put and removal come from two files, the removal first: the row stays away."""
    image = {"id": 5, "customer_id": 1, "contact_type": "email", "contact_value": "gone"}
    for seed in range(3):
        log = Log().root(1, "r", seq=0)
        base = work_folder(spark, "test-order")
        log.row("customer_contacts", {"id": 5}, "d", before=image, seq=10)
        append(spark, base, log.records, files=1)
        put = Log().row("customer_contacts", {"id": 5}, "c", after=image, seq=4)
        run(spark, base, put.records, files=1 + seed)
        assert content(spark, base)["1"]["contacts"] == []


def random_log(seed, n=300):
    """Puts, removals, moves and root deletes of few rows, in transactions and without."""
    rng = random.Random(seed)
    log = Log()
    for txn in range(n // 4):
        rows = rng.randrange(1, 6)
        name = None if rng.random() < 0.3 else f"t{txn}"
        for _ in range(rows):
            owner, row = rng.randrange(6), rng.randrange(5)
            image = {"id": row, "customer_id": owner, "contact_type": "email"}
            image["contact_value"] = f"v{len(log.records)}"
            kind = rng.random()
            if kind < 0.15:
                log.root(owner, rng.choice(["c", "u", "u", "d"]), name)
            elif kind < 0.4:
                log.row("customer_contacts", {"id": row}, "d", before=image, txn=name)
            else:
                before = {"id": row, "customer_id": rng.randrange(6)}
                log.row("customer_contacts", {"id": row}, "u", before=before, after=image, txn=name)
        if name and rng.random() < 0.9:
            log.end(name, rows)
    return log.records


def final(spark, records):
    outputs = engine.final_outputs(spark.createDataFrame(records, BRONZE), SPEC)
    rows = outputs.select("_id", documents.document_json(SPEC).alias("json")).collect()
    return {r["_id"]: json.loads(r["json"]) for r in rows}


def test_random_order_over_many_files_equals_the_batch(spark):
    records = random_log(7)
    shuffled = random.Random(8).sample(records, len(records))
    base = work_folder(spark, "test-random")
    run(spark, base, shuffled[:200])
    run(spark, base, shuffled[200:])
    assert content(spark, base) == final(spark, records)


def test_rebuild_half_by_backfill_and_half_by_stream(spark):
    """Transactions, rows, tombstones and root deletes reach over the cut; open ones wait in the state."""
    records = random_log(9)
    shuffled = random.Random(10).sample(records, len(records))
    base = work_folder(spark, "test-rebuild")
    append(spark, base, shuffled[:180])
    rebuild.backfill(rebuild.read_files(spark, f"{base}/log"), SPEC, f"{base}/sink", f"{base}/seed")
    assert content(spark, base) == final(spark, shuffled[:180])
    for part in (shuffled[180:250], shuffled[250:]):
        append(spark, base, part)
        log = rebuild.read_files(spark, f"{base}/log", streaming=True)
        go_on(spark, base, rebuild.remaining(log, f"{base}/seed"), seed=f"{base}/seed")
    assert content(spark, base) == final(spark, records)


def test_an_empty_sink_reads_as_empty(spark):
    assert sinks.replica(spark, work_folder(spark, "nothing")).count() == 0
    assert sinks.dead_letters(spark, work_folder(spark, "nothing")).count() == 0


def test_the_state_is_merged_and_a_batch_replayed(spark, monkeypatch):
    """Bases replace old folders, and a micro-batch that comes again leaves state and sink as they are."""
    monkeypatch.setattr(state, "MERGE_EVERY", 2)
    records = random_log(11)
    shuffled = random.Random(12).sample(records, len(records))
    base = work_folder(spark, "test-merge")
    tables = state.Tables(f"{base}/state", SPEC)
    size = len(shuffled) // 6 + 1
    for number in range(6):
        part = spark.createDataFrame(shuffled[number * size : (number + 1) * size], BRONZE)
        for _ in range(2 if number == 3 else 1):
            state.step(routing.decode(part, SPEC), tables, f"{base}/sink", number)
        if number in (3, 5):
            assert content(spark, base) == final(spark, shuffled[: (number + 1) * size])
    # The last base is that of batch 5; what the base of batch 3 replaced is gone.
    assert [os.path.exists(tables.folder(n)) for n in range(6)] == [False] * 4 + [True] * 2
    assert [os.path.exists(tables.folder(n, base=True)) for n in (1, 3, 5)] == [False, True, True]


def test_the_stream_asks_no_state_store_key_by_key(spark):
    """Held rows and entities are joined as tables, so a micro-batch has no stateful operator and runs no Python."""
    base = work_folder(spark, "test-native")
    append(spark, base, random_log(13))
    query = pipeline.start(
        read_log(spark, f"{base}/log", streaming=True), SPEC, f"{base}/sink", f"{base}/checkpoint", available_now=True
    )
    query.awaitTermination()
    assert query.lastProgress["stateOperators"] == []
    assert content(spark, base)
