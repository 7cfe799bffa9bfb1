"""Document history: one document per bundle, whole transactions only, the last one the final document."""

import random

import scenarios
from conftest import Log

from docfold.operators import assembly, documents, engine, history
from docfold.spec import CUSTOMER_SPEC as SPEC


def outputs(spark, log, **options):
    events = assembly.actions(log.frame(spark), SPEC)
    found = history.document_history(events, SPEC, **options)
    rows = found.select("*", documents.document_json(SPEC).alias("json")).collect()
    return sorted(rows, key=lambda r: (r["_id"], r["bundle_seq"], r["bundle_id"]))


def contact(i, value, owner=1):
    return {"id": i, "customer_id": owner, "contact_type": "email", "contact_value": value}


def values(row):
    return [c["value"] for c in row["document"]["contacts"]]


def test_last_is_final_in_all_scenarios(spark):
    log = scenarios.build()
    found = outputs(spark, log, ranges=3, slice_points=2)
    last = {r["_id"]: r["json"] for r in found}
    final = engine.final_outputs(log.frame(spark), SPEC)
    rows = final.select("_id", documents.document_json(SPEC).alias("json")).collect()
    assert last == {r["_id"]: r["json"] for r in rows}


def test_interleaved_transactions_show_whole_or_not_at_all(spark):
    log = Log().root(1, "r")
    log.row("customer_contacts", {"id": 1}, "c", after=contact(1, "a1"), txn="7:1")
    log.row("customer_contacts", {"id": 2}, "c", after=contact(2, "b2"), txn="8:1")
    log.row("customer_contacts", {"id": 1}, "u", after=contact(1, "b1"), txn="8:2")
    log.row("customer_contacts", {"id": 3}, "c", after=contact(3, "a3"), txn="7:2")
    log.end("7", 2).end("8", 2)
    found = outputs(spark, log)
    # Transaction 8 ends before 7: its newer row 1 is never replaced by the older one of 7.
    assert [r["bundle_id"] for r in found] == [found[0]["bundle_id"], "txn:8", "txn:7"]
    assert [values(r) for r in found] == [[], ["b1", "b2"], ["b1", "b2", "a3"]]


def test_delete_and_return_of_a_root(spark):
    log = Log().root(1, "r").row("customer_contacts", {"id": 1}, "r", after=contact(1, "x"))
    log.root(1, "d").row("customer_contacts", {"id": 2}, "r", after=contact(2, "y")).root(1, "c")
    found = outputs(spark, log)
    assert [r["deleted"] for r in found] == [False, False, True, False]
    assert [values(r) for r in found if not r["deleted"]] == [[], ["x"], ["y"]]


def test_a_hot_entity_in_slices_and_too_large_points(spark):
    log = Log().root(1, "r")
    for i in range(60):
        log.row("customer_contacts", {"id": i % 20}, "u", after=contact(i % 20, f"v{i}" * 3))
    found = outputs(spark, log, slice_points=7, ranges=11, limit=150)
    assert len(found) == 61
    errors = [r["error"] is not None for r in found]
    assert not errors[0] and errors[-1] and errors == sorted(errors)
    fine = outputs(spark, log, slice_points=7, ranges=11)
    assert [len(r["document"]["contacts"]) for r in fine] == [min(i, 20) for i in range(61)]


def test_random_logs_equal_folds_of_their_prefixes(spark):
    rng = random.Random(11)
    log = Log()
    for i in range(40):
        owner, kind = rng.randrange(3), rng.random()
        if kind < 0.2:
            log.root(owner, rng.choice(["c", "d", "u"]))
        else:
            row = rng.randrange(4)
            other = rng.randrange(3)
            image = contact(row, f"v{i}", owner)
            if kind < 0.4:
                log.row("customer_contacts", {"id": row}, "d", before=image)
            else:
                log.row("customer_contacts", {"id": row}, "u", before=contact(row, "", other), after=image)
    found = outputs(spark, log)
    for cut in range(4, 40, 9):
        part = Log()
        part.records = [r for r in log.records if r[3] <= cut]
        final = engine.final_outputs(part.frame(spark), SPEC)
        want = {r["_id"]: r["json"] for r in final.select("_id", documents.document_json(SPEC).alias("json")).collect()}
        got = {r["_id"]: r["json"] for r in found if r["bundle_seq"] <= cut}
        assert got == want


def test_an_empty_log(spark):
    assert outputs(spark, Log()) == []
