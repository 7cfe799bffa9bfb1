"""The parity queries fold the base rows once, and write no more than their result needs."""

import json

import pytest

from docfold.operators import routing
from docfold.plans import sink_queries
from docfold.sources.changelog import BRONZE
from docfold.spec import CUSTOMER_SPEC as SPEC


@pytest.fixture
def outputs(spark):
    """Snapshot outputs of a few customers, folded once for all cases."""
    from docfold.operators import engine

    records = []
    for i in range(120):
        image = {"id": i, "customer_number": f"C{i}", "updated_at": 1_700_000_000_000 + i}
        value = {"op": "r", "before": None, "after": image}
        records.append(("customers", json.dumps({"id": i}), json.dumps(value), 0, None))
    return engine.final_outputs(spark.createDataFrame(records, BRONZE), SPEC)


@pytest.fixture
def tables(spark):
    """Base tables of the same customers, without children."""
    made = spark.range(120).selectExpr(
        "id",
        "concat('C', id) as customer_number",
        "cast(null as string) as first_name",
        "cast(null as string) as last_name",
        "cast(null as date) as date_of_birth",
        "cast(null as string) as status",
        "cast(null as timestamp) as created_at",
        "timestamp_millis(1700000000000 + id) as updated_at",
    )
    found = {"customers": made}
    for child in SPEC.children:
        row = child.image.replace("id string", "id bigint") if child.is_collection else child.image
        found[child.table] = spark.createDataFrame([], row)
    return found


@pytest.mark.parametrize("name", ["stale_mismatches", "repair_list"])
def test_the_base_rows_are_folded_once(spark, monkeypatch, outputs, tables, name):
    folds = []
    monkeypatch.setattr(sink_queries, "snapshot_outputs", lambda *_: folds.append(1) or outputs)
    monkeypatch.setattr(sink_queries.mapping, "base_tables", lambda *_: tables)
    found = sink_queries.QUERIES[name](spark, "").collect()
    assert len(folds) == 1
    missing = {"0", "101"}
    if name == "repair_list":
        # Ids 0 to 5 modulo 41 have a faulty field; 1000000000 and 1000000109 are extra.
        by_id = {r["_id"]: r for r in found}
        assert missing <= set(by_id) and not by_id["0"]["deleted"]
        assert by_id["1000000109"]["deleted"]


def test_counting_writes_ids_only(spark, monkeypatch, outputs, tables):
    written = []
    monkeypatch.setattr(sink_queries, "snapshot_outputs", lambda *_: outputs)
    monkeypatch.setattr(sink_queries.mapping, "table", lambda *_: tables["customers"])
    monkeypatch.setattr(sink_queries.mapping, "base_tables", lambda *_: tables)
    usual = sink_queries.materialize
    monkeypatch.setattr(
        sink_queries, "materialize", lambda f, purpose: written.append(f.columns) or usual(f, purpose)
    )
    assert sink_queries.count_parity(spark, "").first().asDict() == {
        "source_count": 120,
        "replica_count": 120,  # two are missing, two are extra
        "delta": 0,
        "in_parity": True,
    }
    assert written == [["id"]]


def test_decoded_records_hold_no_ids_twice(spark):
    """The ids of images are read where events are bundled; before that they were written with every record."""
    decoded = routing.decode(spark.createDataFrame([], BRONZE), SPEC)
    assert not [c for c in decoded.columns if c.endswith("_ids")]
