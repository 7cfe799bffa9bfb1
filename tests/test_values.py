import json

from pyspark.sql import functions as F

from docfold.functions import values
from docfold.operators import readmodel, relational


def apply(spark, rule, *inputs):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(rule(F.col("v"))).collect()]


def test_text(spark):
    assert apply(spark, values.text, " a ", "  ", "", None) == [" a ", None, None, None]
    assert apply(spark, values.text_or_null, " a ", " \t", None) == ["a", None, None]


def test_dates_and_instants(spark):
    assert apply(spark, values.iso_date, "-51965", "19723", "2024-02-30", "x", None) == [
        "1827-09-23",
        "2024-01-01",
        "2024-02-30",
        "x",
        None,
    ]
    assert apply(
        spark,
        values.instant_text,
        "1704067200000",
        "1704067200120",
        "2024-02-11T09:31:00.123456Z",
        "2024-02-11T09:31:00+01:00",
        "2024-02-11",
        "2024-02-11T09:31Z",
        "no",
    ) == [
        "2024-01-01T00:00:00Z",
        "2024-01-01T00:00:00.120Z",
        "2024-02-11T09:31:00.123456Z",
        "2024-02-11T08:31:00Z",
        "2024-02-11",
        "2024-02-11T09:31Z",
        "no",
    ]


def test_read_model_dates(spark):
    assert apply(spark, readmodel.to_date, "0", "", "19723", "2024-05-06", "2024-05-06T23:00:00Z") == [
        None,
        None,
        "2024-01-01",
        "2024-05-06",
        "2024-05-06",
    ]
    assert apply(spark, readmodel.to_iso, None, "2024-05-06", "2024-05-06T01:02:03Z") == [
        "",
        "2024-05-06T00:00:00.000Z",
        "2024-05-06T01:02:03.000Z",
    ]


def test_boolean_entries(spark):
    got = apply(spark, values.boolean_entries, '{"a":true,"b":"true","c":false}', "{bad", "[1]", None)
    assert got == [{"a": True, "c": False}, {}, {}, {}]


def test_page_numbers():
    assert [relational.page_number(v) for v in ("3", "0", "-2", "x", "", None, "7up", 4)] == [
        3,
        1,
        1,
        1,
        1,
        1,
        7,
        4,
    ]


def test_stored_documents(spark):
    docs = [
        {"_id": "1", "id": 1, "profile": '{"riskRating":"high"}', "status": "inactive"},
        {"_id": {"id": 2}, "after": {"first_name": "Mirela", "addresses": [{"type": "boat"}]}},
        {"_id": "3", "deleted": True},
        {"_id": "4", "deleted": False, "contacts": [{"type": "email", "isPrimary": "true"}]},
    ]
    frame = spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")
    rows = {r["id"]: r for r in readmodel.from_store(frame).collect()}
    assert set(rows) == {"1", "2", "4"}
    assert rows["1"]["profile"]["riskRating"] == "high" and rows["1"]["status"] == "inactive"
    assert rows["2"]["firstName"] == "Mirela" and rows["2"]["addresses"] == []
    assert rows["2"]["status"] == "active" and rows["2"]["updatedAt"] == ""
    assert rows["4"]["contacts"][0]["isPrimary"] is False
    assert rows["4"]["preferences"]["paperlessStatements"] is True
