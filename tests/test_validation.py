import copy
import json

import pytest

from docfold.operators import validation as v

VALID = {
    "customerNumber": " C-1 ",
    "firstName": "Mirela",
    "lastName": "Tandoni",
    "dateOfBirth": "",
    "status": "active",
    "profile": {
        "preferredLanguage": "en",
        "occupation": " ",
        "annualIncome": 1200.5,
        "taxResidencyCountry": "gb",
        "riskRating": "low",
    },
    "addresses": [
        {
            "type": "work",
            "line1": " 1 Way ",
            "city": "C",
            "postalCode": 123,
            "countryCode": "us",
            "validFrom": "2024-01-01",
        }
    ],
    "contacts": [
        {"type": "email", "value": "a", "isPrimary": True, "verifiedAt": "2024-01-01T10:00:00+02:00"},
        {"type": "email", "value": "b", "isPrimary": "yes"},
    ],
    "preferences": {
        "marketingEmailOptIn": True,
        "marketingSmsOptIn": False,
        "paperlessStatements": True,
        "notificationChannels": {"email": True},
    },
}


def broken(path, value):
    data = copy.deepcopy(VALID)
    target = data
    for step in path[:-1]:
        target = target[step]
    target[path[-1]] = value
    return data


CASES = [
    ([1], v.PAYLOAD),
    ("text", v.PAYLOAD),
    (None, v.PAYLOAD),
    (broken(["firstName"], "  "), v.NAMES),
    (broken(["customerNumber"], None), v.NAMES),
    (broken(["dateOfBirth"], "1.2.2000"), v.BIRTH),
    (broken(["status"], "gone"), v.STATUS),
    (broken(["status"], " active"), v.STATUS),
    (broken(["profile"], "{}"), v.PROFILE),
    (broken(["profile", "preferredLanguage"], ""), v.PROFILE),
    (broken(["profile", "riskRating"], "odd"), v.PROFILE),
    (broken(["profile", "annualIncome"], "12.345"), v.INCOME),
    (broken(["profile", "annualIncome"], "-1"), v.INCOME),
    (broken(["profile", "taxResidencyCountry"], "GBR"), v.COUNTRY),
    (broken(["addresses"], {}), v.ADDRESSES),
    (broken(["addresses"], VALID["addresses"] * 2), v.ADDRESS),
    (broken(["addresses", 0, "countryCode"], " us"), v.ADDRESS),
    (broken(["addresses", 0, "validFrom"], None), v.ADDRESS),
    (broken(["addresses", 0], 5), v.ADDRESS),
    (broken(["contacts"], None), v.CONTACTS),
    (broken(["contacts", 1, "isPrimary"], True), v.CONTACT),
    (broken(["contacts", 0, "verifiedAt"], "soon"), v.CONTACT),
    (broken(["contacts", 0, "type"], "fax"), v.CONTACT),
    (broken(["preferences", "paperlessStatements"], "yes"), v.SWITCHES),
    (broken(["preferences", "notificationChannels"], {"email": 1}), v.SWITCHES),
    (broken(["preferences", "notificationChannels"], None), v.SWITCHES),
    ({**broken(["status"], "gone"), "addresses": {}, "preferences": 1}, v.STATUS),
    (broken(["addresses"], []), None),
    (VALID, None),
]


@pytest.fixture(scope="module")
def results(spark):
    rows = [(i, json.dumps(payload)) for i, (payload, _) in enumerate(CASES)]
    frame = spark.createDataFrame(rows + [(len(CASES), "{bad")], "i int, payload string")
    return {r["i"]: r for r in v.checked(frame).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_first_error(results, i):
    assert results[i]["error"] == CASES[i][1]
    assert (results[i]["data"] is None) == (CASES[i][1] is not None)


def test_malformed_text(results):
    assert results[len(CASES)]["error"] == v.PAYLOAD


def test_cleaned_input(results):
    data = results[len(CASES) - 1]["data"].asDict(recursive=True)
    assert data["customerNumber"] == "C-1" and data["dateOfBirth"] is None
    assert data["profile"]["annualIncome"] == "1200.5"
    assert data["profile"]["occupation"] is None
    assert data["profile"]["taxResidencyCountry"] == "GB"
    assert data["addresses"][0]["line1"] == "1 Way"
    assert data["addresses"][0]["postalCode"] == "123"
    assert data["addresses"][0]["countryCode"] == "US"
    assert [c["isPrimary"] for c in data["contacts"]] == [True, False]
    assert data["contacts"][0]["verifiedAt"] == "2024-01-01T08:00:00.000Z"
    assert data["preferences"]["notificationChannels"] == {"email": True}
