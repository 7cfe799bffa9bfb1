import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docfold.session import local_session  # noqa: E402
from docfold.sources.changelog import BRONZE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "docfold-tests")
    yield session
    session.stop()


class Log:
    """A hand-written change log; ``seq`` is the order of the calls unless given."""

    def __init__(self):
        self.records = []

    def add(self, source, key, value, seq=None):
        seq = len(self.records) if seq is None else seq
        key = key if key is None or isinstance(key, str) else json.dumps(key)
        value = value if value is None or isinstance(value, str) else json.dumps(value)
        self.records.append((source, key, value, seq, None))
        return self

    def row(self, source, key, op, before=None, after=None, txn=None, seq=None):
        event = {"op": op, "before": before, "after": after}
        if txn is not None:
            event["transaction"] = {"id": txn}
        return self.add(source, key, event, seq)

    def root(self, cid, op="c", txn=None, seq=None, **columns):
        if op == "d":
            return self.row("customers", {"id": cid}, "d", {"id": cid}, None, txn, seq)
        image = {"id": cid, "customer_number": f"CUS-{cid}", "first_name": "Mirela"}
        return self.row("customers", {"id": cid}, op, None, {**image, **columns}, txn, seq)

    def end(self, txn, count, status="END", seq=None):
        value = {"status": status, "id": f"{txn}:999"}
        if count is not None:
            value["event_count"] = count
        return self.add("transaction", txn, value, seq)

    def frame(self, spark):
        return spark.createDataFrame(self.records, BRONZE)


@pytest.fixture
def log():
    return Log()
