"""The keyed stage of the feeds: a small state per id in the state store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class StoredChange(StatefulProcessor):
    """Per id: the first output inserts, later ones replace; one that was seen before is none.

    Only the first output of a call is held back, so an id with very many outputs takes no memory.
    """

    OUTPUT = "id string, operation string, deleted boolean, version bigint, batch_id bigint, at timestamp"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "batch_id bigint, version bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.newest.get()
        before = stored and tuple(stored)
        newest, first = before, None

        def change(operation: str, row: Row) -> Row:
            return Row(
                id=key[0],
                operation=operation,
                deleted=row.deleted,
                version=row.version,
                batch_id=row.batch_id,
                at=row.committed_at,
            )

        for row in rows:
            order = (row.batch_id, row.version)
            if before is not None and order <= before:
                continue
            newest = order if newest is None else max(newest, order)
            if before is None and (first is None or order < (first.batch_id, first.version)):
                first, row = row, first
            if row is not None:
                yield change("replace", row)
        if first is not None:
            yield change("insert", first)
        if newest != before:
            self.newest.update(newest)

    def close(self) -> None:
        pass
