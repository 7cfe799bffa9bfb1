"""The whole batch path: change log in, documents and delete markers out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from docfold.operators import assembly, documents, fold, routing
from docfold.operators.skew import SLICE_ROWS
from docfold.session import materialize
from docfold.spec import DOCUMENT_LIMIT_BYTES, DocumentSpec


@dataclass(frozen=True)
class State:
    """The folded log: entity lifetimes and current rows in long form.

    ``large`` holds the rows of entities that may exceed one document; it is null when none does.
    """

    entities: DataFrame
    small: DataFrame
    large: DataFrame | None

    @property
    def live(self) -> DataFrame:
        """All current rows."""
        return self.small if self.large is None else self.small.unionByName(self.large)


def state_of(
    events: DataFrame, spec: DocumentSpec, limit: int = DOCUMENT_LIMIT_BYTES
) -> State:
    """Fold committed events."""
    rows = materialize(fold.latest(events), "latest")
    entities = materialize(fold.lifetimes(rows, spec), "entities")
    return State(entities, *fold.live_rows(rows, entities, limit))


def outputs_of(state: State, spec: DocumentSpec, limit: int = DOCUMENT_LIMIT_BYTES) -> DataFrame:
    """Final documents, errors and delete markers of a folded log."""
    docs = documents.documents(state.small, state.large, spec, limit)
    return documents.with_markers(docs, fold.delete_markers(state.entities))


def final_outputs(
    bronze: DataFrame,
    spec: DocumentSpec,
    limit: int = DOCUMENT_LIMIT_BYTES,
    slice_rows: int = SLICE_ROWS,
    strict: bool = False,
) -> DataFrame:
    """Documents, errors and markers after everything complete in the log.

    Records that can't be read are in ``rejected``; with ``strict`` they fail the job.
    """
    events = assembly.actions(bronze, spec, slice_rows, strict)
    return outputs_of(state_of(events, spec, limit), spec, limit)


def rejected(bronze: DataFrame, spec: DocumentSpec) -> DataFrame:
    """Records of a log that ``final_outputs`` sets aside, with their position and error."""
    return routing.malformed(routing.decode(bronze, spec))
