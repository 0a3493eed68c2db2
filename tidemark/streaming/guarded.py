"""Upserts that count what does not fit, table by table, and stop a table that has too much of it.

The state of a table is one small record in its error folder: how many misfits were logged, and whether it is suspended.
Records are numbered and never changed; the newest holds. A suspended table refuses batches until it is resumed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.apply_errors import ACTION, APPLY, ERROR, IGNORE_RECORD, LOG_ERROR, STOP_TASK, SUSPEND_TABLE, ErrorPolicy, judged
from tidemark.tables import storage
from tidemark.tables.lake_table import LakeTable
from tidemark.workspace import new_folder

_STATES, _ERRORS = "states", "errors"
_KEPT_STATES = 5


class TableSuspended(RuntimeError):
    """The table takes no batches until it is resumed."""


class TaskStopped(RuntimeError):
    """A misfit that must not be passed over; nothing of the batch was applied."""


@dataclass(frozen=True)
class ErrorState:
    number: int = 0
    errors: int = 0
    suspended: bool = False
    #: last batch counted, by source
    batches: tuple[tuple[str, int], ...] = ()


class GuardedTable:
    """A keyed table with an error policy. ``folder`` keeps its state and the misfits that were logged."""

    def __init__(self, table: LakeTable, policy: ErrorPolicy, folder: str):
        self.table, self.policy, self.folder = table, policy, folder.rstrip("/")
        self.spark = table.spark

    def state(self) -> ErrorState:
        numbers = self._numbers()
        if not numbers:
            return ErrorState()
        found = json.loads(storage.read_text(self.spark, f"{self.folder}/{_STATES}/{numbers[-1]:09d}.json"))
        return ErrorState(numbers[-1], found["errors"], found["suspended"], tuple((k, v) for k, v in found["batches"]))

    def _numbers(self) -> list[int]:
        place = f"{self.folder}/{_STATES}"
        names = storage.children(self.spark, place) if storage.exists(self.spark, place) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _save(self, state: ErrorState) -> ErrorState:
        text = json.dumps({"errors": state.errors, "suspended": state.suspended, "batches": state.batches})
        storage.create_text(self.spark, f"{self.folder}/{_STATES}/{state.number:09d}.json", text)
        for number in self._numbers()[:-_KEPT_STATES]:
            storage.delete(self.spark, f"{self.folder}/{_STATES}/{number:09d}.json")
        return state

    def resume(self) -> ErrorState:
        """Takes batches again; counting starts anew."""
        last = self.state()
        return self._save(ErrorState(last.number + 1, 0, False, last.batches))

    def errors(self) -> DataFrame:
        """All logged misfits, with the batch that brought them."""
        return self.spark.read.parquet(f"{self.folder}/{_ERRORS}")

    def upsert(self, changes: DataFrame, source: tuple[str, int], instant: str | None = None) -> ErrorState:
        """Applies what fits, logs what does not. A batch that was counted before changes nothing.

        The judged batch is written once, which also counts it; misfits and fitting rows are read from there. A batch
        that suspends the table or stops the task is not applied at all.
        """
        last = self.state()
        if last.suspended:
            raise TableSuspended(f"{self.table.spec.name} is suspended after {last.errors} errors")
        counted = dict(last.batches)
        if counted.get(source[0], -1) >= source[1]:
            return last
        if self.table.exists() and dict(self.table.state().batches).get(source[0], -1) >= source[1]:
            # applied, but not counted: a run died in between, after its misfits were written
            return self._save(self._next(last, last.errors + self._logged(source), counted | {source[0]: source[1]}))
        stored = self.table.snapshot(include_deletes=True) if self.table.exists() else None
        rows = judged(changes, stored, self.table.spec, self.policy)
        seen = Observation()
        counts = [F.count(F.when(F.col(ACTION) == a, 1)).alias(a) for a in (LOG_ERROR, IGNORE_RECORD, SUSPEND_TABLE, STOP_TASK)]
        folder = new_folder(self.spark, "judged")
        rows.observe(seen, *counts).write.parquet(folder)
        try:
            staged = self.spark.read.schema(rows.schema).parquet(folder)
            found = seen.get
            errors = last.errors + found[LOG_ERROR]
            verdict = self._verdict(found, errors)
            if verdict == STOP_TASK:
                raise TaskStopped(f"{self.table.spec.name}: {found[STOP_TASK] or errors} misfits in batch {source[1]}")
            if found[LOG_ERROR] or verdict == SUSPEND_TABLE:
                logged = staged.where(F.col(ACTION).isin(LOG_ERROR, SUSPEND_TABLE))
                logged.write.mode("overwrite").parquet(self._error_folder(source))
            if verdict == SUSPEND_TABLE:
                self._save(ErrorState(last.number + 1, errors + found[SUSPEND_TABLE], True, last.batches))
                raise TableSuspended(f"{self.table.spec.name} is suspended by batch {source[1]}")
            self.table.upsert(staged.where(F.col(ACTION) == APPLY).drop(ERROR, ACTION), instant, source=source)
            return self._save(self._next(last, errors, counted | {source[0]: source[1]}))
        finally:
            storage.delete(self.spark, folder)

    @staticmethod
    def _next(last: ErrorState, errors: int, batches: dict[str, int]) -> ErrorState:
        return ErrorState(last.number + 1, errors, False, tuple(batches.items()))

    def _error_folder(self, source: tuple[str, int]) -> str:
        return f"{self.folder}/{_ERRORS}/source={_folder_name(source[0])}/batch={source[1]}"

    def _logged(self, source: tuple[str, int]) -> int:
        folder = self._error_folder(source)
        return self.spark.read.parquet(folder).count() if storage.exists(self.spark, folder) else 0

    def _verdict(self, found: dict, errors: int) -> str:
        if found[STOP_TASK]:
            return STOP_TASK
        if found[SUSPEND_TABLE]:
            return SUSPEND_TABLE
        if self.policy.escalation_count and errors > self.policy.escalation_count:
            return self.policy.escalation
        return APPLY


def _folder_name(source: str) -> str:
    return "".join(c if c.isalnum() else "_" for c in source)
