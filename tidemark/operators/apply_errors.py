"""Changes that do not fit the stored keys: inserts of a key that is there, updates and deletes of one that is not.

Each change is classified against the table as it is when the change comes: the stored keys, then the changes of its key
before it in the batch. One join with the keys of the touched rows and one window over the key do this. What happens to a
misfit is a policy per operation; too many of them suspend the table.

Changes no newer than the stored row are late, not wrong: the merge passes over them. Changes of one key are seen in the
order of their sequence, and of their operation letter where sequences are equal.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.envelope import DELETE, INSERT, OP, UPDATE
from tidemark.spec import TableSpec

# What is done with a misfit. The record policies apply it: an insert as an update, an update as an insert.
LOG_ERROR, IGNORE_RECORD, INSERT_RECORD, UPDATE_RECORD = "LOG_ERROR", "IGNORE_RECORD", "INSERT_RECORD", "UPDATE_RECORD"
SUSPEND_TABLE, STOP_TASK = "SUSPEND_TABLE", "STOP_TASK"
# The kinds of misfits.
INSERT_OF_PRESENT, UPDATE_OF_ABSENT, DELETE_OF_ABSENT = "insert of present key", "update of absent key", "delete of absent key"

ERROR, ACTION = "apply_error", "apply_action"
APPLY = "APPLY"
_ALLOWED = {
    "on_insert": (LOG_ERROR, IGNORE_RECORD, INSERT_RECORD, SUSPEND_TABLE, STOP_TASK),
    "on_update": (LOG_ERROR, IGNORE_RECORD, UPDATE_RECORD, SUSPEND_TABLE, STOP_TASK),
    "on_delete": (LOG_ERROR, IGNORE_RECORD, SUSPEND_TABLE, STOP_TASK),
    "escalation": (LOG_ERROR, SUSPEND_TABLE, STOP_TASK),
}


@dataclass(frozen=True)
class ErrorPolicy:
    """What to do per operation. Beyond ``escalation_count`` logged errors of a table ``escalation`` holds; 0: never."""

    on_insert: str = LOG_ERROR
    on_update: str = LOG_ERROR
    on_delete: str = IGNORE_RECORD
    escalation: str = LOG_ERROR
    escalation_count: int = 0

    def __post_init__(self):
        for name, allowed in _ALLOWED.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")


def judged(changes: DataFrame, stored: DataFrame | None, spec: TableSpec, policy: ErrorPolicy) -> DataFrame:
    """The changes with ``apply_error`` (NULL if they fit) and ``apply_action``.

    ``stored`` are the rows of the table, flagged ones included; only key, ordering and flag are read, and the
    changes are read once.
    """
    keys, order = list(spec.keys), spec.ordering
    rows = changes.withColumns({"_there": F.lit(None).cast("boolean"), "_stored": F.lit(None).cast("string")})
    if stored is not None:
        known = stored.select(
            *keys, (~F.coalesce(F.col(spec.delete_flag), F.lit(False))).alias("_there"), F.col(order).cast("string").alias("_stored")
        )
        rows = changes.join(known, keys, "left")
    op = F.col(OP)
    late = F.coalesce(F.col(order).cast("string") <= F.col("_stored"), F.lit(False))
    # after an insert the key is there, and after a delete it is not, whatever came of them; an update changes this
    # only where it may insert
    leaves = F.when(late, None).when(op == INSERT, True).when(op == DELETE, False)
    if policy.on_update == UPDATE_RECORD:
        leaves = leaves.when(op == UPDATE, True)
    earlier = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first(), op).rowsBetween(Window.unboundedPreceding, -1)
    there = F.coalesce(F.last("_leaves", ignorenulls=True).over(earlier), F.col("_there"), F.lit(False))
    error = (
        F.when(F.col("_late"), None)
        .when((op == INSERT) & F.col("_before"), INSERT_OF_PRESENT)
        .when((op == UPDATE) & ~F.col("_before"), UPDATE_OF_ABSENT)
        .when((op == DELETE) & ~F.col("_before"), DELETE_OF_ABSENT)
    )
    rows = rows.withColumns({"_late": late, "_leaves": leaves}).withColumn("_before", there).withColumn(ERROR, error)
    return rows.withColumn(ACTION, _action(F.col(ERROR), policy)).drop("_there", "_stored", "_late", "_leaves", "_before")


def _action(error: Column, policy: ErrorPolicy) -> Column:
    action = F.when(error.isNull(), APPLY)
    for kind, chosen in ((INSERT_OF_PRESENT, policy.on_insert), (UPDATE_OF_ABSENT, policy.on_update), (DELETE_OF_ABSENT, policy.on_delete)):
        action = action.when(error == kind, APPLY if chosen in (INSERT_RECORD, UPDATE_RECORD) else chosen)
    return action
