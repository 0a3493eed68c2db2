"""Error policies per operation, counts per table, and suspension."""

from __future__ import annotations

import random

import pytest

from tidemark.operators.apply_errors import ACTION, ERROR, ErrorPolicy, judged
from tidemark.spec import TableSpec
from tidemark.streaming.guarded import GuardedTable, TableSuspended, TaskStopped
from tidemark.tables.lake_table import LakeTable

SPEC = TableSpec("public.t", keys=("id",))
SCHEMA = "Op string, id int, v int, trx_seq string, _is_deleted boolean"


def changes(spark, *rows):
    return spark.createDataFrame([(op, i, v, f"{s:035d}", op == "D") for op, i, v, s in rows], SCHEMA)


def classified(spark, stored, rows, **policy):
    table = changes(spark, *stored) if stored is not None else None
    found = judged(changes(spark, *rows), table, SPEC, ErrorPolicy(**policy)).collect()
    return sorted((r["id"], int(r["trx_seq"]), r["Op"], r[ERROR], r[ACTION]) for r in found)


def test_each_operation_against_stored_and_absent_keys(spark):
    stored = [("I", 1, 0, 0), ("I", 2, 0, 0), ("I", 3, 0, 0), ("D", 4, 0, 0)]
    rows = [("I", 1, 1, 1), ("U", 2, 1, 1), ("D", 3, 1, 1), ("U", 4, 1, 1), ("D", 5, 1, 1), ("I", 6, 1, 1)]
    assert classified(spark, stored, rows) == [
        (1, 1, "I", "insert of present key", "LOG_ERROR"),
        (2, 1, "U", None, "APPLY"),
        (3, 1, "D", None, "APPLY"),
        (4, 1, "U", "update of absent key", "LOG_ERROR"),
        (5, 1, "D", "delete of absent key", "IGNORE_RECORD"),
        (6, 1, "I", None, "APPLY"),
    ]


def test_late_changes_are_no_errors(spark):
    rows = [("I", 1, 1, 5), ("U", 2, 1, 3)]
    assert [r[3] for r in classified(spark, [("I", 1, 0, 5), ("D", 2, 0, 4)], rows)] == [None, None]


def test_without_a_table_everything_is_absent(spark):
    assert [r[3] for r in classified(spark, None, [("U", 1, 1, 1), ("I", 2, 1, 1)])] == ["update of absent key", None]


@pytest.mark.parametrize("on_update", ["LOG_ERROR", "UPDATE_RECORD"])
def test_changes_of_one_key_equal_a_walk_by_hand(spark, on_update):
    draw = random.Random(6)
    stored = [("I" if draw.random() < 0.7 else "D", i, 0, 2) for i in range(30)]
    rows = [(draw.choice("IUD"), draw.randrange(40), s, s) for s in range(300)]
    there, wanted = {i: (op != "D", 2) for op, i, _, _ in stored}, []
    for op, i, _, s in sorted(rows, key=lambda r: r[3]):
        present, newest = there.get(i, (False, -1))
        if s <= 2 and i < 30:
            wanted.append((i, s, op, None))
            continue
        wrong = {"I": present, "U": not present, "D": not present}[op]
        wanted.append((i, s, op, wrong))
        if op != "U" or on_update == "UPDATE_RECORD":
            there[i] = (op != "D", newest)
    found = [(i, s, op, None if late is None else e is not None) for (i, s, op, e, _), late in zip(classified(spark, stored, rows, on_update=on_update), [w[3] for w in sorted(wanted)])]
    assert found == sorted(wanted)


def test_policies_are_checked():
    with pytest.raises(ValueError):
        ErrorPolicy(on_delete="INSERT_RECORD")


@pytest.fixture
def guarded(spark, place):
    def make(**policy):
        table = LakeTable(spark, f"{place}/table", SPEC)
        table.seed(changes(spark, ("I", 1, 0, 0), ("I", 2, 0, 0)))
        return GuardedTable(table, ErrorPolicy(**policy), f"{place}/errors")

    return make


def values(guarded):
    return {r["id"]: r["v"] for r in guarded.table.snapshot().collect()}


def test_fitting_rows_are_applied_and_misfits_logged(spark, guarded):
    table = guarded()
    state = table.upsert(changes(spark, ("I", 1, 9, 1), ("U", 2, 9, 1), ("I", 3, 9, 1), ("D", 4, 9, 1)), ("feed", 0))
    assert (state.errors, state.suspended) == (1, False)
    assert values(table) == {1: 0, 2: 9, 3: 9}
    assert [(r["id"], r[ERROR]) for r in table.errors().collect()] == [(1, "insert of present key")]


def test_record_policies_apply_misfits(spark, guarded):
    table = guarded(on_insert="INSERT_RECORD", on_update="UPDATE_RECORD")
    assert table.upsert(changes(spark, ("I", 1, 9, 1), ("U", 5, 9, 1)), ("feed", 0)).errors == 0
    assert values(table) == {1: 9, 2: 0, 5: 9}


def test_a_repeated_batch_is_not_counted_again(spark, guarded):
    table = guarded()
    batch = changes(spark, ("I", 1, 9, 1), ("U", 2, 9, 1))
    first = table.upsert(batch, ("feed", 0))
    assert table.upsert(batch, ("feed", 0)) == first


def test_a_batch_applied_but_not_counted_is_counted_from_its_log(spark, guarded, monkeypatch):
    table = guarded()
    batch = changes(spark, ("U", 8, 1, 1), ("I", 8, 1, 2), ("U", 2, 9, 1))
    with monkeypatch.context() as broken:
        broken.setattr(GuardedTable, "_save", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            table.upsert(batch, ("feed", 0))
    assert table.upsert(batch, ("feed", 0)).errors == 1
    assert values(table) == {1: 0, 2: 9, 8: 1}


def test_too_many_errors_suspend_the_table_until_it_is_resumed(spark, guarded):
    table = guarded(escalation="SUSPEND_TABLE", escalation_count=2)
    table.upsert(changes(spark, ("I", 1, 9, 1), ("U", 7, 9, 1)), ("feed", 0))
    with pytest.raises(TableSuspended):
        table.upsert(changes(spark, ("U", 8, 9, 2), ("U", 2, 9, 2)), ("feed", 1))
    assert values(table) == {1: 0, 2: 0}
    again = GuardedTable(table.table, table.policy, table.folder)  # the next run
    with pytest.raises(TableSuspended):
        again.upsert(changes(spark, ("U", 2, 9, 3)), ("feed", 2))
    again.resume()
    assert again.upsert(changes(spark, ("U", 2, 9, 3)), ("feed", 2)).errors == 0
    assert values(again) == {1: 0, 2: 9}


@pytest.mark.parametrize("action, error", [("SUSPEND_TABLE", TableSuspended), ("STOP_TASK", TaskStopped)])
def test_single_misfits_may_stop_everything(spark, guarded, action, error):
    table = guarded(on_delete=action)
    with pytest.raises(error):
        table.upsert(changes(spark, ("D", 9, 9, 1), ("U", 2, 9, 1)), ("feed", 0))
    assert values(table) == {1: 0, 2: 0}
    assert table.state().suspended == (action == "SUSPEND_TABLE")


def test_the_batch_is_read_once(spark):
    plan = judged(changes(spark, ("I", 1, 1, 1)), changes(spark, ("I", 1, 1, 0)), SPEC, ErrorPolicy())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan ExistingRDD") == 2 and text.count("Join") == 1 and text.count("Window ") == 1
