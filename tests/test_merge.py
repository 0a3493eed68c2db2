"""Precombine and merge: laws, edge rows, and the plans that carry them."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import (
    INCOMING_WINS,
    LATEST_WINS,
    MergeRule,
    blank_deleted,
    broadcast_limit,
    live_rows,
    measured,
    merge,
    winners,
)
from tidemark.operators.precombine import precombine

SCHEMA = "id int, value string, seq string, _is_deleted boolean"


def rule(policy=LATEST_WINS):
    return MergeRule(("id",), "seq", "_is_deleted", policy)


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def as_set(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_precombine_keeps_the_greatest_ordering(spark):
    frame = rows(spark, (1, "a", "1", False), (1, "b", "2", False), (2, "c", "1", False))
    assert as_set(precombine(frame, ["id"], "seq")) == [(1, "b", "2", False), (2, "c", "1", False)]


def test_precombine_null_ordering_is_lowest_and_never_loses_a_key(spark):
    frame = rows(spark, (1, "a", None, False), (1, "b", "0", False), (2, "c", None, False))
    assert as_set(precombine(frame, ["id"], "seq")) == [(1, "b", "0", False), (2, "c", None, False)]


def test_precombine_breaks_ties_by_the_other_columns(spark):
    frame = rows(spark, (1, "a", "1", False), (1, "z", "1", False), (1, "m", "1", False))
    for order in itertools.permutations(frame.collect()):
        shuffled = spark.createDataFrame(list(order), SCHEMA)
        assert as_set(precombine(shuffled, ["id"], "seq")) == [(1, "z", "1", False)]


def test_precombine_reduces_a_hot_key_before_the_shuffle(spark):
    hot = spark.range(0, 30000, numPartitions=6).selectExpr(
        "CAST(CASE WHEN id < 20000 THEN 1 ELSE id END AS int) AS id",
        "CAST(id AS string) AS value",
        "lpad(CAST(id AS string), 10, '0') AS seq",
        "false AS _is_deleted",
    )
    latest = precombine(hot, ["id"], "seq")
    assert plan(latest).count("WindowGroupLimit") == 2
    assert latest.where("id = 1").collect()[0]["value"] == "19999"
    final = latest.write.format("noop").mode("overwrite")
    final.save()
    # rows that enter the shuffle: at most one per key and map task
    shuffled = latest.groupBy().count().first()[0]
    assert shuffled == 10001


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize(
    ("policy", "expected"),
    [
        (
            LATEST_WINS,
            [(1, "new", "5", False), (2, "old", "4", False), (3, None, "6", True), (4, "kept", "1", False), (5, "ins", "1", False)],
        ),
        (
            INCOMING_WINS,
            [(1, "new", "5", False), (2, "late", "3", False), (3, None, "6", True), (4, "kept", "1", False), (5, "ins", "1", False)],
        ),
    ],
)
def test_merge_replaces_inserts_and_deletes(spark, small, policy, expected):
    stored = rows(spark, (1, "old", "4", False), (2, "old", "4", False), (3, "old", "4", False), (4, "kept", "1", False))
    batch = rows(spark, (1, "new", "5", False), (2, "late", "3", False), (3, "gone", "6", True), (5, "ins", "1", False))
    merged = merge(stored, blank_deleted(batch, rule(policy)), rule(policy), small)
    assert as_set(merged) == sorted(expected, key=str)


@pytest.mark.parametrize("small", [True, False])
def test_a_deleted_key_is_not_revived_by_an_older_change(spark, small):
    stored = rows(spark, (1, "old", "1", False))
    deleted = merge(stored, blank_deleted(rows(spark, (1, "x", "5", True)), rule()), rule(), small)
    late = merge(deleted, rows(spark, (1, "late", "3", False)), rule(), small)
    assert live_rows(late, "_is_deleted").count() == 0
    again = merge(late, rows(spark, (1, "back", "7", False)), rule(), small)
    assert as_set(again) == [(1, "back", "7", False)]


@pytest.mark.parametrize("small", [True, False])
def test_delete_of_an_absent_key_shows_no_row(spark, small):
    merged = merge(rows(spark, (1, "a", "1", False)), rows(spark, (9, None, "2", True)), rule(), small)
    assert as_set(live_rows(merged, "_is_deleted")) == [(1, "a", "1", False)]


@pytest.mark.parametrize("small", [True, False])
def test_null_orderings_and_ties(spark, small):
    stored = rows(spark, (1, "s", None, False), (2, "s", "1", False), (3, "s", "1", False), (4, "s", None, False))
    batch = rows(spark, (1, "i", "1", False), (2, "i", None, False), (3, "i", "1", False), (4, "i", None, False))
    expected = [(1, "i", "1", False), (2, "s", "1", False), (3, "i", "1", False), (4, "i", None, False)]
    assert as_set(merge(stored, batch, rule(), small)) == expected


@pytest.mark.parametrize("small", [True, False])
def test_merging_a_batch_twice_and_an_empty_batch(spark, small):
    stored = rows(spark, (1, "a", "1", False), (2, "b", "2", False))
    batch = rows(spark, (1, "c", "3", False), (7, "d", "1", False))
    once = merge(stored, batch, rule(), small)
    assert as_set(merge(once, batch, rule(), small)) == as_set(once)
    assert as_set(merge(stored, rows(spark), rule(), small)) == as_set(stored)


def test_batches_commute_under_latest_wins_only(spark):
    stored = rows(spark, (1, "a", "1", False), (2, "b", "9", False))
    first = rows(spark, (1, "c", "3", False), (2, "late", "2", False))
    second = rows(spark, (1, "d", "2", False), (3, "n", "1", False))
    for policy, same in ((LATEST_WINS, True), (INCOMING_WINS, False)):
        one = merge(merge(stored, first, rule(policy), True), second, rule(policy), True)
        other = merge(merge(stored, second, rule(policy), True), first, rule(policy), True)
        assert (as_set(one) == as_set(other)) is same


def test_composite_keys_and_odd_column_names(spark):
    schema = "`a b` int, `c.d` string, `x``y` string, seq string, _is_deleted boolean"
    odd = MergeRule(("a b", "c.d"), "seq", "_is_deleted")
    stored = spark.createDataFrame([(1, "k", "s", "1", False), (1, "l", "s", "1", False)], schema)
    batch = spark.createDataFrame([(1, "k", "i", "2", False)], schema)
    for small in (True, False):
        assert as_set(merge(stored, batch, odd, small)) == [(1, "k", "i", "2", False), (1, "l", "s", "1", False)]


def test_winners_are_the_changes_not_beaten_by_a_later_stored_row(spark):
    stored = rows(spark, (1, "s", "5", False), (2, "s", "1", False), (3, "s", "5", True), (2, "twice", "0", False))
    batch = rows(spark, (1, "i", "4", False), (2, "i", "4", False), (3, "i", "4", False), (4, "i", None, False))
    for small in (True, False):
        assert as_set(winners(stored, batch, rule(), small)) == [(2, "i", "4", False), (4, "i", None, False)]
        assert as_set(winners(stored, batch, rule(INCOMING_WINS), small)) == as_set(batch)


def test_a_small_batch_does_not_shuffle_the_stored_rows(spark, place):
    spark.range(1000).selectExpr(
        "CAST(id AS int) AS id", "'s' AS value", "'1' AS seq", "false AS _is_deleted"
    ).write.parquet(f"{place}/stored")
    rows(spark, (1, "i", "2", False)).write.parquet(f"{place}/batch")
    stored, batch = spark.read.parquet(f"{place}/stored"), spark.read.parquet(f"{place}/batch")
    text = plan(merge(stored, batch, rule(), True))
    # the stored rows: one scan, straight into a broadcast anti join
    join, scan = text.split("Union")[1].splitlines()[1:3]
    assert "BroadcastHashJoin" in join and "LeftAnti, BuildRight" in join and "FileScan" in scan
    assert "SortMergeJoin" not in text
    # for the comparison, key and ordering only
    assert "ReadSchema: struct<id:int,seq:string>" in text
    # the payload of the batch is not broadcast
    broadcasts = [line for line in text.splitlines() if "BroadcastExchange" in line]
    assert broadcasts and "value" not in "".join(broadcasts)


def test_rows_that_stay_and_rows_that_change_are_in_different_files(spark, place):
    from tidemark import LakeTable, TableSpec

    table = LakeTable(spark, place, TableSpec("t", ("id",), ordering="seq"))
    table.seed(rows(spark, *[(i, "s", "1", False) for i in range(100)]), "20240101000000")
    table.upsert(rows(spark, (1, "i", "2", False), (200, "n", "2", False)), "20240102000000")
    files = table.snapshot().groupBy(F.input_file_name()).agg(F.collect_set("_commit_time").alias("c")).collect()
    assert len(files) > 1 and all(len(r["c"]) == 1 for r in files)


def test_a_large_batch_is_one_full_outer_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored, batch = rows(spark, (1, "a", "1", False)), rows(spark, (1, "b", "2", False))
        text = plan(merge(stored, batch, rule(), False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("FullOuter") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_measured_size_counts_text(spark, place):
    frame, size = measured(rows(spark, (1, "x" * 1000, "1", False), (2, None, "1", False)))
    frame.write.parquet(f"{place}/out")
    assert size.get["bytes"] == 2 * (16 + 4 * 16) + 1000 + 2
    keys, size = measured(rows(spark, (1, "x" * 1000, "1", False)), ["id", "seq"])
    keys.write.parquet(f"{place}/keys")
    assert size.get["bytes"] == 16 + 2 * 16 + 1
    empty, size = measured(rows(spark))
    empty.write.parquet(f"{place}/empty")
    assert size.get["bytes"] == 0


def test_broadcast_limit_follows_the_session(spark):
    for text, expected in (("10MB", 10 << 20), ("-1", -1), ("2g", 2 << 30), ("512", 512), ("1k", 1024)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert broadcast_limit(spark) == expected
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unknown_policy_is_refused():
    with pytest.raises(ValueError, match="policy"):
        MergeRule(("id",), "seq", "_is_deleted", "whatever")


def test_rows_that_share_the_first_keys_are_shuffled_together_by_a_large_merge(spark):
    lines = MergeRule(("o", "n"), "seq", "_is_deleted")
    schema = "o string, n int, value string, seq string, _is_deleted boolean"
    numbers = [-(2**31), -17, -1, 0, 1, 15, 16, 2**31 - 1]
    stored = spark.createDataFrame([(o, n, "s", "1", False) for o in "ab" for n in numbers], schema)
    batch = spark.createDataFrame([("a", n, "i", "2", n == 0) for n in [*numbers, 7]] + [("c", 1, "i", "2", False)], schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge(stored, batch, lines, False)
        text = plan(merged)
        got = as_set(merged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = [("a", n, "i", "2", n == 0) for n in [*numbers, 7]] + [("b", n, "s", "1", False) for n in numbers]
    assert got == sorted([*want, ("c", 1, "i", "2", False)], key=str)
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert text.count("FullOuter") == 1 and len(dealt) == 2 and all("_tidemark_run" in line for line in dealt)


def test_several_large_waiting_batches_are_shuffled_once(spark, place, monkeypatch):
    from tidemark import LakeTable, TableSpec
    from tidemark.spec import TableType
    from tidemark.tables import lake_table

    released = []
    monkeypatch.setattr(lake_table, "LARGE_STEP", 1)
    monkeypatch.setattr(lake_table, "release_shuffles", released.append)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spec = TableSpec("t", ("o", "n"), ordering="seq", table_type=TableType.MERGE_ON_READ)
        table = LakeTable(spark, place, spec)
        rows_of = lambda value, seq, *ns: spark.createDataFrame([("a", n, value, seq) for n in ns], "o string, n long, value string, seq string")
        table.seed(rows_of("s", "1", 1, 2, 3, 40), "20240101000000")
        table.upsert(rows_of("i", "2", 2, 3, 5), "20240102000000")
        table.upsert(rows_of("j", "3", 3, 5, 60), "20240103000000")
        text = plan(table.snapshot())
        got = sorted((r["n"], r["value"]) for r in table.snapshot().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(1, "s"), (2, "i"), (3, "j"), (5, "j"), (40, "s"), (60, "j")]
    assert text.count("Exchange hashpartitioning") == 2 and text.count("_tidemark_run") > 2
    assert len(released) == 3
