"""The keyed table: commits, versions, partitions, incremental reads, maintenance, failures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark import LakeTable, TableSpec
from tidemark.operators.merge import INCOMING_WINS, LATEST_WINS
from tidemark.spec import TableType
from tidemark.tables import lake_table, storage
from tidemark.tables.commits import Commit, next_instant
from tidemark.tables.lake_table import COMMIT_TIME

TABLES = "/root/testdata/sf0.001"
SCHEMA = "id int, place string, value string, trx_seq string, _is_deleted boolean"
BOTH_TYPES = pytest.mark.parametrize("table_type", list(TableType))


def spec(**overrides):
    return TableSpec(**{"name": "public.things", "keys": ("id",), **overrides})


def rows(spark, *values):
    return spark.createDataFrame([(*v, False) if len(v) == 4 else v for v in values], SCHEMA)


def shown(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*(columns or ("id", "place", "value"))).collect())


def sequence(number):
    return "20240101000000" + str(number).zfill(21)


def modulo_feed(spark, number):
    """The numbered batches of the published fixture, with known row counts and sums."""
    orders = spark.read.parquet(f"{TABLES}/orders.parquet")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")

    def change(frame, op, counter):
        return frame.selectExpr(f"'{op}' AS Op", "*", f"'{sequence(counter)}' AS trx_seq", f"'{op}' = 'D' AS _is_deleted")

    if number == 0:
        return change(orders, "I", 0)
    if number == 1:
        raised = orders.where(key % 21 == 0).withColumn("o_totalprice", price + 2)
        return change(raised, "U", 2).unionByName(change(orders.where(key % 11 == 0), "D", 3))
    raised = orders.where(key % 7 == 0).withColumn("o_totalprice", price + 1)
    added = orders.where(key % 13 == 0).withColumn("o_orderkey", key + 1000000)
    return change(raised, "U", 1).unionByName(change(added, "I", 1))


def totals(frame):
    row = frame.agg(F.count(F.lit(1)), F.round(F.sum("o_totalprice"), 2)).first()
    return tuple(row)


@BOTH_TYPES
@pytest.mark.parametrize("limit", ["10MB", "-1"])
@pytest.mark.parametrize(
    ("policy", "after_late_batch"),
    [(LATEST_WINS, (1479, 371364870.44)), (INCOMING_WINS, (1499, 376269598.04))],
)
def test_published_totals(spark, place, table_type, limit, policy, after_late_batch):
    table = LakeTable(
        spark, place, TableSpec("public.orders", ("o_orderkey",), table_type=table_type, policy=policy)
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        table.seed(modulo_feed(spark, 0))
        table.upsert(modulo_feed(spark, 1))
        assert totals(table.snapshot()) == (1363, 340754702.24)
        table.upsert(modulo_feed(spark, 2))
        assert totals(table.snapshot()) == after_late_batch
        merged = table.snapshot().drop(COMMIT_TIME).collect()
        table.compact()
        assert sorted(map(str, table.read_optimized().drop(COMMIT_TIME).collect())) == sorted(map(str, merged))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@BOTH_TYPES
def test_a_row_moves_to_another_partition(spark, place, table_type):
    table = LakeTable(spark, place, spec(partition_by=("place",), table_type=table_type))
    table.seed(rows(spark, (1, "a", "x", sequence(0)), (2, "a", "y", sequence(0)), (3, "b", "z", sequence(0))))
    table.upsert(rows(spark, (1, "b", "moved", sequence(1))))
    assert shown(table.snapshot()) == [(1, "b", "moved"), (2, "a", "y"), (3, "b", "z")]
    table.upsert(rows(spark, (1, "c", "again", sequence(2))))
    assert shown(table.snapshot()) == [(1, "c", "again"), (2, "a", "y"), (3, "b", "z")]
    # a late older change of the moved row changes nothing
    table.upsert(rows(spark, (1, "a", "late", sequence(1))))
    assert shown(table.snapshot()) == [(1, "c", "again"), (2, "a", "y"), (3, "b", "z")]
    table.compact()
    assert shown(table.snapshot()) == [(1, "c", "again"), (2, "a", "y"), (3, "b", "z")]


@BOTH_TYPES
def test_a_delete_without_its_partition_value(spark, place, table_type):
    table = LakeTable(spark, place, spec(partition_by=("place",), table_type=table_type))
    table.seed(rows(spark, (1, "a", "x", sequence(0)), (2, "a", "y", sequence(0))))
    table.upsert(rows(spark, (1, None, None, sequence(1), True)))
    assert shown(table.snapshot()) == [(2, "a", "y")]


@BOTH_TYPES
def test_a_partition_emptied_by_moves_does_not_come_back(spark, place, table_type):
    table = LakeTable(spark, place, spec(partition_by=("place",), table_type=table_type))
    table.seed(rows(spark, (1, "only", "x", sequence(0)), (2, "b", "y", sequence(0))))
    table.upsert(rows(spark, (1, "b", "moved", sequence(1))))
    table.compact()
    assert shown(table.snapshot()) == [(1, "b", "moved"), (2, "b", "y")]
    assert not [n for n in table.state().parts if "only" in n]


def test_odd_partition_values_are_matched(spark, place):
    table = LakeTable(spark, place, spec(partition_by=("place",)))
    values = ["1997/01/15", "a b", "50%", "x+y", "é=ü", None]
    table.seed(rows(spark, *[(i, v, "old", sequence(0)) for i, v in enumerate(values)]))
    table.upsert(rows(spark, *[(i, "elsewhere", "new", sequence(1)) for i in range(len(values))]))
    assert shown(table.snapshot()) == [(i, "elsewhere", "new") for i in range(len(values))]


def test_only_touched_partitions_are_rewritten(spark, place):
    table = LakeTable(spark, place, spec(partition_by=("place",), stable_partition=True))
    table.seed(rows(spark, (1, "a", "x", sequence(0)), (2, "b", "y", sequence(0))), "20240101000000")
    table.upsert(rows(spark, (2, "b", "z", sequence(1))), "20240102000000")
    bases = {n: p.base[:8] for n, p in table.state().parts.items()}
    assert bases == {"place=a": "20240101", "place=b": "20240102"}
    files = table.snapshot().where("place = 'a'").select(F.input_file_name()).distinct().collect()
    assert files and all("tidemark_version=20240101" in f[0] for f in files)
    pruned = table.snapshot().where("place = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "(place" in pruned.split("PartitionFilters")[1].split("]")[0]


def test_an_empty_batch_keeps_files_and_records_progress(spark, place):
    table = LakeTable(spark, place, spec())
    table.seed(rows(spark, (1, "a", "x", sequence(0))))
    before = table.state()
    table.upsert(rows(spark), source=("feed", 3))
    after = table.state()
    assert after.parts == before.parts and after.batches == {"feed": 3}
    assert shown(table.snapshot()) == [(1, "a", "x")]


def test_a_batch_delivered_again_is_skipped(spark, place):
    table = LakeTable(spark, place, spec(policy=INCOMING_WINS))
    table.seed(rows(spark, (1, "a", "x", sequence(0))))
    table.upsert(rows(spark, (1, "a", "one", sequence(1))), source=("feed", 0))
    table.upsert(rows(spark, (1, "a", "two", sequence(2))), source=("feed", 1))
    number = table.state().number
    table.upsert(rows(spark, (1, "a", "one", sequence(1))), source=("feed", 0))
    assert table.state().number == number
    assert shown(table.snapshot()) == [(1, "a", "two")]


def test_files_without_a_commit_are_invisible(spark, place):
    table = LakeTable(spark, place, spec())
    table.seed(rows(spark, (1, "a", "x", sequence(0))), "20240101000000")
    # a writer that died after its files and before its commit
    rows(spark, (9, "a", "half", sequence(9))).withColumn(COMMIT_TIME, F.lit("x")).write.parquet(
        f"{place}/base/tidemark_version=20240102000000000"
    )
    assert shown(table.snapshot()) == [(1, "a", "x")]
    table.upsert(rows(spark, (2, "a", "y", sequence(1))), "20240103000000")
    assert shown(table.snapshot()) == [(1, "a", "x"), (2, "a", "y")]
    assert "base/tidemark_version=20240102000000000" in table.stale_folders()


def test_a_second_writer_fails_at_its_commit(spark, place):
    table = LakeTable(spark, place, spec())
    table.seed(rows(spark, (1, "a", "x", sequence(0))))
    stale = table.state()
    table.upsert(rows(spark, (1, "a", "y", sequence(1))))
    with pytest.raises(Exception, match="(?i)exist"):
        table.log.append(stale.next("20991231000000000", "upsert"))
    assert shown(table.snapshot()) == [(1, "a", "y")]


def test_null_keys_are_refused(spark, place):
    table = LakeTable(spark, place, spec())
    table.seed(rows(spark, (1, "a", "x", sequence(0))))
    with pytest.raises(Exception, match="NULL in key column id"):
        table.upsert(rows(spark, (None, "a", "y", sequence(1))))
    assert shown(table.snapshot()) == [(1, "a", "x")]


def test_seed_refuses_a_filled_table_unless_it_replaces(spark, place):
    table = LakeTable(spark, place, spec())
    table.seed(rows(spark, (1, "a", "x", sequence(0))))
    with pytest.raises(ValueError, match="replace=True"):
        table.seed(rows(spark, (2, "a", "y", sequence(0))))
    table.seed(rows(spark, (2, "a", "y", sequence(0))), replace=True)
    assert shown(table.snapshot()) == [(2, "a", "y")]


def test_upsert_creates_a_missing_table(spark, place):
    table = LakeTable(spark, place, spec())
    table.upsert(rows(spark, (1, "a", "x", sequence(0)), (1, "a", "y", sequence(1))))
    assert shown(table.snapshot()) == [(1, "a", "y")]


def test_changes_are_conformed_to_the_table(spark, place):
    table = LakeTable(spark, place, spec())
    table.seed(rows(spark, (1, "a", "x", sequence(0))))
    drifted = spark.sql(f"SELECT 'extra' AS more, '{sequence(1)}' AS trx_seq, 'new' AS value, '2' AS id")
    table.upsert(drifted)
    assert shown(table.snapshot()) == [(1, "a", "x"), (2, None, "new")]


@BOTH_TYPES
def test_incremental_reads_only_later_commits(spark, place, table_type):
    table = LakeTable(spark, place, spec(table_type=table_type))
    table.seed(rows(spark, (1, "a", "x", sequence(5)), (2, "a", "y", sequence(0))), "20240101000000")
    table.upsert(rows(spark, (2, "a", "z", sequence(1)), (1, "a", "late", sequence(4))), "20240102000000")
    table.upsert(rows(spark, (2, None, None, sequence(2), True), (3, "a", "n", sequence(0))), "20240103000000")
    assert shown(table.incremental("20240101000000")) == [(3, "a", "n")]
    with_deletes = table.incremental("20240101000000", include_deletes=True)
    assert shown(with_deletes, "id", "_is_deleted") == [(2, True), (3, False)]
    assert shown(table.incremental("20240103000000")) == []
    assert len(shown(table.incremental("20231231000000"))) == 2


def test_incremental_of_appended_changes_reads_no_payload_of_the_base(spark, place):
    table = LakeTable(spark, place, spec(table_type=TableType.MERGE_ON_READ))
    table.seed(rows(spark, (1, "a", "x", sequence(0))), "20240101000000")
    table.upsert(rows(spark, (1, "a", "y", sequence(1))), "20240102000000")
    text = table.incremental("20240101000000")._jdf.queryExecution().executedPlan().toString()
    schemas = [line.split("ReadSchema: ")[1] for line in text.splitlines() if "FileScan" in line]
    # the changes once in full, and key and ordering of base and changes for the comparison
    assert sorted("place" in schema for schema in schemas) == [False, False, True]


def test_merge_on_read_appends_and_compacts_by_itself(spark, place):
    table = LakeTable(spark, place, spec(table_type=TableType.MERGE_ON_READ, compact_after=3))
    table.seed(rows(spark, (1, "a", "v0", sequence(0))))
    for number in (1, 2):
        table.upsert(rows(spark, (1, "a", f"v{number}", sequence(number))))
        assert shown(table.read_optimized()) == [(1, "a", "v0")]
        assert shown(table.snapshot()) == [(1, "a", f"v{number}")]
    table.upsert(rows(spark, (1, "a", "v3", sequence(3))))
    assert shown(table.read_optimized()) == [(1, "a", "v3")]
    assert not any(p.pending for p in table.state().parts.values())


def test_compaction_purges_old_deletes_only(spark, place):
    table = LakeTable(spark, place, spec(table_type=TableType.MERGE_ON_READ))
    table.seed(rows(spark, (1, "a", "x", sequence(0)), (2, "a", "y", sequence(0))), "20240101000000")
    table.upsert(rows(spark, (1, None, None, sequence(1), True)), "20240102000000")
    table.upsert(rows(spark, (2, None, None, sequence(1), True)), "20240103000000")
    table.compact("20240104000000", purge_before="20240103000000")
    assert shown(table.snapshot(include_deletes=True), "id", "_is_deleted") == [(2, True)]


@BOTH_TYPES
def test_deletes_are_forgotten_when_the_feed_is(spark, place, table_type):
    table = LakeTable(spark, place, spec(table_type=table_type, compact_after=1))
    table.seed(rows(spark, (1, "a", "x", sequence(0)), (2, "a", "y", sequence(0))), "20240101000000")
    table.upsert(rows(spark, (1, None, None, sequence(5), True)), "20240102000000")
    table.upsert(rows(spark, (2, "a", "z", sequence(1))), "20990109000000")
    if table_type is TableType.COPY_ON_WRITE:
        table.upsert(rows(spark, (2, "a", "z", sequence(2))), "20990110000000")
    assert shown(table.snapshot(include_deletes=True), "id", "_is_deleted") == [(2, False)]


def test_old_versions_are_cleaned_after_commits(spark, place):
    table = LakeTable(spark, place, spec(kept_commits=2))
    table.seed(rows(spark, (1, "a", "v0", sequence(0))))
    for number in range(1, 5):
        table.upsert(rows(spark, (1, "a", f"v{number}", sequence(number))))
    assert len(storage.children(spark, f"{place}/base")) == 2
    assert len(table.log.numbers()) == 2
    assert table.stale_folders() == []
    assert shown(table.snapshot()) == [(1, "a", "v4")]


def test_a_hot_partition_is_written_by_several_tasks(spark, place):
    """One partition holds most rows: the rebalanced write cuts it into several files."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(0, 40000, numPartitions=8).selectExpr(
            "CAST(id AS int) AS id",
            "CASE WHEN id < 30000 THEN 'hot' ELSE concat('p', id % 4) END AS place",
            "sha2(CAST(id AS string), 256) AS value",
            f"'{sequence(0)}' AS trx_seq",
            "false AS _is_deleted",
        )
        table = LakeTable(spark, place, spec(partition_by=("place",)))
        table.seed(hot)
        files = table.snapshot().where("place = 'hot'").inputFiles()
        assert len([f for f in files if "place=hot" in f]) > 3
        assert table.snapshot().count() == 40000
        # the same for a batch and a shuffled merge, as far as the tasks before the write go (two or more here)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        table.upsert(hot.withColumn("trx_seq", F.lit(sequence(1))), "20990101000000")
        for kind in ("changes", "base"):
            assert len(storage.children(spark, f"{place}/{kind}/tidemark_version=20990101000000000/place=hot")) > 1
        assert table.snapshot().count() == 40000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clustered_files_hold_ranges_even_of_one_value(spark, place, monkeypatch):
    import tidemark.tables.lake_table as module

    monkeypatch.setattr(module, "tasks_for", lambda stored: 4)
    table = LakeTable(spark, place, spec())
    table.seed(
        spark.range(8000).selectExpr(
            "CAST(id AS int) AS id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS string) END AS place",
            "'v' AS value", f"'{sequence(0)}' AS trx_seq", "false AS _is_deleted",
        )
    )
    table.cluster(["place"])
    per_file = (
        table.snapshot()
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.count("*").alias("n"), F.min("place").alias("low"), F.max("place").alias("high"))
        .orderBy("low", "high")
        .collect()
    )
    assert len(per_file) == 4 and max(r["n"] for r in per_file) < 4000
    assert all(a["high"] <= b["low"] for a, b in zip(per_file, per_file[1:]))


def test_commit_records_survive_a_round_trip_and_instants_grow(spark, place):
    table = LakeTable(spark, place, spec(partition_by=("place",)))
    table.seed(rows(spark, (1, "a", "x", sequence(0))), read_up_to={"other": "20240101000000000"})
    state = table.state()
    assert Commit.from_json(state.to_json()) == state
    late = state.next("20991231235959999", "upsert")
    assert next_instant(late) == "21000101000000000"
    with pytest.raises(ValueError, match="not later"):
        next_instant(late, "20240101000000")
    with pytest.raises(ValueError):
        next_instant(None, "20241399000000")


def test_a_seed_holds_every_key_once_and_none_without_a_value(spark, place):
    spec = TableSpec("t", ("id",), ordering="seq")
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 5), (2, "x", 1), (2, "y", 1)], "id int, val string, seq int")
    batch = spark.createDataFrame([(1, "new", 3), (2, "new", 3)], "id int, val string, seq int")
    found = []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            table = LakeTable(spark, f"{place}/{limit}", spec)
            table.seed(rows)
            table.upsert(batch)
            found.append(sorted(tuple(r) for r in table.snapshot().select("id", "val", "seq").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found[0] == found[1] == [(1, "b", 5), (2, "new", 3)]
    with pytest.raises(Exception, match="NULL in key column id"):
        LakeTable(spark, f"{place}/null", spec).seed(spark.createDataFrame([(None, "a", 1)], "id int, val string, seq int"))


def test_the_name_of_a_version_folder_is_reserved(spark, place):
    rows = spark.sql("SELECT 1 AS id, 1 AS seq, 'x' AS TIDEMARK_VERSION")
    with pytest.raises(ValueError, match="may not be called"):
        LakeTable(spark, place, TableSpec("t", ("id",), ordering="seq")).seed(rows)


def test_a_replacing_seed_forgets_what_was_read(spark, place):
    table = LakeTable(spark, place, TableSpec("t", ("id",), ordering="seq"))
    rows = spark.sql("SELECT 1 AS id, 1 AS seq")
    table.seed(rows)
    table.upsert(rows.withColumn("seq", F.lit(2)), source=("s", 0))
    table.seed(rows, replace=True)
    table.upsert(rows.withColumn("seq", F.lit(3)), source=("s", 0))
    assert table.snapshot().first()["seq"] == 3


@BOTH_TYPES
def test_a_batch_of_unique_keys_is_not_combined_again(spark, place, table_type, monkeypatch):
    table = LakeTable(spark, f"{place}/things", spec(table_type=table_type))
    table.seed(rows(spark, (1, "a", "old", sequence(1)), (2, "a", "stays", sequence(1))), unique_keys=True)
    combined = []
    real = lake_table.precombine
    monkeypatch.setattr(lake_table, "precombine", lambda *a, **k: combined.append(a) or real(*a, **k))
    table.upsert(rows(spark, (1, "b", "new", sequence(2)), (3, "c", "came", sequence(2))), unique_keys=True)
    assert not combined
    assert shown(table.snapshot()) == [(1, "b", "new"), (2, "a", "stays"), (3, "c", "came")]
