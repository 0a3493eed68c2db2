"""Specs, streams, stages, catalog entries, derived tables and the workspace."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark import LakeTable, TableSpec
from tidemark.operators.merge import INCOMING_WINS
from tidemark.plans.order_line import RETAIL_LAYOUT, Sources, denormalize, denormalize_changes, table_spec
from tidemark.plans.refresh import last_instant, refresh
from tidemark.plans.stages import Lake, continuous, incremental, run_custom_steps, seed
from tidemark.plans.star import Reference, star_join
from tidemark.spec import TableType, load_specs, spec_from_item
from tidemark.streaming.upsert import Feed, merge_batch, run_once, session_for
from tidemark.tables.catalog import create_database, lineage, set_lineage, sync_table
from tidemark.tables.lake_table import COMMIT_TIME
from tidemark import workspace

TABLES = "/root/testdata/sf0.001"


def sequence(number):
    return "20240101000000" + str(number).zfill(21)


def change(spark, number, *values):
    rows = [(op, key, text, sequence(number), op == "D") for op, key, text in values]
    return spark.createDataFrame(rows, "Op string, id int, value string, trx_seq string, _is_deleted boolean")


def shown(table):
    return sorted((r["id"], r["value"]) for r in table.snapshot().collect())


ITEM = {
    "config": "step::system::public.things",
    "identifier": "shop",
    "enabled": True,
    "hudi_config": {"primary_key": "id, part", "watermark": "trx_seq", "is_partitioned": True, "partition_path": "part",
                    "table_type": "MERGE_ON_READ", "transformer_sql": "SELECT * FROM <SRC>", "transformer_class": "a.B"},
    "spark_jdbc_config": {"partitionColumn": "id"},
    "spark_conf": {"jdbc_load": {"spark.executor.cores": "2"}},
}


def test_specs_from_config_documents():
    disabled = {**ITEM, "config": "step::system::public.off", "enabled": False}
    other = {"config": "database::config", "identifier": "shop"}
    specs = load_specs(json.dumps([other, ITEM, disabled]))
    assert list(specs) == ["public.things"]
    spec = specs["public.things"]
    assert spec.keys == ("id", "part") and spec.partition_by == ("part",) and not spec.moves_partitions
    assert spec.table_type is TableType.MERGE_ON_READ and spec.transformer is None
    assert spec.source_folder("shop") == "shop/public/things"
    assert spec.target("shop") == "shop_public_things"
    renamed = spec_from_item({**ITEM, "override_target_table_name": "other"})
    assert renamed.target("shop") == "other" and renamed.source_folder("shop") == "shop/public/things"


@pytest.mark.parametrize(
    ("section", "message"),
    [
        ({"primary_key": ""}, "at least one key"),
        ({"primary_key": "id,id"}, "repeat"),
        ({"primary_key": "trx_seq"}, "cannot be a key"),
        ({"primary_key": "id", "is_partitioned": True}, "partition_path"),
        ({"primary_key": "id", "op": "BULK_INSERT"}, "UPSERT"),
        ({"primary_key": "id", "transformer_class": "no.function"}, "package.module:function"),
    ],
)
def test_bad_specs_are_refused(section, message):
    with pytest.raises(ValueError, match=message):
        spec_from_item({**ITEM, "hudi_config": section})


def test_stages_from_extract_to_live_table(spark, place):
    lake = Lake(f"{place}/raw", f"{place}/keyed", "shop", "shop")
    spec = TableSpec("public.things", ("id",))
    change(spark, 0, ("I", 1, "a"), ("I", 2, "b")).write.parquet(lake.extract(spec))
    seed(spark, lake, spec)
    change(spark, 1, ("U", 1, "a1")).write.parquet(lake.changes(spec) + "/20240101/x")
    incremental(spark, lake, [spec])
    assert shown(lake.table(spark, spec)) == [(1, "a1"), (2, "b")]
    commits = lake.table(spark, spec).state().number
    incremental(spark, lake, [spec])
    assert lake.table(spark, spec).state().number == commits
    change(spark, 2, ("D", 2, "b"), ("I", 3, "c")).write.parquet(lake.changes(spec) + "/20240102/y")
    (stream,) = continuous(spark, lake, [spec], interval="1 second")
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    assert shown(lake.table(spark, spec)) == [(1, "a1"), (3, "c")]
    with pytest.raises(ValueError, match="replace=True"):
        seed(spark, lake, spec)


def test_a_stream_sets_broken_rows_aside(spark, place):
    spec = TableSpec("public.things", ("id",))
    table = LakeTable(spark, f"{place}/table", spec)
    table.seed(change(spark, 0, ("I", 1, "a")))
    rows = change(spark, 1, ("U", 1, "b"), ("I", None, "no key"))
    rows.write.parquet(f"{place}/changes/a")
    feed = Feed(spec, f"{place}/changes", rows.schema, f"{place}/table", f"{place}/cp", quarantine=f"{place}/aside")
    run_once(spark, [feed])
    assert shown(table) == [(1, "b")]
    aside = spark.read.option("recursiveFileLookup", True).parquet(f"{place}/aside").collect()
    assert [(r["value"], r["quarantine_reason"]) for r in aside] == [("no key", "null key id")]


def test_replay_after_a_failure_between_files_and_commit(spark, place, monkeypatch):
    spec = TableSpec("public.things", ("id",), policy=INCOMING_WINS)
    table = LakeTable(spark, f"{place}/table", spec)
    table.seed(change(spark, 0, ("I", 1, "a")))
    batch = change(spark, 1, ("U", 1, "b"), ("I", 2, "n"))
    apply = merge_batch(Feed(spec, "changes", batch.schema, f"{place}/table", f"{place}/cp"), "incremental")
    with monkeypatch.context() as broken:
        broken.setattr(LakeTable, "_publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            apply(batch, 0)
    assert shown(table) == [(1, "a")]
    apply(batch, 0)
    apply(batch, 0)
    assert shown(table) == [(1, "b"), (2, "n")]
    assert table.state().number == 2


def test_catalog_follows_commits(spark, place):
    spec = TableSpec("public.things", ("id",), partition_by=("value",))
    table = LakeTable(spark, f"{place}/t", spec)
    create_database(spark, "catalog_test", f"{place}/db")
    table.seed(change(spark, 0, ("I", 1, "it's 1/2"), ("I", 2, "b")))
    files, view = sync_table(table, "catalog_test", "things")
    assert spark.table(view).count() == 2
    table.upsert(change(spark, 1, ("U", 1, "b"), ("D", 2, None)))
    sync_table(table, "catalog_test", "things")
    assert [tuple(r) for r in spark.table(view).select("id", "value").collect()] == [(1, "b")]
    assert spark.sql(f"SHOW PARTITIONS {files}").count() == 1
    # without the record of the last sync, all partitions are set again
    table.log.remove(table.log.numbers()[:-1])
    table.upsert(change(spark, 2, ("I", 5, "new")))
    table.log.remove(table.log.numbers()[:-1])
    sync_table(table, "catalog_test", "things")
    assert sorted(r["id"] for r in spark.table(view).collect()) == [1, 5]


def test_catalog_of_an_unpartitioned_table_and_lineage(spark, place):
    table = LakeTable(spark, f"{place}/t", TableSpec("public.things", ("id",)))
    create_database(spark, "catalog_plain", f"{place}/db")
    table.seed(change(spark, 0, ("I", 1, "a")))
    sync_table(table, "catalog_plain", "things")
    table.upsert(change(spark, 1, ("U", 1, "it's")))
    files, view = sync_table(table, "catalog_plain", "things")
    assert [r["value"] for r in spark.table(view).collect()] == ["it's"]
    set_lineage(spark, files, ["shop_orders", "it's"])
    assert lineage(spark, files) == ["shop_orders", "it's"]


def retail(spark, lines):
    names = {"orders": "orders", "customer": "customer", "district": "nation", "warehouse": "region", "item": "part"}
    return Sources(order_line=lines, **{k: spark.read.parquet(f"{TABLES}/{v}.parquet") for k, v in names.items()})


def test_full_and_delta_plans_give_the_same_rows(spark):
    lines = spark.read.parquet(f"{TABLES}/lineitem.parquet").withColumn(COMMIT_TIME, F.lit("20240101000000123"))
    full = denormalize(retail(spark, lines), RETAIL_LAYOUT)
    for small in (True, False):
        delta = denormalize_changes(retail(spark, lines), RETAIL_LAYOUT, small)
        assert delta.schema == full.schema
        assert full.exceptAll(delta).count() == 0 and delta.exceptAll(full).count() == 0


def test_a_small_delta_shuffles_none_of_the_other_tables(spark):
    lines = spark.read.parquet(f"{TABLES}/lineitem.parquet").limit(5).withColumn(COMMIT_TIME, F.lit("20240101000000"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        delta = denormalize_changes(retail(spark, lines), RETAIL_LAYOUT, True)
        text = delta._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 5 and "hashpartitioning" not in text


def test_the_fact_is_never_broadcast_and_a_hot_order_is_split(spark):
    """A third of all lines belong to one order: adaptive execution cuts that key in the join of the facts."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = (
            spark.read.parquet(f"{TABLES}/lineitem.parquet")
            .repartition(8)
            .withColumn("l_orderkey", F.expr("CASE WHEN l_partkey < 70 THEN 7 ELSE l_orderkey END"))
            .withColumn(COMMIT_TIME, F.lit("20240101000000"))
        )
        rows = denormalize(retail(spark, lines), RETAIL_LAYOUT)
        assert len(rows.collect()) == 6000
        text = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in text


def test_refresh_by_day_partitions_follows_the_fact(spark, place):
    lines = spark.read.parquet(f"{TABLES}/lineitem.parquet").where("l_orderkey < 60")
    spec = TableSpec("public.order_line", ("l_orderkey", "l_linenumber"), ordering="l_shipdate")
    fact = LakeTable(spark, f"{place}/fact", spec)
    target = LakeTable(spark, f"{place}/gold", table_spec())

    def run():
        return refresh(
            target,
            fact,
            lambda rows: denormalize(retail(spark, rows), RETAIL_LAYOUT),
            lambda rows, small: denormalize_changes(retail(spark, rows), RETAIL_LAYOUT, small),
        )

    fact.seed(lines.where("l_quantity < 25"))
    run()
    fact.upsert(lines.where("l_quantity >= 25"))
    run()
    commits = target.state().number
    run()
    assert target.state().number == commits
    whole = denormalize(retail(spark, fact.snapshot()), RETAIL_LAYOUT)
    derived = target.snapshot().select(whole.columns)
    assert whole.exceptAll(derived).count() == 0 and derived.exceptAll(whole).count() == 0
    assert target.state().parts and all(n.startswith("order_date=") for n in target.state().parts)
    (upto,) = last_instant(fact.snapshot()).first()
    assert upto == target.state().read_up_to["public.order_line"]


def test_refresh_without_a_marker_starts_from_the_greatest_day(spark, place):
    lines = spark.read.parquet(f"{TABLES}/lineitem.parquet").where("l_orderkey < 20")
    spec = TableSpec("public.order_line", ("l_orderkey", "l_linenumber"), ordering="l_shipdate")
    fact = LakeTable(spark, f"{place}/fact", spec)
    target = LakeTable(spark, f"{place}/gold", table_spec(partition_by=()))
    seen = []

    def update(rows, small):
        seen.append((rows.count(), small))
        return denormalize_changes(retail(spark, rows), RETAIL_LAYOUT, small)

    fact.seed(lines, "20240101120000")
    target.seed(denormalize(retail(spark, fact.snapshot()), RETAIL_LAYOUT))
    fact.upsert(lines.withColumn("l_shipdate", F.expr("l_shipdate + interval 1 year")).where("l_orderkey < 5"), "20240102")
    refresh(target, fact, None, update)
    # the day starts at midnight, so the seed of that day is read once more
    assert seen == [(fact.snapshot().count(), True)]
    assert target.state().read_up_to == {"public.order_line": "20240102000000000"}


def test_star_join_on_several_columns(spark):
    left = spark.sql("SELECT 1 AS a, 2 AS b")
    right = spark.sql("SELECT * FROM VALUES (1, 2, 'yes'), (1, 3, 'no') AS t(x, y, z)")
    assert [r["z"] for r in star_join(left, Reference(right, [("a", "x"), ("b", "y")])).collect()] == ["yes"]


def count_rows(spark, path, least):
    return spark.read.parquet(path).where(F.col("id") >= int(least)).count()


def test_custom_steps_run_the_enabled_functions(spark, place):
    spark.range(5).write.parquet(f"{place}/in")
    step = {"config": "step::consumption::count", "enabled": True, "entrypoint": ["test_stages:count_rows", f"{place}/in", "2"]}
    off = {**step, "config": "step::consumption::off", "enabled": False}
    assert run_custom_steps(spark, [step, off, ITEM], "consumption") == {"count": 3}


def test_the_workspace_is_the_shared_folder_of_the_session(spark, monkeypatch, place):
    class Session:
        class conf:
            value = f"{place}/shared/"

            @classmethod
            def get(cls, key, default=None):
                return cls.value if key == "spark.checkpoint.dir" else default

        class sparkContext:
            master = "spark://host:7077"
            applicationId = "app-1"

    assert workspace.new_folder(Session, "x").startswith(f"{place}/shared/tidemark/x-")
    Session.conf.value = None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(Session)
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        workspace.shared_root(Session)


def test_settings_of_a_stage_hold_in_a_session_of_its_own(spark):
    spec = TableSpec("t", ("id",), stage_conf={"x_seed": {"spark.sql.shuffle.partitions": "3"}})
    assert session_for(spark, spec, "seed").conf.get("spark.sql.shuffle.partitions") == "3"
    assert session_for(spark, spec, "incremental") is spark
    fixed = TableSpec("t", ("id",), stage_conf={"x_seed": {"spark.executor.memory": "1g"}})
    with pytest.raises(ValueError, match="when the application starts"):
        session_for(spark, fixed, "seed")


def test_a_batch_that_differs_leaves_a_report(spark, place):
    spec = TableSpec("t", ("id",), ordering="seq")
    feed = Feed(spec, f"{place}/changes", spark.range(1).schema, f"{place}/table", f"{place}/check", drift_reports=f"{place}/drift")
    apply = merge_batch(feed, "incremental")
    apply(spark.sql("SELECT 1 AS id, 1 AS seq, 'kept' AS val"), 0)
    apply(spark.sql("SELECT 1 AS id, 2 AS seq, 'new' AS extra"), 1)
    row = LakeTable(spark, f"{place}/table", spec).snapshot().first()
    assert (row["val"], row["extra"]) == ("kept", "new")
    report = spark.read.parquet(f"{place}/drift/incremental_batch=1").collect()
    assert {(r["column_name"], r["change"]) for r in report} >= {("val", "removed"), ("extra", "added")}
