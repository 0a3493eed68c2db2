"""Plain day folders in the catalog, partitions that move in place, and sources found in plans."""

from __future__ import annotations

import os

import pytest

from tidemark.functions.envelope import DELETED, SEQUENCE
from tidemark.spec import TableSpec
from tidemark.tables.catalog import create_database, lineage, lineage_of, store_lineage, sync_table
from tidemark.tables.day_folders import publish_days, write_days
from tidemark.tables.lake_table import LakeTable


@pytest.fixture
def statements(spark, monkeypatch):
    seen = []
    original = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (seen.append(text), original(self, text, *a, **k))[1])
    return seen


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id int, day string")


def found(spark, table):
    return sorted((r["id"], r["day"]) for r in spark.table(table).collect())


def test_days_lie_in_plain_folders_and_move_in_place(spark, place, statements):
    create_database(spark, "slash_days", f"{place}/db")
    table = "slash_days.things"
    first = write_days(rows(spark, (1, "1997/01/15"), (2, "1997/01/16"), (3, None)), f"{place}/first", "day")
    assert sorted(first) == ["1997/01/15", "1997/01/16", "undated"]
    assert os.path.isdir(f"{place}/first/1997/01/15") and not [n for n in os.listdir(f"{place}/first") if "=" in n]
    publish_days(spark, table, "id INT", "day", first, place)
    assert found(spark, table) == [(1, "1997/01/15"), (2, "1997/01/16"), (3, "undated")]
    second = write_days(rows(spark, (9, "1997/01/15"), (4, "1997/02/01")), f"{place}/second", "day")
    publish_days(spark, table, "id INT", "day", second, place)
    assert found(spark, table) == [(2, "1997/01/16"), (3, "undated"), (4, "1997/02/01"), (9, "1997/01/15")]
    assert not [s for s in statements if "DROP" in s]
    only = spark.table(table).where("day = '1997/01/15'")
    assert "PartitionFilters: [isnotnull(day" in only._jdf.queryExecution().executedPlan().toString()


def test_live_partitions_of_keyed_tables_are_never_dropped(spark, place, statements):
    create_database(spark, "kept_parts", f"{place}/db")
    table = LakeTable(spark, f"{place}/t", TableSpec("public.t", keys=("id",), partition_by=("p",)))
    change = lambda *r: spark.createDataFrame([(i, p, str(s), False) for i, p, s in r], f"id int, p string, {SEQUENCE} string, {DELETED} boolean")
    table.seed(change((1, "a", 0), (2, "b", 0)))
    sync_table(table, "kept_parts", "things")
    table.upsert(change((1, "a", 1), (3, "c", 1)))
    files, view = sync_table(table, "kept_parts", "things")
    assert sorted((r["id"], r["p"], r[SEQUENCE]) for r in spark.table(view).collect()) == [(1, "a", "1"), (2, "b", "0"), (3, "c", "1")]
    assert [s for s in statements if "SET LOCATION" in s] and not [s for s in statements if "DROP" in s]


def test_sources_are_found_below_views_joins_and_unions(spark, place):
    create_database(spark, "lineage_of_plan", f"{place}/db")
    for name in ("a", "b", "c"):
        spark.range(3).write.mode("overwrite").parquet(f"{place}/{name}")
    spark.sql(f"CREATE TABLE lineage_of_plan.known USING parquet LOCATION '{place}/c'")
    spark.read.parquet(f"{place}/a").createOrReplaceTempView("lineage_view")
    made = spark.sql("SELECT v.id FROM lineage_view v JOIN lineage_of_plan.known k ON v.id = k.id")
    made = made.union(spark.read.parquet(f"{place}/b")).union(spark.range(2)).union(spark.read.parquet(f"{place}/a"))
    assert lineage_of(made) == sorted([f"{place}/a", f"{place}/b", "spark_catalog.lineage_of_plan.known"])
    assert store_lineage(spark, "lineage_of_plan.known", made) == lineage(spark, "lineage_of_plan.known")
