"""Extracts, envelopes, landing, discovery, conforming, quarantine and transformers."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.envelope import change_envelope, full_load_envelope, full_load_sequence
from tidemark.functions.keys import joined_key, partition_path, record_key
from tidemark.operators.quarantine import REASON, refuse_above, split
from tidemark.operators.schema import ADDED, REMOVED, RETYPED, conform, drift, drift_report
from tidemark.operators.transform import apply_sql, transformed
from tidemark.sinks.landing import expire_changes, land_change_stream, land_changes, last_day, unexpired
from tidemark.sources.jdbc import jdbc_options, slice_edges, slice_number, slice_predicates
from tidemark.sources.raw_zone import discover, matches, read_changes, register, selects, stream_changes
from tidemark.spec import TableSpec
from tidemark.tables.catalog import create_database

URL = "jdbc:postgresql://db/shop"


def test_jdbc_reads_the_table_unless_told_otherwise():
    assert jdbc_options("public.orders", URL) == {"url": URL, "fetchsize": "10000", "dbtable": "public.orders"}
    named = jdbc_options("public.orders", URL, {"dbtable": "public.orders_v2", "fetchSize": 5, "sessionInitStatement": "x"})
    assert named == {"url": URL, "dbtable": "public.orders_v2", "fetchSize": "5", "sessionInitStatement": "x"}
    assert "dbtable" not in jdbc_options("public.orders", URL, {"query": "select 1"})


def test_a_sliced_query_becomes_a_derived_table():
    slicing = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 300, "numPartitions": 30}
    options = jdbc_options("public.t", URL, {"query": "select id from t", **slicing})
    assert options["dbtable"] == "(select id from t) extract" and "query" not in options
    with pytest.raises(ValueError, match="slicing needs all"):
        jdbc_options("public.t", URL, {"partitionColumn": "id"})
    with pytest.raises(ValueError, match="either query or dbtable"):
        jdbc_options("public.t", URL, {"query": "q", "dbtable": "d"})


def test_slices_cover_every_row_once(spark):
    """Bounds set the width only: values outside them and NULL are read too."""
    values = spark.createDataFrame([(None,), (-5,), (0,), (9,), (10,), (49,), (50,), (1124,)], "id int")
    predicates = slice_predicates("id", 0, 50, 5)
    assert len(predicates) == 5
    read = [values.where(p).count() for p in predicates]
    assert sum(read) == 8 and read[0] == 4 and read[-1] == 3
    numbered = values.select("id", slice_number("id", 0, 50, 5).alias("slice"))
    for number, predicate in enumerate(predicates):
        assert numbered.where(predicate).where(F.col("slice") != number).count() == 0
    assert slice_edges(0, 3, 30) == [1, 2]
    assert slice_predicates("id", 7, 7, 4) == ["1 = 1"]


def test_the_full_load_envelope_is_nullable_and_fixed_width(spark):
    enveloped = full_load_envelope(spark.range(1), datetime(2024, 1, 2, 3, 4, 5))
    assert enveloped.columns == ["Op", "id", "trx_seq", "_is_deleted"]
    assert all(enveloped.schema[c].nullable for c in ("Op", "trx_seq", "_is_deleted"))
    assert tuple(enveloped.first()) == ("I", 0, "20240102030405" + "0" * 21, False)
    assert len(full_load_sequence(datetime(2024, 1, 1))) == 35


def test_change_sequences_sort_as_text(spark):
    feed = spark.sql(
        "SELECT * FROM VALUES ('U', timestamp_ntz '2024-01-01 00:00:00', 9, 1), "
        "('D', timestamp_ntz '2024-01-01 00:00:00', 10, 1), (NULL, timestamp_ntz '2023-12-31 23:59:59', 999, 1) "
        "AS t(op, at, n, id)"
    )
    rows = change_envelope(feed, "op", "at", "n").orderBy("trx_seq").collect()
    assert [r["Op"] for r in rows] == [None, "U", "D"]
    assert [r["_is_deleted"] for r in rows] == [False, False, True]
    assert {len(r["trx_seq"]) for r in rows} == {35}


def test_key_texts(spark):
    row = spark.sql("SELECT 1 AS a, 'x' AS b, CAST(NULL AS string) AS c")
    got = row.select(
        record_key(["a"]), record_key(["a", "b"]), joined_key("a", "b"), joined_key("a", "c"), partition_path(["a", "c"])
    ).first()
    assert tuple(got) == ("1", "a:1,b:x", "1-x", None, "a=1/c=__HIVE_DEFAULT_PARTITION__")


def test_landed_changes_are_dated_compressed_and_cut_to_milliseconds(spark, place):
    rows = spark.sql(
        "SELECT id, timestampadd(HOUR, CAST(id AS int), timestamp_ntz '2024-01-01 00:00:00.123456') AS at FROM range(72)"
    )
    land_changes(rows, place, "at", rows_per_file=5)
    back = spark.read.parquet(place)
    assert sorted(r["dt"] for r in back.select("dt").distinct().collect()) == [20240101, 20240102, 20240103]
    assert back.where("date_format(at, 'SSSSSS') <> '123000'").count() == 0
    assert all(f.endswith(".gz.parquet") for f in back.inputFiles())
    kept = unexpired(spark.read.parquet(place), date(2024, 1, 3), kept_days=1)
    assert kept.count() == 48
    assert "PartitionFilters: [(isnull(dt" in kept._jdf.queryExecution().executedPlan().toString()
    assert expire_changes(spark, place, date(2024, 1, 3), kept_days=1) == ["dt=20240101"]
    assert spark.read.parquet(place).count() == 48


def test_a_change_stream_lands_the_same_files(spark, place):
    rows = spark.sql("SELECT id, timestamp_ntz '2024-01-01 00:00:00' AS at FROM range(10)")
    rows.write.parquet(f"{place}/in/a")
    stream = stream_changes(spark, f"{place}/in", rows.schema)
    query = land_change_stream(stream, f"{place}/out", f"{place}/checkpoint", "at", {"availableNow": True})
    query.awaitTermination()
    assert spark.read.parquet(f"{place}/out").select("id", "dt").distinct().count() == 10


def test_discovery_skips_control_tables_and_selects_by_pattern(spark, place):
    spark.range(3).write.parquet(f"{place}/full/shop/public/orders")
    spark.range(2).write.parquet(f"{place}/full/shop/public/customer")
    spark.range(1).write.parquet(f"{place}/full/shop/control_tables/status")
    spark.range(4).write.parquet(f"{place}/incremental/shop/public/orders/20240101/a")
    spark.range(5).write.parquet(f"{place}/incremental/shop/public/orders/20240102/b")
    assert [t.name for t in discover(spark, place, "full")] == ["full_shop_public_customer", "full_shop_public_orders"]
    assert [t.name for t in discover(spark, place, "full", "ord%")] == ["full_shop_public_orders"]
    (changes,) = discover(spark, place, "incremental")
    create_database(spark, "raw_test", f"{place}/db")
    assert spark.table(register(spark, changes, "raw_test")).count() == 9
    assert read_changes(spark, changes.folder).count() == 9


def test_selection_pattern():
    assert selects("order_line", "order%") and selects("a.b", "a.b") and not selects("axb", "a.b")
    assert selects("anything", "%") and not selects("orders", "order")


def test_conform_reorders_fills_casts_and_leaves_out(spark):
    schema = spark.sql("SELECT 1L AS id, 'x' AS name, CAST(1.5 AS decimal(9,2)) AS price").schema
    got = conform(spark.sql("SELECT 'more' AS extra, '7' AS id"), schema)
    assert got.columns == ["id", "name", "price"] and tuple(got.first()) == (7, None, None)
    assert [f.dataType for f in got.schema] == [f.dataType for f in schema]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(spark.sql("SELECT 'seven' AS id"), schema).collect()


def test_drift_names_every_difference(spark):
    registered = spark.sql("SELECT 1 AS a, 'x' AS b, true AS c").schema
    found = spark.sql("SELECT 'y' AS d, 1L AS a, true AS c")
    assert drift(found.schema, registered) == [
        ("a", RETYPED, "int", "bigint"),
        ("b", REMOVED, "string", None),
        ("d", ADDED, None, "string"),
    ]
    report = {r["column_name"]: (r["n_rows"], r["n_filled"]) for r in drift_report(found, registered, "t").collect()}
    assert report == {"a": (1, 1), "b": (1, 0), "d": (1, 1)}
    assert drift_report(found, found.schema, "t").count() == 0


def test_quarantine_names_the_first_reason_and_keeps_the_row(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1, 's', '5', '2024-01-01'), (NULL, NULL, 'x', NULL), (2, NULL, '5', NULL), "
        "(3, 's', '5x', NULL), (4, 's', NULL, 'no day') AS t(id, seq, n, day)"
    )
    good, bad = split(rows, ["id"], "seq", {"n": "int", "day": "date"})
    assert [tuple(r) for r in good.collect()] == [(1, "s", 5, date(2024, 1, 1))]
    reasons = sorted(r[REASON] for r in bad.collect())
    assert reasons == ["not a date: day", "not a int: n", "null key id", "null ordering seq"]
    assert good.count() + bad.count() == rows.count()
    checks = (["id"], "seq", {"n": "int", "day": "date"})
    refuse_above(rows, 0.8, *checks)
    with pytest.raises(ValueError, match="4 of 5 rows"):
        refuse_above(rows, 0.5, *checks)


def test_transformers_of_a_spec(spark):
    batch = spark.range(3)
    doubled = TableSpec("t", ("id",), transformer_sql="SELECT id, id * 2 AS twice FROM <SRC>",
                        transformer=lambda rows: rows.where("twice > 0"))
    assert [tuple(r) for r in transformed(batch, doubled).orderBy("id").collect()] == [(1, 2), (2, 4)]
    with pytest.raises(ValueError, match="<SRC>"):
        apply_sql(batch, "SELECT 1")


def test_undated_rows_are_kept_and_bare_day_folders_expire(spark, place):
    rows = spark.sql("SELECT id, CASE WHEN id > 0 THEN timestamp_ntz '2024-01-09 00:00:00' END AS at FROM range(3)")
    land_changes(rows, place, "at")
    assert last_day(spark, place) == date(2024, 1, 9)
    assert unexpired(spark.read.parquet(place), date(2024, 2, 9)).count() == 1
    spark.range(1).write.parquet(f"{place}/20200101")
    assert expire_changes(spark, place, date(2024, 1, 9)) == ["20200101"]


def test_both_selection_rules_take_an_underscore_for_itself(spark):
    names = spark.createDataFrame([("order_line",), ("orderXline",)], "name string")
    kept = [r["name"] for r in names.where(matches(F.col("name"), "order_%")).collect()]
    assert kept == [n for n in ("order_line", "orderXline") if selects(n, "order_%")] == ["order_line"]


def test_a_catalog_entry_on_another_folder_is_refused(spark, place):
    create_database(spark, "clash", f"{place}/clash.db")
    for root in ("one", "two"):
        spark.range(3).write.parquet(f"{place}/{root}/full/shop/public/orders")
    first, second = (discover(spark, f"{place}/{root}", "full")[0] for root in ("one", "two"))
    assert register(spark, first, "clash") == register(spark, first, "clash")
    with pytest.raises(ValueError, match="is registered on"):
        register(spark, second, "clash")
