"""Keyed tables: seeding, layout, snapshot and incremental reads, catalog entries, maintenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import DELETED, full_load_envelope
from tidemark.functions.keys import joined_key, partition_path, record_key
from tidemark.plans.order_line import instant_day
from tidemark.plans.refresh import last_instant
from tidemark.plans.sales import sales_by_district_and_day
from tidemark.queries import feeds
from tidemark.queries.gold import raw_database, retail_order_lines
from tidemark.queries.merges import merged_table
from tidemark.queries.registry import load, query
from tidemark.sinks.landing import land_full_extract
from tidemark.spec import TableType
from tidemark.streaming.upsert import seed_from_extract
from tidemark.tables.catalog import create_database, lineage, set_lineage, store_lineage, sync_table
from tidemark.tables.day_folders import SLASH_PATTERN, publish_days, write_days
from tidemark.tables.lake_table import COMMIT_TIME, VERSION, LakeTable
from tidemark.workspace import new_folder, shared_root

DATABASE = "tidemark_checks"


def _database(spark: SparkSession) -> str:
    create_database(spark, DATABASE, f"{shared_root(spark)}/tidemark/{DATABASE}.db")
    return DATABASE


def _unique(folder: str) -> str:
    return folder.rsplit("/", 1)[-1].replace("-", "_")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       'I' AS "Op", '20240101000000000000000000000000000' AS trx_seq, false AS _is_deleted,
       '20240101000000000' AS _commit_time
FROM orders""")
def seed_bulk_insert(spark: SparkSession, folder: str) -> DataFrame:
    """A full extract in the raw zone fills an empty table without a merge."""
    place = new_folder(spark, "seed")
    land_full_extract(full_load_envelope(load(spark, folder, "orders"), feeds.STARTED), f"{place}/full")
    table = seed_from_extract(spark, feeds.order_spec(), f"{place}/full", f"{place}/table", instant=feeds.SEED)
    return table.snapshot()


@query("""
SELECT o_orderkey, 'o_orderstatus=' || o_orderstatus || '/o_month=' || strftime(o_orderdate, '%Y-%m') AS expected,
       'o_orderstatus=' || o_orderstatus || '/o_month=' || strftime(o_orderdate, '%Y-%m') AS stored_in
FROM orders""")
def partition_layout(spark: SparkSession, folder: str) -> DataFrame:
    """The folder each row is stored in, against the path built from its partition columns."""
    place = new_folder(spark, "layout")
    spec = feeds.order_spec(partition_by=("o_orderstatus", "o_month"))
    table = LakeTable(spark, place, spec)
    orders = feeds.batch(spark, folder, 0)
    table.seed(orders.withColumn("o_month", F.date_format("o_orderdate", "yyyy-MM")), feeds.SEED)
    stored = spark.read.parquet(f"{place}/base/{VERSION}={feeds.SEED}")
    stored_in = F.regexp_extract("_metadata.file_path", rf"/{VERSION}=[0-9]+/(.*)/[^/]+$", 1)
    return stored.select(
        "o_orderkey", partition_path(spec.partition_by).alias("expected"), stored_in.alias("stored_in")
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       'l_orderkey:' || l_orderkey || ',l_linenumber:' || l_linenumber AS complex_key,
       CAST(l_orderkey AS VARCHAR) AS simple_key,
       l_orderkey || '-' || l_linenumber || '-' || l_partkey AS joined_key
FROM lineitem""")
def record_key_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Record keys in text form, of one and of several columns."""
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        record_key(["l_orderkey", "l_linenumber"]).alias("complex_key"),
        record_key(["l_orderkey"]).alias("simple_key"),
        joined_key("l_orderkey", "l_linenumber", "l_partkey").alias("joined_key"),
    )


@query(feeds.winners_sql("trx_seq DESC", f"{feeds.RESULT_SQL}, _commit_time"))
def snapshot_read(spark: SparkSession, folder: str) -> DataFrame:
    """Three commits on a partitioned table: the newest version of each partition, deleted rows absent."""
    table = merged_table(spark, folder, "snapshot", partition_by=("o_orderpriority",), stable_partition=True)
    return table.snapshot().select(*feeds.RESULT, COMMIT_TIME)


@query(
    feeds.winners_sql(
        "trx_seq DESC",
        "o_orderkey, trx_seq, _is_deleted, _commit_time, "
        "CASE WHEN NOT _is_deleted THEN o_totalprice END AS o_totalprice",
        "_commit_time > '20240101000000000'",
    )
)
def incremental_read(spark: SparkSession, folder: str) -> DataFrame:
    """What changed after the seed, deleted keys included."""
    table = merged_table(spark, folder, "incremental")
    changed = table.incremental(feeds.SEED, include_deletes=True)
    return changed.select("o_orderkey", "trx_seq", DELETED, COMMIT_TIME, "o_totalprice")


@query("""
SELECT 'last commit' AS instant_of, '20240103000000000' AS instant_time
UNION ALL SELECT 'last commit day', '20240103000000'
UNION ALL SELECT 'last order', strftime(max(o_orderdate), '%Y%m%d%H%M%S') FROM orders""")
def max_instant(spark: SparkSession, folder: str) -> DataFrame:
    """The greatest instants of a table as digits: of a commit, of its day, of an order."""
    rows = merged_table(spark, folder, "instant").snapshot(include_deletes=True)
    rows = rows.withColumn("commit_day", instant_day(F.col(COMMIT_TIME)))
    instants = {
        "last commit": last_instant(rows),
        "last commit day": last_instant(rows, "commit_day"),
        "last order": last_instant(load(spark, folder, "orders"), "o_orderdate"),
    }
    named = [i.select(F.lit(name).alias("instant_of"), "instant_time") for name, i in instants.items()]
    return reduce(DataFrame.unionByName, named)


@query(feeds.LATEST_SQL)
def catalog_sync_merge_on_read(spark: SparkSession, folder: str) -> DataFrame:
    """The view of an unpartitioned merge-on-read table shows what its snapshot shows."""
    place = new_folder(spark, "catalog")
    table = LakeTable(spark, place, feeds.order_spec(table_type=TableType.MERGE_ON_READ))
    database, name = _database(spark), _unique(place)
    table.seed(feeds.batch(spark, folder, 0), feeds.SEED)
    sync_table(table, database, name)
    for number in (1, 2):
        table.upsert(feeds.batch(spark, folder, number))
        _, view = sync_table(table, database, name)
    return spark.table(view).select(*feeds.RESULT)


@query(feeds.LATEST_SQL)
def catalog_sync(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog view after a sync per commit: partitions point to their newest folders."""
    place = new_folder(spark, "catalog")
    spec = feeds.order_spec(partition_by=("o_orderpriority",), stable_partition=True)
    table = LakeTable(spark, place, spec)
    database, name = _database(spark), _unique(place)
    table.seed(feeds.batch(spark, folder, 0), feeds.SEED)
    sync_table(table, database, name)
    table.upsert(feeds.batch(spark, folder, 1), feeds.FIRST)
    sync_table(table, database, name)
    table.upsert(feeds.batch(spark, folder, 2), feeds.SECOND)
    _, view = sync_table(table, database, name)
    return spark.table(view).select(*feeds.RESULT)


@query("""
SELECT 'orders' AS source_table, count(*) AS n_rows FROM orders
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'sales', count(*) FROM (
  SELECT DISTINCT c_nationkey, CAST(o_orderdate AS DATE)
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON o_orderkey = l_orderkey)""")
def lineage_properties(spark: SparkSession, folder: str) -> DataFrame:
    """The source tables stored on a derived table, each with its current size."""
    place = new_folder(spark, "lineage")
    name = f"`{_database(spark)}`.`{_unique(place)}`"
    sales = sales_by_district_and_day(retail_order_lines(spark, folder))
    sales.write.option("path", place).saveAsTable(name, format="parquet")
    set_lineage(spark, name, ["orders", "customer", "lineitem"])
    counts = [
        load(spark, folder, source).agg(F.lit(source).alias("source_table"), F.count(F.lit(1)).alias("n_rows"))
        for source in lineage(spark, name)
    ]
    counts.append(spark.table(name).agg(F.lit("sales").alias("source_table"), F.count(F.lit(1)).alias("n_rows")))
    return reduce(DataFrame.unionByName, counts)


@query(f"WITH {feeds.NATURAL_LINES_SQL} SELECT *, '20240101000000000' AS _commit_time FROM lines")
def cluster_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """A table rewritten in ship-date order holds the same rows."""
    table = LakeTable(spark, new_folder(spark, "cluster"), feeds.natural_line_spec())
    table.seed(load(spark, folder, "lineitem"), feeds.SEED)
    table.cluster(["l_shipdate"], feeds.FIRST)
    return table.snapshot().drop(DELETED)


@query(
    feeds.winners_sql(
        "trx_seq DESC", "_commit_time, count(*) AS n_rows, 0 AS n_stale_folders", "NOT _is_deleted"
    )
    + " GROUP BY _commit_time"
)
def clean_versions(spark: SparkSession, folder: str) -> DataFrame:
    """With all but the last commit cleaned away, the snapshot is still whole."""
    table = merged_table(spark, folder, "clean", partition_by=("o_orderstatus",), stable_partition=True)
    table.clean(retain=1)
    left = len(table.stale_folders(retain=1))
    return table.snapshot().groupBy(COMMIT_TIME).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(left).alias("n_stale_folders")
    )


@query("""
SELECT strftime(ts, '%Y/%m/%d') AS order_date, event_id, user_id,
       CASE WHEN dayofmonth(ts) % 2 = 0 THEN value + 1 ELSE value END AS value
FROM events""")
def slash_day_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Days in plain yyyy/MM/dd folders, half of them written anew and moved in place, read through the catalog."""
    place = new_folder(spark, "days")
    day = F.date_format("ts", SLASH_PATTERN).alias("order_date")
    events = load(spark, folder, "events").select("event_id", "user_id", "value", "ts", day)
    table = f"`{raw_database(spark, place)}`.`events_by_day`"
    schema = "event_id BIGINT, user_id BIGINT, value DOUBLE"
    first = write_days(events.drop("ts"), f"{place}/first", "order_date")
    publish_days(spark, table, schema, "order_date", first, place)
    changed = events.where(F.dayofmonth("ts") % 2 == 0).withColumn("value", F.col("value") + 1)
    publish_days(spark, table, schema, "order_date", write_days(changed.drop("ts"), f"{place}/second", "order_date"), place)
    return spark.table(table).select("order_date", "event_id", "user_id", "value")


@query("""
SELECT unnest(['customer', 'lineitem', 'nation', 'orders', 'part', 'region']) AS source, count(*) AS n_rows
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey""")
def lineage_from_plan(spark: SparkSession, folder: str) -> DataFrame:
    """The six sources of the denormalized order line, found in its plan, stored on the table and read back."""
    place = new_folder(spark, "lineage")
    rows = retail_order_lines(spark, folder)
    table = f"`{raw_database(spark, place)}`.`order_line_dn`"
    rows.write.parquet(f"{place}/rows")
    spark.read.parquet(f"{place}/rows").limit(0).write.option("path", f"{place}/table").saveAsTable(table)
    store_lineage(spark, table, rows)
    names = [source.rsplit("/", 1)[-1].removesuffix(".parquet") for source in lineage(spark, table)]
    sources = spark.createDataFrame([(n,) for n in names], "source string")
    return sources.crossJoin(F.broadcast(spark.read.parquet(f"{place}/rows").agg(F.count(F.lit(1)).alias("n_rows"))))
