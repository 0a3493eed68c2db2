"""The raw zone: extracts, change envelopes, landing, conforming, drift, discovery, quarantine, transformers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import DELETED, OP, SEQUENCE, change_envelope
from tidemark.functions.envelope import full_load_envelope as with_envelope
from tidemark.operators.quarantine import REASON, split
from tidemark.operators.schema import conform, drift_report
from tidemark.operators.transform import apply_callable, apply_sql
from tidemark.queries import feeds
from tidemark.queries.registry import load, query
from tidemark.queries.tables import raw_database
from tidemark.sinks.landing import land_changes, land_full_extract, last_day, unexpired
from tidemark.sources.jdbc import slice_number
from tidemark.sources.raw_zone import (
    FULL,
    INCREMENTAL,
    discover,
    matches,
    raw_folder,
    read_changes,
    read_extract,
    register,
    with_provenance,
)
from tidemark.sources.schemas import read_merged
from tidemark.workspace import new_folder

_SLICES = 16


@query(f"""
WITH bounds AS (SELECT min(o_orderkey) AS low, max(o_orderkey) + 1 AS high FROM orders),
edges AS (SELECT low + (high - low) * i // {_SLICES} AS edge FROM bounds, range(1, {_SLICES}) r(i))
SELECT o_orderkey, o_custkey, o_totalprice,
       CAST((SELECT count(*) FROM edges WHERE edge <= o_orderkey) AS INTEGER) AS slice
FROM orders""")
def jdbc_slices(spark: SparkSession, folder: str) -> DataFrame:
    """The slice of a parallel extract that reads each order, for slices cut between the key's bounds."""
    orders = load(spark, folder, "orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey") + 1).first()
    slices = slice_number("o_orderkey", low, high, _SLICES)
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", slices.alias("slice"))


@query("""
SELECT 'I' AS "Op", *, '20240101000000000000000000000000000' AS trx_seq, false AS _is_deleted FROM orders""")
def full_load_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """A full extract in the shape of the change feed, landed and read back."""
    target = raw_folder(new_folder(spark, "raw"), FULL, "shop/public/orders")
    land_full_extract(with_envelope(load(spark, folder, "orders"), feeds.STARTED), target)
    return read_extract(spark, target)


@query("""
SELECT CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS "Op",
       event_id, user_id, event_type, value,
       props, strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST(event_id AS VARCHAR), 21, '0') AS trx_seq,
       event_type = 'error' AS _is_deleted
FROM events""")
def cdc_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a change feed: operation letter, fixed-width change sequence and delete flag."""
    return _event_changes(spark, folder).select(
        OP, "event_id", "user_id", "event_type", "value", "props", SEQUENCE, DELETED
    )


def _event_changes(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    kind = F.col("event_type")
    op = F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U")
    changes = events.withColumns({"op": op, "changed_at": F.col("ts"), "counter": F.col("event_id")})
    return change_envelope(changes, "op", "changed_at", "counter")


@query("""
SELECT event_id, user_id, event_type, value, props, date_trunc('milliseconds', ts) AS ts,
       CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS dt
FROM events""")
def cdc_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Changes landed as compressed files in day folders, times in milliseconds."""
    target = raw_folder(new_folder(spark, "raw"), INCREMENTAL, "shop/public/events")
    land_changes(_event_changes(spark, folder), target, "ts")
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value", "props", "ts", "dt")


@query("SELECT * FROM lineitem")
def multi_dir_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Physical partitions landed in folders of their own, read as one logical table."""
    target = raw_folder(new_folder(spark, "raw"), INCREMENTAL, "shop/public/order_line")
    lines = load(spark, folder, "lineitem")
    physical = lines.withColumn("order_line_part", F.lower("l_returnflag"))
    physical.write.partitionBy("order_line_part").parquet(target)
    return read_changes(spark, target, lines.schema)


@query(f"""
WITH {feeds.FEED_SQL}
SELECT "Op", o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN batch = 0 THEN o_orderpriority END AS o_orderpriority, trx_seq, _is_deleted
FROM changes""")
def schema_conform(spark: SparkSession, folder: str) -> DataFrame:
    """Change rows with a missing, a retyped, an unknown and reordered columns, brought to the full load's shape."""
    full = with_envelope(load(spark, folder, "orders"), feeds.STARTED)
    changes = feeds.batch(spark, folder, 1).unionByName(feeds.batch(spark, folder, 2))
    drifted = changes.select(
        SEQUENCE,
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.lit("web").alias("o_channel"),
        "o_totalprice",
        "o_orderkey",
        "o_orderdate",
        "o_orderstatus",
        DELETED,
        OP,
    )
    return conform(full, full.schema).unionByName(conform(drifted, full.schema))


@query("""
SELECT 'orders' AS table_name, 'o_orderpriority' AS column_name, 'removed' AS change,
       'string' AS registered_type, CAST(NULL AS VARCHAR) AS found_type, count(*) AS n_rows, 0 AS n_filled
FROM orders
UNION ALL
SELECT 'orders', 'o_custkey', 'retyped', 'bigint', 'string', count(*), count(*) FROM orders
UNION ALL
SELECT 'orders', 'o_urgent', 'added', NULL, 'boolean', count(*),
       count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END)
FROM orders""")
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """How landed files differ from the registered schema, and how many rows each difference fills."""
    target = raw_folder(new_folder(spark, "raw"), FULL, "shop/public/orders")
    orders = load(spark, folder, "orders")
    drifted = orders.withColumns(
        {
            "o_custkey": F.col("o_custkey").cast("string"),
            "o_urgent": F.when(F.col("o_orderpriority") == "1-URGENT", True),
        }
    ).drop("o_orderpriority")
    land_full_extract(drifted, target)
    return drift_report(read_extract(spark, target), orders.schema, "orders")


@query("""
SELECT *, 'shop' AS source_db, 'public' AS schema_name, 'customer' AS table_name,
       'shop_public_customer' AS target_table, 'lake' AS target_db, true AS from_parquet
FROM customer""")
def provenance_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Source tags and the file of origin on every row."""
    target = raw_folder(new_folder(spark, "raw"), FULL, "shop/public/customer")
    land_full_extract(load(spark, folder, "customer"), target)
    tagged = with_provenance(
        read_extract(spark, target),
        source_db="shop",
        schema_name="public",
        table_name="customer",
        target_table="shop_public_customer",
        target_db="lake",
    )
    return tagged.select(
        *load(spark, folder, "customer").columns,
        "source_db",
        "schema_name",
        "table_name",
        "target_table",
        "target_db",
        F.col("source_file").endswith(".parquet").alias("from_parquet"),
    )


@query("""
SELECT 'order_line' AS table_name, l_orderkey AS record, l_linenumber AS part FROM lineitem
UNION ALL SELECT 'orders', o_orderkey, 0 FROM orders""")
def table_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a mixed feed whose schema and table match a selection rule."""

    def tagged(name: str, schema: str, table: str, record: str, part=F.lit(0)) -> DataFrame:
        return load(spark, folder, name).select(
            F.lit(schema).alias("schema_name"),
            F.lit(table).alias("table_name"),
            F.col(record).cast("long").alias("record"),
            part.cast("int").alias("part"),
        )

    mixed = [
        tagged("orders", "public", "orders", "o_orderkey"),
        tagged("lineitem", "public", "order_line", "l_orderkey", F.col("l_linenumber")),
        tagged("customer", "public", "customer", "c_custkey"),
        tagged("orders", "audit", "orders", "o_orderkey"),
        tagged("part", "public", "orderXbook", "p_partkey"),
    ]
    chosen = matches(F.col("table_name"), "order_%", "public", F.col("schema_name")) | matches(
        F.col("table_name"), "orders", "public", F.col("schema_name")
    )
    return reduce(DataFrame.unionByName, mixed).where(chosen).drop("schema_name")


@query(f"""
WITH {feeds.FEED_SQL}
SELECT 'full_shop_public_customer' AS table_name, 5 AS n_columns, count(*) AS n_rows FROM customer
UNION ALL SELECT 'full_shop_public_orders', 9, count(*) FROM orders
UNION ALL SELECT 'full_shop_audit_orders', 3, count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'incr_shop_public_orders', 9, count(*) FROM changes WHERE batch = 1""")
def bronze_discovery(spark: SparkSession, folder: str) -> DataFrame:
    """Tables found below the raw zone and registered: their columns, and their rows through the catalog."""
    root = new_folder(spark, "raw")
    orders = with_envelope(load(spark, folder, "orders"), feeds.STARTED)
    land_full_extract(orders, raw_folder(root, FULL, "shop/public/orders"))
    land_full_extract(load(spark, folder, "customer"), raw_folder(root, FULL, "shop/public/customer"))
    audited = load(spark, folder, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    land_full_extract(audited, raw_folder(root, FULL, "shop/audit/orders"))
    changes = feeds.batch(spark, folder, 1)
    changes.write.parquet(raw_folder(root, INCREMENTAL, "shop/public/orders") + "/20240102")
    changes.select(OP).write.parquet(raw_folder(root, INCREMENTAL, "shop/control_tables/status"))
    database = raw_database(spark, root)
    found = discover(spark, root, FULL) + discover(spark, root, INCREMENTAL)
    sizes = [
        spark.table(register(spark, t, database)).agg(
            F.lit(t.name).alias("table_name"),
            F.lit(len(t.schema)).alias("n_columns"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        for t in found
    ]
    return reduce(DataFrame.unionByName, sizes)


@query("""
WITH days AS (
  SELECT o_orderkey, o_orderstatus, CAST(o_custkey AS DECIMAL(20,0)) AS customer, CAST(NULL AS VARCHAR) AS note,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS seen, CAST(o_orderkey AS VARCHAR) AS mark
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, NULL, o_custkey, o_orderpriority, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT o_orderkey, o_orderstatus, o_custkey, NULL, o_orderdate, NULL FROM orders WHERE o_orderstatus = 'P'
)
SELECT 'incr_shop_public_orders' AS table_name,
       'o_orderkey:bigint o_orderstatus:string customer:decimal(20,0) seen:timestamp_ntz mark:string note:string' AS columns,
       o_orderkey, o_orderstatus, CAST(customer AS BIGINT) AS customer, note, seen, mark
FROM days""")
def discover_merged_schema(spark: SparkSession, folder: str) -> DataFrame:
    """A table whose days gained and lost columns and widened types: its common schema, and its rows under that schema."""
    root = new_folder(spark, "raw")
    place = raw_folder(root, INCREMENTAL, "shop/public/orders")
    orders, key, customer = load(spark, folder, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    status, day, seen = F.col("o_orderstatus"), F.col("o_orderdate").cast("date"), F.col("o_orderdate")
    first = orders.where(status == "F").select(key.cast("int"), status, customer.cast("int").alias("customer"), day.alias("seen"), key.cast("int").alias("mark"))
    second = orders.where(status == "O").select(key, customer.alias("customer"), seen.alias("seen"), F.col("o_orderpriority").alias("mark"), F.col("o_orderpriority").alias("note"))
    third = orders.where(status == "P").select(key, status, customer.cast("decimal(12,0)").alias("customer"), seen.alias("seen"))
    for name, rows in (("20240101", first), ("20240102", second), ("20240103", third)):
        rows.write.parquet(f"{place}/{name}")
    (found,) = discover(spark, root, INCREMENTAL, merge_files=1000)
    kinds = " ".join(f"{f.name}:{f.dataType.simpleString()}" for f in found.schema)
    rows = read_merged(spark, found.folder)
    return rows.select(
        F.lit(found.name).alias("table_name"),
        F.lit(kinds).alias("columns"),
        "o_orderkey",
        "o_orderstatus",
        F.col("customer").cast("bigint").alias("customer"),
        "note",
        "seen",
        "mark",
    )


@query("""
WITH broken AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS o_orderkey,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'seq' || o_orderkey END AS trx_seq,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey
  FROM orders)
SELECT o_orderkey, trx_seq, TRY_CAST(o_custkey AS BIGINT) AS o_custkey,
       CASE WHEN o_orderkey IS NULL THEN 'null key o_orderkey'
            WHEN trx_seq IS NULL THEN 'null ordering trx_seq'
            WHEN o_custkey = 'n/a' THEN 'not a bigint: o_custkey' END AS quarantine_reason
FROM broken""")
def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without key, without sequence or with unreadable numbers are set aside with the reason."""
    priority = F.col("o_orderpriority")
    broken = load(spark, folder, "orders").select(
        F.when(priority != "5-LOW", F.col("o_orderkey")).alias("o_orderkey"),
        F.when(priority != "4-NOT SPECIFIED", F.concat(F.lit("seq"), F.col("o_orderkey"))).alias("trx_seq"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
    )
    good, set_aside = split(broken, ["o_orderkey"], "trx_seq", {"o_custkey": "bigint"})
    good = good.withColumn(REASON, F.lit(None).cast("string"))
    return good.unionByName(set_aside.withColumn("o_custkey", F.col("o_custkey").try_cast("bigint")))


@query("""
SELECT o_orderkey, o_totalprice, upper(o_orderstatus) || '/' || o_orderpriority AS lane,
       coalesce(c_mktsegment, 'NONE') AS segment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def sql_transformer(spark: SparkSession, folder: str) -> DataFrame:
    """User SQL over a batch and one more relation."""
    text = """
        SELECT o_orderkey, o_totalprice, concat(upper(o_orderstatus), '/', o_orderpriority) AS lane,
               coalesce(c_mktsegment, 'NONE') AS segment
        FROM <SRC> LEFT JOIN {customer} ON o_custkey = c_custkey"""
    return apply_sql(feeds.batch(spark, folder, 0), text, customer=load(spark, folder, "customer"))


def urgent_first(batch: DataFrame) -> DataFrame:
    """A transformer of a table spec: a rank in front of the priority text."""
    return batch.withColumn("rank", F.substring("o_orderpriority", 1, 1).cast("int")).drop("o_orderpriority")


@query(f"""
WITH {feeds.FEED_SQL}
SELECT o_orderkey, o_totalprice, trx_seq, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS rank
FROM changes""")
def callable_transformer(spark: SparkSession, folder: str) -> DataFrame:
    """User code over a batch: a function from DataFrame to DataFrame."""
    changed = apply_callable(feeds.feed(spark, folder), urgent_first)
    return changed.select("o_orderkey", "o_totalprice", SEQUENCE, "rank")


@query("""
SELECT event_id, user_id, date_trunc('milliseconds', ts) AS ts FROM events
WHERE ts >= (SELECT date_trunc('day', max(ts)) FROM events) - INTERVAL 8 DAY""")
def expire_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The changes still kept eight days before the last day; older folders are not read."""
    target = raw_folder(new_folder(spark, "raw"), INCREMENTAL, "shop/public/events")
    land_changes(_event_changes(spark, folder), target, "ts")
    kept = unexpired(spark.read.parquet(target), last_day(spark, target))
    return kept.select("event_id", "user_id", "ts")
