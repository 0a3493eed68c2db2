"""Precombine and upsert: copy on write and merge on read, both policies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import SEQUENCE, UPDATE, change_envelope
from tidemark.operators.merge import INCOMING_WINS, merge, touched_rows
from tidemark.operators.precombine import precombine
from tidemark.queries import feeds
from tidemark.queries.registry import load, query
from tidemark.spec import FAIL, TableSpec, TableType
from tidemark.tables.lake_table import COMMIT_TIME, LakeTable
from tidemark.workspace import new_folder


def merged_table(spark: SparkSession, folder: str, purpose: str, **spec) -> LakeTable:
    """Seed with batch 0, then upsert batches 1 and 2."""
    table = LakeTable(spark, new_folder(spark, purpose), feeds.order_spec(**spec))
    table.seed(feeds.batch(spark, folder, 0), feeds.SEED)
    table.upsert(feeds.batch(spark, folder, 1), feeds.FIRST)
    table.upsert(feeds.batch(spark, folder, 2), feeds.SECOND)
    return table


@query(feeds.winners_sql("trx_seq DESC", where="true"))
def precombine_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The latest change of every order, deletes included."""
    return precombine(feeds.feed(spark, folder), ["o_orderkey"], SEQUENCE).select(*feeds.RESULT)


@query(f"WITH {feeds.NATURAL_LINES_SQL} SELECT * FROM lines")
def precombine_ties(spark: SparkSession, folder: str) -> DataFrame:
    """One line per (order, line number): equal ship dates are decided by part and supplier."""
    lines = load(spark, folder, "lineitem")
    return precombine(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey", "l_suppkey"])


@query(feeds.LATEST_SQL)
def upsert_latest_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Late, older changes neither revive a deleted order nor undo a newer price."""
    return merged_table(spark, folder, "latest").snapshot().select(*feeds.RESULT)


@query(feeds.INCOMING_SQL)
def upsert_incoming_wins(spark: SparkSession, folder: str) -> DataFrame:
    """The batch that arrives later wins, whatever its sequence."""
    return merged_table(spark, folder, "incoming", policy=INCOMING_WINS).snapshot().select(*feeds.RESULT)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN o_totalprice + 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS o_month,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN '20240102000000000' ELSE '20240101000000000' END
         AS _commit_time
FROM orders""")
def upsert_partition_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of recent orders in a table partitioned by month: older months are neither read nor rewritten."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    spec = feeds.order_spec(partition_by=("o_month",), stable_partition=True)
    table = LakeTable(spark, new_folder(spark, "pruned"), spec)
    orders = feeds.batch(spark, folder, 0).withColumn("o_month", month)
    table.seed(orders, feeds.SEED)
    recent = load(spark, folder, "orders").where("o_orderdate >= timestamp_ntz '2001-01-01'")
    changed = recent.withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + 2,
            "op": F.lit(UPDATE),
            "changed_at": feeds.moment("2024-01-01 00:00:00"),
            "counter": F.lit(2),
            "o_month": month,
        }
    )
    table.upsert(change_envelope(changed, "op", "changed_at", "counter"), feeds.FIRST)
    return table.snapshot().select(*feeds.COLUMNS, "o_month", COMMIT_TIME)


@query("""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'F'
            ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
FROM orders""")
def upsert_moves_partition(spark: SparkSession, folder: str) -> DataFrame:
    """Pending orders get finished in a table partitioned by status: each row leaves its old partition."""
    table = LakeTable(spark, new_folder(spark, "moves"), feeds.order_spec(partition_by=("o_orderstatus",)))
    table.seed(feeds.batch(spark, folder, 0), feeds.SEED)
    finished = load(spark, folder, "orders").where(
        (F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    )
    finished = finished.withColumns(
        {
            "o_orderstatus": F.lit("F"),
            "op": F.lit(UPDATE),
            "changed_at": feeds.moment("2024-01-01 00:00:00"),
            "counter": F.lit(2),
        }
    )
    table.upsert(change_envelope(finished, "op", "changed_at", "counter"), feeds.FIRST)
    return table.snapshot().select(*feeds.COLUMNS)


@query(feeds.LATEST_SQL)
def mor_snapshot_read(spark: SparkSession, folder: str) -> DataFrame:
    """Changes are only appended; the snapshot merges them when it is read."""
    table = merged_table(spark, folder, "mor", table_type=TableType.MERGE_ON_READ)
    return table.snapshot().select(*feeds.RESULT)


@query(feeds.LATEST_SQL)
def compaction_equals_mor(spark: SparkSession, folder: str) -> DataFrame:
    """After compaction the base files alone hold what the merged read showed."""
    table = merged_table(spark, folder, "compacted", table_type=TableType.MERGE_ON_READ)
    table.compact()
    return table.read_optimized().select(*feeds.RESULT)


@query(f"""WITH {feeds.NATURAL_LINES_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_shipdate
FROM lines""")
def seed_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A seed whose keys repeat takes the latest row of each; merges of any size then agree."""
    lines = load(spark, folder, "lineitem")
    table = LakeTable(spark, new_folder(spark, "repeated"), feeds.natural_line_spec())
    table.seed(lines, feeds.SEED)
    returned = table.snapshot().where("l_returnflag = 'R'").drop(COMMIT_TIME)
    table.upsert(returned.withColumn("l_quantity", F.col("l_quantity") + 1), feeds.FIRST)
    return table.snapshot().select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


@query("""
SELECT kind, event_id, event_type, user_id, CASE WHEN event_type = 'click' THEN 'seen' ELSE props END AS v
FROM events, (SELECT unnest(['COPY_ON_WRITE', 'MERGE_ON_READ']) AS kind)""")
def column_called_v(spark: SparkSession, folder: str) -> DataFrame:
    """A source column with the short name ``v`` keeps its own values in both table types."""
    events = load(spark, folder, "events").withColumnRenamed("props", "v")
    found = []
    for kind in TableType:
        spec = TableSpec("public.events", ("event_id",), ordering="ts", table_type=kind)
        table = LakeTable(spark, new_folder(spark, "column"), spec)
        table.seed(events, feeds.SEED)
        table.upsert(events.where("event_type = 'click'").withColumn("v", F.lit("seen")), feeds.FIRST)
        rows = table.snapshot().select("event_id", "event_type", "user_id", "v")
        found.append(rows.withColumn("kind", F.lit(kind.value)))
    return found[0].unionByName(found[1])


@query("""
WITH changed AS (SELECT *, o_orderpriority IN ('1-URGENT', '2-HIGH') AS hit FROM orders)
SELECT kind, o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       CASE WHEN hit THEN o_totalprice + 2 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN hit THEN 'web' END AS o_channel
FROM changed, (SELECT unnest(['COPY_ON_WRITE', 'MERGE_ON_READ']) AS kind)
UNION ALL
SELECT 'refused', 2, NULL, NULL, NULL, NULL, NULL""")
def upsert_drifted_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A batch without some columns keeps their stored values, one with a new column adds it; or both are refused."""
    full = feeds.batch(spark, folder, 0)
    prices = feeds.batch(spark, folder, 1).where("Op = 'U'")
    drifted = prices.drop("o_custkey", "o_orderpriority").withColumn("o_channel", F.lit("web"))
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_channel"]
    found = []
    for kind in TableType:
        table = LakeTable(spark, new_folder(spark, "drifted"), feeds.order_spec(table_type=kind))
        table.seed(full, feeds.SEED)
        table.upsert(drifted, feeds.FIRST)
        found.append(table.snapshot().select(F.lit(kind.value).alias("kind"), *columns))
    refused = 0
    for strict in ({"missing_columns": FAIL}, {"new_columns": FAIL}):
        table = LakeTable(spark, new_folder(spark, "strict"), feeds.order_spec(**strict))
        table.seed(full, feeds.SEED)
        try:
            table.upsert(drifted, feeds.FIRST)
        except ValueError:
            refused += 1
    nothing = [F.lit(None).cast(t).alias(c) for c, t in found[0].dtypes if c not in ("kind", "o_orderkey")]
    told = spark.range(1).select(F.lit("refused").alias("kind"), F.lit(refused).cast("long").alias("o_orderkey"), *nothing)
    return found[0].unionByName(found[1]).unionByName(told)


@query(f"""
WITH {feeds.FEED_SQL}, seeded AS (SELECT *, o_orderstatus AS part FROM changes WHERE batch = 0),
arrived AS (SELECT *, 'P' AS part FROM changes WHERE batch = 2 AND "Op" = 'U' AND o_orderstatus = 'P'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY trx_seq DESC) AS nth
  FROM (SELECT * FROM seeded WHERE part = 'P' UNION ALL SELECT * FROM arrived))
SELECT {feeds.RESULT_SQL} FROM ranked WHERE nth = 1""")
def merge_dynamic_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """The partitions that a batch touches, merged with it: the scan is pruned by the batch while the job runs."""
    place = new_folder(spark, "pruned")
    feeds.batch(spark, folder, 0).write.partitionBy("o_orderstatus").parquet(f"{place}/stored")
    late = feeds.batch(spark, folder, 2).where("Op = 'U' AND o_orderstatus = 'P'")
    late.write.parquet(f"{place}/batch")
    return pruned_merge(spark, f"{place}/stored", f"{place}/batch").select(*feeds.RESULT)


def pruned_merge(spark: SparkSession, stored: str, batch: str) -> DataFrame:
    changes, rows = spark.read.parquet(batch), spark.read.parquet(stored)
    spec = feeds.order_spec(partition_by=("o_orderstatus",), stable_partition=True)
    touched = touched_rows(rows.select(*changes.columns), changes, spec.partition_by, small_batch=True)
    return merge(touched, precombine(changes, spec.keys, spec.ordering), spec.rule, small_batch=False)
