"""Streaming upserts: run once, continuous, replayed, out of order, overlapping a full load, rebuilt."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import SEQUENCE, UPDATE, change_envelope, full_load_envelope
from tidemark.operators.merge import INCOMING_WINS
from tidemark.queries import feeds
from tidemark.queries.merges import merged_table
from tidemark.queries.registry import load, query
from tidemark.sinks.closing import land_closed_stream
from tidemark.sinks.expiry import expire_read_days as expire_behind
from tidemark.sinks.landing import land_changes, land_full_extract
from tidemark.spec import TableSpec
from tidemark.streaming.upsert import (
    INCREMENTAL_STAGE,
    Feed,
    merge_batch,
    run_continuously,
    run_once,
    seed_from_extract,
)
from tidemark.streaming.watch import Watched
from tidemark.tables import storage
from tidemark.tables.lake_table import LakeTable
from tidemark.workspace import new_folder


def _order_feed(place: str, schema, **options) -> Feed:
    return Feed(
        spec=options.pop("spec", feeds.order_spec()),
        changes=f"{place}/changes",
        schema=schema,
        table=f"{place}/table",
        checkpoint=f"{place}/checkpoints",
        **options,
    )


def _land(rows: DataFrame, place: str, number: int) -> None:
    rows.write.parquet(f"{place}/changes/2024010{number}/part{number}")


@query(feeds.LATEST_SQL)
def cdc_run_once(spark: SparkSession, folder: str) -> DataFrame:
    """Two scheduled runs: each applies only the change files that landed since the run before."""
    place = new_folder(spark, "once")
    full = feeds.batch(spark, folder, 0)
    land_full_extract(full, f"{place}/full")
    table = seed_from_extract(spark, feeds.order_spec(), f"{place}/full", f"{place}/table")
    feed = _order_feed(place, full.schema)
    for number in (1, 2):
        _land(feeds.batch(spark, folder, number), place, number)
        run_once(spark, [feed])
    return table.snapshot().select(*feeds.RESULT)


_CUSTOMERS_SQL = """
SELECT 'customer' AS table_name, c_custkey AS record,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS amount FROM customer"""


@query(
    feeds.winners_sql("trx_seq DESC", "'orders' AS table_name, o_orderkey AS record, o_totalprice AS amount")
    + " UNION ALL "
    + _CUSTOMERS_SQL
)
def cdc_continuous(spark: SparkSession, folder: str) -> DataFrame:
    """One long-running stream per table, side by side in one session."""
    place, other = new_folder(spark, "continuous"), new_folder(spark, "continuous")
    full = feeds.batch(spark, folder, 0)
    orders = LakeTable(spark, f"{place}/table", feeds.order_spec())
    orders.seed(full)
    for number in (1, 2):
        _land(feeds.batch(spark, folder, number), place, number)

    spec = TableSpec(name="public.customer", keys=("c_custkey",))
    rows = load(spark, folder, "customer")
    customers = LakeTable(spark, f"{other}/table", spec)
    customers.seed(full_load_envelope(rows, feeds.STARTED))
    changed = rows.where("c_mktsegment = 'BUILDING'").withColumns(
        {
            "c_acctbal": F.col("c_acctbal") + 1,
            "op": F.lit(UPDATE),
            "changed_at": feeds.moment("2024-01-01 00:00:00"),
            "counter": F.lit(1),
        }
    )
    changes = change_envelope(changed, "op", "changed_at", "counter")
    _land(changes, other, 1)

    running = run_continuously(
        spark,
        [_order_feed(place, full.schema), _order_feed(other, changes.schema, spec=spec)],
        interval="1 second",
    )
    try:
        for stream in running:
            stream.processAllAvailable()
    finally:
        for stream in running:
            stream.stop()
    return (
        orders.snapshot()
        .select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("record"),
                F.col("o_totalprice").alias("amount"))
        .unionByName(
            customers.snapshot().select(
                F.lit("customer").alias("table_name"), F.col("c_custkey").alias("record"),
                F.col("c_acctbal").alias("amount"),
            )
        )
    )


@query(feeds.INCOMING_SQL)
def cdc_replay_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that are delivered again change nothing, even where the later arrival wins."""
    place = new_folder(spark, "replay")
    spec = feeds.order_spec(policy=INCOMING_WINS)
    full = feeds.batch(spark, folder, 0)
    table = LakeTable(spark, f"{place}/table", spec)
    table.seed(full)
    apply = merge_batch(_order_feed(place, full.schema, spec=spec), INCREMENTAL_STAGE)
    for number in (1, 2, 1, 2):
        apply(feeds.batch(spark, folder, number), number)
    return table.snapshot().select(*feeds.RESULT)


@query("""
SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events)
WHERE nth = 1""")
def cdc_out_of_order(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive by type instead of by time: the last event of each user is still the latest one."""
    place = new_folder(spark, "disorder")
    events = load(spark, folder, "events").select("event_id", "event_type", "user_id", "ts", "value", "props")
    spec = TableSpec(name="public.events", keys=("user_id",), ordering="ts")
    feed = _order_feed(place, events.schema, spec=spec, files_per_batch=1)
    kind, named = F.col("event_type"), ["view", "signup", "purchase", "error"]
    others = ~F.coalesce(kind.isin(named), F.lit(False))
    for number, arrives in enumerate([*[kind == k for k in named], others], start=1):
        _land(events.where(arrives), place, number)
        run_once(spark, [feed])
    return LakeTable(spark, f"{place}/table", spec).snapshot().select(*events.columns)


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 3 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'O' THEN '20240101000001' || lpad('1', 21, '0')
            ELSE '20240101000000' || lpad('0', 21, '0') END AS trx_seq
FROM orders""")
def full_cdc_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """The feed starts before the full load: changes the extract already holds do not overwrite it."""
    place = new_folder(spark, "overlap")
    orders = load(spark, folder, "orders")
    full = full_load_envelope(orders, feeds.STARTED)
    table = LakeTable(spark, f"{place}/table", feeds.order_spec())
    table.seed(full)

    def changes(moment: str, rows: DataFrame, add: int) -> DataFrame:
        changed = rows.withColumns(
            {
                "o_totalprice": F.col("o_totalprice") + add,
                "op": F.lit(UPDATE),
                "changed_at": feeds.moment(moment),
                "counter": F.lit(1),
            }
        )
        return change_envelope(changed, "op", "changed_at", "counter")

    before = changes("2023-12-31 23:59:59", orders, 7)
    after = changes("2024-01-01 00:00:01", orders.where("o_orderstatus = 'O'"), 3)
    _land(before.unionByName(after), place, 1)
    run_once(spark, [_order_feed(place, full.schema)])
    return table.snapshot().select("o_orderkey", "o_totalprice", SEQUENCE)


@query(
    feeds.winners_sql("trx_seq DESC", f"{feeds.RESULT_SQL}, 2 AS copies")
)
def rebuild_equals_live(spark: SparkSession, folder: str) -> DataFrame:
    """A table rebuilt from extract and change files next to the live one: every row is in both."""
    place = new_folder(spark, "rebuild")
    live = merged_table(spark, folder, "live").snapshot()
    full = feeds.batch(spark, folder, 0)
    land_full_extract(full, f"{place}/full")
    for number in (1, 2):
        _land(feeds.batch(spark, folder, number), place, number)
    rebuilt = seed_from_extract(spark, feeds.order_spec(), f"{place}/full", f"{place}/table")
    run_once(spark, [_order_feed(place, full.schema)])
    # once more in place, with a checkpoint of its own
    seed_from_extract(spark, feeds.order_spec(), f"{place}/full", f"{place}/table", replace=True)
    run_once(spark, [replace(_order_feed(place, full.schema), checkpoint=f"{place}/second")])
    both = live.select(*feeds.RESULT).unionByName(rebuilt.snapshot().select(*feeds.RESULT))
    return both.groupBy(*feeds.RESULT).agg(F.count(F.lit(1)).alias("copies"))


@query(feeds.LATEST_SQL)
def cdc_new_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """A table rebuilt in place, and fed with a new checkpoint that numbers its batches from 0 again, loses no change."""
    place = new_folder(spark, "anew")
    full = feeds.batch(spark, folder, 0)
    land_full_extract(full, f"{place}/full")
    table = seed_from_extract(spark, feeds.order_spec(), f"{place}/full", f"{place}/table")
    _land(feeds.batch(spark, folder, 1), place, 1)
    run_once(spark, [_order_feed(place, full.schema)])
    seed_from_extract(spark, feeds.order_spec(), f"{place}/full", f"{place}/table", replace=True)
    _land(feeds.batch(spark, folder, 2), place, 2)
    run_once(spark, [replace(_order_feed(place, full.schema), checkpoint=f"{place}/new_checkpoints")])
    return table.snapshot().select(*feeds.RESULT)


_LAG_DAYS = 12


@query(f"""
SELECT event_id, user_id, date_trunc('milliseconds', ts) AS ts FROM events
WHERE ts >= (SELECT date_trunc('day', max(ts)) FROM events) - INTERVAL {_LAG_DAYS} DAY""")
def expire_read_days(spark: SparkSession, folder: str) -> DataFrame:
    """Of two streams one has not read the last days yet: days before those go, though all are older than is kept."""
    place = new_folder(spark, "expiry")
    events = load(spark, folder, "events").select("event_id", "user_id", "ts")
    first_late = F.date_trunc("day", F.lit(events.agg(F.max("ts")).first()[0])).cast("timestamp_ntz") - F.expr(f"INTERVAL {_LAG_DAYS} DAYS")
    feed = f"{place}/feed"

    def read(name: str) -> None:
        rows = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(feed)
        sink = rows.writeStream.format("parquet").option("checkpointLocation", f"{place}/{name}/checkpoint")
        sink.trigger(availableNow=True).start(f"{place}/{name}/out").awaitTermination()

    land_changes(events.where(F.col("ts") < first_late), feed, "ts")
    read("lagging")
    land_changes(events.where(F.col("ts") >= first_late), feed, "ts")
    read("prompt")
    expire_behind(spark, feed, [f"{place}/lagging/checkpoint", f"{place}/prompt/checkpoint"], kept_days=0)
    return spark.read.parquet(feed).select("event_id", "user_id", "ts")


_WAIT_SECONDS = 300


@query("""
SELECT event_id, user_id, event_type, value, props, date_trunc('milliseconds', ts) AS ts, strftime(ts, '%Y%m%d') AS day
FROM events""")
def cdc_landing_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Changes landed by a stream in bare day folders, in files that are closed by size or by time."""
    place = new_folder(spark, "closing")
    events = load(spark, folder, "events")
    events.write.parquet(f"{place}/feed")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 64).parquet(f"{place}/feed")
    wanted, landed = events.count(), f"{place}/landed"
    query = land_closed_stream(
        stream, landed, f"{place}/checkpoint", "ts", kilobytes=16, seconds=2, trigger={"processingTime": "1 second"}
    )
    try:
        rows = _all_landed(spark, landed, wanted, query)
    finally:
        query.stop()
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{8})/[^/]+$", 1)
    return rows.select("event_id", "user_id", "event_type", "value", "props", F.col("ts").cast("timestamp_ntz").alias("ts"), day.alias("day"))


def _all_landed(spark: SparkSession, folder: str, wanted: int, query) -> DataFrame:
    """Waits until all rows are in closed files: the last ones are closed by time.

    Rows are counted after a batch only, and waiting ends in an error if no batch runs and none ends for long.
    """
    until, seen = time.monotonic() + _WAIT_SECONDS, None
    while True:
        ended = query.lastProgress["batchId"] if query.lastProgress else None
        if ended != seen and storage.exists(spark, folder):
            rows = spark.read.option("recursiveFileLookup", True).parquet(folder)
            if rows.count() >= wanted:
                return rows
        if query.exception() is not None:
            raise query.exception()
        status = query.status
        if ended != seen or status["isTriggerActive"] and status["isDataAvailable"]:
            until, seen = time.monotonic() + _WAIT_SECONDS, ended
        if time.monotonic() > until:
            raise TimeoutError(f"rows are still waiting after {_WAIT_SECONDS} s")
        time.sleep(0.5)


@query("""
SELECT 'public.orders' AS table_name, 'running' AS state, 0 AS restarts, 0 AS failures, count(*) AS stored FROM orders
UNION ALL
SELECT 'public.customer', 'failed', 1, 2, 0""")
def stream_status(spark: SparkSession, folder: str) -> DataFrame:
    """Two watched streams: one table's changes lack keys, so it fails again after a restart; the other goes on."""
    place = new_folder(spark, "watched")
    orders = full_load_envelope(load(spark, folder, "orders").select(*feeds.COLUMNS), feeds.STARTED)
    customers = full_load_envelope(load(spark, folder, "customer"), feeds.STARTED)
    broken = customers.withColumn("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")))
    spec = TableSpec("public.customer", keys=("c_custkey",))
    orders.write.parquet(f"{place}/orders/changes")
    broken.write.parquet(f"{place}/customer/changes")
    watched = [_order_feed(f"{place}/orders", orders.schema), _order_feed(f"{place}/customer", broken.schema, spec=spec)]
    with Watched(spark, watched, interval="1 second", most_restarts=1) as streams:
        until = time.monotonic() + _WAIT_SECONDS
        good, bad = (streams.statuses[f.spec.name] for f in watched)
        while time.monotonic() < until and not (good.batches and bad.failures == 2):
            streams.look()
            time.sleep(0.3)
        status = [(s.table_name, s.state, s.restarts, s.failures) for s in (good, bad)]
    tables = [LakeTable(spark, f.table, f.spec) for f in watched]
    stored = [t.snapshot().count() if t.exists() else 0 for t in tables]
    rows = [(*s, n) for s, n in zip(status, stored)]
    return spark.createDataFrame(rows, "table_name string, state string, restarts int, failures int, stored long")
