"""Plans that must hold: buckets, footers, dynamic pruning; and watched streams."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions.envelope import full_load_envelope
from tidemark.operators.merge import touched_rows
from tidemark.queries import feeds, gold
from tidemark.sources.footers import extremes
from tidemark.spec import TableSpec
from tidemark.streaming.upsert import Feed
from tidemark.streaming.watch import Watched
from tidemark.tables.lake_table import LakeTable

TABLES = "/root/testdata/sf0.001"


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_bucketed_facts_meet_without_an_exchange(spark):
    rows = gold.denorm_bucketed(spark, TABLES)
    text = plan_of(rows)
    at = text.index("SortMergeJoin")
    depth = len(re.match(r"[\s:+\-|]*", text[text.rindex("\n", 0, at) + 1 : at])[0])
    below = []
    for line in text[at:].split("\n")[1:]:
        if len(re.match(r"[\s:+\-|]*", line)[0]) <= depth:
            break
        below.append(line)
    assert "SortMergeJoin [l_orderkey" in text and "Bucketed: true" in text
    assert not [line for line in below if "Exchange" in line]
    assert rows.count() == 6000


def test_extremes_come_from_footers(spark, place):
    rows = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))).alias("day"))
    rows.write.parquet(f"{place}/rows")
    found = extremes(spark, f"{place}/rows", ["id", "day"])
    assert re.search(r"PushedAggregation: \[.*MAX\(day\)", plan_of(found))
    row = found.first().asDict()
    assert (row["n_rows"], row["least_id"], row["greatest_id"], row["filled_day"], str(row["greatest_day"])) == (100, 0, 99, 50, "2024-04-08")
    spark.range(1).select(F.lit("x").alias("t")).write.parquet(f"{place}/texts")
    with pytest.raises(ValueError):
        extremes(spark, f"{place}/texts", ["t"])


def test_a_batch_prunes_the_scan_while_the_job_runs(spark, place):
    spark.range(100).withColumn("p", F.col("id") % 10).write.partitionBy("p").parquet(f"{place}/stored")
    spark.createDataFrame([(1, 3), (2, 3), (3, None)], "v int, p long").write.parquet(f"{place}/batch")
    rows = touched_rows(spark.read.parquet(f"{place}/stored"), spark.read.parquet(f"{place}/batch"), ["p"], True)
    assert "dynamicpruning" in plan_of(rows)
    assert sorted(r["id"] for r in rows.collect()) == list(range(3, 100, 10))


def test_a_drifted_batch_reads_only_its_partitions(spark, place):
    table = LakeTable(spark, place, TableSpec("public.t", keys=("id",), partition_by=("p",), stable_partition=True))
    schema = "id long, p string, a string, b string, trx_seq string"
    table.seed(spark.createDataFrame([(1, "x", "a1", "b1", "0"), (2, "y", "a2", "b2", "0")], schema))
    table.upsert(spark.createDataFrame([(1, "x", "new", "1"), (3, "x", "c", "1")], "id long, p string, a string, trx_seq string"))
    found = {r["id"]: (r["a"], r["b"]) for r in table.snapshot().collect()}
    assert found == {1: ("new", "b1"), 2: ("a2", "b2"), 3: ("c", None)}


def test_a_failing_stream_is_restarted_alone(spark, place):
    changes = full_load_envelope(spark.range(5).withColumnRenamed("id", "k"), feeds.STARTED)
    broken = changes.withColumn("k", F.when(F.col("k") > 1, F.col("k")))
    watched = []
    for name, rows in (("good", changes), ("bad", broken)):
        rows.write.parquet(f"{place}/{name}/changes")
        spec = TableSpec(f"public.{name}", keys=("k",))
        watched.append(Feed(spec, f"{place}/{name}/changes", rows.schema, f"{place}/{name}/table", f"{place}/{name}/checkpoint"))
    with Watched(spark, watched, interval="300 milliseconds", most_restarts=2) as streams:
        good, bad = streams.statuses["public.good"], streams.statuses["public.bad"]
        first = streams.running["public.good"]
        until = time.monotonic() + 90
        while time.monotonic() < until and not (good.batches and bad.failures == 3):
            streams.look()
            time.sleep(0.2)
        assert streams.look() == []  # it failed too often
        assert streams.running["public.good"] is first and first.isActive
        rows = {r["table_name"]: r for r in streams.status().collect()}
    assert (rows["public.good"]["state"], rows["public.good"]["rows"], rows["public.good"]["failures"]) == ("running", 5, 0)
    assert (rows["public.bad"]["state"], rows["public.bad"]["restarts"], rows["public.bad"]["failures"]) == ("failed", 2, 3)
    assert rows["public.bad"]["error"]
    assert LakeTable(spark, f"{place}/good/table", watched[0].spec).snapshot().count() == 5


@pytest.mark.parametrize("changes", [False, True])
def test_items_that_are_shuffled_meet_the_lines_before_their_orders(spark, changes):
    lines = spark.read.parquet(f"{TABLES}/lineitem.parquet").withColumn("_commit_time", F.lit(feeds.SEED))

    def rows():
        sources = gold._retail_sources(spark, TABLES, lines)
        return gold.denormalize_changes(sources, gold.RETAIL_LAYOUT, False) if changes else gold.denormalize(sources, gold.RETAIL_LAYOUT)

    want = sorted(map(str, rows().collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text, got = plan_of(rows()), sorted(map(str, rows().collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want and len(got) == 6000
    at = text.index("Exchange hashpartitioning(l_partkey")
    depth = len(re.match(r"[\s:+\-|]*", text[text.rindex("\n", 0, at) + 1 : at])[0])
    below = []
    for line in text[at:].split("\n")[1:]:
        if len(re.match(r"[\s:+\-|]*", line)[0]) <= depth:
            break
        below.append(line)
    assert below and not any("o_orderkey" in line for line in below)
