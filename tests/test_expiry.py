"""Days go only after every stream has read them."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.sinks.expiry import change_files, expire_read_days, files_read, low_water_mark
from tidemark.sinks.landing import land_changes, last_day, unexpired

SCHEMA = "id long, at timestamp_ntz"


@pytest.fixture
def feed(spark, place):
    def land(*days):
        rows = [(d, datetime(2024, 3, d)) for d in days]
        land_changes(spark.createDataFrame(rows, SCHEMA), f"{place}/feed", "at")

    def read(name):
        rows = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(f"{place}/feed")
        sink = rows.writeStream.format("parquet").option("checkpointLocation", f"{place}/{name}").trigger(availableNow=True)
        sink.start(f"{place}/out_{name}").awaitTermination()
        return f"{place}/{name}"

    return land, read


def days(place):
    return sorted(d for d in os.listdir(f"{place}/feed") if d.startswith("dt="))


def test_an_empty_feed_has_nothing_to_expire(spark, place):
    os.makedirs(f"{place}/feed")
    assert last_day(spark, f"{place}/feed") is None
    assert expire_read_days(spark, f"{place}/feed", []) == []
    rows = spark.range(3).withColumn("dt", F.lit("20240101"))
    assert unexpired(rows, None).count() == 3


def test_a_lagging_stream_keeps_its_days(spark, place, feed):
    land, read = feed
    land(1, 2, 3)
    lagging = read("a")
    land(4, 5, 30)
    prompt = read("b")
    assert low_water_mark(spark, f"{place}/feed", [prompt]) is None
    assert low_water_mark(spark, f"{place}/feed", [prompt, lagging]) == "20240304"
    assert expire_read_days(spark, f"{place}/feed", [prompt, lagging]) == ["dt=20240301", "dt=20240302", "dt=20240303"]
    read("a")
    assert expire_read_days(spark, f"{place}/feed", [prompt, lagging]) == ["dt=20240304", "dt=20240305"]
    assert days(place) == ["dt=20240330"]


def test_a_late_file_in_an_old_day_keeps_that_day_and_later_ones(spark, place, feed):
    land, read = feed
    land(1, 2, 3, 30)
    done = read("a")
    land(2)
    assert expire_read_days(spark, f"{place}/feed", [done]) == ["dt=20240301"]


def test_a_stream_that_never_committed_keeps_everything(spark, place, feed):
    land, read = feed
    land(1, 30)
    assert expire_read_days(spark, f"{place}/feed", [read("a"), f"{place}/never"]) == []


def test_a_batch_without_its_commit_has_read_nothing(spark, place, feed):
    land, read = feed
    land(1, 30)
    checkpoint = read("a")
    assert files_read(spark, checkpoint).count() == change_files(spark, f"{place}/feed").count()
    os.remove(f"{checkpoint}/commits/0")
    assert expire_read_days(spark, f"{place}/feed", [checkpoint], date(2024, 12, 1)) == []
