"""Expiry of change files behind the streams that read them.

A stream's checkpoint logs which files each batch took and which batches were committed. A day is read once every stream
has committed all of its files; days go in order, and none goes before the oldest day that some stream has still to read.
Logs and file lists are read as tables, so their length is no matter for the driver, which sees one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.landing import DAY_FOLDER, KEPT_DAYS, days_of, last_day, oldest_kept
from tidemark.tables import storage

_PLACE = rf"/((?:{DAY_FOLDER}=)?(\d{{8}}))/([^/]+)$"


def change_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files in day folders: day folder, day, name. Contents are not read."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    return _placed(paths.select("path")).where("day <> ''")


def files_read(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The files of a stream's committed batches: day folder, day, name.

    Every batch has a log of its files, or stands in a compacted log. A batch that was planned and not committed has read
    nothing yet.
    """
    commits = storage.children(spark, f"{checkpoint}/commits")
    last = max((int(c) for c in commits if c.isdigit()), default=-1)
    places = [f"{checkpoint}/sources/{s}" for s in storage.children(spark, f"{checkpoint}/sources")]
    if last < 0 or not places:
        return _placed(spark.createDataFrame([], "path string"))
    lines = spark.read.text(places, recursiveFileLookup=True).where("value LIKE '{%'")
    entry = F.from_json("value", "path string, batchId long")
    taken = lines.select(entry.alias("e")).where(F.col("e.batchId") <= last).select(F.col("e.path").alias("path"))
    # a checkpoint writes paths as URIs, in which "+" stands for itself
    return _placed(taken.withColumn("path", F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))))).distinct()


def _placed(paths: DataFrame) -> DataFrame:
    part = lambda n: F.regexp_extract("path", _PLACE, n)
    return paths.select(part(1).alias("folder"), part(2).alias("day"), part(3).alias("name"))


def low_water_mark(spark: SparkSession, folder: str, checkpoints: Sequence[str]) -> str | None:
    """The oldest day with a file that some stream has not read; None if all have read everything."""
    there = change_files(spark, folder)
    unread = [there.join(files_read(spark, c), ["folder", "day", "name"], "left_anti").select("day") for c in checkpoints]
    if not unread:
        return None
    return reduce(DataFrame.unionByName, unread).agg(F.min("day")).first()[0]


def expire_read_days(
    spark: SparkSession, folder: str, checkpoints: Sequence[str], last: date | None = None, kept_days: int = KEPT_DAYS
) -> list[str]:
    """Deletes day folders that are older than ``kept_days`` and that every stream has read; names what it deleted.

    ``checkpoints`` are those of all streams that read the folder: a stream without any commit keeps every day. ``last`` is the
    day to count from, the newest one landed if not given. An empty feed has nothing to expire. A day in which a file
    turned up after the streams' logs were read is kept for the next run.
    """
    last = last or last_day(spark, folder)
    if last is None:
        return []
    found = {d: storage.children(spark, f"{folder}/{d}") for d, day in days_of(spark, folder).items() if day < oldest_kept(last, kept_days)}
    mark = low_water_mark(spark, folder, checkpoints)
    gone = []
    for name, day in sorted(days_of(spark, folder).items(), key=lambda d: d[1]):
        if name in found and (mark is None or day < mark) and storage.children(spark, f"{folder}/{name}") == found[name]:
            storage.delete(spark, f"{folder}/{name}")
            gone.append(name)
    return gone
