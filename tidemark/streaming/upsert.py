"""Change files to keyed tables: run once on a schedule, or continuously, exactly once per batch."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quarantine import REASON, parted, reason, refuse_share
from tidemark.operators.schema import drift, drift_report
from tidemark.operators.transform import transformed
from tidemark.sources.raw_zone import read_extract, stream_changes
from tidemark.spec import TableSpec
from tidemark.tables import storage
from tidemark.tables.lake_table import COMMIT_TIME, LakeTable
from tidemark.workspace import staged

# Stages that feed one table, each with its own checkpoint.
SEED_STAGE, INCREMENTAL_STAGE, CONTINUOUS_STAGE = "seed", "incremental", "continuous"
# Settings of the calling session that a stage's own session takes over.
CARRIED = (
    "spark.sql.shuffle.partitions",
    "spark.sql.session.timeZone",
    "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.files.maxPartitionBytes",
)


@dataclass(frozen=True)
class Feed:
    """One table fed from a folder of change files.

    With a ``quarantine`` folder, rows that cannot be merged are written there; the batch fails when they are
    more than ``quarantine_share`` of it. With a ``drift_reports`` folder, a batch whose columns differ from the
    table's leaves a report there.
    """

    spec: TableSpec
    changes: str
    schema: T.StructType
    table: str
    checkpoint: str
    quarantine: str | None = None
    quarantine_share: float = 1.0
    drift_reports: str | None = None
    files_per_batch: int | None = None
    bytes_per_batch: str | None = None
    after_batch: Callable[[LakeTable], None] | None = None


def session_for(spark: SparkSession, spec: TableSpec, stage: str) -> SparkSession:
    """A session with the settings that the spec has for a stage; the given one if there are none.

    Settings are named after stages (``seed``, or with more words, ``x_seed``). A setting that cannot change in a
    running application is refused: it belongs to the launch of the job.
    """
    found = [conf for name, conf in spec.stage_conf.items() if stage in name.split("_")]
    settings = {k: v for conf in found for k, v in conf.items()}
    if not settings:
        return spark
    fixed = [k for k in settings if not spark.conf.isModifiable(k)]
    if fixed:
        raise ValueError(f"{spec.name}: set {fixed} when the application starts, not for its stage {stage}")
    own = spark.newSession()
    for key in CARRIED:
        if (value := spark.conf.get(key, None)) is not None:
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key, value)
    return own


def seed_from_extract(spark: SparkSession, spec: TableSpec, extract: str, table: str, **options) -> LakeTable:
    """Fill an empty table from a full extract."""
    target = LakeTable(spark, table, spec)
    target.seed(transformed(read_extract(spark, extract), spec), **options)
    return target


def merge_batch(feed: Feed, stage: str) -> Callable[[DataFrame, int], None]:
    """The function that applies one micro-batch. The batch number goes into the commit record, so a batch
    that is delivered again after a failure finds itself applied and changes nothing. Numbers count for the
    checkpoint that they come from: a new checkpoint starts at 0 again and all its batches are applied."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        table = LakeTable(spark, feed.table, feed.spec)
        rows = transformed(batch, feed.spec)
        if feed.drift_reports and table.exists():
            registered = T.StructType([f for f in table.state().struct() if f.name != COMMIT_TIME])
            if drift(rows.schema, registered):
                report = drift_report(rows, registered, feed.spec.name)
                report.write.mode("overwrite").parquet(f"{feed.drift_reports}/{stage}_batch={number}")
        source = (f"{stage}:{_checkpoint_id(spark, feed, stage)}:{feed.changes}", number)
        if feed.quarantine:
            # the batch is read and judged once; its rows are counted as they are written
            counts = Observation()
            judged = rows.withColumn(REASON, reason(feed.spec.keys, feed.spec.ordering))
            judged = judged.observe(counts, F.count(F.lit(1)).alias("total"), F.count(REASON).alias("bad"))
            with staged(judged, "judged") as (judged, _):
                refuse_share(counts.get["total"], counts.get["bad"], feed.quarantine_share)
                good, set_aside = parted(judged)
                # the folder is named after the batch: a repeated batch overwrites its own rows
                set_aside.write.mode("overwrite").parquet(f"{feed.quarantine}/{stage}_batch={number}")
                table.upsert(good, source=source)
        else:
            table.upsert(rows, source=source)
        if feed.after_batch:
            feed.after_batch(table)

    return apply


def _checkpoint_id(spark: SparkSession, feed: Feed, stage: str) -> str:
    """The id that Structured Streaming gave this checkpoint when it was made."""
    path = f"{feed.checkpoint}/{stage}/metadata"
    return json.loads(storage.read_text(spark, path))["id"] if storage.exists(spark, path) else ""


def start(spark: SparkSession, feed: Feed, stage: str, trigger: dict) -> StreamingQuery:
    spark = session_for(spark, feed.spec, stage)
    # with the FAIR scheduler, each table gets a pool of its own
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", feed.spec.name)
    changes = stream_changes(spark, feed.changes, feed.schema, feed.files_per_batch, feed.bytes_per_batch)
    return (
        changes.writeStream.queryName(f"{stage}_{feed.spec.name}_{abs(hash(feed.table))}")
        .foreachBatch(merge_batch(feed, stage))
        .option("checkpointLocation", f"{feed.checkpoint}/{stage}")
        .trigger(**trigger)
        .start()
    )


def run_once(spark: SparkSession, feeds: Iterable[Feed]) -> None:
    """Apply all change files not yet consumed, then stop. Tables run side by side."""
    running = [start(spark, f, INCREMENTAL_STAGE, {"availableNow": True}) for f in feeds if f.spec.enabled]
    failures = []
    for query in running:
        try:
            query.awaitTermination()
        except StreamingQueryException as failure:  # the other tables go on
            failures.append(failure)
    if failures:
        raise failures[0]


def run_continuously(spark: SparkSession, feeds: Iterable[Feed], interval: str = "180 seconds") -> list[StreamingQuery]:
    """One stream per table in this session, each applying new files every ``interval``."""
    return [start(spark, f, CONTINUOUS_STAGE, {"processingTime": interval}) for f in feeds if f.spec.enabled]
