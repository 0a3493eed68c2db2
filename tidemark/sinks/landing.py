"""Writers of the raw zone."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.layout import spread_for_write
from tidemark.tables import storage

# How change files are written.
DAY_FOLDER = "dt"
DAY_PATTERN = "yyyyMMdd"
DAY_DIGITS = "%Y%m%d"
KEPT_DAYS = 8
CHANGE_COMPRESSION = "gzip"
BATCH_INTERVAL = "180 seconds"


def land_full_extract(rows: DataFrame, folder: str) -> None:
    """The whole table, replacing the extract before."""
    rows.write.mode("overwrite").parquet(folder)


def _millisecond_times(rows: DataFrame) -> DataFrame:
    cut = {
        f.name: F.date_trunc("MILLISECOND", f.name).cast(f.dataType)
        for f in rows.schema
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    return rows.withColumns(cut) if cut else rows


def dated(rows: DataFrame, changed_at: str) -> DataFrame:
    """Times cut to milliseconds and the day folder each row belongs to."""
    return _millisecond_times(rows).withColumn(DAY_FOLDER, F.date_format(F.col(changed_at), DAY_PATTERN))


def land_changes(rows: DataFrame, folder: str, changed_at: str, rows_per_file: int | None = None) -> None:
    """Append change rows as gzip parquet, one folder per day."""
    writer = spread_for_write(dated(rows, changed_at), [DAY_FOLDER]).write.mode("append")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(DAY_FOLDER).option("compression", CHANGE_COMPRESSION).parquet(folder)


def land_change_stream(
    rows: DataFrame, folder: str, checkpoint: str, changed_at: str, trigger: dict | None = None
) -> StreamingQuery:
    """The same landing for a stream of changes: a set of files per trigger interval."""
    return (
        dated(rows, changed_at)
        .writeStream.format("parquet")
        .partitionBy(DAY_FOLDER)
        .option("compression", CHANGE_COMPRESSION)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": BATCH_INTERVAL}))
        .start(folder)
    )


def days_of(spark: SparkSession, folder: str) -> dict[str, str]:
    """Day digits of the day folders, ``dt=<day>`` as landed here or the bare day as other feeds land it.

    Folders of undated rows, and any others, are no day folders.
    """
    names = {d: d.removeprefix(f"{DAY_FOLDER}=") for d in storage.children(spark, folder)}
    return {d: digits for d, digits in names.items() if re.fullmatch(r"\d{8}", digits)}


def last_day(spark: SparkSession, folder: str) -> date | None:
    """The newest day that holds change files, from the folder names; None for an empty feed."""
    newest = max(days_of(spark, folder).values(), default=None)
    return datetime.strptime(newest, DAY_DIGITS).date() if newest else None


def oldest_kept(last: date, kept_days: int) -> str:
    return (last - timedelta(days=kept_days)).strftime(DAY_DIGITS)


def unexpired(rows: DataFrame, last: date | None, kept_days: int = KEPT_DAYS) -> DataFrame:
    """Change rows of the days that are still kept: a filter on the day folder, so older folders are not read.

    Undated rows are kept: nothing says that they are old. Without a last day (an empty feed) nothing expires.
    """
    if last is None:
        return rows
    day = F.col(DAY_FOLDER)
    return rows.where(day.isNull() | (day >= oldest_kept(last, kept_days)))


def expire_changes(spark: SparkSession, folder: str, last: date, kept_days: int = KEPT_DAYS) -> list[str]:
    """Delete the day folders that are no longer kept."""
    oldest = oldest_kept(last, kept_days)
    expired = sorted(d for d, digits in days_of(spark, folder).items() if digits < oldest)
    for day in expired:
        storage.delete(spark, f"{folder}/{day}")
    return expired
