"""How rows are spread over files before a write."""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BYTES_PER_TASK = 128 << 20  # of parquet, a few times as much in memory
_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def spread_for_write(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of one table partition together, in as many tasks as its size needs.

    The rebalance hint lets adaptive execution split a partition that holds a large share of all rows and
    join small ones, from the measured shuffle sizes.
    """
    return rows.hint("rebalance", *partition_by) if partition_by else rows


def sorted_in_tasks(rows: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Bulk-insert order: sorted inside every task only, so that no global sort is paid."""
    spread = spread_for_write(rows, partition_by)
    columns = list(dict.fromkeys([*partition_by, *sort_by]))
    return spread.sortWithinPartitions(*columns) if columns else spread


def clustered(rows: DataFrame, columns: Sequence[str], keys: Sequence[str], files: int) -> DataFrame:
    """Sorted across files: each file holds one range. The key follows the cluster columns, so that a value
    of the cluster columns that fills a third of the table is still cut into several ranges."""
    by = list(dict.fromkeys([*columns, *keys]))
    return rows.repartitionByRange(files, *by).sortWithinPartitions(*by)


def tasks_for(stored_bytes: int, bytes_per_task: int = BYTES_PER_TASK) -> int:
    return max(1, math.ceil(stored_bytes / bytes_per_task))


@contextmanager
def shuffles_sized_for(spark: SparkSession, stored_bytes: int):
    """Run a job over this much stored data with enough shuffle partitions, so that each fits in memory.

    Raises the session's setting only where it is too low; adaptive execution joins what turns out small.
    """
    before = spark.conf.get(_SHUFFLE_PARTITIONS)
    needed = tasks_for(stored_bytes)
    if needed <= int(before):
        yield
        return
    spark.conf.set(_SHUFFLE_PARTITIONS, str(needed))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_PARTITIONS, before)
