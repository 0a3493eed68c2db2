"""Fact tables kept in buckets of their join key, so that they meet without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from tidemark.plans.order_line import Layout, Sources, denormalize_changes


def save_bucketed(rows: DataFrame, table: str, folder: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A catalog table whose files hold one bucket each, sorted by the keys; returns it.

    Rows are dealt out by the key once, when the table is written, and never again when it is joined on it. Choose
    buckets so that one fits into a task: the key decides its bucket, so a key with very many rows fills one.
    """
    writer = rows.repartition(buckets, *keys).write.mode("overwrite").option("path", folder).format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return rows.sparkSession.table(table)


def denormalize_bucketed(sources: Sources, layout: Layout) -> DataFrame:
    """The denormalized order line from orders and lines in equal buckets of the order's key.

    The two facts meet first, bucket by bucket; what is left are references, joined as their sizes allow.
    """
    return denormalize_changes(replace(sources, orders=sources.orders.hint("merge")), layout, small=False, bucketed=True)
