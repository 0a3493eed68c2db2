"""The change envelope: ``Op``, the source columns, ``trx_seq``, ``_is_deleted``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names, letters and widths of the change envelope.
OP = "Op"
SEQUENCE = "trx_seq"
DELETED = "_is_deleted"
INSERT, UPDATE, DELETE = "I", "U", "D"
TIME_FORMAT = "%Y%m%d%H%M%S"
TIME_PATTERN = "yyyyMMddHHmmss"
TIME_DIGITS = 14
COUNTER_DIGITS = 21


def nullable_lit(value, never) -> Column:
    """A constant whose column is nullable, as the same column is in the change feed.

    A bare literal is typed NOT NULL; comparing it with a value it never has keeps the schema nullable
    and still folds to the literal at run time.
    """
    return F.nullif(F.lit(value), F.lit(never))


def full_load_sequence(started: datetime) -> str:
    """One sequence for all rows of a full extract: its start time, then a zero counter."""
    return started.strftime(TIME_FORMAT) + "0" * COUNTER_DIGITS


def change_sequence(changed_at: Column, counter: Column) -> Column:
    """Fixed-width digits (time, then counter), so that text order is change order."""
    time_part = F.date_format(changed_at, TIME_PATTERN)
    return F.concat(time_part, F.lpad(counter.cast("string"), COUNTER_DIGITS, "0"))


def delete_flag(op: Column) -> Column:
    return op.eqNullSafe(F.lit(DELETE))


def full_load_envelope(extract: DataFrame, started: datetime) -> DataFrame:
    """Put a full extract into the shape of the change feed: every row is an insert at load start."""
    return extract.select(
        nullable_lit(INSERT, "").alias(OP),
        "*",
        nullable_lit(full_load_sequence(started), "").alias(SEQUENCE),
        nullable_lit(False, True).alias(DELETED),
    )


def change_envelope(feed: DataFrame, op: str, changed_at: str, counter: str) -> DataFrame:
    """Turn feed rows (operation letter, change time, counter, after-image) into change rows."""
    image = [c for c in feed.columns if c not in (op, changed_at, counter)]
    return feed.select(
        F.col(op).alias(OP),
        *image,
        change_sequence(F.col(changed_at), F.col(counter)).alias(SEQUENCE),
        delete_flag(F.col(op)).alias(DELETED),
    )
