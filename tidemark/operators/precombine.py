"""Keep one row per key: the one with the greatest ordering value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def precombine(
    rows: DataFrame,
    keys: Sequence[str],
    ordering: Sequence[str] | str,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The latest row of each key. NULL orders lowest; remaining columns break ties, greatest first.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the shuffle, so a key
    that holds a large share of all rows sends one row per task, not all its rows, to the final task.
    """
    first = [ordering] if isinstance(ordering, str) else list(ordering)
    if tie_break is None:
        used = {*keys, *first}
        tie_break = [f.name for f in rows.schema if f.name not in used and not isinstance(f.dataType, _UNORDERED)]
    latest_first = [F.col(c).desc_nulls_last() for c in [*first, *tie_break]]
    newest = Window.partitionBy(*keys).orderBy(*latest_first)
    return rows.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")
