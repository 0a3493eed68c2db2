"""Inner equi joins of a fact with what it refers to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reference:
    """A relation and the (left column, right column) pairs it is joined on."""

    rows: DataFrame
    on: Sequence[tuple[str, str]]


def star_join(start: DataFrame, *references: Reference, small_start: bool = False) -> DataFrame:
    """Join one reference after the other.

    No reference is hinted: Spark broadcasts one only when its size is below the session's limit, and
    splits skewed keys of the sort-merge joins that remain. ``small_start`` says that the size of ``start``
    was checked and every reference is unique on its join columns: the rows joined so far are then never more
    than ``start`` has, and go to the references instead of the references being shuffled.
    """
    joined = start
    for reference in references:
        same = [F.col(left) == F.col(right) for left, right in reference.on]
        left = F.broadcast(joined) if small_start else joined
        joined = left.join(reference.rows, same, "inner")
    return joined
