"""Record keys in text form and partition columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_key(*parts: str) -> Column:
    """``a-b-c`` as text; NULL as soon as one part is NULL, so that no half key can match."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("-"), F.col(part).cast("string")]
    return F.concat(*pieces[1:])


def record_key(keys: Sequence[str]) -> Column:
    """Text form of a record key: the bare value for one column, ``name:value`` pairs for several."""
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    return F.concat_ws(",", *[F.concat(F.lit(f"{k}:"), F.col(k).cast("string")) for k in keys])


def partition_path(columns: Sequence[str]) -> Column:
    """The hive-style relative path a row is written to, ``a=1/b=2``."""
    pieces = [
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
        for c in columns
    ]
    return F.concat_ws("/", *pieces)
