"""Split a batch into rows that can be merged and rows that are set aside with a reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "quarantine_reason"


def reason(keys: Sequence[str], ordering: str, casts: Mapping[str, str] | None = None) -> Column:
    """Why a row cannot be merged; NULL for a good row. ``casts`` maps text columns to their real types."""
    checks = [F.when(F.col(k).isNull(), f"null key {k}") for k in keys]
    checks.append(F.when(F.col(ordering).isNull(), f"null ordering {ordering}"))
    for column, kind in (casts or {}).items():
        unreadable = F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()
        checks.append(F.when(unreadable, f"not a {kind}: {column}"))
    return F.coalesce(*checks)


def split(
    rows: DataFrame, keys: Sequence[str], ordering: str, casts: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good rows with their casts applied, set-aside rows as they came, with the reason)."""
    return parted(rows.withColumn(REASON, reason(keys, ordering, casts)), casts)


def parted(judged: DataFrame, casts: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The same two for rows that carry their reason."""
    good = judged.where(F.col(REASON).isNull()).drop(REASON)
    good = good.withColumns({c: F.col(c).try_cast(kind) for c, kind in (casts or {}).items()})
    return good, judged.where(F.col(REASON).isNotNull())


def refuse_above(
    rows: DataFrame, share: float, keys: Sequence[str], ordering: str, casts: Mapping[str, str] | None = None
) -> None:
    """Stop when more than ``share`` of a batch would be set aside: the table is suspended, not half merged."""
    if share >= 1:
        return
    refuse_share(*rows.agg(F.count(F.lit(1)), F.count(reason(keys, ordering, casts))).first(), share)


def refuse_share(total: int, bad: int, share: float) -> None:
    if total and bad / total > share:
        raise ValueError(f"{bad} of {total} rows are set aside, more than {share:.1%} of the batch")
