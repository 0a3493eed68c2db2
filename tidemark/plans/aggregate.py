"""Keep an aggregated table current from signed changes of its detail rows.

Every touched detail row counts twice: its old image with a minus, its new image with a plus. Counts and sums follow from
the signed sums alone. A maximum follows from them too, unless a group loses the row that held it: such groups, and only
they, are read anew from the detail table. A group without rows goes.

Groups must not be NULL (they are the keys of the aggregated table). Sums take NULL measures for nothing; a maximum over
NULLs is NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.tables.lake_table import COMMIT_TIME, LakeTable
from tidemark.workspace import staged

_SIGN, _GONE, _CAME, _LOST = "_sign", "_gone_", "_came_", "_lost"


@dataclass(frozen=True)
class Aggregate:
    """Output columns over detail rows: ``count`` of rows, ``sums`` and ``maxima`` by (output, SQL over the detail).

    Measures of sums should be exact (decimals or integers): a minus takes away what a plus added.
    """

    groups: tuple[str, ...]
    count: str
    sums: Mapping[str, str]
    maxima: Mapping[str, str]

    def full(self, rows: DataFrame) -> DataFrame:
        """From all detail rows. Every task adds up its own rows first."""
        sums = [F.coalesce(F.sum(F.expr(m)), F.lit(0)).alias(c) for c, m in self.sums.items()]
        return rows.groupBy(*self.groups).agg(
            F.count(F.lit(1)).alias(self.count), *sums, *[F.max(F.expr(m)).alias(c) for c, m in self.maxima.items()]
        )

    def signed(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """Per group touched: signed count and sums, and the greatest of the measures that left and that came."""
        measures = {**self.sums, **self.maxima}

        def side(rows: DataFrame, sign: int) -> DataFrame:
            return rows.select(*self.groups, *[F.expr(m).alias(c) for c, m in measures.items()], F.lit(sign).alias(_SIGN))

        both = side(old, -1).unionByName(side(new, 1))
        left, came = F.col(_SIGN) < 0, F.col(_SIGN) > 0
        return both.groupBy(*self.groups).agg(
            F.sum(_SIGN).alias(self.count),
            *[F.coalesce(F.sum(F.when(left, -F.col(c)).otherwise(F.col(c))), F.lit(0)).alias(c) for c in self.sums],
            *[F.max(F.when(left, F.col(c))).alias(_GONE + c) for c in self.maxima],
            *[F.max(F.when(came, F.col(c))).alias(_CAME + c) for c in self.maxima],
        )

    def lost(self, stored: Callable[[str], Column]) -> Column:
        """Whether the row that held some maximum left, and none as great came."""
        found = F.lit(False)
        for c in self.maxima:
            gone, came = F.col(_GONE + c), F.col(_CAME + c)
            found = found | (F.coalesce(gone >= stored(c), F.lit(False)) & ~F.coalesce(came >= gone, F.lit(False)))
        return found


def follow(aggregated: LakeTable, plan: Aggregate) -> Callable:
    """What ``refresh_any`` calls before it commits changed detail rows: brings the aggregated table up to them.

    The aggregated table is committed first, with the same markers of what was read. If the detail's commit then
    fails, the next run finds the markers ahead of the detail's: at the same place the step is left out, and if more has
    arrived in between, the groups are counted anew from all rows.
    """

    def apply(
        old: DataFrame,
        new: DataFrame,
        before: Mapping[str, str],
        markers: Mapping[str, str],
        after: Callable[[DataFrame | None], DataFrame],
        instant: str | None,
    ) -> None:
        if not aggregated.exists():
            aggregated.seed(_dated(plan.full(after(None)), aggregated, markers), instant, unique_keys=True, read_up_to=dict(markers))
            return
        seen = {name: aggregated.state().read_up_to.get(name, "") for name in markers}
        if seen == dict(markers):
            return
        if seen != {name: before.get(name, "") for name in markers}:
            aggregated.seed(_dated(plan.full(after(None)), aggregated, markers), instant, replace=True, unique_keys=True, read_up_to=dict(markers))
            return
        _apply_signed(aggregated, plan, plan.signed(old, new), markers, after, instant)

    return apply


def _dated(rows: DataFrame, aggregated: LakeTable, markers: Mapping[str, str]) -> DataFrame:
    """Rows with the ordering column of the aggregated table: the newest commit that went into them."""
    return rows.withColumn(aggregated.spec.ordering, F.lit(max(markers.values())))


def _apply_signed(aggregated, plan: Aggregate, delta: DataFrame, markers, after, instant) -> None:
    groups = list(plan.groups)
    stored = aggregated.snapshot().select(*groups, *[F.col(c).alias(f"_s_{c}") for c in (plan.count, *plan.sums, *plan.maxima)])

    def was(column: str) -> Column:
        return F.col(f"_s_{column}")

    def added(column: str) -> Column:
        # a sum of decimals is wider than what it adds to; the stored type is kept
        return (F.coalesce(was(column), F.lit(0)) + F.col(column)).cast(kinds[column])

    kinds = {f.name: f.dataType for f in aggregated.snapshot().schema}
    joined = delta.join(stored, groups, "left")
    changed = joined.select(
        *groups,
        *[added(c).alias(c) for c in (plan.count, *plan.sums)],
        # greatest() passes over NULLs
        *[F.greatest(was(c), F.col(_CAME + c)).cast(kinds[c]).alias(c) for c in plan.maxima],
        plan.lost(was).alias(_LOST),
    )
    with staged(changed, "groups") as (changed, _):
        anew = changed.where(F.col(_LOST) & (F.col(plan.count) > 0)).select(*groups)
        if anew.head(1):
            maxima = [F.max(F.expr(m)).alias(f"_m_{c}") for c, m in plan.maxima.items()]
            read = after(anew).groupBy(*groups).agg(*maxima)
            picked = {c: F.when(F.col(_LOST), F.col(f"_m_{c}")).otherwise(F.col(c)).cast(kinds[c]) for c in plan.maxima}
            changed = changed.join(read, groups, "left").withColumns(picked).drop(*[f"_m_{c}" for c in plan.maxima])
        flag = aggregated.spec.delete_flag
        rows = changed.drop(_LOST).withColumn(flag, F.col(plan.count) == 0)
        aggregated.upsert(_dated(rows, aggregated, markers), instant, read_up_to=dict(markers))


def current(aggregated: LakeTable) -> DataFrame:
    """The groups without the columns of the keyed table."""
    return aggregated.snapshot().drop(COMMIT_TIME, aggregated.spec.ordering, aggregated.spec.delete_flag)
