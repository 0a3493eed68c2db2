"""An aggregated table that follows signed changes."""

from __future__ import annotations

import random

import pytest

from tidemark.operators.merge import INCOMING_WINS
from tidemark.plans.aggregate import Aggregate, current, follow
from tidemark.spec import TableSpec
from tidemark.tables.lake_table import LakeTable

PLAN = Aggregate(groups=("g",), count="n", sums={"total": "CAST(v AS DECIMAL(18,2))"}, maxima={"top": "v", "last": "w"})
SCHEMA = "id int, g string, v int, w string"


class Detail:
    """Detail rows on the driver, and the watch calls that a refresh would make."""

    def __init__(self, spark, place, rows):
        self.spark, self.rows, self.reads = spark, {r[0]: r for r in rows}, []
        spec = TableSpec("gold.x", keys=("g",), ordering="as_of", policy=INCOMING_WINS)
        self.table = LakeTable(spark, f"{place}/x", spec)
        self.watch = follow(self.table, PLAN)
        self.number = 0
        self.watch(self.frame([]), self.frame(rows), {}, self.marker(), self.after, None)

    def frame(self, rows):
        return self.spark.createDataFrame(list(rows), SCHEMA)

    def marker(self):
        return {"fact": f"{self.number:017d}"}

    def after(self, groups):
        rows = self.frame(self.rows.values())
        if groups is None:
            self.reads.append(None)
            return rows
        self.reads.append(sorted(r["g"] for r in groups.collect()))
        return rows.join(groups, ["g"], "left_semi")

    def change(self, gone=(), new=(), before=None):
        old = [self.rows[i] for i in {*gone, *(r[0] for r in new)} if i in self.rows]
        for i in gone:
            del self.rows[i]
        self.rows |= {r[0]: r for r in new}
        before = before or self.marker()
        self.number += 1
        self.reads = []
        self.watch(self.frame(old), self.frame(new), before, self.marker(), self.after, None)

    def agrees(self):
        def plain(rows):
            return sorted(tuple(r) for r in rows.select("g", "n", "total", "top", "last").collect())

        return plain(current(self.table)) == plain(PLAN.full(self.frame(self.rows.values())))


@pytest.fixture
def detail(spark, place):
    return Detail(spark, place, [(1, "a", 5, "x"), (2, "a", 7, "y"), (3, "b", 1, None), (4, "c", 9, "z")])


def test_it_starts_from_all_rows(detail):
    assert detail.agrees()


def test_inserts_and_sums_need_no_detail_rows(detail):
    detail.change(new=[(5, "a", 6, "a"), (6, "d", 2, None), (3, "b", 4, None)])
    assert detail.agrees() and detail.reads == []


def test_a_group_whose_maximum_left_is_read_anew_and_no_other(detail):
    detail.change(gone=[2], new=[(3, "b", 2, None)])
    assert detail.agrees() and detail.reads == [["a"]]


def test_a_maximum_that_is_replaced_by_a_greater_one_is_not_read(detail):
    detail.change(new=[(2, "a", 8, "y")])
    assert detail.agrees() and detail.reads == []


def test_rows_move_between_groups_and_empty_groups_go(detail):
    detail.change(gone=[3], new=[(4, "a", 9, "z")])
    assert detail.agrees()
    assert {r["g"] for r in current(detail.table).collect()} == {"a"}


def test_nulls(detail):
    detail.change(new=[(7, "e", None, None), (4, "c", None, None)])
    assert detail.agrees()


def test_a_step_that_was_committed_is_left_out(detail):
    before = detail.marker()
    detail.change(gone=[1])
    state = detail.table.state().number
    detail.watch(detail.frame([(1, "a", 5, "x")]), detail.frame([]), before, detail.marker(), detail.after, None)
    assert detail.table.state().number == state and detail.agrees()


def test_markers_that_do_not_fit_count_all_rows_anew(detail):
    detail.change(new=[(8, "b", 3, "q")], before={"fact": "unknown"})
    assert detail.reads == [None] and detail.agrees()


def test_random_changes(spark, place):
    draw = random.Random(8)
    row = lambda i: (i, draw.choice("abcdef"), draw.randrange(20), draw.choice("xyz"))
    detail = Detail(spark, place, [row(i) for i in range(40)])
    for step in range(4):
        gone = draw.sample(sorted(detail.rows), 8)
        changed = [i for i in draw.sample(sorted(detail.rows), 10) if i not in gone]
        detail.change(gone, [row(i) for i in [*changed, 100 + step, 200 + step]])
        assert detail.agrees(), step
