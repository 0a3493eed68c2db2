"""The denormalized order line: orders, customer, district, warehouse, order line and item in one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import TIME_DIGITS, TIME_PATTERN
from tidemark.functions.keys import joined_key
from tidemark.operators.merge import broadcast_limit, planned_bytes
from tidemark.plans.star import Reference, star_join
from tidemark.spec import TableSpec, TableType
from tidemark.tables.lake_table import COMMIT_TIME

# Names, key, order and partition of the derived table.
TABLE_NAME = "order_line_dn"
KEYS = ("aol_sk", "ol_number")
ORDERING = "ol_instant_time"
DAY_PATTERN = "yyyy/MM/dd"
SORT_ORDER = ("aol_sk", "ol_number", "ol_instant_time")


@dataclass(frozen=True)
class Layout:
    """Join keys (left, right), and where the output columns come from, for one source schema."""

    customer: Sequence[tuple[str, str]]
    district: Sequence[tuple[str, str]]
    warehouse: Sequence[tuple[str, str]]
    order_line: Sequence[tuple[str, str]]
    item: Sequence[tuple[str, str]]
    customer_key: str
    warehouse_key: str
    district_key: str
    order_key: str
    item_key: str
    line_number: str
    order_time: str
    renamed: Mapping[str, str]
    kept: Sequence[str] = field(default_factory=tuple)


# The warehouse schema with composite keys.
WAREHOUSE_LAYOUT = Layout(
    customer=(("o_c_id", "c_id"), ("o_d_id", "c_d_id"), ("o_w_id", "c_w_id")),
    district=(("c_d_id", "d_id"), ("c_w_id", "d_w_id")),
    warehouse=(("d_w_id", "w_id"),),
    order_line=(("o_id", "ol_o_id"), ("o_d_id", "ol_d_id"), ("o_w_id", "ol_w_id")),
    item=(("ol_i_id", "i_id"),),
    customer_key="c_id",
    warehouse_key="w_id",
    district_key="d_id",
    order_key="o_id",
    item_key="i_id",
    line_number="ol_number",
    order_time="o_entry_d",
    kept=(
        "c_zip",
        "c_credit",
        "c_credit_lim",
        "c_discount",
        "c_balance",
        "c_ytd_payment",
        "c_payment_cnt",
        "c_delivery_cnt",
    ),
    renamed={
        "w_name": "whouse_name",
        "d_name": "district_name",
        "ol_delivery_d": "delivery_date",
        "ol_quantity": "quantity",
        "ol_amount": "amount",
        "i_name": "item_name",
        "i_price": "item_price",
    },
)

# The same roles in an orders / line item / part schema with single-column keys.
RETAIL_LAYOUT = Layout(
    customer=(("o_custkey", "c_custkey"),),
    district=(("c_nationkey", "n_nationkey"),),
    warehouse=(("n_regionkey", "r_regionkey"),),
    order_line=(("o_orderkey", "l_orderkey"),),
    item=(("l_partkey", "p_partkey"),),
    customer_key="c_custkey",
    warehouse_key="r_regionkey",
    district_key="n_nationkey",
    order_key="o_orderkey",
    item_key="p_partkey",
    line_number="l_linenumber",
    order_time="o_orderdate",
    kept=(
        "c_name",
        "c_mktsegment",
        "c_acctbal",
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
        "l_discount",
        "l_tax",
    ),
    renamed={
        "r_name": "whouse_name",
        "n_name": "district_name",
        "l_shipdate": "delivery_date",
        "l_quantity": "quantity",
        "l_extendedprice": "amount",
        "p_name": "item_name",
        "p_retailprice": "item_price",
    },
)


def instant_day(instant: Column) -> Column:
    """The day of a commit instant; its milliseconds are cut off because the pattern has none."""
    return F.to_date(F.substring(instant, 1, TIME_DIGITS), TIME_PATTERN)


@dataclass(frozen=True)
class Sources:
    """The six relations; ``order_line`` carries the commit time of the keyed table it was read from."""

    orders: DataFrame
    customer: DataFrame
    district: DataFrame
    warehouse: DataFrame
    order_line: DataFrame
    item: DataFrame

    def references(self) -> list[DataFrame]:
        """All but the order line, without commit times of their own."""
        others = [self.orders, self.customer, self.district, self.warehouse, self.item]
        return [rows.drop(COMMIT_TIME) for rows in others]


def _derived_columns() -> dict[str, Column]:
    """Columns that follow from the order's output columns."""
    customer_scope = ("c_id", "w_id", "d_id")
    return {
        "aol_sk": joined_key(*customer_scope, "o_id"),
        "c_sk": joined_key(*customer_scope),
        "order_date": F.date_format("o_entry_d", DAY_PATTERN),
    }


def _order_columns(layout: Layout) -> dict[str, Column]:
    """Columns that are the same for all lines of an order."""
    return {
        "c_id": F.col(layout.customer_key),
        "w_id": F.col(layout.warehouse_key),
        "d_id": F.col(layout.district_key),
        "o_id": F.col(layout.order_key),
        "o_entry_d": F.col(layout.order_time),
    }


def _line_columns(layout: Layout) -> dict[str, Column]:
    return {
        "ol_number": F.col(layout.line_number),
        "i_id": F.col(layout.item_key),
        "ol_instant_time": instant_day(F.col(COMMIT_TIME)),
    }


def _copied(layout: Layout) -> dict[str, str]:
    """Columns taken over as they are: output name to source name."""
    return {**{c: c for c in layout.kept}, **{new: old for old, new in layout.renamed.items()}}


def _fits_broadcast(item: DataFrame, layout: Layout) -> bool:
    """Whether Spark broadcasts the columns of the item table that are needed."""
    needed = {right for _, right in layout.item} | {c for c in _copied(layout).values() if c in item.columns}
    return planned_bytes(item.select(*sorted(needed))) <= broadcast_limit(item.sparkSession)


def output_columns(layout: Layout) -> list[str]:
    front = ["aol_sk", "c_sk", "c_id", "w_id", "d_id", "o_id", "ol_number", "o_entry_d", "order_date", "i_id"]
    return [*front, *_copied(layout), "ol_instant_time"]


def denormalize(sources: Sources, layout: Layout) -> DataFrame:
    """26 columns per order line, for all order lines.

    Orders meet their customers before their lines: fewer rows are moved, and what all lines of an order
    share is computed once per order.
    """
    orders, customer, district, warehouse, item = sources.references()
    whole = star_join(
        orders,
        Reference(customer, layout.customer),
        Reference(district, layout.district),
        Reference(warehouse, layout.warehouse),
    )
    copied = _copied(layout)
    order_level = {new: F.col(old) for new, old in copied.items() if old in whole.columns}
    line_level = {new: F.col(old) for new, old in copied.items() if old not in whole.columns}
    per_order = {**_order_columns(layout), **order_level}
    join_keys = {f"_order_{i}": left for i, (left, _) in enumerate(layout.order_line)}
    whole = whole.select(
        *[F.col(c).alias(k) for k, c in join_keys.items()], *[v.alias(k) for k, v in per_order.items()]
    )
    on_order = [(key, right) for key, (_, right) in zip(join_keys, layout.order_line)]
    per_line = {**_line_columns(layout), **line_level}
    # two facts meet here: both are shuffled on the order, neither is ever collected for a broadcast
    if _fits_broadcast(item, layout):
        facts = sources.order_line.hint("merge")
        lines = star_join(whole, Reference(facts, on_order), Reference(item, layout.item))
    else:
        # items that are shuffled meet the lines while these are narrow; lines of an order then stay together
        facts = star_join(sources.order_line, Reference(item, layout.item))
        line_keys = {f"_line_{i}": right for i, (_, right) in enumerate(layout.order_line)}
        facts = facts.select(*[F.col(c).alias(k) for k, c in line_keys.items()], *[v.alias(k) for k, v in per_line.items()])
        lines = star_join(whole, Reference(facts.hint("merge"), list(zip(join_keys, line_keys))))
        per_line = {}
    # the order may carry an output name that is a source name of the item; outputs of the order stay as they are
    # texts that follow from the order's columns are made behind the shuffle
    per_line |= _derived_columns()
    return lines.select(*[per_line[c].alias(c) if c in per_line else c for c in output_columns(layout)])


def denormalize_changes(sources: Sources, layout: Layout, small: bool, bucketed: bool = False) -> DataFrame:
    """The same columns for changed order lines only: the joins start from the few lines and look up the rest.

    Lines that are not few meet items that must be shuffled while they are narrow. ``bucketed`` lines stay where they are
    until they have met their orders.
    """
    orders, customer, district, warehouse, item = sources.references()
    of_order = [
        Reference(orders, [(right, left) for left, right in layout.order_line]),
        Reference(customer, layout.customer),
        Reference(district, layout.district),
        Reference(warehouse, layout.warehouse),
    ]
    of_item = [Reference(item, layout.item)]
    late = small or bucketed or _fits_broadcast(item, layout)
    lines = star_join(sources.order_line, *(of_order + of_item if late else of_item + of_order), small_start=small)
    outputs = {
        **_order_columns(layout),
        **_line_columns(layout),
        **{new: F.col(old) for new, old in _copied(layout).items()},
    }
    narrow = lines.select(*[column.alias(c) for c, column in outputs.items()])
    return narrow.withColumns(_derived_columns()).select(*output_columns(layout))


def ordered(rows: DataFrame) -> DataFrame:
    """Globally sorted, for a result that is read in order. Not used before a merge, which keeps no order."""
    return rows.orderBy(*SORT_ORDER)


def table_spec(**overrides) -> TableSpec:
    """The derived table: merge on read, one partition per order day. The day an order was entered does not
    change, so keys are matched inside their partition."""
    values = {
        "name": TABLE_NAME,
        "keys": KEYS,
        "ordering": ORDERING,
        "partition_by": ("order_date",),
        "table_type": TableType.MERGE_ON_READ,
        "stable_partition": True,
    }
    return TableSpec(**{**values, **overrides})
