"""The change feed of the checks: a full load of orders and two change batches, the second one late.

    batch 0  every order as stored                          I  sequence 0
    batch 1  urgent and high priority: price + 2            U  sequence 2
             finished orders of high and medium priority    D  sequence 3
    batch 2  finished and pending orders: price + 1         U  sequence 1 (older than batch 1)
             a new order for every low-priority one         I  sequence 1
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import DELETE, INSERT, OP, SEQUENCE, UPDATE, change_envelope
from tidemark.queries.registry import load
from tidemark.spec import TableSpec

STARTED = datetime(2024, 1, 1)
SEED, FIRST, SECOND = "20240101000000000", "20240102000000000", "20240103000000000"
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def order_spec(**overrides) -> TableSpec:
    return TableSpec(**{"name": "public.orders", "keys": ("o_orderkey",), **overrides})


def moment(text: str) -> Column:
    """A fixed time, the same in every session time zone."""
    return F.lit(text).cast("timestamp_ntz")


def _changes(orders: DataFrame, op: str, counter: int, where: Column | None = None, **new: Column) -> DataFrame:
    rows = orders if where is None else orders.where(where)
    rows = rows.withColumns(new) if new else rows
    return rows.withColumns(
        {"op": F.lit(op), "changed_at": moment("2024-01-01 00:00:00"), "counter": F.lit(counter)}
    )


def raw_batch(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """One batch as the source sends it: operation, time, counter and after-image."""
    orders = load(spark, folder, "orders").select(*COLUMNS)
    priority, status, price = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
    if number == 0:
        return _changes(orders, INSERT, 0)
    if number == 1:
        gone = (status == "F") & priority.isin("2-HIGH", "3-MEDIUM")
        return _changes(
            orders, UPDATE, 2, priority.isin("1-URGENT", "2-HIGH"), o_totalprice=price + 2
        ).unionByName(_changes(orders, DELETE, 3, gone))
    return _changes(orders, UPDATE, 1, status.isin("F", "P"), o_totalprice=price + 1).unionByName(
        _changes(orders, INSERT, 1, priority == "5-LOW", o_orderkey=-1 - F.col("o_orderkey"))
    )


def batch(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """One batch with its change envelope."""
    return change_envelope(raw_batch(spark, folder, number), "op", "changed_at", "counter")


def feed(spark: SparkSession, folder: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [batch(spark, folder, n) for n in range(3)])


RESULT = [*COLUMNS, OP, SEQUENCE]

FEED_SQL = """
feed AS (
  SELECT 0 AS batch, 'I' AS "Op", 0 AS counter, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders
  UNION ALL
  SELECT 1, 'U', 2, o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL
  SELECT 1, 'D', 3, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('2-HIGH', '3-MEDIUM')
  UNION ALL
  SELECT 2, 'U', 1, o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus IN ('F', 'P')
  UNION ALL
  SELECT 2, 'I', 1, -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '5-LOW'
), changes AS (
  SELECT batch, counter, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         "Op", '20240101000000' || lpad(CAST(counter AS VARCHAR), 21, '0') AS trx_seq,
         ("Op" = 'D') AS _is_deleted,
         CASE batch WHEN 0 THEN '20240101000000000' WHEN 1 THEN '20240102000000000'
                    ELSE '20240103000000000' END AS _commit_time
  FROM feed
)"""

RESULT_SQL = 'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, "Op", trx_seq'


def winners_sql(order: str, select: str = RESULT_SQL, where: str = "NOT _is_deleted") -> str:
    """The winning change of every key under an order of the changes."""
    return f"""
WITH {FEED_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY {order}) AS nth FROM changes
)
SELECT {select} FROM ranked WHERE nth = 1 AND {where}"""


LATEST_SQL = winners_sql("trx_seq DESC")
INCOMING_SQL = winners_sql("batch DESC, trx_seq DESC")


def natural_line_spec(**overrides) -> TableSpec:
    """Line items by (order, line); the data repeats that key, the latest ship date wins."""
    return TableSpec(
        **{
            "name": "public.lineitem",
            "keys": ("l_orderkey", "l_linenumber"),
            "ordering": "l_shipdate",
            **overrides,
        }
    )


NATURAL_LINES_SQL = """
lines AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS nth
    FROM lineitem)
  WHERE nth = 1
)"""
