"""Changes that do not fit the stored keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import DELETE, INSERT, OP, SEQUENCE, UPDATE, change_envelope
from tidemark.operators.apply_errors import ERROR, ErrorPolicy
from tidemark.queries import feeds
from tidemark.queries.registry import load, query
from tidemark.streaming.guarded import GuardedTable
from tidemark.tables.lake_table import LakeTable
from tidemark.workspace import new_folder

_STEPS = {
    "1-URGENT": [INSERT],
    "2-HIGH": [UPDATE],
    "3-MEDIUM": [DELETE],
    "4-NOT SPECIFIED": [INSERT, UPDATE],
    "5-LOW": [DELETE, UPDATE],
}


def _misfits(spark: SparkSession, folder: str) -> DataFrame:
    """One or two changes for every order, whether it is stored or not; prices tell them apart."""
    orders = load(spark, folder, "orders").select(*feeds.COLUMNS)
    batches = []
    for priority, letters in _STEPS.items():
        for n, letter in enumerate(letters, 1):
            rows = orders.where(F.col("o_orderpriority") == priority)
            added = {"op": F.lit(letter), "changed_at": feeds.moment("2024-01-01 00:00:00"), "counter": F.lit(n)}
            batches.append(rows.withColumns({**added, "o_totalprice": F.col("o_totalprice") + n}))
    return change_envelope(reduce(DataFrame.unionByName, batches), "op", "changed_at", "counter")


@query("""
WITH stored AS (SELECT *, o_orderstatus <> 'P' AS present FROM orders), steps AS (
  SELECT *, unnest(CASE o_orderpriority WHEN '1-URGENT' THEN ['I'] WHEN '2-HIGH' THEN ['U'] WHEN '3-MEDIUM' THEN ['D']
    WHEN '4-NOT SPECIFIED' THEN ['I', 'U'] ELSE ['D', 'U'] END) AS op,
    unnest(CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN [1, 2] ELSE [1] END) AS n
  FROM stored
), judged AS (
  SELECT *, CASE
    WHEN op = 'I' AND present THEN 'insert of present key'
    WHEN op = 'U' AND (o_orderpriority = '2-HIGH' AND NOT present OR o_orderpriority = '5-LOW') THEN 'update of absent key'
    WHEN op = 'D' AND NOT present THEN 'delete of absent key' END AS error
  FROM steps
), applied AS (
  SELECT o_orderkey, op, n, o_totalprice + n AS o_totalprice FROM judged WHERE error IS NULL
  UNION ALL SELECT o_orderkey, 'I', 0, o_totalprice FROM stored WHERE present
), ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY n DESC) AS nth FROM applied)
SELECT 'stored' AS found, o_orderkey, op AS "Op", n AS counter, o_totalprice, CAST(NULL AS VARCHAR) AS apply_error
FROM ranked WHERE nth = 1 AND op <> 'D'
UNION ALL
SELECT 'logged', o_orderkey, op, n, o_totalprice + n, error FROM judged WHERE error IS NOT NULL AND op <> 'D'""")
def apply_errors(spark: SparkSession, folder: str) -> DataFrame:
    """A batch with misfits: fitting changes are applied, misfits logged, deletes of absent rows passed over."""
    place = new_folder(spark, "guarded")
    table = LakeTable(spark, f"{place}/table", feeds.order_spec())
    table.seed(feeds.batch(spark, folder, 0).where("o_orderstatus <> 'P'"), feeds.SEED)
    guarded = GuardedTable(table, ErrorPolicy(), f"{place}/errors")
    guarded.upsert(_misfits(spark, folder), ("feed", 0), feeds.FIRST)
    columns = ["o_orderkey", OP, F.substring(SEQUENCE, 15, 21).cast("int").alias("counter"), "o_totalprice"]
    stored = table.snapshot().select(F.lit("stored").alias("found"), *columns, F.lit(None).cast("string").alias(ERROR))
    return stored.unionByName(guarded.errors().select(F.lit("logged").alias("found"), *columns, ERROR))
