"""Derived tables: the denormalized order line, its refresh, and daily sales."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import DELETED, TIME_PATTERN, full_load_envelope
from tidemark.operators.merge import INCOMING_WINS
from tidemark.plans.aggregate import current, follow
from tidemark.plans.bucketed import denormalize_bucketed, save_bucketed
from tidemark.plans.order_line import (
    RETAIL_LAYOUT,
    WAREHOUSE_LAYOUT,
    Sources,
    denormalize,
    denormalize_changes,
    ordered,
    table_spec,
)
from tidemark.plans.refresh import refresh, refresh_any
from tidemark.plans.sales import SALES, sales_by_district_and_day
from tidemark.queries import feeds
from tidemark.queries.registry import load, query
from tidemark.sources.footers import extremes
from tidemark.spec import TableSpec
from tidemark.tables.catalog import create_database
from tidemark.tables.lake_table import COMMIT_TIME, LakeTable
from tidemark.workspace import new_folder


_BUCKETS = 16


def raw_database(spark: SparkSession, root: str) -> str:
    """A database of its own for the tables below one folder."""
    name = f"tidemark_{root.rsplit('/', 1)[-1].replace('-', '_')}"
    create_database(spark, name, f"{root}.db")
    return name


def _retail_sources(spark: SparkSession, folder: str, lines: DataFrame) -> Sources:
    roles = {"orders": "orders", "customer": "customer", "district": "nation", "warehouse": "region", "item": "part"}
    return Sources(order_line=lines, **{role: load(spark, folder, name) for role, name in roles.items()})


def _day_as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ol_instant_time", F.col("ol_instant_time").cast("string"))


def retail_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").withColumn(COMMIT_TIME, F.lit(feeds.SEED))
    return denormalize(_retail_sources(spark, folder, lines), RETAIL_LAYOUT)


_KEY = "c_custkey || '-' || r_regionkey || '-' || n_nationkey"


def _denorm_sql(lines: str, day: str) -> str:
    return f"""
SELECT {_KEY} || '-' || o_orderkey AS aol_sk, {_KEY} AS c_sk,
       c_custkey AS c_id, r_regionkey AS w_id, n_nationkey AS d_id, o_orderkey AS o_id,
       l_linenumber AS ol_number, o_orderdate AS o_entry_d, strftime(o_orderdate, '%Y/%m/%d') AS order_date,
       p_partkey AS i_id, c_name, c_mktsegment, c_acctbal, o_orderstatus, o_orderpriority, o_totalprice,
       l_discount, l_tax, r_name AS whouse_name, n_name AS district_name, l_shipdate AS delivery_date,
       l_quantity AS quantity, l_extendedprice AS amount, p_name AS item_name, p_retailprice AS item_price,
       {day} AS ol_instant_time
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN {lines} ON o_orderkey = l_orderkey
JOIN part ON l_partkey = p_partkey"""


@query(_denorm_sql("lineitem", "'2024-01-01'"))
def denorm_order_line(spark: SparkSession, folder: str) -> DataFrame:
    """Six tables joined into one row per order line."""
    return _day_as_text(retail_order_lines(spark, folder))


@query(_denorm_sql("lineitem", "'2024-01-01'"))
def denorm_sorted(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows in key order."""
    return _day_as_text(ordered(retail_order_lines(spark, folder)))


def _warehouse_sources(spark: SparkSession, folder: str) -> Sources:
    """The test tables with the composite keys of the warehouse schema: a district belongs to a warehouse,
    a customer to a district, an order to its customer's district, an order line to its order's."""
    region, nation = load(spark, folder, "region"), load(spark, folder, "nation")
    district = nation.select(
        F.col("n_nationkey").alias("d_id"), F.col("n_regionkey").alias("d_w_id"), F.col("n_name").alias("d_name")
    )
    home = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("c_w_id"))
    customer = (
        load(spark, folder, "customer")
        .join(home, "c_nationkey")
        .select(
            F.col("c_custkey").alias("c_id"),
            F.col("c_nationkey").alias("c_d_id"),
            "c_w_id",
            F.col("c_mktsegment").alias("c_zip"),
            F.when(F.col("c_acctbal") < 0, "BC").otherwise("GC").alias("c_credit"),
            F.abs("c_acctbal").alias("c_credit_lim"),
            F.lit(0.0).alias("c_discount"),
            F.col("c_acctbal").alias("c_balance"),
            F.lit(10.0).alias("c_ytd_payment"),
            F.lit(1).alias("c_payment_cnt"),
            F.lit(0).alias("c_delivery_cnt"),
        )
    )
    scope = customer.select(
        F.col("c_id").alias("o_c_id"), F.col("c_d_id").alias("o_d_id"), F.col("c_w_id").alias("o_w_id")
    )
    orders = (
        load(spark, folder, "orders")
        .select(
            F.col("o_orderkey").alias("o_id"),
            F.col("o_custkey").alias("o_c_id"),
            F.col("o_orderdate").alias("o_entry_d"),
        )
        .join(scope, "o_c_id")
    )
    order_scope = orders.select(
        F.col("o_id").alias("ol_o_id"), F.col("o_d_id").alias("ol_d_id"), F.col("o_w_id").alias("ol_w_id")
    )
    order_line = (
        load(spark, folder, "lineitem")
        .select(
            F.col("l_orderkey").alias("ol_o_id"),
            F.col("l_linenumber").alias("ol_number"),
            F.col("l_partkey").alias("ol_i_id"),
            F.col("l_shipdate").alias("ol_delivery_d"),
            F.col("l_quantity").alias("ol_quantity"),
            F.col("l_extendedprice").alias("ol_amount"),
            F.lit(feeds.SEED).alias(COMMIT_TIME),
        )
        .join(order_scope, "ol_o_id")
    )
    return Sources(
        orders=orders,
        customer=customer,
        district=district,
        warehouse=region.select(F.col("r_regionkey").alias("w_id"), F.col("r_name").alias("w_name")),
        order_line=order_line,
        item=load(spark, folder, "part").select(
            F.col("p_partkey").alias("i_id"), F.col("p_name").alias("i_name"), F.col("p_retailprice").alias("i_price")
        ),
    )


@query(f"""
SELECT {_KEY} || '-' || o_orderkey AS aol_sk, {_KEY} AS c_sk,
       c_custkey AS c_id, r_regionkey AS w_id, n_nationkey AS d_id, o_orderkey AS o_id,
       l_linenumber AS ol_number, o_orderdate AS o_entry_d, strftime(o_orderdate, '%Y/%m/%d') AS order_date,
       p_partkey AS i_id, c_mktsegment AS c_zip, CASE WHEN c_acctbal < 0 THEN 'BC' ELSE 'GC' END AS c_credit,
       abs(c_acctbal) AS c_credit_lim, CAST(0.0 AS DOUBLE) AS c_discount, c_acctbal AS c_balance,
       CAST(10.0 AS DOUBLE) AS c_ytd_payment, 1 AS c_payment_cnt, 0 AS c_delivery_cnt,
       r_name AS whouse_name, n_name AS district_name, l_shipdate AS delivery_date,
       l_quantity AS quantity, l_extendedprice AS amount, p_name AS item_name, p_retailprice AS item_price,
       '2024-01-01' AS ol_instant_time
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN lineitem ON o_orderkey = l_orderkey
JOIN part ON l_partkey = p_partkey""")
def denorm_composite_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The same plan on the warehouse schema: two- and three-column join keys."""
    return _day_as_text(denormalize(_warehouse_sources(spark, folder), WAREHOUSE_LAYOUT))


@query(
    f"WITH {feeds.NATURAL_LINES_SQL}"
    + _denorm_sql(
        "lines", "CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN '2024-01-02' ELSE '2024-01-01' END"
    )
)
def denorm_incremental_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Built from the first commit of the line items, then refreshed with the second one only."""
    place = new_folder(spark, "refresh")
    lines = load(spark, folder, "lineitem")
    late = F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    early = ~F.coalesce(late, F.lit(False))  # lines without a ship date come with the first commit
    fact = LakeTable(spark, f"{place}/lineitem", feeds.natural_line_spec())
    # a folder per district: the test tables hold only a few lines a day
    target = LakeTable(spark, f"{place}/order_line_dn", table_spec(partition_by=("district_name",)))

    def build(rows: DataFrame) -> DataFrame:
        return denormalize(_retail_sources(spark, folder, rows), RETAIL_LAYOUT)

    def update(rows: DataFrame, small: bool) -> DataFrame:
        return denormalize_changes(_retail_sources(spark, folder, rows), RETAIL_LAYOUT, small)

    fact.seed(lines.where(early), feeds.SEED)
    refresh(target, fact, build, update, feeds.SEED)
    fact.upsert(lines.where(~early), feeds.FIRST)
    refresh(target, fact, build, update, feeds.FIRST)
    return _day_as_text(target.snapshot().drop(target.spec.delete_flag, COMMIT_TIME))


_CHANGED_ORDERS_SQL = """
changed_orders AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 1 + o_custkey % 10 ELSE o_custkey END AS o_custkey)
  FROM orders WHERE o_orderpriority <> '2-HIGH')"""


@query(
    f"WITH {feeds.NATURAL_LINES_SQL}, kept AS (SELECT * FROM lines WHERE l_returnflag <> 'R'), {_CHANGED_ORDERS_SQL}"
    + _denorm_sql("kept", "'2024-01-01'").replace("FROM orders", "FROM changed_orders")
)
def denorm_refresh_any(spark: SparkSession, folder: str) -> DataFrame:
    """Refreshed after deleted lines, late orders, orders of another customer and deleted orders."""
    target = _refreshed_thrice(spark, folder, new_folder(spark, "refresh"))
    return _day_as_text(target.snapshot().drop(target.spec.delete_flag, COMMIT_TIME))


def _refreshed_thrice(spark: SparkSession, folder: str, place: str, watch=None) -> LakeTable:
    lines, orders = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    fact = LakeTable(spark, f"{place}/lineitem", feeds.natural_line_spec())
    source = LakeTable(spark, f"{place}/orders", feeds.order_spec())
    target = LakeTable(spark, f"{place}/order_line_dn", table_spec(partition_by=("district_name",)))

    def sources(rows: DataFrame) -> Sources:
        return replace(_retail_sources(spark, folder, rows), orders=source.snapshot().select(*orders.columns))

    def touched(changed: DataFrame, fact_rows: DataFrame) -> DataFrame:
        return fact_rows.join(changed.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")

    def run(instant: str) -> None:
        refresh_any(
            target,
            fact,
            lambda rows: denormalize(sources(rows), RETAIL_LAYOUT),
            lambda rows, small: denormalize_changes(sources(rows), RETAIL_LAYOUT, small),
            {"l_orderkey": "o_id", "l_linenumber": "ol_number"},
            {source: touched},
            instant,
            watch,
        )

    fact.seed(lines, feeds.SEED)
    late = F.col("o_orderpriority") == "5-LOW"
    source.seed(full_load_envelope(orders.where(~late), feeds.STARTED), feeds.SEED)
    run(feeds.SEED)
    returned = fact.snapshot().where("l_returnflag = 'R'").drop(COMMIT_TIME)
    fact.upsert(returned.withColumn(DELETED, F.lit(True)), feeds.FIRST, unique_keys=True)
    source.upsert(full_load_envelope(orders.where(late), feeds.STARTED), feeds.FIRST)
    run(feeds.FIRST)
    moved = orders.where("o_orderstatus = 'P'").withColumn("o_custkey", 1 + F.col("o_custkey") % 10)
    gone = orders.where("o_orderpriority = '2-HIGH' AND o_orderstatus <> 'P'")
    gone = gone.unionByName(moved.where("o_orderpriority = '2-HIGH'"))
    moved = moved.where("o_orderpriority <> '2-HIGH'")
    changes = full_load_envelope(moved, feeds.STARTED).unionByName(
        full_load_envelope(gone, feeds.STARTED).withColumn(DELETED, F.lit(True))
    )
    source.upsert(changes, feeds.SECOND)
    run(feeds.SECOND)
    return target


@query("""
SELECT n_name AS district_name, strftime(o_orderdate, '%Y/%m/%d') AS order_date, count(*) AS n_lines,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_amount,
       max(l_extendedprice) AS max_amount
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN lineitem ON o_orderkey = l_orderkey
JOIN part ON l_partkey = p_partkey
GROUP BY n_name, strftime(o_orderdate, '%Y/%m/%d')""")
def gold_sales_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per nation and day."""
    return sales_by_district_and_day(retail_order_lines(spark, folder))


@query(
    f"WITH {feeds.NATURAL_LINES_SQL}, kept AS (SELECT * FROM lines WHERE l_returnflag <> 'R'), {_CHANGED_ORDERS_SQL}"
    + """
SELECT n_name AS district_name, strftime(o_orderdate, '%Y/%m/%d') AS order_date, count(*) AS n_lines,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_amount,
       max(l_extendedprice) AS max_amount
FROM changed_orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN kept ON o_orderkey = l_orderkey
JOIN part ON l_partkey = p_partkey
GROUP BY n_name, strftime(o_orderdate, '%Y/%m/%d')"""
)
def gold_sales_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per nation and day, kept current through deletes and changes of lines and orders by signed changes."""
    place = new_folder(spark, "sales")
    spec = TableSpec("gold.sales", keys=SALES.groups, ordering="as_of", policy=INCOMING_WINS)
    sales = LakeTable(spark, f"{place}/sales", spec)
    _refreshed_thrice(spark, folder, place, follow(sales, SALES))
    amount = F.col("sum_amount").cast("double")
    return current(sales).select(
        *SALES.groups,
        "n_lines",
        F.col("sum_quantity").cast("double").alias("sum_quantity"),
        amount.alias("sum_amount"),
        (amount / F.col("n_lines")).alias("avg_amount"),
        F.col("max_amount").cast("double").alias("max_amount"),
    )


@query(_denorm_sql("lineitem", "'2024-01-01'"))
def denorm_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The denormalized order line from fact tables in buckets of the order's key, which meet without a shuffle."""
    place = new_folder(spark, "bucketed")
    database = raw_database(spark, place)
    lines = load(spark, folder, "lineitem").withColumn(COMMIT_TIME, F.lit(feeds.SEED))
    lines = save_bucketed(lines, f"{database}.lines", f"{place}/lines", ["l_orderkey"], _BUCKETS)
    orders = save_bucketed(load(spark, folder, "orders"), f"{database}.orders", f"{place}/orders", ["o_orderkey"], _BUCKETS)
    sources = replace(_retail_sources(spark, folder, lines), orders=orders)
    return _day_as_text(denormalize_bucketed(sources, RETAIL_LAYOUT))


@query("""
SELECT count(*) AS n_rows, strftime(max(CAST(o_orderdate AS DATE)), '%Y%m%d%H%M%S') AS last_day,
       min(o_orderkey) AS least_key, max(o_orderkey) AS greatest_key
FROM orders""")
def max_from_footers(spark: SparkSession, folder: str) -> DataFrame:
    """The last day, the range of keys and the number of rows of a table, from the footers of its files."""
    place = new_folder(spark, "footers")
    load(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")).write.parquet(place)
    found = extremes(spark, place, ["o_orderkey", "day"])
    return found.select(
        "n_rows",
        F.date_format("greatest_day", TIME_PATTERN).alias("last_day"),
        F.col("least_o_orderkey").alias("least_key"),
        F.col("greatest_o_orderkey").alias("greatest_key"),
    )
