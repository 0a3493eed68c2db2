"""Tables routed and enriched by a rule document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.rules import compile_rules, land_routed
from tidemark.queries.registry import load, query
from tidemark.sources.raw_zone import INCREMENTAL, raw_folder
from tidemark.workspace import new_folder

DOCUMENT = {
    "rules": [
        {
            "rule-type": "selection",
            "rule-id": "0",
            "object-locator": {"schema-name": "public", "table-name": "%"},
            "rule-action": "include",
            "filters": [],
        },
        {
            "rule-type": "selection",
            "rule-id": "1",
            "object-locator": {"schema-name": "public", "table-name": "events_part%"},
            "rule-action": "exclude",
            "filters": [{"column-name": "event_type", "filter-conditions": [{"filter-operator": "eq", "value": "view"}]}],
        },
        {
            "rule-type": "transformation",
            "rule-id": "10",
            "rule-target": "table",
            "object-locator": {"schema-name": "%", "table-name": "events_part%"},
            "rule-action": "add-prefix",
            "value": "events/",
        },
        {
            "rule-type": "transformation",
            "rule-id": "12",
            "rule-target": "column",
            "object-locator": {"schema-name": "%", "table-name": "%"},
            "rule-action": "add-column",
            "value": "trx_seq",
            "expression": "$AR_H_CHANGE_SEQ",
            "data-type": {"type": "string", "length": 50},
        },
        {
            "rule-type": "transformation",
            "rule-id": "14",
            "rule-target": "column",
            "object-locator": {"schema-name": "%", "table-name": "%"},
            "rule-action": "add-column",
            "value": "_is_deleted",
            "expression": "CASE WHEN $AR_H_OPERATION = 'DELETE' THEN TRUE ELSE FALSE END",
            "data-type": {"type": "boolean"},
        },
        {
            "rule-type": "post-processing",
            "rule-id": "20",
            "rule-action": "add-tag",
            "object-locator": {"schema-name": "%", "table-name": "%"},
            "tag-set": [
                {"key": "source_dbname", "value": "${database}"},
                {"key": "target_table", "value": "${database}_${schema-name}_${table-name}"},
            ],
        },
    ]
}


def mixed_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of three tables as one feed: orders, physical partitions of events, and an audit copy of the orders."""
    orders, events = load(spark, folder, "orders"), load(spark, folder, "events")
    status, kind = F.col("o_orderstatus"), F.col("event_type")
    order_op = F.when(status == "F", "D").when(status == "P", "U").otherwise("I")
    of_orders = orders.select(
        F.explode(F.array(F.lit("public"), F.lit("audit"))).alias("schema_name"),
        F.lit("orders").alias("table_name"),
        order_op.alias("Op"),
        F.lpad(F.col("o_orderkey").cast("string"), 21, "0").alias("change_seq"),
        F.col("o_orderdate").alias("changed_at"),
        "o_orderkey",
        "o_totalprice",
    )
    of_events = events.select(
        F.lit("public").alias("schema_name"),
        F.concat(F.lit("events_part"), (F.col("event_id") % 4).cast("string")).alias("table_name"),
        F.when(kind == "error", "D").otherwise("I").alias("Op"),
        F.lpad(F.col("event_id").cast("string"), 21, "0").alias("change_seq"),
        F.col("ts").alias("changed_at"),
        "event_id",
        "event_type",
        "value",
    )
    return of_orders.unionByName(of_events, allowMissingColumns=True)


@query("""
SELECT 'orders' AS table_name, 'whole' AS part, CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'P' THEN 'U' ELSE 'I' END AS op,
       o_orderkey AS record, o_totalprice AS amount, lpad(CAST(o_orderkey AS VARCHAR), 21, '0') AS trx_seq,
       o_orderstatus = 'F' AS _is_deleted, 'shop' AS source_dbname, 'shop_public_orders' AS target_table
FROM orders
UNION ALL
SELECT 'events', 'events_part' || (event_id % 4), CASE WHEN event_type = 'error' THEN 'D' ELSE 'I' END,
       event_id, value, lpad(CAST(event_id AS VARCHAR), 21, '0'), event_type = 'error', 'shop',
       'shop_public_events_part' || (event_id % 4)
FROM events WHERE event_type IS NULL OR event_type <> 'view'""")
def rule_routing(spark: SparkSession, folder: str) -> DataFrame:
    """A mixed feed landed as one data set, split into its logical tables by a rule document in one pass."""
    landed, routed = new_folder(spark, "mixed"), raw_folder(new_folder(spark, "raw"), INCREMENTAL, "shop")
    feed = mixed_feed(spark, folder)
    feed.write.parquet(landed)
    rules = compile_rules(DOCUMENT, variables={"database": "shop"})
    land_routed(spark.read.schema(feed.schema).parquet(landed), rules, routed)
    return spark.read.parquet(routed).select(
        F.col("table_folder").alias("table_name"),
        F.col("part_folder").alias("part"),
        F.col("Op").alias("op"),
        F.coalesce("o_orderkey", "event_id").alias("record"),
        F.when(F.col("table_folder") == "orders", F.col("o_totalprice")).otherwise(F.col("value")).alias("amount"),
        "trx_seq",
        "_is_deleted",
        F.col("tags.source_dbname").alias("source_dbname"),
        F.col("tags.target_table").alias("target_table"),
    )
