"""Rule documents: selection, names, columns, tags."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.plans.rules import Header, compile_rules, land_routed

HEADER = Header()


def rule(number, kind, action, schema="%", table="%", column=None, **more):
    locator = {"schema-name": schema, "table-name": table} | ({"column-name": column} if column else {})
    return {"rule-id": str(number), "rule-type": kind, "rule-action": action, "object-locator": locator, **more}


ALL = rule(0, "selection", "include", filters=[])


@pytest.fixture(scope="module")
def feed(spark):
    rows = [
        ("public", "orders", "I", "1", None, 1, "a"),
        ("public", "order_line_part1", "U", "2", None, 2, None),
        ("public", "orderXline", "D", "3", None, 3, "c"),
        ("audit", "orders", "I", "4", None, 4, "d"),
    ]
    return spark.createDataFrame(rows, "schema_name string, table_name string, Op string, change_seq string, changed_at date, id int, note string")


def routed(feed, *rules, **variables):
    return compile_rules({"rules": list(rules)}, HEADER, variables).route(feed)


def ids(rows):
    return sorted(r["id"] for r in rows.collect())


def test_nothing_is_taken_without_an_include_rule(feed):
    assert ids(routed(feed)) == []
    assert ids(routed(feed, ALL)) == [1, 2, 3, 4]


def test_excludes_win_and_underscores_stand_for_themselves(feed):
    chosen = rule(1, "selection", "include", "public", "order_line%")
    assert ids(routed(feed, chosen)) == [2]
    assert ids(routed(feed, ALL, rule(1, "selection", "exclude", "audit"))) == [1, 2, 3]


@pytest.mark.parametrize(
    "conditions, wanted",
    [
        ([{"filter-operator": "eq", "value": "a"}], [1]),
        ([{"filter-operator": "noteq", "value": "a"}], [3, 4]),
        ([{"filter-operator": "ste", "value": "c"}], [1, 3]),
        ([{"filter-operator": "gte", "value": "c"}], [3, 4]),
        ([{"filter-operator": "between", "start-value": "b", "end-value": "c"}], [3]),
        ([{"filter-operator": "null"}], [2]),
        ([{"filter-operator": "notnull"}], [1, 3, 4]),
        ([{"filter-operator": "eq", "value": "a"}, {"filter-operator": "eq", "value": "d"}], [1, 4]),
    ],
)
def test_filters(feed, conditions, wanted):
    chosen = rule(0, "selection", "include", filters=[{"column-name": "note", "filter-conditions": conditions}])
    assert ids(routed(feed, chosen)) == wanted


def test_names_follow_rules_in_the_order_of_their_ids(feed):
    first = rule(2, "transformation", "add-prefix", table="order_line_part%", value="order_line/", **{"rule-target": "table"})
    then = rule(10, "transformation", "convert-uppercase", schema="audit", **{"rule-target": "table"})
    last = rule(11, "transformation", "add-suffix", schema="audit", value="_old", **{"rule-target": "table"})
    schema = rule(12, "transformation", "rename", schema="audit", value="history", **{"rule-target": "schema"})
    rows = {r["id"]: (r["schema_folder"], r["table_folder"], r["part_folder"]) for r in routed(feed, ALL, schema, last, then, first).collect()}
    assert rows == {
        1: ("public", "orders", "whole"),
        2: ("public", "order_line", "order_line_part1"),
        3: ("public", "orderXline", "whole"),
        4: ("history", "ORDERS_old", "whole"),
    }


def added(number, name, expression, kind="string", **more):
    return rule(number, "transformation", "add-column", value=name, expression=expression, **{"rule-target": "column", "data-type": {"type": kind}}, **more)


def test_columns_are_added_renamed_and_removed_where_rules_say_so(feed):
    rows = routed(
        feed,
        ALL,
        added(1, "sequence", "$AR_H_CHANGE_SEQ", "int8"),
        added(2, "gone", "$AR_H_OPERATION = 'DELETE'", "boolean"),
        added(3, "label", "concat($note, '!')", schema="audit"),
        added(4, "label", "'other'"),
        rule(5, "transformation", "rename", schema="audit", column="note", value="remark", **{"rule-target": "column"}),
        rule(6, "transformation", "remove-column", table="orderXline", column="note", **{"rule-target": "column"}),
    )
    assert dict(rows.dtypes)["sequence"] == "bigint"
    found = {r["id"]: (r["sequence"], r["gone"], r["label"], r["note"], r["remark"]) for r in rows.collect()}
    assert found == {
        1: (1, False, "other", "a", None),
        2: (2, False, "other", None, None),
        3: (3, True, "other", None, None),
        4: (4, False, "d!", None, "d"),
    }


def test_tags_name_their_table(feed):
    tags = rule(7, "post-processing", "add-tag", "public", **{"tag-set": [{"key": "target", "value": "${db}_${schema-name}_${table-name}"}]})
    found = {r["id"]: r["tags"] for r in routed(feed, ALL, tags, db="shop").collect()}
    assert found[2] == {"target": "shop_public_order_line_part1"}
    assert found[4] == {"target": None}


@pytest.mark.parametrize(
    "wrong",
    [
        rule(1, "selecting", "include"),
        rule(1, "transformation", "shorten", **{"rule-target": "table"}),
        rule(0, "selection", "include"),
        rule(1, "post-processing", "remove-tag", **{"tag-set": []}),
    ],
)
def test_unknown_rules_are_refused(wrong):
    with pytest.raises(ValueError):
        compile_rules({"rules": [ALL, wrong]})


def test_unknown_header_fields_are_refused(feed):
    with pytest.raises(ValueError, match="header"):
        routed(feed, ALL, added(1, "x", "$AR_H_USER"))


def test_one_scan_and_one_write_for_all_tables(spark, feed, place):
    feed.write.parquet(f"{place}/mixed")
    rules = compile_rules({"rules": [ALL, added(1, "sequence", "$AR_H_CHANGE_SEQ")]})
    landed = spark.read.parquet(f"{place}/mixed")
    plan = rules.route(landed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    land_routed(landed, rules, f"{place}/out")
    back = spark.read.parquet(f"{place}/out")
    assert ids(back.where(F.col("schema_folder") == "audit")) == [4]
    assert back.count() == 4
