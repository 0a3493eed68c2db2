"""Common schemas of files that differ."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tidemark.sources.schemas import common_schema, common_type, data_files, merged_schema, read_merged, sampled

pytestmark = pytest.mark.usefixtures("spark")


def kind(text):
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


@pytest.mark.parametrize(
    "one, other, wanted",
    [
        ("int", "int", "int"),
        ("tinyint", "bigint", "bigint"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("bigint", "decimal(38,20)", "string"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("int", "float", "double"),
        ("float", "double", "double"),
        ("decimal(5,2)", "double", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", "timestamp"),
        ("boolean", "int", "string"),
        ("date", "int", "string"),
        ("string", "bigint", "string"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("struct<a:int>", "struct<a:string,b:int>", "struct<a:string,b:int>"),
        ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("struct<a:int>", "int", "string"),
    ],
)
def test_types_widen_the_same_either_way(one, other, wanted):
    assert common_type(kind(one), kind(other)) == kind(wanted)
    if "struct" not in one:
        assert common_type(kind(other), kind(one)) == kind(wanted)


def test_columns_keep_their_order_whatever_their_case():
    merged = common_schema([T.StructType.fromDDL("a int, B date"), T.StructType.fromDDL("c int, b timestamp_ntz, A bigint")])
    assert merged == T.StructType.fromDDL("a bigint, B timestamp_ntz, c int")


def test_samples_hold_both_ends():
    files = [f"{k:03d}" for k in range(100)]
    assert sampled(files, 10)[0] == "000" and sampled(files, 10)[-1] == "099" and len(set(sampled(files, 10))) == 10
    assert sampled(files, 1) == ["099"] and sampled(files[:3], 10) == files[:3] and sampled(files, None) == files


def test_files_that_differ_are_read_under_one_schema(spark, place):
    spark.sql("SELECT 1 AS id, struct(1 AS a) AS s, array(1) AS l, DATE'2024-01-01' AS t, true AS f").write.parquet(f"{place}/20240101")
    spark.sql("SELECT 5000000000L AS ID, struct('x' AS a, 2 AS b) AS s, array(2.5D) AS l, TIMESTAMP_NTZ'2024-01-02 03:00:00' AS t, 'no' AS f").write.parquet(f"{place}/20240102")
    spark.sql("SELECT 1.25BD AS id, 9 AS added, array('p') AS f").write.parquet(f"{place}/20240103/part=x")
    merged = merged_schema(spark, place)
    assert merged == T.StructType.fromDDL("id decimal(22,2), s struct<a:string,b:int>, l array<double>, t timestamp_ntz, f string, added int")
    rows = read_merged(spark, place)
    assert rows.schema == merged
    found = sorted((float(r["id"]), r["s"] and tuple(r["s"]), r["l"], str(r["t"]), r["f"], r["added"]) for r in rows.collect())
    assert found == [
        (1.0, ("1", None), [1.0], "2024-01-01 00:00:00", "true", None),
        (1.25, None, None, "None", '["p"]', 9),
        (5e9, ("x", 2), [2.5], "2024-01-02 03:00:00", "no", None),
    ]
    assert len(data_files(spark, place)) == 3
    assert merged_schema(spark, f"{place}/missing") is None
