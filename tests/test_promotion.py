"""Least common types, and rows of several generations under them."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from contractflow.plans import ContractError
from contractflow.sources import append, common_schema, least_common, promoted, rewrite_promoted, table_ddl, union_promoted

COMMON = [
    ("int", "bigint", "bigint"), ("smallint", "int", "int"), ("float", "double", "double"), ("int", "float", "double"), ("smallint", "float", "float"),
    ("int", "double", "double"), ("date", "timestamp", "timestamp"), ("string", "string", "string"), ("array<int>", "array<bigint>", "array<bigint>"),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"), ("map<string,float>", "map<string,double>", "map<string,double>"),
]
NONE = [("bigint", "double"), ("bigint", "float"), ("string", "int"), ("boolean", "int"), ("struct<a:string>", "struct<a:int>"), ("binary", "string")]


def kind(spark, text):
    return spark.sql(f"SELECT CAST(NULL AS {text}) AS x").schema["x"].dataType


def test_least_common_types(spark):
    for one, two, both in COMMON:
        assert least_common(kind(spark, one), kind(spark, two)).simpleString() == both
        assert set(least_common(kind(spark, two), kind(spark, one)).simpleString()) == set(both)
    for one, two in NONE:
        with pytest.raises(ContractError, match="no type holds both"):
            least_common(kind(spark, one), kind(spark, two), "x")


def test_generations_are_read_together(spark):
    old = spark.createDataFrame([(1, (1,), {"b": "7", "c": "x", "e": "left"}), (2, None, None), (3, (None,), {"b": "seven"})], "Id int, s struct<a: int>, unknown_fields map<string,string>")
    new = spark.createDataFrame([(5_000_000_000, (2, "y"), 8, "z")], "id bigint, s struct<a: bigint, t: string>, b int, c string")
    rows = {r["Id"]: r for r in union_promoted([old, new]).collect()}
    assert common_schema([old.schema, new.schema]).simpleString() == "struct<Id:bigint,s:struct<a:bigint,t:string>,unknown_fields:map<string,string>,b:int,c:string>"
    assert (rows[1]["s"].asDict(), rows[1]["b"], rows[1]["c"], rows[1]["unknown_fields"]) == ({"a": 1, "t": None}, 7, "x", {"e": "left"})
    assert (rows[2]["s"], rows[2]["b"], rows[2]["unknown_fields"]) == (None, None, None)
    assert (rows[3]["b"], rows[3]["unknown_fields"]) == (None, {"b": "seven"})  # a text that does not fit stays where it is
    assert (rows[5_000_000_000]["s"].asDict(), rows[5_000_000_000]["b"], rows[5_000_000_000]["unknown_fields"]) == ({"a": 2, "t": "y"}, 8, None)
    with pytest.raises(ContractError, match="'s.a'"):
        union_promoted([old, spark.createDataFrame([], "s struct<a: string>")])


def test_a_table_is_rewritten_once(spark, database):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("ingested_at", T.TimestampType())])
    wide = T.StructType([T.StructField("id", T.LongType()), T.StructField("ingested_at", T.TimestampType()), T.StructField("x", T.DoubleType())])
    for name, s, row in (("one", schema, "SELECT 1 AS id, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at"), ("two", wide, "SELECT 5000000000 AS id, TIMESTAMP '2024-01-02 00:00:00' AS ingested_at, 0.5D AS x")):
        spark.sql(table_ddl(f"{database}.{name}", s, ["days(ingested_at)"]))
        append(spark.sql(row), f"{database}.{name}", ["days(ingested_at)"])
    rewrite_promoted(spark, [f"{database}.one", f"{database}.two"], f"{database}.both", ["days(ingested_at)"])
    rows = spark.table(f"{database}.both").orderBy("id").collect()
    assert [(r["id"], r["x"], str(r["ingested_at_date"])) for r in rows] == [(1, None, "2024-01-01"), (5_000_000_000, 0.5, "2024-01-02")]


def test_nothing_to_promote(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert promoted(df, df.schema).collect() == df.collect()
