"""Several writers' schemas under one reader's."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.functions import frame
from contractflow.operators.schemas import ReaderField, decode_by_schema
from contractflow.plans import ContractError

READER = (
    ReaderField("id", T.LongType(), ("key", "old_key"), required=True),
    ReaderField("size", T.DoubleType(), default=0.5),
    ReaderField("place", T.StructType([T.StructField("city", T.StringType()), T.StructField("zone", T.IntegerType())]), fields=(ReaderField("city", T.StringType(), ("town",)), ReaderField("zone", T.IntegerType(), default=7))),
)
WRITERS = {1: "old_key int", 2: "key bigint, old_key int, size int, extra string", 300: "id bigint, size float, place struct<town: string>"}


def decoded(spark, messages, writers=WRITERS):
    rows = spark.createDataFrame([(None if n is None else b, n) for n, b in messages], "body string, n long")
    value = F.when(F.col("n") >= 0, frame(F.col("body"), F.col("n"))).otherwise(F.col("body").cast("binary"))
    df = rows.select(F.lit(b"k").alias("key"), value.alias("value"))
    return decode_by_schema(df, {n: T.StructType.fromDDL(w) for n, w in writers.items()}, READER)


def test_fields_are_renamed_promoted_and_filled(spark):
    messages = [(1, {"old_key": 5}), (2, {"key": 6, "old_key": 1, "size": 3, "extra": "x"}), (300, {"id": 7, "size": 0.25, "place": {"town": "a"}}), (2, {}), (300, {"id": 8, "place": None})]
    rows = decoded(spark, [(n, json.dumps(b)) for n, b in messages]).collect()
    assert [r["undecoded"] for r in rows] == [None] * 5 and [r["schema_id"] for r in rows] == [1, 2, 300, 2, 300]
    got = [r["event"].asDict(recursive=True) for r in rows]
    assert got[0] == {"id": 5, "size": 0.5, "place": None}
    assert got[1] == {"id": 6, "size": 3.0, "place": None}
    assert got[2] == {"id": 7, "size": 0.25, "place": {"city": "a", "zone": 7}}
    assert got[3] == {"id": None, "size": None, "place": None}
    assert got[4] == {"id": 8, "size": None, "place": None}


def test_what_cannot_be_decoded_is_kept_whole(spark):
    rows = decoded(spark, [(1, "{"), (1, '{"old_key": "five"}'), (9, "{}"), (-1, "plain"), (None, None), (2, '{"old_key": 1}')]).collect()
    assert [r["event"] is None for r in rows] == [True, True, True, True, True, False]
    assert [None if r["undecoded"] is None else bytes(r["undecoded"])[-5:] for r in rows] == [b"\x00\x00\x00\x01{", b"ive\"}", b"\x00\x00\x09{}", b"plain", b"", None]


def test_schemas_that_cannot_be_read_raise_at_once(spark):
    messages = [(1, "{}")]
    for schema, match in (("size int", "no field 'id'"), ("id string", "written as string"), ("id bigint, size string", "'size'"), ("id bigint, place struct<zone: string>", "'place.zone'"), ("id double", "cannot be read as bigint")):
        with pytest.raises(ContractError, match=match):
            decoded(spark, messages, {1: schema})


def test_no_writers_and_no_messages(spark):
    assert decoded(spark, [(1, "{}")], {}).first()["undecoded"] is not None
    assert decoded(spark, []).count() == 0


def test_a_body_is_parsed_once(spark):
    plan = decoded(spark, [(1, "{}")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == len(WRITERS)
