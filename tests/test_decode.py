"""Bytes that are odd: bad JSON, bad frames, bad encodings, unions, drift."""

from __future__ import annotations

import base64
import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from contractflow import contract_from_dict, route, validate
from contractflow.functions import frame, frame_payload, frame_schema_id, is_framed
from contractflow.operators import (
    decode_avro,
    decode_contract,
    decode_framed,
    decode_json,
    drift_fields,
    event_schema,
    fallback_key,
    flatten_event,
    keep_raw,
    split_conforming,
)
from contractflow.operators.decode import PAYLOAD, avro_writer_schema
from contractflow.plans import DOMAINS

NOW = datetime(2024, 1, 25)
CONTRACT = contract_from_dict(
    {
        "info": {"title": "t", "version": "7"},
        "format": "json",
        "schema": {"fields": [{"name": "id", "type": "long"}, {"name": "name"}, {"name": "v", "type": "double"}]},
        "quality": {"rules": [{"name": "cap", "expr": "v <= 10"}]},
    }
)


def messages(spark, *values: bytes | None):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value binary")


GOOD = b'{"id": 1, "name": "a", "v": 2.5}'
EXTRA = b'{"id": 1, "name": "a", "v": 2.5, "more": {"x": [1, 2]}}'
MISSING = b'{"id": 1}'
TYPE = b'{"id": "one", "name": "a", "v": 2.5}'
CUT = b'{"id": 1, "name": "a"'
JUNK = b"\xff\xfe not json"
EMPTY = b""


def test_decode_violation(spark):
    df = messages(spark, GOOD, EXTRA, MISSING, TYPE, CUT, JUNK, EMPTY, None)
    tagged = validate(decode_contract(df, CONTRACT), CONTRACT, NOW, PAYLOAD).orderBy("i").collect()
    assert [r.is_valid for r in tagged] == [True, True, True, False, False, False, False, False]
    assert {tuple(r.validation_errors) for r in tagged[3:]} == {
        ("DECODE_VIOLATION [decode]: payload could not be decoded",)
    }


ODD_FIELDS = {"id": "long", "i": "int", "v": "double", "ts": "timestamp", "b": "boolean", "bin": "bytes", "s": "string"}
ODD = {
    b'{"id": 123456789012345678901}': False,
    b'{"i": 3000000000}': False,
    b'{"id": 1.0}': False,
    b'{"id": "1"}': False,
    b'{"v": "2.5"}': False,
    b'{"v": 7}': True,
    b'{"b": "true"}': False,
    b'{"bin": "aGk="}': True,
    b'{"bin": "%%%"}': False,
    b'{"ts": "2024-01-01T00:00:00.5+02:00"}': True,
    b'{"ts": "junk"}': False,
    b'{"s": {"a": [1]}}': True,
    b'{"s": true}': True,
    b'[{"id": 1}]': False,
    b"null": False,
    b'"text"': False,
    b"{}": True,
    b"\x00": False,
    b" ": False,
}


def test_odd_payloads_never_stop_the_batch(spark):
    fields = [{"name": name, "type": kind} for name, kind in ODD_FIELDS.items()]
    contract = contract_from_dict({"format": "json", "schema": {"fields": fields}})
    df = messages(spark, *ODD)
    tagged = validate(decode_contract(df, contract), contract, NOW, PAYLOAD).orderBy("i").collect()
    assert {bytes(r.value): r.is_valid for r in tagged} == ODD


def test_decode_check_off_lets_null_rows_pass(spark):
    df = messages(spark, GOOD, CUT, JUNK, None)
    tagged = validate(decode_contract(df, CONTRACT), CONTRACT, NOW, PAYLOAD, decode_check=False)
    assert tagged.filter("is_valid").count() == 4
    unmarked = decode_json(df, CONTRACT.schema(), mark_corrupt=False)
    assert validate(unmarked, CONTRACT, NOW, PAYLOAD, decode_check=False).filter("is_valid").count() == 4


def test_both_sides_make_the_whole(spark):
    df = messages(spark, GOOD, EXTRA, MISSING, TYPE, CUT, JUNK, EMPTY, None, b'{"v": 11}', b'{"v": 10}')
    bronze, quarantine = route(validate(decode_contract(df, CONTRACT), CONTRACT, NOW, PAYLOAD), CONTRACT, NOW)
    assert bronze.columns == ["id", "name", "v", "ingested_at", "schema_version", "source_format"]
    assert quarantine.columns == ["raw_payload", "ingested_at", "schema_version", "source_format", "validation_errors"]
    assert (bronze.count(), quarantine.count()) == (4, 6)
    assert {(r.schema_version, r.source_format, r.ingested_at) for r in bronze.collect()} == {("7", "json", NOW)}


def test_raw_bytes_survive(spark):
    row = keep_raw(messages(spark, JUNK), keep_bytes=True).first()
    assert row.raw_payload.encode() != JUNK
    assert base64.b64decode(row.raw_payload_base64) == JUNK


def test_frames(spark):
    values = [b"\x00\x00\x01\x00\x02{}", b"\x00\xff\xff\xff\xff", b"\x01\x00\x00\x00\x07{}", b"\x00\x00\x00", b"", None]
    v = F.col("value")
    rows = (
        messages(spark, *values)
        .select("i", is_framed(v), frame_schema_id(v), frame_payload(v), frame_payload(v, check_magic=False))
        .orderBy("i")
        .collect()
    )
    assert [bool(r[1]) for r in rows] == [True, True, False, False, False, False]
    assert [r[2] for r in rows] == [65538, 4294967295, None, None, None, None]
    assert [None if r[3] is None else bytes(r[3]) for r in rows] == [b"{}", b"", None, None, None, None]
    assert bytes(rows[2][4]) == b"{}"


def test_frame_roundtrip(spark):
    row = spark.range(1).select(frame(F.lit("body"), F.lit(258)).alias("value")).first()
    assert bytes(row.value) == b"\x00\x00\x00\x01\x02body"


def test_unframed_events_are_rejected_not_lost(spark):
    from contractflow import check_domain
    from contractflow.operators import domain_messages

    domain = DOMAINS["sensors.machines"]
    good = b"\x00\x00\x00\x00\x01" + json.dumps(
        {"event_id": "E1", "payload": {"machine_id": "M", "site_id": "S", "status": "ACTIVE"}}
    ).encode()
    df = spark.createDataFrame([(b"k", good), (b"k", good[5:]), (b"k", None)], "key binary, value binary")
    flat = flatten_event(decode_framed(df, event_schema(domain)), domain)
    routed = domain_messages(check_domain(flat, domain), domain, NOW).collect()
    assert sorted(r.topic for r in routed) == ["dlq.sensors.machines"] * 2 + ["silver.sensors.machines"]
    silver = next(r for r in routed if r.topic.startswith("silver"))
    assert silver.key == "M"
    assert json.loads(silver.value) == {
        "event_id": "E1",
        "machine_id": "M",
        "site_id": "S",
        "status": "ACTIVE",
        "error_reason": "",
        "validated_at": "2024-01-25T00:00:00.000Z",
    }


def test_drift(spark):
    df = spark.createDataFrame([('{"id": 1, "more": "x", "deep": {"a": 1}}',), ('{"id": 1}',), ("nope",), (None,)], "raw string")
    got = [r[0] for r in df.select(drift_fields(F.col("raw"), ["id"])).collect()]
    assert got[0] == {"more": "x", "deep": '{"a":1}'}
    assert got[1] == {} and not got[2] and got[3] is None


def test_fallback_key(spark):
    df = spark.createDataFrame([("a", "e"), ("", "e"), (None, "e"), ("  ", "e")], "b string, e string")
    assert [r[0] for r in df.select(fallback_key("b", "e")).collect()] == ["a", "e", "e", "  "]


def test_avro_without_its_package_says_so(spark):
    df = messages(spark, GOOD)
    with pytest.raises(AnalysisException, match="AVRO"):
        decode_avro(df, avro_writer_schema(CONTRACT)).collect()
    avro = contract_from_dict({"format": "avro", "schema": {"fields": [{"name": "id"}]}})
    with pytest.raises(ValueError, match="writer schema"):
        decode_contract(df, avro)
    with pytest.raises(ValueError, match="format"):
        decode_contract(df, contract_from_dict({"format": "xml"}))


def test_writer_schema_text():
    schema = json.loads(avro_writer_schema(CONTRACT))
    assert schema["fields"][0] == {"name": "id", "type": ["null", "long"], "default": None}


def test_conformance(spark):
    schema = {
        "fields": [
            {"name": "id", "type": "string"},
            {"name": "note", "type": ["null", "string"], "default": None},
            {"name": "level", "type": {"type": "enum", "name": "L", "symbols": ["LOW", "HIGH"]}},
            {"name": "n", "type": "long"},
            {"name": "x", "type": ["null", "double"]},
            {"name": "filled", "type": "string", "default": "d"},
        ]
    }
    rows = [
        ("a", None, "LOW", 5.0, 1, "f"),
        ("b", None, "LOW", 5.0, None, None),
        (None, None, "odd", 5.0, 1, "f"),
        ("d", None, "odd", 5.5, 1, "f"),
        ("e", None, None, 5.0, 1, "f"),
        ("f", None, "HIGH", 5.5, 1, "f"),
        ("g", None, "HIGH", None, 1, "f"),
    ]
    df = spark.createDataFrame(rows, "id string, note string, level string, n double, x int, filled string")
    fits, errors = split_conforming(df, schema, "bronze.a.b")
    assert [r.id for r in fits.orderBy("id").collect()] == ["a", "b"]
    got = {json.loads(r.failed_event).get("id"): (r.error_type, r.error_message) for r in errors.collect()}
    assert got == {
        None: ("MissingField", "id is required"),
        "d": ("UnknownSymbol", "level is not one of ['LOW', 'HIGH']"),
        "e": ("MissingField", "level is required"),
        "f": ("WrongType", "n is not a long"),
        "g": ("MissingField", "n is required"),
    }
    assert {(r.error_stage, r.target_topic) for r in errors.collect()} == {
        ("producer_schema_serialization", "bronze.a.b")
    }
    without = df.drop("id")
    assert split_conforming(without, schema, "t")[0].count() == 0
