"""A newer contract over stored rows: the same as judging the messages from scratch."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from contractflow import contract_from_dict, route, scratch, validate
from contractflow.operators.decode import PAYLOAD, decode_json
from contractflow.operators.upgrade import rule_changes
from contractflow.plans import ContractError, rule_from_text
from contractflow.sources import CommitLog, Tables, provision, snapshot, upgrade

NOW = datetime(2024, 1, 2)
FIELDS = [{"name": "id", "type": "long"}, {"name": "kind"}, {"name": "size", "type": "double"}, {"name": "at", "type": "timestamp"}]


def contract(version, *rules):
    listed = [{"name": n, "expr": e} for n, e in rules]
    return contract_from_dict({"info": {"title": "things", "version": version}, "kafkaTopic": "a.b.things", "format": "json", "schema": {"fields": FIELDS}, "storage": {"partitioning": ["days(ingested_at)"]}, "quality": {"rules": listed}})


OLD = contract("1", ("small", "size < 10"), ("kinds", "kind in ['a','b']"), ("named", "has(kind)"))
BODIES = ['{"id": 1, "kind": "a", "size": 5}', '{"id": 2, "kind": "a", "size": 50}', '{"id": 3, "kind": "c", "size": 50, "at": "2024-01-01T00:00:00.123456Z"}', '{"id": 4, "size": 1}', "{broken", '{"id": 5, "kind": "b", "size": 9.5}', "null", '{"id": 6, "kind": "[kinds]: x", "size": null}']
NEWER = {
    "dropped": [("kinds", "kind in ['a','b']"), ("named", "has(kind)")],
    "added": [("odd", "id != 1"), ("small", "size < 10"), ("kinds", "kind in ['a','b']"), ("named", "has(kind)")],
    "changed": [("small", "size < 6"), ("kinds", "kind in ['a','b','c']"), ("named", "has(kind)")],
    "reordered": [("named", "has(kind)"), ("kinds", "kind in ['a','b']"), ("small", "size < 10")],
    "all new": [("x", "size >= 2 && size <= 60"), ("y", "kind.matches('^[a-c]$')")],
    "none": [],
}


def judged(spark, rules):
    rows = spark.createDataFrame([(b,) for b in BODIES], "body string").select(F.lit(b"k").alias("key"), F.col("body").cast("binary").alias("value"))
    return route(validate(decode_json(rows, rules.schema()), rules, NOW, PAYLOAD), rules, NOW)


def shown(rules, good, bad):
    known = F.from_json("raw_payload", rules.schema())
    certified = {tuple(r) for r in good.select("id", "kind", "size", "at").collect()}
    refused = sorted((str(r["id"]), r["validation_errors"]) for r in bad.select(known["id"].alias("id"), "validation_errors").collect())
    return certified, refused


@pytest.mark.parametrize("case", NEWER)
def test_as_if_judged_from_scratch(spark, database, case):
    new = contract("2", *NEWER[case])
    tables = provision(spark, OLD, Tables(f"{database}.t", f"{database}.t_q", OLD.partitioning))
    log = CommitLog(spark, scratch(spark, "commits"))
    good, bad = judged(spark, OLD)
    log.load({"bronze": good, "quarantine": bad}, tables)
    before = shown(OLD, *snapshot(log, tables))
    version = upgrade(log, tables, OLD, new, NOW)
    after = shown(new, *snapshot(log, tables))
    expected = shown(new, *judged(spark, new))
    if case == "reordered":  # no rule changed, so stored messages keep their order
        assert version is None
        expected = (expected[0], [(i, sorted(errors)) for i, errors in expected[1]])
        after = (after[0], [(i, sorted(errors)) for i, errors in after[1]])
    assert after == expected
    assert shown(OLD, *snapshot(log, tables, 1)) == before
    if version is not None:
        assert upgrade(log, tables, new, new, NOW) is None and log.latest() == version == 2


def test_untouched_loads_are_not_written_again(spark, database):
    tables = provision(spark, OLD, Tables(f"{database}.t", f"{database}.t_q", OLD.partitioning))
    log = CommitLog(spark, scratch(spark, "commits"))
    good, bad = judged(spark, OLD)
    for i in (1, 5):
        log.load({"bronze": good.where(F.col("id") == i)}, tables, f"load{i}")
    upgrade(log, tables, OLD, contract("2", ("odd", "id != 5")), NOW)
    ids = {r["load_id"].split("-")[0] for r in snapshot(log, tables)[0].collect()}
    assert ids == {"load1"} and snapshot(log, tables)[1].count() == 1


def test_versions_that_cannot_be_compared():
    assert rule_changes(OLD, OLD).none
    twice = replace(OLD, rules=(rule_from_text("a", "size < 1"), rule_from_text("a", "size > 0")))
    with pytest.raises(ContractError, match="two rules of one name"):
        rule_changes(OLD, twice)
    with pytest.raises(ContractError, match="differ in their fields"):
        rule_changes(OLD, replace(OLD, fields=OLD.fields[:2]))
