"""Contract documents: both forms, versions, types, topics, folders."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from contractflow import contract_from_dict, load_contract, load_contracts
from contractflow.plans import ContractError, Field, active_version, contract_for_topic, rule_from_text, split_topic
from suite.registry import CONTRACTS


def test_rule_text_form():
    contract = load_contract(CONTRACTS / "sensor_alerts.yaml")
    assert (contract.name, contract.version, contract.topic, contract.format) == (
        "sensor-alerts",
        "1.0.0",
        "bronze.sensors.alerts",
        "json",
    )
    assert contract.partitioning == ("days(ingested_at)",)
    assert [r.kind for r in contract.active_rules] == [
        "allowed_values",
        "allowed_values",
        "not_empty",
        "not_empty",
        "not_future",
    ]


def test_required_fields_are_checked_only_where_the_form_says_so():
    text_form = {"schema": {"fields": [{"name": "a", "nullable": False}]}}
    check_form = {"contract": {"name": "c", "fields": [{"name": "a", "nullable": False, "checks": [{"type": "not_empty"}]}]}}
    assert contract_from_dict(text_form).rules == ()
    assert [r.kind for r in contract_from_dict(text_form, enforce_required=True).rules] == ["required"]
    assert [r.kind for r in contract_from_dict(check_form).rules] == ["required", "not_empty"]
    assert [r.kind for r in contract_from_dict(check_form, enforce_required=False).rules] == ["not_empty"]


def test_disabled_and_blank_rules():
    contract = load_contract(CONTRACTS / "events.json")
    assert "value-floor" in [r.name for r in contract.rules]
    assert "value-floor" not in [r.name for r in contract.active_rules]
    blank = contract_from_dict({"quality": {"rules": [{"name": "x", "expr": "  "}, {"expr": "has(a)"}]}})
    assert [r.name for r in blank.rules] == ["unnamed_rule"]


def test_defaults():
    contract = contract_from_dict({"kafkaTopic": "bronze.a.b"})
    assert (contract.version, contract.format, contract.rules, contract.partitioning) == ("1.0.0", "avro", (), ())
    assert contract.checkpoint_path("s3://bucket/cp/") == "s3://bucket/cp/bronze_a_b"
    stated = contract_from_dict({"storage": {"checkpointPath": "s3://here"}})
    assert stated.checkpoint_path("s3://bucket") == "s3://here"


def test_types():
    names = ("string", "int", "integer", "long", "float", "double", "boolean", "timestamp", "bytes")
    fields = [{"name": name, "type": name.upper()} for name in names]
    schema = contract_from_dict({"schema": {"fields": fields}}).schema()
    assert [f.dataType.simpleString() for f in schema] == [
        "string", "int", "int", "bigint", "float", "double", "boolean", "timestamp", "binary",
    ]
    with pytest.raises(ValueError, match="unknown contract type"):
        Field("a", "decimal")
    with pytest.raises(ContractError):
        contract_from_dict({"schema": {"fields": [{"name": "a", "type": "uuid"}]}})


def test_namespaced_template():
    contract = contract_from_dict(
        {
            "contract": {
                "name": "s",
                "namespace": "sensors",
                "table": "alerts",
                "quarantine_table": "alerts_quarantine",
                "partitioning": ["days(event_time)"],
                "fields": None,
            }
        }
    )
    assert (contract.table, contract.quarantine_table) == ("sensors.alerts", "sensors.alerts_quarantine")
    assert contract.schema() == T.StructType([])


def test_all_check_types():
    checks = [
        {"type": "not_empty"},
        {"type": "allowed_values", "values": ["a", 1]},
        {"type": "range", "min": -9999, "max": 9999},
        {"type": "range_by_field", "field": "kind", "ranges": {"t": [-50, 150]}},
        {"type": "not_future", "tolerance_seconds": 300},
        {"type": "regex", "pattern": "^x"},
        {"type": "unheard_of"},
    ]
    rules = contract_from_dict({"contract": {"name": "c", "fields": [{"name": "a", "checks": checks}]}}).rules
    assert [r.kind for r in rules] == [*[c["type"] for c in checks[:-1]], "unrecognised"]
    assert rules[1].args["values"] == ["a", "1"]
    with pytest.raises(ContractError, match="lacks"):
        contract_from_dict({"contract": {"name": "c", "fields": [{"name": "a", "checks": [{"type": "regex"}]}]}})


def test_topic():
    assert split_topic("bronze.sensors.alerts") == ("bronze", "sensors", "alerts")
    with pytest.raises(ContractError):
        split_topic("sensors.alerts")


def test_contract_of_a_topic():
    docs = [("1", "bronze.a.b", "active"), ("2", "bronze.a.b", "active"), ("3", "bronze.a.b", "draft"), ("9", "bronze.a.c", "active")]
    contracts = [
        contract_from_dict({"info": {"title": "x", "version": v, "status": s}, "kafkaTopic": t}) for v, t, s in docs
    ]
    assert contract_for_topic(contracts, "bronze.a.b").version == "2"
    with pytest.raises(ContractError, match="no active contract"):
        contract_for_topic(contracts, "bronze.a.d")
    with pytest.raises(ContractError, match="not of the form"):
        contract_for_topic(contracts, "a.b")


def test_folder_skips_what_does_not_load(tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"info": {"title": "good"}}))
    (tmp_path / "bad.yaml").write_text("a: [1,")
    (tmp_path / "list.yaml").write_text("- 1")
    (tmp_path / "number.yaml").write_text("quality: {rules: [{name: n, expr: 'f > 1.2.3'}]}")
    (tmp_path / "notes.txt").write_text("not a contract")
    loaded, skipped = load_contracts(tmp_path)
    assert [c.name for c in loaded] == ["good"]
    assert sorted(skipped) == ["bad.yaml", "list.yaml", "number.yaml"]


def test_highest_active_version():
    docs = [("1.9.0", "active"), ("1.10.0", "active"), ("2.0.0", "draft"), ("0.1", "deprecated")]
    contracts = [contract_from_dict({"info": {"title": "c", "version": v, "status": s}}) for v, s in docs]
    assert active_version(contracts, "c").version == "1.10.0"
    with pytest.raises(ContractError):
        active_version(contracts, "other")


def test_blanks_inside_quotes_belong_to_the_value():
    rule = rule_from_text("r", "a in [' A ', \"B \", C , 'D,E']")
    assert rule.args["values"] == [" A ", "B ", "C", "D,E"]


def test_disabled_rules_are_not_read():
    rules = [{"name": "off", "expr": "f > 1.2.3", "disabled": True}, {"name": "on", "expr": "f > 1"}]
    contract = contract_from_dict({"quality": {"rules": rules}})
    assert [r.name for r in contract.active_rules] == ["on"]
    checks = [{"type": "range", "min": "low", "disabled": True}, {"type": "not_empty"}]
    off = contract_from_dict({"contract": {"name": "c", "fields": [{"name": "a", "checks": checks}]}})
    assert [r.kind for r in off.active_rules] == ["not_empty"]


@pytest.mark.parametrize("text", ["f > 1-2", "f >= 1 && f <= 2.", "f < .", "f >= -- && f <= 3"])
def test_malformed_numbers_are_told_from_unknown_forms(text):
    if text == "f >= 1 && f <= 2.":
        assert rule_from_text("r", text).args == {"min": 1.0, "max": 2.0}
    else:
        with pytest.raises(ContractError, match="is not a number"):
            rule_from_text("r", text)
    assert rule_from_text("r", "f > 1e5").kind == "unrecognised"


def test_one_bad_file_does_not_stop_a_folder(tmp_path):
    faults = {
        "tolerance": {"type": "not_future", "tolerance_seconds": "soon"},
        "pair": {"type": "range_by_field", "field": "b", "ranges": {"x": [1, 2, 3]}},
        "none": {"type": "range_by_field", "field": "b", "ranges": {}},
        "bound": {"type": "range", "min": "low"},
    }
    for name, check in faults.items():
        (tmp_path / f"{name}.json").write_text(json.dumps({"contract": {"name": name, "fields": [{"name": "a", "checks": [check]}]}}))
    (tmp_path / "bytes.yaml").write_bytes(b"\xff\xfe\x00x")
    (tmp_path / "folder.yaml").mkdir()
    (tmp_path / "good.json").write_text(json.dumps({"info": {"title": "good"}}))
    loaded, skipped = load_contracts(tmp_path)
    assert [c.name for c in loaded] == ["good"]
    assert sorted(skipped) == ["bound.json", "bytes.yaml", "folder.yaml", "none.json", "pair.json", "tolerance.json"]


@pytest.mark.parametrize(
    "text, number", [("f > 1e5", 1e5), ("f <= +5", 5.0), ("f >= -1.5E-2", -0.015), ("f != .5", 0.5), ("f < 7.", 7.0)]
)
def test_any_number_form_where_the_contract_allows_it(text, number):
    assert rule_from_text("r", text, any_number=True).args["number"] == number
    plain = rule_from_text("r", text)
    assert (plain.kind == "compare") == (not any(c in text[4:] for c in "eE+"))
    doc = {"info": {"title": "t"}, "quality": {"numbers": "any", "rules": [{"name": "r", "expr": text}]}}
    assert contract_from_dict(doc).active_rules[0].args["number"] == number


def test_number_forms_in_bands_and_beside_other_forms():
    band = rule_from_text("r", "f >= +1e1 && g <= 2E2", any_number=True)
    assert (band.kind, band.args) == ("range", {"min": 10.0, "max": 200.0})
    for text, kind in (("f < now()", "not_future"), ("f != ''", "not_blank"), ('f != ""', "not_blank"), ("f > g", "unrecognised"), ("f > 1e", "unrecognised")):
        assert rule_from_text("r", text, any_number=True).kind == kind
    with pytest.raises(ContractError, match="is not a number"):
        rule_from_text("r", "f > 1.2.3", any_number=True)
