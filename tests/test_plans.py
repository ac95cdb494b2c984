"""The shape of the plans: what is shuffled, pushed down, and never run row by row in Python."""

from __future__ import annotations

import re

import pytest

from contractflow import check_domain
from contractflow.plans import DOMAINS
from suite import QUERIES
from suite.mappings import flat_events

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


MAP_ONLY = [n for n in QUERIES if n.startswith(("rule_", "inject_")) and "duplicate" not in n] + [
    "contract_validate",
    "contract_yaml_equiv",
    "contract_alerts",
    "domain_transactions",
    "domain_shipments",
    "conformance_split",
    "frame_strip",
    "drift_map",
    "key_fallback",
    "retention",
]


@pytest.mark.parametrize("name", MAP_ONLY)
def test_validation_never_shuffles(spark, name):
    assert "Exchange" not in plan(spark, name)


WRITERS = ("stream_", "batch_", "provision", "schema_", "retention_drop")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(WRITERS)))
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEval|MapInPandas|Cartesian|NestedLoopJoin", text)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("rule_cmp_gt", "c_custkey:bigint,c_acctbal:double"),
        ("table_count", ""),
        ("uniqueness", "event_id:bigint"),
        ("top_duplicates", "l_orderkey:bigint,l_linenumber:int"),
        ("violations_per_rule", "ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string"),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


def test_rules_of_a_stream_read_only_their_fields(spark):
    events = flat_events(spark, SF_DIR, "sales.transactions")
    reasons = check_domain(events, DOMAINS["sales.transactions"]).select("event_id", "error_reason")
    text = reasons._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>" in text


def test_retention_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(o_orderdate" in plan(spark, "retention")


def test_counts_shuffle_one_row_per_task(spark):
    text = plan(spark, "violations_per_rule")
    assert text.count("Exchange") == 1 and "Exchange SinglePartition" in text


@pytest.mark.parametrize("name", ["violations_per_rule", "top_duplicates", "frame_ids", "detection_labels", "uniqueness"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


@pytest.mark.parametrize("name", ["route_bronze", "route_quarantine", "silver_json", "dlq_json"])
def test_payload_is_not_decoded_again_by_a_filter(spark, name):
    for line in plan(spark, name).splitlines():
        assert not re.search(r"Filter .*from_json", line)


def test_conditions_stay_in_generated_code(spark):
    text = plan(spark, "rule_band")
    assert "lambda" not in text and "*(1) Project" in text
