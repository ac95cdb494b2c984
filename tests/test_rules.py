"""Truth tables of the rule kinds: nulls, blanks, boundaries and one step beside them."""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow import compile_rules
from contractflow.operators import check_domain
from contractflow.plans import DOMAINS, ContractError, Rule, required_rule, rule_from_check, rule_from_text

NOW = datetime(2024, 1, 25, tzinfo=timezone.utc)


def broken(spark, rule: Rule, values: list, kind: str = "string", **others) -> list[bool]:
    """Which of the values break the rule, in order."""
    fields = [T.StructField("i", T.IntegerType()), T.StructField("f", T._parse_datatype_string(kind))]
    fields += [T.StructField(name, T.StringType()) for name in others]
    rows = [(i, value, *[column[i] for column in others.values()]) for i, value in enumerate(values)]
    df = spark.createDataFrame(rows, T.StructType(fields))
    tagged = compile_rules([rule], df.schema, NOW).tag(df).orderBy("i").collect()
    for row in tagged:
        assert row.is_valid == (len(row.validation_errors) == 0)
    return [not row.is_valid for row in tagged]


def test_allowed_values(spark):
    rule = rule_from_text("r", "f in ['A','B']")
    assert broken(spark, rule, ["A", "B", "C", "", "a", " A", None]) == [False, False, True, True, True, True, True]


def test_allowed_values_of_numbers(spark):
    assert broken(spark, rule_from_text("r", "f in [1, 2]"), [1, 2, 3, None], "int") == [False, False, True, True]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("f > 5", [True, True, False, False]),
        ("f >= 5", [True, False, False, False]),
        ("f < 5", [False, True, True, False]),
        ("f <= 5", [False, False, True, False]),
        ("f != 5", [False, True, False, False]),
    ],
)
@pytest.mark.parametrize("kind", ["double", "int", "bigint", "float"])
def test_comparisons(spark, text, expected, kind):
    values = [4, 5, 6, None] if kind in ("int", "bigint") else [4.5, 5.0, 5.5, None]
    assert broken(spark, rule_from_text("r", text), values, kind) == expected


def test_numbers_in_text(spark):
    values = ["4", "5", "5.5", " 6 ", "abc", "", None]
    assert broken(spark, rule_from_text("r", "f <= 5"), values) == [False, False, True, True, False, False, False]


def test_not_a_number_is_larger_than_every_limit(spark):
    nan = float("nan")
    assert broken(spark, rule_from_text("r", "f <= 5"), [nan, math.inf, -math.inf], "double") == [True, True, False]


def test_band(spark):
    rule = rule_from_text("r", "f >= -1.5 && f <= 2")
    values = [-1.6, -1.5, 0.0, 2.0, 2.1, None]
    assert broken(spark, rule, values, "double") == [True, False, False, False, True, False]


def test_band_ignores_the_second_name(spark):
    rule = rule_from_text("r", "f >= 0 && whatever <= 2")
    assert broken(spark, rule, [-1.0, 1.0, 3.0], "double") == [True, False, True]


@pytest.mark.parametrize(
    "rule",
    [
        rule_from_text("r", "has(f)"),
        rule_from_text("r", "f != ''"),
        rule_from_text("r", 'f != ""'),
        rule_from_check("f", {"type": "not_empty"}),
    ],
)
def test_empty(spark, rule):
    values = ["x", "", "   ", "\t", " x ", None]
    assert broken(spark, rule, values) == [False, True, True, False, False, True]


def test_empty_of_a_number_is_null_only(spark):
    assert broken(spark, rule_from_text("r", "has(f)"), [0.0, None], "double") == [False, True]


def test_required_accepts_blank(spark):
    assert broken(spark, required_rule("f"), ["x", "", "  ", None]) == [False, False, False, True]


def test_pattern_is_unanchored(spark):
    rule = rule_from_text("r", r"f.matches('[0-9]{2}')")
    assert broken(spark, rule, ["a12b", "1a2", "", None]) == [False, True, True, False]


def test_anchored_pattern_with_escape(spark):
    rule = rule_from_check("f", {"type": "regex", "pattern": r"^\w+@x\.org$"})
    assert broken(spark, rule, ["a@x.org", "a@xxorg", "a@x.org "]) == [False, True, True]


def test_not_future(spark):
    values = [
        "2024-01-25T00:00:00.000000+00:00",
        "2024-01-25T00:00:00.999999+00:00",
        "2024-01-25T00:00:01.000000+00:00",
        "2024-01-25T00:00:01+00:00",
        "2024-01-25T00:00:01Z",
        "2024-01-25T01:00:00+01:00",
        "2024-01-25T01:00:01+01:00",
        "soon",
        "",
        None,
    ]
    expected = [False, False, True, True, True, False, True, False, False, False]
    assert broken(spark, rule_from_text("r", "f < now()"), values) == expected


def test_not_future_tolerance(spark):
    rule = rule_from_check("f", {"type": "not_future", "tolerance_seconds": 300})
    values = [NOW + timedelta(seconds=s) for s in (0, 300, 300.9, 301)]
    assert broken(spark, rule, values, "timestamp") == [False, False, False, True]


def test_range_by_field(spark):
    rule = rule_from_check("f", {"type": "range_by_field", "field": "by", "ranges": {"t": [-50, 150], "h": [0, 100]}})
    values = [-51.0, -50.0, 151.0, 120.0, 100.0, -1.0, 999.0, 999.0, None]
    chooser = ["t", "t", "t", "h", "h", "h", "other", None, "t"]
    expected = [True, False, True, True, False, True, False, False, False]
    assert broken(spark, rule, values, "double", by=chooser) == expected


def test_half_open_range(spark):
    assert broken(spark, rule_from_check("f", {"type": "range", "max": 2}), [-9e9, 2.0, 2.1, None], "double") == [
        False,
        False,
        True,
        False,
    ]


def test_messages_keep_rule_order(spark):
    rules = [rule_from_text("b", "f in ['A']"), rule_from_text("a", "f.matches('^A')"), rule_from_text("c", "has(f)")]
    df = spark.createDataFrame([("x",), (None,), ("A",)], "f string")
    errors = [r.validation_errors for r in compile_rules(rules, df.schema, NOW).tag(df).collect()]
    assert errors == [
        ["ALLOWED_VALUES_VIOLATION [b]: 'f' not in ['A']", "REGEX_VIOLATION [a]: 'f' does not match pattern"],
        ["ALLOWED_VALUES_VIOLATION [b]: 'f' not in ['A']", "NOT_EMPTY_VIOLATION [c]: 'f' is null or empty"],
        [],
    ]


def test_equal_messages_are_all_kept(spark):
    rules = [rule_from_text("same", "has(f)"), rule_from_text("same", "has(f)")]
    df = spark.createDataFrame([(None,)], "f string")
    compiled = compile_rules(rules, df.schema, NOW)
    assert len(compiled.tag(df).first().validation_errors) == 2
    assert compiled.violations(df).collect() == [Row(rule="same", violations=2)]


def test_violations_count_like_the_arrays(spark):
    df = spark.range(1000).select((F.col("id") % 17).cast("double").alias("f"))
    rules = [rule_from_text("low", "f >= 3"), rule_from_text("high", "f <= 12"), rule_from_text("never", "f >= 0")]
    compiled = compile_rules(rules, df.schema, NOW)
    tagged = compiled.tag(df).collect()
    counted = {r.rule: r.violations for r in compiled.violations(df).collect()}
    assert counted == {
        name: sum(any(f"[{name}]" in e for e in row.validation_errors) for row in tagged) for name in ("low", "high")
    }


@pytest.mark.parametrize(
    "text", ["f == 3", "f > 1e5", "f ~ 3", "3 < f", "f in []", "f => 3", "f < now() + 1", "has(f) && has(g)"]
)
def test_unknown_forms_pass_and_are_listed(spark, text):
    rule = rule_from_text("odd", text)
    assert not rule.recognised
    df = spark.createDataFrame([("x",), (None,)], "f string")
    compiled = compile_rules([rule], df.schema, NOW)
    assert compiled.skipped == (rule,)
    assert all(r.is_valid for r in compiled.tag(df).collect())
    with pytest.raises(ContractError):
        compile_rules([rule], df.schema, NOW, strict=True)


@pytest.mark.parametrize("text", ["f > 1.2.3", "f <= -", "f >= 1 && f <= 1-2"])
def test_malformed_numbers_fail_when_the_contract_is_loaded(text):
    with pytest.raises(ContractError):
        rule_from_text("r", text)


def test_list_items():
    values = rule_from_text("r", """f in ['a,b', "it's", bare, 7 ]""").args["values"]
    assert values == ["a,b", "it's", "bare", "7"]


def test_unknown_field(spark):
    with pytest.raises(ContractError, match="unknown field"):
        compile_rules([rule_from_text("r", "has(nope)")], T.StructType([T.StructField("f", T.StringType())]), NOW)


def test_disabled_rules_are_left_out(spark):
    df = spark.createDataFrame([(None,)], "f string")
    compiled = compile_rules([rule_from_text("r", "has(f)", enabled=False)], df.schema, NOW)
    row = compiled.tag(df).first()
    assert row.is_valid and row.validation_errors == []
    assert compiled.tag(df).schema["validation_errors"].dataType.elementType == T.StringType()


# ── the nine streams: nulls pass everything but the null checks ──────────────


def _reasons(spark, name: str, **values) -> str:
    domain = DOMAINS[name]
    columns = {"event_id": "string", **domain.columns}
    row = tuple({**dict.fromkeys(columns), **values}.values())
    schema = ", ".join(f"{c} {k}" for c, k in columns.items())
    return check_domain(spark.createDataFrame([row], schema), domain).first().error_reason


def test_null_passes_value_checks(spark):
    assert _reasons(spark, "sales.transactions", transaction_id="T") == ""
    assert _reasons(spark, "sales.transactions") == "transaction_id is null"
    assert _reasons(spark, "sensors.readings") == "reading_id is null; sensor_id is null; machine_id is null"


def test_blank_is_not_null(spark):
    assert _reasons(spark, "sales.customers", customer_id="", email="  ") == ""


def test_all_reasons_in_order(spark):
    got = _reasons(spark, "sales.transactions", amount=0.0, currency="GBP", payment_method="")
    assert got == (
        "transaction_id is null; amount must be positive; currency is invalid; payment_method is invalid"
    )


@pytest.mark.parametrize(
    ("temperature", "vibration", "expected"),
    [
        (-20.0, 0.0, ""),
        (100.0, 20.0, ""),
        (-20.1, 20.1, "temperature out of range; vibration_level out of range"),
        (100.1, -0.1, "temperature out of range; vibration_level out of range"),
    ],
)
def test_reading_bounds(spark, temperature, vibration, expected):
    got = _reasons(
        spark,
        "sensors.readings",
        reading_id="R",
        sensor_id="S",
        machine_id="M",
        temperature=temperature,
        vibration_level=vibration,
    )
    assert got == expected
