"""Random rows and rules against a plain Python reading of the rules."""

from __future__ import annotations

import math
import re
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contractflow import check_domain, compile_rules
from contractflow.operators.validate import CompiledRules
from contractflow.plans import DOMAINS, rule_from_text

NOW = datetime(2024, 1, 25)
TEXTS = st.one_of(st.none(), st.sampled_from(["", " ", "A", "B", "a12", "99", "x y", "7", "-3.5"]), st.text("AB 12.", max_size=4))
NUMBERS = st.one_of(st.none(), st.sampled_from([0.0, -1.5, 5.0, 5.5, math.inf, -math.inf]), st.floats(-20, 20))
LIMITS = st.sampled_from(["0", "5", "-1.5", "5.5", "100"])
RULES = st.one_of(
    st.lists(st.sampled_from(["A", "B", "99", "x y"]), min_size=1, max_size=3).map(lambda v: ("in", f"t in {v}", v)),
    st.tuples(st.sampled_from([">", ">=", "<", "<=", "!="]), LIMITS).map(lambda p: ("cmp", f"n {p[0]} {p[1]}", p)),
    st.tuples(LIMITS, LIMITS).map(lambda p: ("band", f"n >= {p[0]} && n <= {p[1]}", p)),
    st.sampled_from([("empty", "has(t)", None), ("empty", "t != ''", None)]),
    st.sampled_from(["[0-9]{2}", "^A", "B$", "1|2"]).map(lambda p: ("match", f"t.matches('{p}')", p)),
)


def breaks(kind: str, args, t: str | None, n: float | None) -> bool:
    if kind == "in":
        return t not in args
    if kind == "empty":
        return t is None or t.strip(" ") == ""
    if kind == "match":
        return t is not None and re.search(args, t) is None
    if n is None:
        return False
    if kind == "band":
        return n < float(args[0]) or n > float(args[1])
    limit = float(args[1])
    return not {">": n > limit, ">=": n >= limit, "<": n < limit, "<=": n <= limit, "!=": n != limit}[args[0]]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(TEXTS, NUMBERS), min_size=1, max_size=25), rules=st.lists(RULES, min_size=1, max_size=5))
def test_rules(spark, rows, rules):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, n double")
    compiled: CompiledRules = compile_rules([rule_from_text(f"r{j}", r[1]) for j, r in enumerate(rules)], df.schema, NOW)
    tagged = compiled.tag(df).orderBy("i").collect()
    for row, (t, n) in zip(tagged, rows, strict=True):
        expected = [f"r{j}" for j, (kind, _, args) in enumerate(rules) if breaks(kind, args, t, n)]
        assert [re.search(r"\[(r\d)\]", e).group(1) for e in row.validation_errors] == expected
        assert row.is_valid == (not expected)


CATEGORIES = st.sampled_from([None, "", "MAD", "EUR", "GBP", "CARD", "CASH", "usd"])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(TEXTS, NUMBERS, CATEGORIES, CATEGORIES), min_size=1, max_size=25))
def test_transactions(spark, rows):
    domain = DOMAINS["sales.transactions"]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, transaction_id string, amount double, currency string, payment_method string",
    )
    checked = check_domain(df, domain).orderBy("i").collect()
    for row, (key, amount, currency, method) in zip(checked, rows, strict=True):
        expected = []
        if key is None:
            expected.append("transaction_id is null")
        if amount is not None and amount <= 0:
            expected.append("amount must be positive")
        if currency is not None and currency not in ("MAD", "EUR", "USD"):
            expected.append("currency is invalid")
        if method is not None and method not in ("CARD", "CASH", "TRANSFER"):
            expected.append("payment_method is invalid")
        assert row.error_reason == "; ".join(expected)


def test_many_rules_stay_exact(spark):
    """A contract of five hundred rules compiles and counts like its parts."""
    df = spark.range(500).select(F.col("id").cast("double").alias("n"))
    rules = [rule_from_text(f"r{limit}", f"n <= {limit}") for limit in range(0, 500, 1)]
    compiled = compile_rules(rules, df.schema, NOW)
    counted = {r.rule: r.violations for r in compiled.violations(df).collect()}
    assert counted == {f"r{limit}": 499 - limit for limit in range(0, 499)}
    assert compiled.tag(df).filter("is_valid").count() == 1
