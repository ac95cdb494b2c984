"""Compile rules into columns and tag rows with their violations.

Validation is map-only: one projection, built-in expressions, no shuffle and no UDF. Rules are
compiled once, when the plan is declared, for batch tables and streams alike.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.functions import Fields, any_true, instant, message, violation
from contractflow.plans import Contract, ContractError, Domain, Rule

logger = logging.getLogger(__name__)

ERRORS, VALID, REASON = "validation_errors", "is_valid", "error_reason"

# The bytes of a message that could not be decoded, null for all others, and what is said of it.
UNDECODED, NOT_DECODED = "undecoded", "payload could not be decoded"


class Check(NamedTuple):
    """One compiled rule: when ``violated`` is true the row gets ``message``."""

    rule: str
    violated: Column
    message: str


@dataclass(frozen=True)
class CompiledRules:
    """The compiled checks in rule order, and the rules that could not be compiled."""

    checks: tuple[Check, ...]
    skipped: tuple[Rule, ...] = ()

    def valid(self) -> Column:
        return ~any_true([check.violated for check in self.checks])

    def errors(self) -> Column:
        """Messages in rule order, an empty array for a valid row.

        No message is empty, so the empty text can stand for "passed" until it is removed; unlike
        a filter with a lambda this stays inside generated code.
        """
        if not self.checks:
            return F.array().cast("array<string>")
        return F.array_remove(F.array(*[F.when(c.violated, c.message).otherwise("") for c in self.checks]), "")

    def reason(self) -> Column:
        """Messages joined by ``"; "``; the empty text means valid."""
        return F.concat_ws("; ", *[F.when(c.violated, c.message) for c in self.checks])

    def tag(self, df: DataFrame) -> DataFrame:
        """Both columns; the flag is read off the array, so that no condition is built twice."""
        return df.withColumn(ERRORS, self.errors()).withColumn(VALID, F.size(ERRORS) == 0)

    def violations(self, df: DataFrame) -> DataFrame:
        """Violations per rule, straight from the conditions: one aggregate, no arrays, one row shuffled."""
        by_rule: dict[str, list[Column]] = {}
        for check in self.checks:
            by_rule.setdefault(check.rule, []).append(F.count_if(check.violated))
        if not by_rule:
            raise ContractError("there is no rule to count")
        lines = [
            F.struct(F.lit(rule).alias("rule"), reduce(lambda a, b: a + b, counts).alias("violations"))
            for rule, counts in by_rule.items()
        ]
        counted = df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))
        return counted.filter(F.col("violations") > 0)


def compile_rules(
    rules: Iterable[Rule],
    schema: T.StructType,
    as_of: datetime | Column,
    payload: str | None = None,
    strict: bool = False,
    extra: Sequence[Check] = (),
) -> CompiledRules:
    """Bind rules to a schema.

    A rule of no known form lets every row pass; it is logged and listed in ``skipped``, or
    raises when ``strict``. A rule on an unknown field always raises. ``extra`` checks come first.
    """
    fields, clock = Fields(schema, payload), instant(as_of)
    checks: list[Check] = list(extra)
    skipped: list[Rule] = []
    for rule in rules:
        if not rule.enabled:
            continue
        if not rule.recognised:
            if strict:
                raise ContractError(f"rule {rule.name!r} has no known form: {rule.text!r}")
            logger.warning("rule %r skipped, no known form: %r", rule.name, rule.text)
            skipped.append(rule)
            continue
        for name in filter(None, (rule.field, rule.args.get("by"))):
            if name not in fields:
                raise ContractError(f"rule {rule.name!r} names the unknown field {name!r}")
        checks.append(Check(rule.name, violation(rule, fields, clock), message(rule)))
    return CompiledRules(tuple(checks), tuple(skipped))


def validate(
    df: DataFrame,
    contract: Contract,
    as_of: datetime | Column,
    payload: str | None = None,
    strict: bool = False,
    decode_check: bool = True,
) -> DataFrame:
    """Add ``validation_errors`` and ``is_valid``.

    ``payload`` names the decoded struct column, or is left out for a flat table. With
    ``decode_check`` a payload that could not be decoded is a violation of its own instead of
    a row of nulls.
    """
    extra = [decode_failure(df.schema, payload)] if payload and decode_check else []
    return compile_rules(contract.active_rules, df.schema, as_of, payload, strict, extra).tag(df)


CORRUPT = "_corrupt_record"


def decode_failure(schema: T.StructType, payload: str) -> Check:
    failed = F.col(payload).isNull()
    if CORRUPT in schema[payload].dataType.fieldNames():
        failed = failed | F.col(f"{payload}.{CORRUPT}").isNotNull()
    return Check("decode", failed, "DECODE_VIOLATION [decode]: payload could not be decoded")


def check_domain(df: DataFrame, domain: Domain) -> DataFrame:
    """Add ``error_reason`` to flattened events of one of the nine streams.

    A message that could not be decoded has that for its reason, and no other.
    """
    never = F.lit(None).cast("timestamp")  # no rule of these streams looks at the clock
    reason = compile_rules(domain.rules, df.schema, never).reason()
    if UNDECODED in df.columns:
        reason = F.when(F.col(UNDECODED).isNotNull(), F.lit(NOT_DECODED)).otherwise(reason)
    return df.withColumn(REASON, reason)
