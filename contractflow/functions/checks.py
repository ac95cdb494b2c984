"""Each rule kind as a violation: a boolean column and the message that goes with it.

Two families disagree on nulls on purpose. Contract checks treat a missing value as a breach
in ``allowed_values`` and ``not_empty``; stream checks let a null pass everything except the
explicit ``missing`` check. A null condition always means "passes".
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from contractflow.functions import values as V
from contractflow.plans.rules import Rule

Check = Callable[[Rule, V.Fields, Column], Column]

# The message of each rule kind.
MESSAGES = {
    "allowed_values": "ALLOWED_VALUES_VIOLATION [{name}]: '{field}' not in {values}",
    "compare": "RANGE_VIOLATION [{name}]: '{field}' failed '{text}'",
    "range": "RANGE_VIOLATION [{name}]: '{field}' out of [{min}, {max}]",
    "range_by_field": "RANGE_VIOLATION [{name}]: '{field}' out of range for its '{by}'",
    "not_empty": "NOT_EMPTY_VIOLATION [{name}]: '{field}' is null or empty",
    "not_blank": "NOT_EMPTY_VIOLATION [{name}]: '{field}' is empty",
    "required": "NULL_VIOLATION [{name}]: '{field}' is null",
    "regex": "REGEX_VIOLATION [{name}]: '{field}' does not match pattern",
    "not_future": "NOT_FUTURE_VIOLATION [{name}]: '{field}' is in the future",
    "missing": "{name}",
    "not_positive": "{name}",
    "unknown_value": "{name}",
    "out_of_range": "{name}",
}


def message(rule: Rule) -> str:
    parts = dict(rule.args)
    if rule.kind == "range":
        parts["min"] = -math.inf if parts["min"] is None else parts["min"]
        parts["max"] = math.inf if parts["max"] is None else parts["max"]
    return MESSAGES[rule.kind].format(name=rule.name, field=rule.field, text=rule.text, **parts)


def _allowed_values(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    return ~F.coalesce(V.text(fields.get(rule.field)[0]).isin(*rule.args["values"]), F.lit(False))


def _compare(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    value, limit = V.number(*fields.get(rule.field)), F.lit(rule.args["number"])
    breached = {
        ">": value <= limit,
        ">=": value < limit,
        "<": value >= limit,
        "<=": value > limit,
        "!=": value == limit,
    }
    return breached[rule.args["op"]]


def _outside(value: Column, low: Column | float | None, high: Column | float | None) -> Column:
    sides = ([] if low is None else [value < low]) + ([] if high is None else [value > high])
    return sides[0] | sides[1] if len(sides) == 2 else (sides[0] if sides else F.lit(False))


def _range(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    return _outside(V.number(*fields.get(rule.field)), rule.args["min"], rule.args["max"])


def _range_by_field(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    value = V.number(*fields.get(rule.field))
    chooser = V.text(fields.get(rule.args["by"])[0])
    (first, bounds), *others = rule.args["ranges"].items()
    breached = F.when(chooser == first, _outside(value, *bounds))
    for choice, bounds in others:
        breached = breached.when(chooser == choice, _outside(value, *bounds))
    return breached


def _not_empty(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    return V.is_blank(fields.get(rule.field)[0])


def _required(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    return fields.get(rule.field)[0].isNull()


def _regex(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    return ~V.text(fields.get(rule.field)[0]).rlike(rule.args["pattern"])


def _not_future(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    latest = clock.cast("long") + F.lit(rule.args.get("tolerance", 0))
    return V.epoch_seconds(*fields.get(rule.field)) > latest


def _not_positive(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    return V.number(*fields.get(rule.field)) <= 0


def _unknown_value(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    return ~V.text(fields.get(rule.field)[0]).isin(*rule.args["values"])


CHECKS: dict[str, Check] = {
    "allowed_values": _allowed_values,
    "compare": _compare,
    "range": _range,
    "range_by_field": _range_by_field,
    "not_empty": _not_empty,
    "not_blank": _not_empty,
    "required": _required,
    "regex": _regex,
    "not_future": _not_future,
    "missing": _required,
    "not_positive": _not_positive,
    "unknown_value": _unknown_value,
    "out_of_range": _range,
}


def violation(rule: Rule, fields: V.Fields, clock: Column) -> Column:
    """True where the row breaks the rule, false or null where it does not."""
    return CHECKS[rule.kind](rule, fields, clock)
