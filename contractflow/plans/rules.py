"""Quality rules as data.

A contract states a rule either as text (``severity in ['A', 'B']``) or as a typed check
(``{type: allowed_values, values: [A, B]}``). Both become the same :class:`Rule`, so every
later step knows one rule list only. Numbers and lists are parsed here, when the contract is
loaded, and never inside a running batch.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any


class ContractError(ValueError):
    """A contract that cannot be used as written."""


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    field: str | None = None
    args: Mapping[str, Any] = dataclasses.field(default_factory=dict)
    text: str = ""
    enabled: bool = True

    @property
    def recognised(self) -> bool:
        return self.kind != UNRECOGNISED


UNRECOGNISED = "unrecognised"

_NUMBER = re.compile(r"(?P<plus>\+?)-?(?:\d+(?:\.\d*)?|\.\d+)(?P<power>(?:[eE][+-]?\d+)?)")
_OPERAND = r"\S+"  # any word; whether it is a number is asked afterwards

# The rule texts a contract may use, one form per rule kind.
RULE_FORMS = {
    "allowed_values": r"(?P<field>\w+)\s+in\s+\[(?P<items>.+)\]",
    "compare": r"(?P<field>\w+)\s*(?P<op>>=|<=|!=|>|<)\s*(?P<number>" + _OPERAND + ")",
    "range": r"(?P<field>\w+)\s*>=\s*(?P<min>" + _OPERAND + r")\s*&&\s*\w+\s*<=\s*(?P<max>" + _OPERAND + ")",
    "not_empty": r"has\((?P<field>\w+)\)",
    "not_blank": r"""(?P<field>\w+)\s*!=\s*['"]{2}""",
    "regex": r"""(?P<field>\w+)\.matches\(['"](?P<pattern>.+)['"]\)""",
    "not_future": r"(?P<field>\w+)\s*<\s*now\(\)",
}

_FORMS = {kind: re.compile(form) for kind, form in RULE_FORMS.items()}

# A list item is a quoted text (commas inside belong to it) or a bare word.
_ITEM = re.compile(r"""'(?P<single>[^']*)'|"(?P<double>[^"]*)"|(?P<bare>[^,\s'"][^,]*)""")


def _number(text: Any, rule: str) -> float:
    number = isinstance(text, (int, float)) and not isinstance(text, bool)
    if not number and not (isinstance(text, str) and _NUMBER.fullmatch(text.strip())):
        raise ContractError(f"rule {rule!r}: {text!r} is not a number")
    return float(text)


def _items(text: str) -> list[str]:
    found = []
    for match in _ITEM.finditer(text):
        quoted = match["single"] if match["single"] is not None else match["double"]
        found.append(quoted if quoted is not None else match["bare"].strip())
    return found


def _operand(word: str, any_number: bool) -> bool:
    """Whether a word of a rule is an operand. Words with letters or quotes are not (they may belong to another form),
    nor, unless ``any_number``, are numbers with a power of ten or a plus sign; any other word is meant for one."""
    found = _NUMBER.fullmatch(word)
    if found:
        return any_number or not (found["plus"] or found["power"])
    return not any(c.isalpha() or c in "'\"()[]&+" for c in word)


def rule_from_text(name: str, text: str, enabled: bool = True, any_number: bool = False) -> Rule:
    """Read one rule text; a text of no known form becomes an unrecognised rule, and so does a disabled one,
    which is not read any further. ``any_number`` also reads operands such as ``1e5`` and ``+5``, which
    are of no known form otherwise; a word that is meant for a number and is none raises."""
    text = text.strip()
    if not enabled:
        return Rule(name, UNRECOGNISED, None, {}, text, False)
    for kind, form in _FORMS.items():
        match = form.fullmatch(text)
        if match is None:
            continue
        parts = match.groupdict()
        if not all(_operand(parts[p], any_number) for p in ("number", "min", "max") if p in parts):
            continue
        target = parts.pop("field")
        if kind == "allowed_values":
            parts = {"values": _items(parts["items"])}
        elif kind == "compare":
            parts["number"] = _number(parts["number"], name)
        elif kind == "range":
            parts = {bound: _number(parts[bound], name) for bound in ("min", "max")}
        return Rule(name, kind, target, parts, text, enabled)
    return Rule(name, UNRECOGNISED, None, {}, text, enabled)


def rule_from_check(target: str, check: Mapping[str, Any]) -> Rule:
    """Read one typed check of a field; the rule is named ``<field>-<check type>``."""
    kind = str(check.get("type", ""))
    name = str(check.get("name", f"{target}-{kind}"))
    if check.get("disabled", False):
        return Rule(name, UNRECOGNISED, target, {}, repr(dict(check)), False)
    try:
        if kind == "not_empty":
            args: dict[str, Any] = {}
        elif kind == "allowed_values":
            args = {"values": [str(v) for v in check["values"]]}
        elif kind == "range":
            args = {"min": _bound(check.get("min"), name), "max": _bound(check.get("max"), name)}
        elif kind == "range_by_field":
            args = {
                "by": check["field"],
                "ranges": _ranges(check["ranges"], name),
            }
        elif kind == "not_future":
            args = {"tolerance": int(_number(check.get("tolerance_seconds", 0), name))}
        elif kind == "regex":
            args = {"pattern": check["pattern"]}
        else:
            return Rule(name, UNRECOGNISED, target, {}, repr(dict(check)))
    except KeyError as missing:
        raise ContractError(f"check {name!r} lacks {missing}") from None
    return Rule(name, kind, target, args)


def _ranges(ranges: Any, rule: str) -> dict[str, tuple[float, float]]:
    if not isinstance(ranges, Mapping) or not ranges:
        raise ContractError(f"check {rule!r}: ranges must map at least one value to its bounds")
    found = {}
    for value, bounds in ranges.items():
        if not isinstance(bounds, (list, tuple)) or len(bounds) != 2:
            raise ContractError(f"check {rule!r}: the range of {value!r} is no pair of bounds")
        found[str(value)] = (_number(bounds[0], rule), _number(bounds[1], rule))
    return found


def _bound(value: Any, rule: str) -> float | None:
    return None if value is None else _number(value, rule)


def required_rule(target: str) -> Rule:
    """The check behind ``nullable: false``."""
    return Rule(f"{target}-required", "required", target)
