"""A new version of a contract, applied to rows that an earlier version has judged, rule by changed rule.

Rules that both versions have were judged already, and their messages stand. Certified rows are held against the added
rules only; refused rows lose the messages of rules that are gone and are decoded for the added ones. What comes out
is what validating everything from scratch would give, in one pass over each table without a shuffle. Versions that
list the same rules in another order have no changes: stored messages keep their order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.operators.decode import PAYLOAD, RAW
from contractflow.operators.validate import CORRUPT, ERRORS, compile_rules
from contractflow.plans import Contract, ContractError, Rule

DECODE = "decode"  # the name under which undecodable payloads are reported


@dataclass(frozen=True)
class RuleChanges:
    """The rules of the newer version, those of them that the older lacks, and the names of rules that are gone.

    A rule that was changed is both gone and added.
    """

    rules: tuple[Rule, ...]
    added: tuple[Rule, ...]
    gone: tuple[str, ...]

    @property
    def none(self) -> bool:
        return not self.added and not self.gone


def rule_changes(old: Contract, new: Contract) -> RuleChanges:
    """What tells two versions apart. Names of rules must be unique in each, and the fields the same in both."""
    for contract in (old, new):
        names = [r.name for r in contract.active_rules]
        if len(set(names)) < len(names):
            raise ContractError(f"contract {contract.name!r} {contract.version} has two rules of one name")
    if [(f.name, f.type) for f in old.fields] != [(f.name, f.type) for f in new.fields]:
        raise ContractError("the versions differ in their fields: such rows have to be read again from the messages")
    before, after = ([r for r in c.active_rules if r.recognised] for c in (old, new))
    added = tuple(r for r in after if r not in before)
    gone = tuple(r.name for r in before if r not in after)
    return RuleChanges(tuple(after), added, gone)


def _of(rule: str) -> Column:
    """The messages that name a rule, out of a row's errors."""
    return F.filter(ERRORS, lambda e: e.rlike(r"^\w+ \[" + re.escape(rule) + r"\]: "))


def rejudged_certified(bronze: DataFrame, changes: RuleChanges, as_of: datetime | Column) -> DataFrame:
    """Certified rows with ``validation_errors``: the messages of added rules that they break."""
    return bronze.withColumn(ERRORS, compile_rules(changes.added, bronze.schema, as_of).errors())


def rejudged_refused(quarantine: DataFrame, contract: Contract, changes: RuleChanges, as_of: datetime | Column) -> DataFrame:
    """Refused rows with their payload decoded and ``validation_errors`` as the new version has them, in its order."""
    schema = T.StructType([*contract.schema().fields, T.StructField(CORRUPT, T.StringType())])
    decoded = quarantine.withColumn(PAYLOAD, F.from_json(RAW, schema, {"columnNameOfCorruptRecord": CORRUPT}))
    fresh = {c.rule: F.when(c.violated, F.array(F.lit(c.message))) for c in compile_rules(changes.added, decoded.schema, as_of, PAYLOAD).checks}
    none = F.array().cast("array<string>")
    parts = [_of(DECODE), *[F.coalesce(fresh[r.name], none) if r.name in fresh else _of(r.name) for r in changes.rules]]
    return decoded.withColumn(ERRORS, F.flatten(F.array(*parts)))


def message_of(contract: Contract) -> Column:
    """The JSON message that a certified row came from, as far as its fields tell."""
    return F.to_json(F.struct(*contract.field_names), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
