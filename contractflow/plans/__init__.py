"""Declarative inputs: contracts, rules, type names and the nine event streams."""

from contractflow.plans.contract import (
    Contract,
    Field,
    active_contracts,
    active_version,
    contract_for_topic,
    contract_from_dict,
    load_contract,
    load_contracts,
    split_topic,
)
from contractflow.plans.domains import DOMAINS, ENVELOPE, Domain
from contractflow.plans.rules import ContractError, Rule, required_rule, rule_from_check, rule_from_text
from contractflow.plans.types import SPARK_TYPES, spark_type

__all__ = [
    "DOMAINS",
    "ENVELOPE",
    "SPARK_TYPES",
    "Contract",
    "ContractError",
    "Domain",
    "Field",
    "Rule",
    "active_contracts",
    "active_version",
    "contract_for_topic",
    "contract_from_dict",
    "load_contract",
    "load_contracts",
    "required_rule",
    "rule_from_check",
    "rule_from_text",
    "spark_type",
    "split_topic",
]
