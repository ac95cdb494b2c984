"""Data contracts and data quality on Spark."""

from contractflow.operators import check_domain, compile_rules, route, validate
from contractflow.plans import DOMAINS, Contract, Rule, contract_from_dict, load_contract, load_contracts
from contractflow.session import pin, scratch

__all__ = [
    "DOMAINS",
    "Contract",
    "Rule",
    "check_domain",
    "compile_rules",
    "contract_from_dict",
    "load_contract",
    "load_contracts",
    "pin",
    "route",
    "scratch",
    "validate",
]
