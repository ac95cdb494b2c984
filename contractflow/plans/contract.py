"""Data contracts: the small driver-side object everything else is derived from."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import types as T

from contractflow.plans.rules import ContractError, Rule, required_rule, rule_from_check, rule_from_text
from contractflow.plans.types import spark_type


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    nullable: bool = True

    def __post_init__(self) -> None:
        spark_type(self.type)


@dataclass(frozen=True)
class Contract:
    name: str
    version: str = "1.0.0"
    status: str = "active"
    topic: str = ""
    format: str = "avro"
    fields: tuple[Field, ...] = ()
    rules: tuple[Rule, ...] = ()
    table: str = ""
    quarantine_table: str = ""
    checkpoint: str = ""
    partitioning: tuple[str, ...] = ()
    sla: Mapping[str, Any] = field(default_factory=dict)

    @property
    def active_rules(self) -> tuple[Rule, ...]:
        return tuple(rule for rule in self.rules if rule.enabled)

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> T.StructType:
        """The payload schema, in contract order."""
        return T.StructType([T.StructField(f.name, spark_type(f.type), f.nullable) for f in self.fields])

    def checkpoint_path(self, base: str) -> str:
        """The stated checkpoint, else a folder under ``base`` named after the topic."""
        return self.checkpoint or f"{base.rstrip('/')}/{self.topic.replace('.', '_')}"


def split_topic(topic: str) -> tuple[str, str, str]:
    """``<zone>.<group>.<artifact>``; further parts are ignored, fewer are an error."""
    parts = topic.split(".")
    if len(parts) < 3:
        raise ContractError(f"topic {topic!r} is not of the form <zone>.<group>.<artifact>")
    return parts[0], parts[1], parts[2]


def contract_from_dict(doc: Mapping[str, Any], enforce_required: bool | None = None) -> Contract:
    """Build a contract from either document form.

    ``enforce_required`` turns ``nullable: false`` into a check. It is on by default for the
    field/check form, which defines it so, and off for the rule-text form, where only a
    ``has(...)`` rule makes a field required. Rule texts may use numbers such as ``1e5`` and ``+5`` where the
    document's quality section says ``numbers: any``.
    """
    if "contract" in doc:
        return _from_checks(doc["contract"], True if enforce_required is None else enforce_required)
    return _from_rule_texts(doc, bool(enforce_required))


def _from_rule_texts(doc: Mapping[str, Any], enforce_required: bool) -> Contract:
    info, storage = doc.get("info", {}), doc.get("storage", {})
    fields = tuple(_field(f) for f in doc.get("schema", {}).get("fields", []))
    required = [required_rule(f.name) for f in fields if enforce_required and not f.nullable]
    any_number = doc.get("quality", {}).get("numbers") == "any"
    rules = [
        rule_from_text(r.get("name", "unnamed_rule"), r["expr"], not r.get("disabled", False), any_number)
        for r in doc.get("quality", {}).get("rules", [])
        if r.get("expr", "").strip()
    ]
    return Contract(
        name=info.get("title", doc.get("kafkaTopic", "contract")),
        version=str(info.get("version", "1.0.0")),
        status=info.get("status", "active"),
        topic=doc.get("kafkaTopic", ""),
        format=doc.get("format", "avro").lower(),
        fields=fields,
        rules=(*required, *rules),
        table=storage.get("icebergTable", ""),
        quarantine_table=storage.get("quarantineTable", ""),
        checkpoint=storage.get("checkpointPath", ""),
        partitioning=tuple(storage.get("partitioning", ())),
        sla=doc.get("sla", {}),
    )


def _from_checks(doc: Mapping[str, Any], enforce_required: bool) -> Contract:
    declared = doc.get("fields") or []
    rules: list[Rule] = []
    for f in declared:
        if enforce_required and not f.get("nullable", True):
            rules.append(required_rule(f["name"]))
        rules.extend(rule_from_check(f["name"], check) for check in f.get("checks", []))
    sla = dict(doc.get("sla", {}))
    if "max_latency_seconds" in doc:
        sla["max_latency_seconds"] = doc["max_latency_seconds"]
    table = doc.get("iceberg_table") or _qualified(doc, "table")
    return Contract(
        name=doc["name"],
        version=str(doc.get("version", "1.0.0")),
        status=doc.get("status", "active"),
        topic=doc.get("kafka_topic", ""),
        format=doc.get("format", "avro").lower(),
        fields=tuple(_field(f) for f in declared),
        rules=tuple(rules),
        table=table,
        # quarantine_table is fully qualified beside iceberg_table, bare beside namespace
        quarantine_table=doc.get("quarantine_table", "") if doc.get("iceberg_table") else _qualified(doc, "quarantine_table"),
        checkpoint=doc.get("checkpoint_path", ""),
        partitioning=tuple(doc.get("partitioning") or ()),
        sla=sla,
    )


def _field(doc: Mapping[str, Any]) -> Field:
    try:
        return Field(doc["name"], doc.get("type", "string"), doc.get("nullable", True))
    except ValueError as error:
        raise ContractError(f"field {doc.get('name')!r}: {error}") from None


def _qualified(doc: Mapping[str, Any], key: str) -> str:
    if not doc.get(key):
        return ""
    return f"{doc['namespace']}.{doc[key]}" if doc.get("namespace") else doc[key]


def load_contract(path: str | Path, enforce_required: bool | None = None) -> Contract:
    """Load one contract file; JSON is read by the same loader, being a subset of YAML."""
    with open(path, encoding="utf-8") as source:
        doc = yaml.safe_load(source)
    if not isinstance(doc, Mapping):
        raise ContractError(f"{path}: not a contract document")
    return contract_from_dict(doc, enforce_required)


def load_contracts(folder: str | Path) -> tuple[list[Contract], dict[str, str]]:
    """Load every contract of a folder; files that fail are reported, not fatal."""
    loaded: list[Contract] = []
    skipped: dict[str, str] = {}
    for path in sorted(Path(folder).iterdir()):
        if path.suffix not in (".json", ".yaml", ".yml"):
            continue
        try:
            loaded.append(load_contract(path))
        except (ContractError, yaml.YAMLError, KeyError, TypeError, AttributeError, ValueError, OSError) as error:
            skipped[path.name] = f"{type(error).__name__}: {error}"
    return loaded, skipped


def contract_for_topic(contracts: Iterable[Contract], topic: str) -> Contract:
    """The contract of a topic, in its highest active version."""
    split_topic(topic)
    listed = list(contracts)
    names = [c.name for c in listed if c.topic == topic and c.status == "active"]
    if not names:
        raise ContractError(f"no active contract for topic {topic!r}")
    return active_version([c for c in listed if c.topic == topic], names[0])


def active_contracts(contracts: Iterable[Contract]) -> tuple[list[Contract], dict[str, str]]:
    """The highest active version of every contract, and why others are left out."""
    listed = list(contracts)
    names = dict.fromkeys(c.name for c in listed)
    chosen = [active_version(listed, n) for n in names if any(c.name == n and c.status == "active" for c in listed)]
    skipped = {}
    for c in listed:
        if not any(c is kept for kept in chosen):
            reason = f"status is {c.status!r}" if c.status != "active" else "a higher version is active"
            skipped[f"{c.name} {c.version}"] = reason
    return chosen, skipped


def active_version(contracts: Iterable[Contract], name: str) -> Contract:
    """The highest active version of a contract."""
    candidates = [c for c in contracts if c.name == name and c.status == "active"]
    if not candidates:
        raise ContractError(f"no active version of contract {name!r}")
    return max(candidates, key=lambda c: [int(part) for part in re.findall(r"\d+", c.version)])
