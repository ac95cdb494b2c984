"""DataFrame operators: decode, validate, project, route, measure, inject."""

from contractflow.operators.conformance import conformance_error, split_conforming
from contractflow.operators.decode import (
    decode_avro,
    decode_contract,
    decode_framed,
    decode_json,
    drift_fields,
    event_schema,
    flatten_event,
    frame_report,
    keep_raw,
)
from contractflow.operators.project import fallback_key, iso_text, merge_event, message_json, wrap_event
from contractflow.operators.routing import (
    batch_counts,
    certified,
    domain_messages,
    emit_where,
    quarantined,
    route,
    split_domain,
)
from contractflow.operators.validate import CompiledRules, check_domain, compile_rules, validate

__all__ = [
    "CompiledRules",
    "batch_counts",
    "certified",
    "check_domain",
    "compile_rules",
    "conformance_error",
    "decode_avro",
    "decode_contract",
    "decode_framed",
    "decode_json",
    "domain_messages",
    "drift_fields",
    "emit_where",
    "event_schema",
    "fallback_key",
    "flatten_event",
    "frame_report",
    "iso_text",
    "keep_raw",
    "merge_event",
    "message_json",
    "quarantined",
    "route",
    "split_conforming",
    "split_domain",
    "validate",
    "wrap_event",
]
