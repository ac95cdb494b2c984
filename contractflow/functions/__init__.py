"""Column builders: clock, field access, violations and message frames."""

from contractflow.functions.checks import message, violation
from contractflow.functions.clock import instant, require_utc
from contractflow.functions.framing import frame, frame_payload, frame_schema_id, is_framed
from contractflow.functions.values import Fields, any_true, epoch_seconds, is_blank, number, text, timestamp, unwrap

__all__ = [
    "Fields",
    "any_true",
    "epoch_seconds",
    "frame",
    "frame_payload",
    "frame_schema_id",
    "instant",
    "is_blank",
    "is_framed",
    "message",
    "number",
    "require_utc",
    "text",
    "timestamp",
    "unwrap",
    "violation",
]
