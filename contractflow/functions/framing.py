"""The five-byte frame in front of registry-encoded messages: a zero byte and a schema id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The frame layout.
MAGIC = b"\x00"
HEADER_BYTES = 5


def is_framed(value: Column) -> Column:
    return (F.length(value) >= HEADER_BYTES) & (F.substring(value, 1, 1) == F.lit(MAGIC))


def frame_schema_id(value: Column) -> Column:
    """The big-endian schema id of a frame, null where there is no frame."""
    return F.when(is_framed(value), F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long"))


def frame_payload(value: Column, check_magic: bool = True) -> Column:
    """The bytes behind the header; unframed values give null unless ``check_magic`` is off."""
    payload = F.substring(value, F.lit(HEADER_BYTES + 1), F.length(value) - HEADER_BYTES)
    return F.when(is_framed(value), payload) if check_magic else payload


def frame(payload: Column, schema_id: Column) -> Column:
    """Put the header in front of a payload."""
    return F.concat(F.lit(MAGIC), F.unhex(F.lpad(F.hex(schema_id), 8, "0")), payload.cast("binary"))
