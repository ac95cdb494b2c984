"""Reading a field the way the rules need it: as text, number or whole epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.functions.clock import require_utc


class Fields:
    """The fields a rule may name, found in a struct column or at the root of a table."""

    def __init__(self, schema: T.StructType, payload: str | None = None):
        self._prefix = f"{payload}." if payload else ""
        struct = schema[payload].dataType if payload else schema
        if not isinstance(struct, T.StructType):
            raise TypeError(f"{payload!r} is not a struct column")
        self._types = {f.name: f.dataType for f in struct.fields}

    def __contains__(self, name: str) -> bool:
        return name in self._types

    def raw(self, name: str) -> Column:
        return F.col(f"{self._prefix}`{name}`")

    def get(self, name: str) -> tuple[Column, T.DataType]:
        """The field's value and type; a decoded union is unwrapped to its filled member."""
        dtype, value = self._types[name], self.raw(name)
        return unwrap(value, dtype) if isinstance(dtype, T.StructType) else (value, dtype)


def unwrap(value: Column, struct: T.StructType) -> tuple[Column, T.DataType]:
    """Unwrap ``struct<member>`` or ``struct<member0, member1, ...>``."""
    members = [f for f in struct.fields if f.name == "member" or f.name.removeprefix("member").isdigit()]
    if not members:
        return value, struct
    if len({m.dataType.simpleString() for m in members}) == 1:
        return F.coalesce(*[value[m.name] for m in members]), members[0].dataType
    return F.coalesce(*[value[m.name].cast("string") for m in members]), T.StringType()


def text(value: Column) -> Column:
    return value.cast("string")


def number(value: Column, dtype: T.DataType) -> Column:
    """Numbers stay as they are; text that is no number becomes null instead of an error."""
    return value.try_cast("double") if isinstance(dtype, T.StringType) else value


def timestamp(value: Column, dtype: T.DataType) -> Column:
    """ISO-8601 text with or without fraction, offset or ``Z``; unreadable text becomes null.

    Text without an offset is UTC, which the session has to be set to.
    """
    if isinstance(dtype, T.StringType):
        require_utc()
    return F.try_to_timestamp(value) if isinstance(dtype, T.StringType) else value.cast("timestamp")


def epoch_seconds(value: Column, dtype: T.DataType) -> Column:
    return timestamp(value, dtype).cast("long")


def is_blank(value: Column) -> Column:
    """Null, empty, or nothing but spaces; the value is read once, it may be costly to derive."""
    return F.coalesce(F.trim(text(value)), F.lit("")) == ""


def any_true(conditions: list[Column]) -> Column:
    """True when one condition holds; an unknown condition does not count.

    Halves are joined rather than a chain built, so that many rules do not make a deep expression.
    """
    if not conditions:
        return F.lit(False)
    if len(conditions) == 1:
        return F.coalesce(conditions[0], F.lit(False))
    half = len(conditions) // 2
    return any_true(conditions[:half]) | any_true(conditions[half:])
