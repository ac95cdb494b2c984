"""Rows that do not fit a writer schema go to an error table instead of failing the job.

A value fits where a strict writer would take it: numbers are not rounded, text is no number, a time fits
its logical type, and a union needs one branch that fits.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Avro's primitive types and the logical types of times, with the Spark types that fit as they are.
PLAIN = {
    "string": T.StringType,
    "boolean": T.BooleanType,
    "bytes": T.BinaryType,
    "float": T.NumericType,
    "double": T.NumericType,
}
WHOLE = {"int": 32, "long": 64}
LOGICAL = {
    "timestamp-millis": T.TimestampType,
    "timestamp-micros": T.TimestampType,
    "local-timestamp-millis": T.TimestampNTZType,
    "local-timestamp-micros": T.TimestampNTZType,
    "date": T.DateType,
}


def _branches(avro_type: Any) -> tuple[list[Any], bool]:
    """The branches of a field's type that are not null, and whether null is allowed."""
    branches = avro_type if isinstance(avro_type, list) else [avro_type]
    return [b for b in branches if b != "null"], "null" in branches


def _named(branch: Any) -> str:
    if not isinstance(branch, Mapping):
        return branch
    return branch.get("logicalType", branch["type"]) if branch["type"] != "enum" else f"one of {list(branch['symbols'])}"


def _whole(value: Column, dtype: T.DataType, bits: int) -> Column | bool:
    """Whether a number is whole and in range; what is not exact does not fit."""
    if not isinstance(dtype, T.NumericType):
        return False
    sizes = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
    if sizes.get(type(dtype), 99) <= bits:
        return True
    low, high = -(2 ** (bits - 1)), 2 ** (bits - 1)
    inside = (value >= F.lit(low)) & (value < F.lit(float(high)) if bits == 64 else value < F.lit(high))
    return inside if isinstance(dtype, T.LongType) else inside & (value == F.floor(value))


def _fits(value: Column, dtype: T.DataType, branch: Any) -> Column | bool:
    """Whether a value that is not null fits a branch: always, never, or under a condition."""
    name = branch["type"] if isinstance(branch, Mapping) else branch
    if name == "enum":
        return value.isin(*branch["symbols"]) if isinstance(dtype, T.StringType) else False
    logical = branch.get("logicalType") if isinstance(branch, Mapping) else None
    if logical in LOGICAL and isinstance(dtype, LOGICAL[logical]):
        return True
    if logical == "decimal" and isinstance(dtype, T.DecimalType):
        digits = dtype.precision - dtype.scale <= branch["precision"] - branch.get("scale", 0)
        return digits and dtype.scale <= branch.get("scale", 0)
    if name in WHOLE:
        return _whole(value, dtype, WHOLE[name])
    if name not in PLAIN:
        raise ValueError(f"unsupported field type {branch!r}")
    return isinstance(dtype, PLAIN[name])


def _misfit(value: Column, dtype: T.DataType, branches: list[Any]) -> Column | None:
    """The condition under which a value cannot be written, or None when it always can."""
    conditions = [_fits(value, dtype, branch) for branch in branches]
    if any(c is True for c in conditions):
        return None
    open_ones = [c for c in conditions if c is not False]
    if not open_ones:
        return value.isNotNull()
    return value.isNotNull() & ~F.coalesce(reduce(lambda a, b: a | b, open_ones), F.lit(False))


def _complaint(branches: list[Any]) -> tuple[str, str]:
    if len(branches) == 1:
        enum = isinstance(branches[0], Mapping) and branches[0]["type"] == "enum"
        return ("UnknownSymbol", f"is not {_named(branches[0])}") if enum else ("WrongType", f"is not a {_named(branches[0])}")
    return "WrongType", "is none of " + ", ".join(_named(b) for b in branches)


def conformance_error(schema: Mapping[str, Any], columns: T.StructType) -> Column:
    """The first misfit of a row as ``struct<error_type, error_message>``, null if it fits."""
    found: list[Column] = []

    def report(condition: Column, kind: str, text: str) -> None:
        found.append(F.when(condition, F.struct(F.lit(kind).alias("error_type"), F.lit(text).alias("error_message"))))

    present = set(columns.fieldNames())
    for field in schema["fields"]:
        name = field["name"]
        branches, nullable = _branches(field["type"])
        filled = nullable or field.get("default") is not None
        if name not in present:
            if not filled:
                report(F.lit(True), "MissingField", f"{name} is required")
            continue
        value = F.col(f"`{name}`")
        if not filled:
            report(value.isNull(), "MissingField", f"{name} is required")
        misfit = _misfit(value, columns[name].dataType, branches)
        if misfit is not None:
            kind, text = _complaint(branches)
            report(misfit, kind, f"{name} {text}")
    if not found:
        return F.lit(None).cast("struct<error_type:string,error_message:string>")
    return F.coalesce(*found)


def split_conforming(
    df: DataFrame, schema: Mapping[str, Any], target_topic: str, stage: str = "producer_schema_serialization"
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and an error record for each row that does not."""
    error = conformance_error(schema, df.schema)
    fits = df.filter(error.isNull())
    failures = df.select(error.alias("error"), F.to_json(F.struct(*df.columns)).alias("failed_event")).filter(
        F.col("error").isNotNull()
    )
    return fits, failures.select(
        F.lit(stage).alias("error_stage"),
        "error.error_type",
        "error.error_message",
        F.lit(target_topic).alias("target_topic"),
        "failed_event",
    )
