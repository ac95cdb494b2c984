"""Messages of one topic written under several schemas, read under one: dispatch by the id in the frame.

Every message names the schema it was written with. Its body is parsed under that schema only, and then brought to the
reader's: fields are found by name or by an earlier name, numbers are promoted, and what the writer did not know has a
default. All in one pass over the messages, whatever the number of schemas.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.functions import frame_payload, frame_schema_id
from contractflow.operators.decode import avro_column
from contractflow.operators.validate import CORRUPT, UNDECODED
from contractflow.plans import ContractError

# The types that a written type may be read as, besides itself.
PROMOTIONS = {
    "int": ("bigint", "float", "double"),
    "bigint": ("float", "double"),
    "float": ("double",),
    "string": ("binary",),
    "binary": ("string",),
}


@dataclass(frozen=True)
class ReaderField:
    """A field as it is read: ``aliases`` are its earlier names, latest first. A field that a writer does not have is
    ``default``, unless it is ``required``: then the writer's schema cannot be read at all."""

    name: str
    dataType: T.DataType
    aliases: tuple[str, ...] = ()
    default: Any = None
    required: bool = False
    fields: tuple[ReaderField, ...] = ()  # of a struct, where its own fields are resolved too


def resolved(written: Column, schema: T.StructType, reader: Sequence[ReaderField], where: str = "") -> Column:
    """A struct of the reader's fields from one of the writer's; raises ContractError where that cannot be."""
    columns, names = [], {f.name: f for f in schema}
    for field in reader:
        at = f"{where}{field.name}"
        source = next((names[n] for n in (field.name, *field.aliases) if n in names), None)
        if source is None:
            if field.required:
                raise ContractError(f"the writer has no field {at!r}, and the reader no default for it")
            columns.append(F.lit(field.default).cast(field.dataType).alias(field.name))
            continue
        value, have, want = written.getField(source.name), source.dataType, field.dataType
        if field.fields and isinstance(have, T.StructType):
            inner = resolved(value, have, field.fields, f"{at}.")
            value = F.when(value.isNotNull(), inner)
        elif have.simpleString() != want.simpleString():
            if want.simpleString() not in PROMOTIONS.get(have.simpleString(), ()):
                raise ContractError(f"field {at!r} was written as {have.simpleString()} and cannot be read as {want.simpleString()}")
            value = value.cast(want)
        columns.append(value.alias(field.name))
    return F.struct(*columns)


def decode_by_schema(df: DataFrame, writers: Mapping[int, T.StructType | str], reader: Sequence[ReaderField]) -> DataFrame:
    """``kafka_key``, ``schema_id``, ``event`` and ``undecoded`` from framed messages of several schemas.

    ``writers`` has the schema of each id: a StructType for JSON bodies, Avro text for Avro ones. ``undecoded`` holds the
    whole value of a message without a frame, with an id that is not among the writers, or with a body that is
    broken, and its event is null; it is null for all others. A null value counts as empty. Schemas that cannot be
    resolved raise before any message is read.
    """
    body, whole = frame_payload(F.col("value")), F.coalesce("value", F.lit(b""))
    held = df.select(F.col("key").cast("string").alias("kafka_key"), frame_schema_id(F.col("value")).alias("schema_id"), body.alias("__body"), whole.alias("__whole"))
    parsed = {}
    for number, schema in writers.items():
        mine = F.when(F.col("schema_id") == number, F.col("__body"))
        if isinstance(schema, str):
            parsed[f"__{number}"] = avro_column(mine, schema, "PERMISSIVE")
        else:
            marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
            parsed[f"__{number}"] = F.from_json(mine.cast("string"), marked, {"columnNameOfCorruptRecord": CORRUPT})
    # the parsed bodies are columns of their own, so that a body is parsed once and not once a field
    wide = held.withColumns(parsed)
    event = None
    for number in writers:
        written = F.col(f"__{number}")
        schema = wide.schema[f"__{number}"].dataType
        fits = F.col("schema_id") == number
        if CORRUPT in schema.fieldNames():
            fits = fits & written.isNotNull() & written.getField(CORRUPT).isNull()
            schema = T.StructType([f for f in schema if f.name != CORRUPT])
        else:
            fits = fits & written.isNotNull()
        branch = resolved(written, schema, reader)
        event = F.when(fits, branch) if event is None else event.when(fits, branch)
    if event is None:
        empty = T.StructType([T.StructField(f.name, f.dataType) for f in reader])
        event = F.lit(None).cast(empty)
    out = wide.select("kafka_key", "schema_id", event.alias("event"), "__whole")
    return out.select("kafka_key", "schema_id", "event", F.when(F.col("event").isNull(), F.col("__whole")).alias(UNDECODED))
