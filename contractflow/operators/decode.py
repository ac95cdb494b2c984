"""From message bytes to typed columns."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.functions import frame_payload, frame_schema_id, is_framed, unwrap
from contractflow.operators.validate import CORRUPT, UNDECODED
from contractflow.plans import ENVELOPE, Contract, Domain, spark_type

RAW, RAW_BYTES, PAYLOAD = "raw_payload", "raw_payload_base64", "parsed_payload"


def keep_raw(df: DataFrame, keep_bytes: bool = False) -> DataFrame:
    """Keep the message as text; ``keep_bytes`` adds base64, for bytes that are not UTF-8."""
    kept = {RAW: F.col("value").cast("string")}
    if keep_bytes:
        kept[RAW_BYTES] = F.base64("value")
    return df.withColumns(kept)


def decode_json(df: DataFrame, schema: T.StructType, mark_corrupt: bool = True) -> DataFrame:
    """Add ``raw_payload`` and ``parsed_payload`` from a JSON ``value``.

    Text that does not fit the schema gives nulls; ``mark_corrupt`` also keeps that text inside
    the struct, so it can be told from a message whose fields are really null.
    """
    options = {"mode": "PERMISSIVE"}
    if mark_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options["columnNameOfCorruptRecord"] = CORRUPT
    return keep_raw(df).withColumn(PAYLOAD, F.from_json(F.col("value").cast("string"), schema, options))


def avro_column(value: Column, avro_schema: str, mode: str) -> Column:
    from pyspark.sql.avro.functions import from_avro

    return from_avro(value, avro_schema, {"mode": mode})


def decode_avro(df: DataFrame, avro_schema: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Add ``raw_payload`` and ``parsed_payload`` from bare Avro; needs the spark-avro package."""
    return keep_raw(df, keep_bytes=True).withColumn(PAYLOAD, avro_column(F.col("value"), avro_schema, mode))


def decode_contract(df: DataFrame, contract: Contract, avro_schema: str | None = None) -> DataFrame:
    """Decode messages the way the contract's format says."""
    if contract.format == "json":
        return decode_json(df, contract.schema())
    if contract.format == "avro":
        if avro_schema is None:
            raise ValueError(f"contract {contract.name!r} is in Avro: its writer schema is needed")
        return decode_avro(df, avro_schema)
    raise ValueError(f"unknown payload format {contract.format!r}")


def decode_framed(
    df: DataFrame,
    schema: T.StructType | str,
    check_magic: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """``kafka_key``, ``event`` and ``undecoded`` from framed messages.

    A schema text means Avro, a ``StructType`` means framed JSON. ``undecoded`` holds the whole value of a
    message without a frame or with a broken body, and is null for all others; a null value counts as empty.
    """
    body = frame_payload(F.col("value"), check_magic)
    broken = F.col("event").isNull()
    if isinstance(schema, str):
        event = avro_column(body, schema, mode)
    else:
        marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        event = F.from_json(body.cast("string"), marked, {"columnNameOfCorruptRecord": CORRUPT})
        broken = broken | F.col(f"event.{CORRUPT}").isNotNull()
    whole = F.coalesce("value", F.lit(b""))
    decoded = df.select(F.col("key").cast("string").alias("kafka_key"), "value", event.alias("event"))
    return decoded.select("kafka_key", "event", F.when(broken, whole).alias(UNDECODED))


def frame_report(df: DataFrame) -> DataFrame:
    """Messages per schema id, with unframed ones counted under a null id."""
    return df.groupBy(
        is_framed(F.col("value")).alias("framed"), frame_schema_id(F.col("value")).alias("schema_id")
    ).agg(F.count("*").alias("messages"), F.sum(F.length("value").cast("long")).alias("bytes"))


def event_schema(domain: Domain, flat: bool = False) -> T.StructType:
    """The event layout of a stream: payload nested in the envelope, or merged at its root."""
    payload = [T.StructField(name, spark_type(kind)) for name, kind in domain.columns.items()]
    if flat:
        head = [T.StructField(name, T.StringType()) for name in ("domain", "event_type", "event_id")]
        return T.StructType([*head, T.StructField("timestamp", T.LongType()), *payload])
    head = [T.StructField(name, T.StringType()) for name in ENVELOPE]
    return T.StructType([*head, T.StructField("payload", T.StructType(payload))])


def flatten_event(df: DataFrame, domain: Domain) -> DataFrame:
    """Envelope and payload columns side by side; a payload merged at the root works as well."""
    event = df.schema["event"].dataType
    nested = "payload" in event.fieldNames()
    payload = event["payload"].dataType if nested else event
    path = "event.payload" if nested else "event"

    def pick(struct: T.StructType, at: str, name: str, kind: str) -> Column:
        if name not in struct.fieldNames():
            return F.lit(None).cast(spark_type(kind)).alias(name)
        dtype, value = struct[name].dataType, F.col(f"{at}.{name}")
        return (unwrap(value, dtype)[0] if isinstance(dtype, T.StructType) else value).alias(name)

    return df.select(
        *[name for name in ("kafka_key", UNDECODED) if name in df.columns],
        *[pick(event, "event", name, "string") for name in ENVELOPE],
        *[pick(payload, path, name, kind) for name, kind in domain.columns.items()],
    )


def drift_fields(raw: Column, known: Sequence[str]) -> Column:
    """The JSON fields a contract does not know, as a map of texts."""
    return F.map_filter(F.from_json(raw, "map<string,string>"), lambda name, _: ~name.isin(*known))


def avro_writer_schema(contract: Contract, record: str = "Event") -> str:
    """An Avro schema text with the contract's fields, for streams without a published one."""
    # Avro names of the contract types.
    names = {"string": "string", "int": "int", "integer": "int", "long": "long", "float": "float",
             "double": "double", "boolean": "boolean", "bytes": "bytes",
             "timestamp": {"type": "long", "logicalType": "timestamp-micros"}}
    fields = [
        {"name": f.name, "type": ["null", names[f.type.lower()]], "default": None}
        if f.nullable
        else {"name": f.name, "type": names[f.type.lower()]}
        for f in contract.fields
    ]
    return json.dumps({"type": "record", "name": record, "fields": fields})
