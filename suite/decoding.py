"""Frames, JSON payloads, envelopes, keys and schema fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow import compile_rules, validate
from contractflow.functions import frame, frame_payload, frame_schema_id, is_framed
from contractflow.operators import (
    conformance_error,
    decode_framed,
    decode_json,
    drift_fields,
    event_schema,
    fallback_key,
    flatten_event,
    frame_report,
    keep_raw,
    merge_event,
    split_conforming,
    wrap_event,
)
from contractflow.operators.decode import PAYLOAD
from contractflow.operators.schemas import ReaderField, decode_by_schema
from contractflow.plans import DOMAINS, rule_from_text
from contractflow.sources import as_messages
from suite.domains import decoded_events
from suite.mappings import event_messages, events_sql, flat_events
from suite.registry import AS_OF, query, reason_sql, table
from suite.rules import EVENT_VIOLATIONS, EVENTS, verdict_sql, verdicts


@query("SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events")
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages decoded with the contract's schema."""
    decoded = decode_json(event_messages(table(spark, sf_dir, "events")), EVENTS.schema())
    return decoded.select(
        "parsed_payload.event_id",
        F.unix_micros("parsed_payload.ts").alias("ts_us"),
        "parsed_payload.user_id",
        "parsed_payload.event_type",
        "parsed_payload.value",
        "parsed_payload.props",
    )


_BROKEN = "event_id % 10 = 4"
_NULL = "event_id % 10 = 5"


@query(
    f"SELECT event_id, CASE WHEN {_BROKEN} OR {_NULL} THEN NULL ELSE event_type END AS event_type, "
    f"CASE WHEN {_BROKEN} OR {_NULL} THEN 'DECODE_VIOLATION [decode]: payload could not be decoded|"
    "ALLOWED_VALUES_VIOLATION [valid-event-type]: ''event_type'' not in "
    "[''click'', ''view'', ''purchase'', ''signup'']' "
    f"ELSE {reason_sql('|', EVENT_VIOLATIONS)} END AS errors FROM events"
)
def decode_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut-off JSON and empty messages are violations of their own, not rows of nulls."""
    messages = event_messages(table(spark, sf_dir, "events"))
    cut = F.substring(F.col("value"), F.lit(1), F.length("value") - 1)
    messages = messages.withColumn(
        "value", F.when(F.col("offset") % 10 == 4, cut).when(F.col("offset") % 10 != 5, F.col("value"))
    )
    tagged = validate(decode_json(messages, EVENTS.schema()), EVENTS, AS_OF, PAYLOAD)
    return verdicts(
        tagged.select(
            F.col("offset").alias("event_id"), "parsed_payload.event_type", "validation_errors", "is_valid"
        ),
        ["event_id", "event_type"],
    ).drop("is_valid")


@query("SELECT event_id, 'k' AS drifted, regexp_extract(props, '([0-9]+)', 1) AS k FROM events")
def drift_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields the contract does not know, kept as a map."""
    merged = F.concat(
        F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "user_id": 1, '), F.expr("substring(props, 2)")
    )
    df = table(spark, sf_dir, "events").select("event_id", drift_fields(merged, EVENTS.field_names).alias("drift"))
    return df.select("event_id", F.array_join(F.map_keys("drift"), ",").alias("drifted"), F.col("drift")["k"].alias("k"))


@query("SELECT doc_id, text AS raw_payload, base64(encode(text)) AS raw_payload_base64 FROM documents")
def raw_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole messages kept as text and as base64."""
    messages = table(spark, sf_dir, "documents").withColumn("value", F.col("text").cast("binary"))
    return keep_raw(messages, keep_bytes=True).select(
        "doc_id", "raw_payload", F.regexp_replace("raw_payload_base64", "\\s", "").alias("raw_payload_base64")
    )


@query(
    "SELECT event_id, CASE WHEN event_id % 3 = 0 OR event_id % 3 = 1 THEN 'E' || event_id ELSE 'U' || user_id END AS key "
    "FROM events"
)
def key_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty business ids fall back to the event id."""
    business = F.when(F.col("event_id") % 3 == 1, F.lit("")).when(
        F.col("event_id") % 3 == 2, F.concat(F.lit("U"), F.col("user_id").cast("string"))
    )
    event = F.concat(F.lit("E"), F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", fallback_key(business, event).alias("key"))


@query(f"SELECT * FROM {events_sql('logistics.shipments')}")
def envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrapped, framed, decoded and flattened again: nothing is lost."""
    return decoded_events(spark, sf_dir, "logistics.shipments").drop("kafka_key", "undecoded")


@query(f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS produced_at) FROM {events_sql('sales.transactions')}")
def envelope_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant whose payload is merged at the root is flattened by the same operator."""
    domain = DOMAINS["sales.transactions"]
    flat = flat_events(spark, sf_dir, domain.name)
    merged = merge_event(flat, "sales", "transactions_event", AS_OF, list(domain.columns), F.col("event_id"))
    messages = as_messages(
        merged,
        F.col("event.event_id"),
        frame(F.to_json("event"), F.lit(3)),
        domain.bronze_topic,
        F.lit(0),
        F.lit(AS_OF),
    )
    return flatten_event(decode_framed(messages, event_schema(domain, flat=True)), domain).drop("kafka_key", "undecoded")


@query(
    "SELECT 'E' || event_id AS event_id, 'web' AS domain, 'seen' AS event_type, "
    "'2024-01-25T00:00:00.000000+00:00' AS produced_at, CAST(1706140800 AS BIGINT) AS epoch_s, user_id, value FROM events"
)
def envelope_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both envelope forms over the same rows."""
    df = table(spark, sf_dir, "events")
    event_id = F.concat(F.lit("E"), F.col("event_id").cast("string"))
    nested = wrap_event(df, "web", "seen", AS_OF, ["user_id", "value"], event_id).withColumnRenamed("event", "nested")
    both = merge_event(nested, "web", "seen", AS_OF, ["user_id", "value"], event_id)
    return both.select(
        "nested.event_id",
        "event.domain",
        "nested.event_type",
        "nested.produced_at",
        F.col("event.timestamp").alias("epoch_s"),
        "nested.payload.user_id",
        "event.value",
    )


# Framed with the user's id, but every tenth value has another first byte and some are too short.
_FRAME_CASE = "CASE WHEN event_id % 10 = 9 THEN 'other' WHEN event_id % 10 = 8 THEN 'short' ELSE 'framed' END"


def mixed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = frame(F.col("props"), F.col("user_id") + 70000)
    value = (
        F.when(F.col("event_id") % 10 == 9, F.concat(F.lit(b"{"), framed))
        .when(F.col("event_id") % 10 == 8, F.lit(b"\x00\x01"))
        .otherwise(framed)
    )
    return table(spark, sf_dir, "events").select("event_id", F.lit(b"k").alias("key"), value.alias("value"))


@query(
    f"SELECT event_id, {_FRAME_CASE} = 'framed' AS framed, "
    f"CASE WHEN {_FRAME_CASE} = 'framed' THEN user_id + 70000 END AS schema_id, "
    f"CASE WHEN {_FRAME_CASE} = 'framed' THEN props END AS payload FROM events"
)
def frame_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header split from payload; values without a frame give nulls."""
    value = F.col("value")
    return mixed_frames(spark, sf_dir).select(
        "event_id",
        is_framed(value).alias("framed"),
        frame_schema_id(value).alias("schema_id"),
        frame_payload(value).cast("string").alias("payload"),
    )


@query(
    "SELECT framed, schema_id, count(*) AS messages, CAST(sum(size) AS BIGINT) AS bytes FROM ("
    f"SELECT {_FRAME_CASE} = 'framed' AS framed, CASE WHEN {_FRAME_CASE} = 'framed' THEN user_id + 70000 END AS schema_id, "
    f"CASE {_FRAME_CASE} WHEN 'framed' THEN strlen(props) + 5 WHEN 'other' THEN strlen(props) + 6 ELSE 2 END AS size "
    "FROM events) GROUP BY framed, schema_id"
)
def frame_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and bytes per schema id."""
    return frame_report(mixed_frames(spark, sf_dir))


@query(
    verdict_sql(
        "events",
        "event_id",
        [
            (
                "event_type NOT IN ('click', 'view')",
                "ALLOWED_VALUES_VIOLATION [kind]: 'kind' not in ['click', 'view']",
            ),
            ("user_id > 100", "RANGE_VIOLATION [low]: 'size' failed 'size <= 100'"),
        ],
    )
)
def union_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union members of either shape are unwrapped before a rule sees them."""
    even = F.col("event_id") % 2 == 0
    payload = F.struct(
        F.struct(F.col("event_type").alias("member")).alias("kind"),
        F.struct(F.when(even, F.col("user_id")).alias("member0"), F.when(~even, F.col("user_id")).alias("member1")).alias(
            "size"
        ),
    )
    df = table(spark, sf_dir, "events").select("event_id", payload.alias("parsed_payload"))
    rules = [rule_from_text("kind", "kind in ['click','view']"), rule_from_text("low", "size <= 100")]
    return verdicts(compile_rules(rules, df.schema, AS_OF, "parsed_payload").tag(df), ["event_id"])


ALERT_SCHEMA = {
    "type": "record",
    "name": "Alert",
    "fields": [
        {"name": "alert_id", "type": ["null", "string"], "default": None},
        {"name": "sensor_id", "type": "string"},
        {"name": "machine_id", "type": ["null", "string"], "default": None},
        {
            "name": "severity",
            "type": {"type": "enum", "name": "Severity", "symbols": ["LOW", "MEDIUM", "HIGH", "CRITICAL"]},
        },
        {"name": "level", "type": "int"},
    ],
}
_WRITTEN = (
    "(SELECT event_id, alert_id, sensor_id, machine_id, severity, "
    "CAST(CASE WHEN event_id % 11 = 0 THEN 1.5 ELSE 2 END AS DOUBLE) AS level "
    f"FROM {events_sql('sensors.alerts')})"
)
_MISFIT = (
    "CASE WHEN sensor_id IS NULL THEN 'MissingField' WHEN severity = 'EMERGENCY' THEN 'UnknownSymbol' "
    "WHEN level = 1.5 THEN 'WrongType' END"
)


def _written_alerts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    flat = flat_events(spark, sf_dir, "sensors.alerts")
    level = F.when(F.expr("substring(event_id, 2)").cast("long") % 11 == 0, 1.5).otherwise(2.0)
    df = flat.select("event_id", "alert_id", "sensor_id", "machine_id", "severity", level.alias("level"))
    return split_conforming(df, ALERT_SCHEMA, "bronze.sensors.alerts", "producer_avro_serialization")


@query(
    f"SELECT event_id, alert_id, sensor_id, severity, level FROM {_WRITTEN} WHERE {_MISFIT} IS NULL".replace(
        "event_id % 11", "CAST(substr(event_id, 2) AS BIGINT) % 11"
    )
)
def conformance_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the writer schema accepts."""
    fits, _ = _written_alerts(spark, sf_dir)
    return fits.drop("machine_id")


@query(
    (
        "SELECT 'producer_avro_serialization' AS error_stage, error_type, "
        "CASE error_type WHEN 'MissingField' THEN 'sensor_id is required' WHEN 'WrongType' THEN 'level is not a int' "
        "ELSE 'severity is not one of [''LOW'', ''MEDIUM'', ''HIGH'', ''CRITICAL'']' END AS error_message, "
        "'bronze.sensors.alerts' AS target_topic, event_id, severity FROM "
        f"(SELECT *, {_MISFIT} AS error_type FROM {_WRITTEN}) WHERE error_type IS NOT NULL"
    ).replace("event_id % 11", "CAST(substr(event_id, 2) AS BIGINT) % 11")
)
def conformance_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows it refuses, with stage, kind, message, topic and the event as JSON."""
    _, errors = _written_alerts(spark, sf_dir)
    return errors.select(
        "error_stage",
        "error_type",
        "error_message",
        "target_topic",
        F.get_json_object("failed_event", "$.event_id").alias("event_id"),
        F.get_json_object("failed_event", "$.severity").alias("severity"),
    )


def _refused_fields(schema: dict, df: DataFrame, key: str) -> DataFrame:
    error = conformance_error(schema, df.schema)
    return df.select(key, error["error_type"].alias("error_type"), error["error_message"].alias("error_message"))


def _record(**fields: object) -> dict:
    return {"type": "record", "name": "Row", "fields": [{"name": n, "type": t} for n, t in fields.items()]}


_MICROS = {"type": "long", "logicalType": "timestamp-micros"}


@query("SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'MissingField' END AS error_type, CASE WHEN event_id % 9 = 0 THEN 'at is required' END AS error_message FROM events")
def conformance_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times and dates fit their logical types, in plain fields and in unions with null."""
    at = F.col("ts").cast("timestamp")
    df = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 9 != 0, at).alias("at"), at.alias("seen"), F.to_date(at).alias("day"))
    schema = _record(event_id="long", at=_MICROS, seen=["null", _MICROS], day={"type": "int", "logicalType": "date"})
    return _refused_fields(schema, df, "event_id")


@query(
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> floor(l_discount) THEN 'WrongType' WHEN l_orderkey > 2000 THEN 'WrongType' END AS error_type, "
    "CASE WHEN l_discount <> floor(l_discount) THEN 'l_discount is not a int' WHEN l_orderkey > 2000 THEN 'big is not a int' END AS error_message FROM lineitem"
)
def conformance_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that would be rounded or cut off do not fit a whole type; whole ones do."""
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_quantity", (F.col("l_orderkey") + (2**31 - 2001)).alias("big"))
    schema = _record(l_orderkey="long", l_linenumber="int", l_discount="int", l_quantity="double", big="int")
    error = conformance_error(schema, df.schema)
    return df.select("l_orderkey", "l_linenumber", error["error_type"].alias("error_type"), error["error_message"].alias("error_message"))


@query(
    "SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'WrongType' WHEN props IS NOT NULL THEN 'WrongType' END AS error_type, "
    "CASE WHEN event_type IN ('error', 'signup') THEN 'event_type is none of one of [''click'', ''view''], one of [''purchase'']' "
    "WHEN props IS NOT NULL THEN 'props is none of long, double' END AS error_message FROM events"
)
def conformance_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value of a union needs one branch that fits; text fits no number."""
    names = [{"type": "enum", "name": "Seen", "symbols": ["click", "view"]}, {"type": "enum", "name": "Done", "symbols": ["purchase"]}]
    schema = _record(event_id=["null", "long", "string"], event_type=["null", *names], value=["null", "long", "double"], props=["null", "long", "double"])
    return _refused_fields(schema, table(spark, sf_dir, "events").drop("ts", "user_id"), "event_id")


def _columns(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


WRITERS = {
    7: _columns(id=T.IntegerType(), user=T.IntegerType(), kind=T.StringType()),
    8: _columns(event_id=T.LongType(), user_id=T.LongType(), event_type=T.StringType(), value=T.FloatType()),
    70000: _columns(event_id=T.LongType(), user_id=T.LongType(), event_type=T.StringType(), value=T.DoubleType(), note=T.StringType()),
}
READER = (
    ReaderField("event_id", T.LongType(), ("id",), required=True),
    ReaderField("user_id", T.LongType(), ("uid", "user")),
    ReaderField("event_type", T.StringType(), ("kind",)),
    ReaderField("value", T.DoubleType(), default=-1.0),
)


@query(
    "SELECT event_id AS at, CASE event_id % 5 WHEN 0 THEN 7 WHEN 1 THEN 8 WHEN 2 THEN CAST(70000 AS BIGINT) WHEN 3 THEN 9 END AS schema_id, "
    "CASE WHEN event_id % 5 < 3 THEN event_id END AS event_id, CASE WHEN event_id % 5 < 3 THEN user_id END AS user_id, "
    "CASE WHEN event_id % 5 < 3 THEN event_type END AS event_type, "
    "CASE event_id % 5 WHEN 0 THEN -1 WHEN 1 THEN CAST(CAST(floor(value) AS FLOAT) AS DOUBLE) WHEN 2 THEN value END AS value, "
    "event_id % 5 >= 3 AS undecoded FROM events"
)
def frames_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three schemas in one topic, read under one; an unknown id and a message without a frame stay as they came."""
    events = table(spark, sf_dir, "events")
    case = F.col("event_id") % 5
    first = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("user"), F.col("event_type").alias("kind")))
    second = F.to_json(F.struct("event_id", "user_id", "event_type", F.floor("value").alias("value")))
    third = F.to_json(F.struct("event_id", "user_id", "event_type", "value", F.lit("not read").alias("note")))
    body = F.when(case == 0, first).when(case == 1, second).otherwise(third)
    number = F.when(case == 0, 7).when(case == 1, 8).when(case == 2, 70000).otherwise(9)
    value = F.when(case < 4, frame(body, number)).otherwise(F.lit("{}").cast("binary"))
    messages = events.select(F.col("event_id").cast("string").cast("binary").alias("key"), value.alias("value"))
    decoded = decode_by_schema(messages, WRITERS, READER)
    return decoded.select(F.col("kafka_key").cast("long").alias("at"), "schema_id", "event.*", F.col("undecoded").isNotNull().alias("undecoded"))
