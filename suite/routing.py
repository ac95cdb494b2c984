"""The split into certified and refused rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow import route, validate
from contractflow.operators import batch_counts, decode_json
from contractflow.operators.decode import PAYLOAD
from suite.alerts import TAGGED_SQL, tagged_alerts
from suite.mappings import event_messages
from suite.registry import AS_OF, query, reason_sql, table
from suite.rules import EVENT_VIOLATIONS, EVENTS, verdicts

EVENT_REASON = reason_sql("|", EVENT_VIOLATIONS)
BRONZE_SQL = (
    "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props, "
    "CAST(1706140800 AS BIGINT) AS ingested, '1.2.0' AS schema_version, 'json' AS source_format "
    f"FROM events WHERE {EVENT_REASON} = ''"
)
QUARANTINE_SQL = (
    "SELECT event_id AS raw_event_id, value AS raw_value, props AS raw_props, "
    "CAST(1706140800 AS BIGINT) AS ingested, '1.2.0' AS schema_version, 'json' AS source_format, "
    f"{EVENT_REASON} AS errors FROM events WHERE {EVENT_REASON} <> ''"
)


def tagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(table(spark, sf_dir, "events"))
    return validate(decode_json(messages, EVENTS.schema()), EVENTS, AS_OF, PAYLOAD)


def bronze_view(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "event_id",
        F.unix_micros("ts").alias("ts_us"),
        "user_id",
        "event_type",
        "value",
        "props",
        F.col("ingested_at").cast("long").alias("ingested"),
        "schema_version",
        "source_format",
    )


def quarantine_view(quarantine: DataFrame) -> DataFrame:
    raw = F.from_json("raw_payload", "event_id long, value double, props string")
    return quarantine.select(raw.alias("raw"), "*").select(
        F.col("raw.event_id").alias("raw_event_id"),
        F.col("raw.value").alias("raw_value"),
        F.col("raw.props").alias("raw_props"),
        F.col("ingested_at").cast("long").alias("ingested"),
        "schema_version",
        "source_format",
        F.array_join("validation_errors", "|").alias("errors"),
    )


@query(BRONZE_SQL)
def route_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certified rows: contract fields in order and the audit columns."""
    return bronze_view(route(tagged_events(spark, sf_dir), EVENTS, AS_OF)[0])


@query(QUARANTINE_SQL)
def route_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused rows: the message as received and the reasons."""
    return quarantine_view(route(tagged_events(spark, sf_dir), EVENTS, AS_OF)[1])


@query(
    f"SELECT count(*) AS total, CAST(count(*) FILTER ({EVENT_REASON} = '') AS BIGINT) AS valid, "
    f"CAST(count(*) FILTER ({EVENT_REASON} <> '') AS BIGINT) AS invalid FROM events"
)
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_counts(tagged_events(spark, sf_dir))


@query(f"SELECT event_id, defects, errors, errors = '' AS is_valid FROM {TAGGED_SQL}")
def contract_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five-rule alert contract over alerts with known defects."""
    tagged = tagged_alerts(spark, sf_dir).withColumn("defects", F.array_join("injected_defects", ","))
    return verdicts(tagged, ["event_id", "defects"])


