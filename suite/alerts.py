"""Alert events derived from the events table, with known defects written in.

The same rows are built in SQL for DuckDB. The clock lies after the last event, so the only
events in its future are the injected ones.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow import load_contract, validate
from contractflow.operators import certified, iso_text, quarantined
from contractflow.operators.defects import blank, duplicate_key, future_time, inject, unknown_value
from suite.registry import CONTRACTS, reason_sql, table

CONTRACT = load_contract(CONTRACTS / "sensor_alerts.yaml")
CLOCK = datetime(2024, 2, 1)
CLOCK_SECONDS = 1706745600

FIELDS = ["alert_id", "sensor_id", "machine_id", "severity", "alert_type", "event_time"]
BASE_SQL = (
    "(SELECT event_id, 'A' || event_id AS alert_id, 'S' || user_id AS sensor_id, 'M' || (user_id % 20) AS machine_id, "
    "CASE event_type WHEN 'click' THEN 'INFO' WHEN 'view' THEN 'WARNING' WHEN 'signup' THEN 'CRITICAL' "
    "ELSE 'EMERGENCY' END AS severity, "
    "CASE event_id % 5 WHEN 0 THEN 'OVERHEATING' WHEN 1 THEN 'EXCESSIVE_VIBRATION' WHEN 2 THEN 'POWER_FAILURE' "
    "WHEN 3 THEN 'COMMUNICATION_LOSS' ELSE 'THRESHOLD_EXCEEDED' END AS alert_type, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time FROM events)"
)


def bucket_sql(multiplier: int, offset: int) -> str:
    return f"(((event_id % 100) * {multiplier} + {offset}) % 100)"


BLANK = f"{bucket_sql(37, 11)} < 10"
FUTURE = f"{bucket_sql(53, 5)} < 10"
UNKNOWN = f"{bucket_sql(71, 3)} < 5"
DUPLICATE = "event_id % 100 >= 85"
INJECTED_SQL = (
    "(SELECT event_id, "
    f"CASE WHEN {DUPLICATE} THEN 'A' || (event_id - 15) ELSE alert_id END AS alert_id, "
    f"CASE WHEN {BLANK} THEN '' ELSE sensor_id END AS sensor_id, machine_id, "
    f"CASE WHEN {UNKNOWN} THEN CASE event_id % 3 WHEN 0 THEN 'BAD' WHEN 1 THEN 'UNKNOWN' ELSE 'ERROR' END "
    "ELSE severity END AS severity, alert_type, "
    f"CASE WHEN {FUTURE} THEN '2024-02-01T03:00:00.000000+00:00' ELSE event_time END AS event_time, "
    f"concat_ws(',', CASE WHEN {BLANK} THEN 'blank_sensor' END, CASE WHEN {FUTURE} THEN 'future_time' END, "
    f"CASE WHEN {UNKNOWN} THEN 'bad_severity' END, CASE WHEN {DUPLICATE} THEN 'duplicate_id' END) AS defects "
    f"FROM {BASE_SQL})"
)
VIOLATIONS = [
    (
        "severity IS NULL OR severity NOT IN ('INFO', 'WARNING', 'CRITICAL', 'EMERGENCY')",
        "ALLOWED_VALUES_VIOLATION [valid-severity]: 'severity' not in ['INFO', 'WARNING', 'CRITICAL', 'EMERGENCY']",
    ),
    (
        "alert_type IS NULL OR alert_type NOT IN ('OVERHEATING', 'EXCESSIVE_VIBRATION', 'POWER_FAILURE', "
        "'COMMUNICATION_LOSS', 'THRESHOLD_EXCEEDED')",
        "ALLOWED_VALUES_VIOLATION [valid-alert-type]: 'alert_type' not in ['OVERHEATING', 'EXCESSIVE_VIBRATION', "
        "'POWER_FAILURE', 'COMMUNICATION_LOSS', 'THRESHOLD_EXCEEDED']",
    ),
    (
        "sensor_id IS NULL OR trim(sensor_id) = ''",
        "NOT_EMPTY_VIOLATION [sensor-id-not-empty]: 'sensor_id' is null or empty",
    ),
    (
        "event_time IS NULL OR trim(event_time) = ''",
        "NOT_EMPTY_VIOLATION [event-time-not-empty]: 'event_time' is null or empty",
    ),
    (
        f"floor(epoch(TRY_CAST(event_time AS TIMESTAMP))) > {CLOCK_SECONDS}",
        "NOT_FUTURE_VIOLATION [event-time-not-future]: 'event_time' is in the future",
    ),
]
TAGGED_SQL = f"(SELECT *, {reason_sql('|', VIOLATIONS)} AS errors FROM {INJECTED_SQL})"
BRONZE_SQL = f"(SELECT * FROM {TAGGED_SQL} WHERE errors = '')"
QUARANTINE_SQL = f"(SELECT * FROM {TAGGED_SQL} WHERE errors <> '')"

DEFECTS = [
    blank("sensor_id", 10, "blank_sensor", multiplier=37, offset=11),
    future_time("event_time", 10, CLOCK, 3, "future_time", multiplier=53, offset=5),
    unknown_value("severity", 5, ["BAD", "UNKNOWN", "ERROR"], "bad_severity", multiplier=71, offset=3),
    duplicate_key("alert_id", 15, "duplicate_id", lambda key: F.concat(F.lit("A"), key.cast("string"))),
]


def base_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    event_type = F.col("event_type")
    severity = F.when(event_type == "click", "INFO").when(event_type == "view", "WARNING")
    severity = severity.when(event_type == "signup", "CRITICAL").otherwise("EMERGENCY")
    types = ["OVERHEATING", "EXCESSIVE_VIBRATION", "POWER_FAILURE", "COMMUNICATION_LOSS", "THRESHOLD_EXCEEDED"]

    def text(prefix: str, value: Column) -> Column:
        return F.concat(F.lit(prefix), value.cast("string"))

    return table(spark, sf_dir, "events").select(
        "event_id",
        text("A", F.col("event_id")).alias("alert_id"),
        text("S", F.col("user_id")).alias("sensor_id"),
        text("M", F.col("user_id") % 20).alias("machine_id"),
        severity.alias("severity"),
        F.get(F.array(*[F.lit(t) for t in types]), (F.col("event_id") % 5).cast("int")).alias("alert_type"),
        iso_text(F.col("ts").cast("timestamp")).alias("event_time"),
    )


def injected_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject(base_alerts(spark, sf_dir), "event_id", DEFECTS)


def tagged_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(injected_alerts(spark, sf_dir), CONTRACT, CLOCK)


def alert_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bronze and quarantine rows of the injected alerts."""
    tagged = tagged_alerts(spark, sf_dir)
    raw = tagged.withColumn("raw_payload", F.to_json(F.struct(*FIELDS)))
    return certified(tagged, CONTRACT, CLOCK, payload=None), quarantined(raw, CONTRACT, CLOCK)
