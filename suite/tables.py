"""Tables: provisioning, loads, widening, retention."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow import pin, scratch
from contractflow.sources import Tables, append, drop_expired, provision, retained, rewrite_promoted, table_ddl, widen
from suite.alerts import BRONZE_SQL, CLOCK_SECONDS, CONTRACT, QUARANTINE_SQL, alert_tables
from suite.registry import query, table


def new_database(spark: SparkSession) -> str:
    """A database of its own in the shared scratch folder."""
    name = f"cf_{uuid.uuid4().hex}"
    pin(spark).sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark, name)}'")
    return name


_AUDIT_SQL = f"CAST({CLOCK_SECONDS} AS BIGINT) AS ingested, '{CONTRACT.version}' AS schema_version, '{CONTRACT.format}' AS source_format, '2024-02-01' AS day"
_FIELDS = list(CONTRACT.field_names)


@query(
    f"SELECT 'bronze' AS side, {', '.join(_FIELDS)}, '' AS errors, {_AUDIT_SQL} FROM {BRONZE_SQL} "
    f"UNION ALL SELECT 'quarantine', {', '.join(_FIELDS)}, errors, {_AUDIT_SQL} FROM {QUARANTINE_SQL}"
)
def provision_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables of the alert contract created from it, loaded, and read back value by value."""
    db = new_database(spark)
    tables = provision(spark, CONTRACT, Tables(f"{db}.alerts", f"{db}.alerts_quarantine", CONTRACT.partitioning))
    bronze, quarantine = alert_tables(spark, sf_dir)
    append(bronze, tables.bronze, tables.partitioning)
    append(quarantine, tables.quarantine, tables.quarantine_partitioning)
    stamps = [F.col("ingested_at").cast("long").alias("ingested"), "schema_version", "source_format", F.col("ingested_at_date").cast("string").alias("day")]
    good = spark.table(tables.bronze).select(F.lit("bronze").alias("side"), *_FIELDS, F.lit("").alias("errors"), *stamps)
    raw = F.from_json("raw_payload", ", ".join(f"{name} string" for name in _FIELDS)).alias("raw")
    bad = spark.table(tables.quarantine).select("*", raw).select(
        F.lit("quarantine").alias("side"), *[F.col(f"raw.{name}").alias(name) for name in _FIELDS], F.array_join("validation_errors", "|").alias("errors"), *stamps
    )
    return good.unionAll(bad)


@query(
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' - INTERVAL 90 DAYS"
)
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows still inside ninety days before the clock."""
    orders = table(spark, sf_dir, "orders")
    return retained(orders, datetime(1999, 1, 1), 90, "o_orderdate").select("o_orderkey", "o_custkey")


_DAILY = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ingested_at", T.TimestampType())])


@query("SELECT event_id, CAST(ts AS DATE)::VARCHAR AS day FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15'")
def retention_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole days before the period dropped from a partitioned table."""
    name = f"{new_database(spark)}.daily"
    spark.sql(table_ddl(name, _DAILY, ["days(ingested_at)"]))
    events = table(spark, sf_dir, "events")
    append(events.select("event_id", F.col("ts").cast("timestamp").alias("ingested_at")), name, ["days(ingested_at)"])
    drop_expired(spark, name, datetime(2024, 1, 25), 10)
    return spark.table(name).select("event_id", F.col("ingested_at_date").cast("string").alias("day"))


@query(
    "SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer "
    "UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer"
)
def schema_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with a new column widens the table; earlier rows read null there."""
    customer = table(spark, sf_dir, "customer")
    old, new = customer.select("c_custkey", "c_name"), customer.select("c_custkey", "c_name", "c_acctbal")
    name = f"{new_database(spark)}.customers"
    spark.sql(table_ddl(name, old.schema))
    append(old, name)
    widen(spark, name, new.schema)
    append(new, name)
    return spark.table(name).select("c_custkey", "c_name", "c_acctbal")


@query(
    "SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END AS value, event_type, "
    "CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS kept, CASE WHEN event_id % 2 = 1 THEN props END AS props FROM events"
)
def schema_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations of a table, the older with narrower types and a map of unknown fields, rewritten under their common schema."""
    events, db = table(spark, sf_dir, "events"), new_database(spark)
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    even = events.where("event_id % 2 = 0").select(
        F.col("event_id").cast("int").alias("event_id"), F.col("user_id").cast("int").alias("user_id"), F.col("value").cast("float").alias("value"), F.create_map(F.lit("event_type"), kind, F.lit("kept"), user).alias("unknown_fields")
    )
    odd = events.where("event_id % 2 = 1").select("event_id", F.col("user_id").cast("long").alias("user_id"), "value", "event_type", "props")
    for name, rows in (("first", even), ("second", odd)):
        spark.sql(table_ddl(f"{db}.{name}", rows.schema))
        append(rows, f"{db}.{name}")
    rewrite_promoted(spark, [f"{db}.first", f"{db}.second"], f"{db}.both")
    return spark.table(f"{db}.both").select("event_id", "user_id", "value", "event_type", F.col("unknown_fields")["kept"].alias("kept"), "props")
