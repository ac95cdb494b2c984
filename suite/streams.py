"""Streams run to the end of their input, compared with the same work done as a batch."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contractflow import scratch
from contractflow.functions import instant
from contractflow.operators import event_schema
from contractflow.plans import DOMAINS, Contract
from contractflow.sources import Tables, file_sink, open_topics, provision
from contractflow.streaming import provision_stats, start_contract_stream, start_domain_streams
from suite.domains import outcome_sql
from suite.mappings import domain_message_stream, event_messages, row_stream
from suite.registry import AS_OF, query, reason_sql
from suite.routing import BRONZE_SQL, EVENT_REASON, QUARANTINE_SQL, bronze_view, quarantine_view
from suite.rules import EVENT_VIOLATIONS, EVENTS
from suite.tables import new_database


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_messages(row_stream(spark, sf_dir, "events"))


def run_contract(spark: SparkSession, sf_dir: str) -> tuple[Tables, str]:
    """The events contract over the table as a stream, until nothing is left."""
    db = new_database(spark)
    tables = provision(spark, EVENTS, Tables(f"{db}.events", f"{db}.events_quarantine", EVENTS.partitioning))
    stats = provision_stats(spark, f"{db}.batch_stats")
    start_contract_stream(
        event_stream(spark, sf_dir),
        EVENTS,
        tables,
        scratch(spark, "checkpoint"),
        stats,
        trigger=None,
        as_of=instant(AS_OF),
    ).awaitTermination()
    return tables, stats


@query(BRONZE_SQL)
def stream_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_view(spark.table(run_contract(spark, sf_dir)[0].bronze))


@query(QUARANTINE_SQL)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_view(spark.table(run_contract(spark, sf_dir)[0].quarantine))


@query(
    f"SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS total, count(*) FILTER ({EVENT_REASON} = '') AS valid, "
    f"count(*) FILTER ({EVENT_REASON} <> '') AS invalid, true AS timed FROM events"
)
def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = spark.table(run_contract(spark, sf_dir)[1])
    return stats.select("batch_id", "total", "valid", "invalid", (F.col("duration_seconds") > 0).alias("timed"))


@query(
    f"SELECT 'bronze' AS side, count(*) AS n, count(DISTINCT event_id) AS events FROM events WHERE {EVENT_REASON} = '' "
    f"UNION ALL SELECT 'quarantine', count(*), count(DISTINCT event_id) FROM events WHERE {EVENT_REASON} <> ''"
)
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crash between the two writes, then a restart: every row is there once.

    The first run has no quarantine table, so it fails after bronze has been written.
    """
    db = new_database(spark)
    tables = Tables(f"{db}.events", f"{db}.events_quarantine", EVENTS.partitioning)
    provision(spark, EVENTS, tables)
    spark.sql(f"DROP TABLE {tables.quarantine}")
    checkpoint = scratch(spark, "checkpoint")

    def run() -> None:
        stream = event_stream(spark, sf_dir)
        start_contract_stream(
            stream, EVENTS, tables, checkpoint, trigger=None, as_of=instant(AS_OF)
        ).awaitTermination()

    try:
        run()
    except StreamingQueryException:
        if spark.table(tables.bronze).isEmpty():
            raise
    else:
        raise RuntimeError("the first run was expected to fail after its first write")
    provision(spark, EVENTS, tables)
    run()
    spark.catalog.refreshTable(tables.bronze)  # read above, rewritten since by the stream's session
    event_id = F.get_json_object("raw_payload", "$.event_id")
    sides = {"bronze": (tables.bronze, F.col("event_id")), "quarantine": (tables.quarantine, event_id)}
    frames = [
        spark.table(name).agg(
            F.lit(side).alias("side"), F.count("*").alias("n"), F.count_distinct(key).alias("events")
        )
        for side, (name, key) in sides.items()
    ]
    return frames[0].unionAll(frames[1])


def run_domains(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """Some of the nine streams at once, into one folder per topic and stream."""
    target = scratch(spark, "topics")

    def sink(messages: DataFrame, name: str) -> StreamingQuery:
        return file_sink(messages, f"{target}/stream={name}", scratch(spark, "checkpoint"), trigger=None)

    sources = {name: domain_message_stream(spark, sf_dir, name) for name in names}
    schemas = {name: event_schema(DOMAINS[name]) for name in names}
    with open_topics(spark):
        for running in start_domain_streams(sources, schemas, sink, instant(AS_OF)):
            running.awaitTermination()
    return target


@query(outcome_sql("sensors.readings"))
def stream_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings from framed bytes to their two topics in one query."""
    target = run_domains(spark, sf_dir, ["sensors.readings"])
    routed = spark.read.parquet(f"{target}/stream=sensors.readings")
    body = F.from_json("value", "event_id string, error_reason string")
    return routed.select("key", "topic", body.alias("body")).select("key", "topic", "body.event_id", "body.error_reason")


@query(" UNION ALL ".join(outcome_sql(name) for name in DOMAINS))
def stream_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine streams at once: nine queries, eighteen topics, compared row by row."""
    target = run_domains(spark, sf_dir, list(DOMAINS))
    body = F.from_json("value", "event_id string, error_reason string")
    parts = []
    for name in DOMAINS:
        routed = spark.read.parquet(f"{target}/stream={name}").select("key", "topic", body.alias("body"))
        parts.append(routed.select("body.event_id", F.coalesce("body.error_reason", F.lit("")).alias("error_reason"), "key", "topic"))
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionAll(part)
    return everything


def small_contract(db: str, fields: int) -> Contract:
    """The events contract as it was when it knew only its first fields."""
    known = EVENTS.fields[:fields]
    names = {f.name for f in known}
    rules = tuple(r for r in EVENTS.rules if r.field in names)
    return replace(EVENTS, fields=known, rules=rules, table=f"{db}.events", quarantine_table=f"{db}.events_quarantine")


def _passed_sql(fields: int) -> str:
    """The rules on the first fields, as SQL on the events."""
    names = {f.name for f in EVENTS.fields[:fields]}
    conditions = [v for r, v in zip(EVENTS.active_rules, EVENT_VIOLATIONS, strict=True) if r.field in names]
    return f"{reason_sql('|', conditions)} = ''"


_OLD_FIELDS = 4


@query(
    f"SELECT event_id, 1 AS version, CAST(NULL AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS props FROM events WHERE {_passed_sql(_OLD_FIELDS)} "
    f"UNION ALL SELECT event_id, 2, value, props FROM events WHERE {EVENT_REASON} = ''"
)
def stream_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a contract, the second with more fields, stream into one table: no value is lost."""
    db = new_database(spark)
    for version, fields in ((1, _OLD_FIELDS), (2, len(EVENTS.fields))):
        contract = replace(small_contract(db, fields), version=str(version))
        tables = Tables(contract.table, contract.quarantine_table, contract.partitioning)
        if version == 1:
            provision(spark, contract, tables)  # the second version meets the table as the first left it
        start_contract_stream(event_stream(spark, sf_dir), contract, tables, scratch(spark, "checkpoint"), trigger=None, as_of=instant(AS_OF)).awaitTermination()
    spark.catalog.refreshTable(tables.bronze)
    return spark.table(tables.bronze).select("event_id", F.col("schema_version").cast("int").alias("version"), "value", "props")


@query(
    "SELECT event_id, CASE WHEN props IS NULL THEN 'value' ELSE 'props,value' END AS unknown, props FROM events "
    f"WHERE {_passed_sql(_OLD_FIELDS)} AND value IS NOT NULL"
)
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that messages carry and the contract does not know are stored as a map."""
    db = new_database(spark)
    contract = small_contract(db, _OLD_FIELDS)
    tables = provision(spark, contract, Tables(contract.table, contract.quarantine_table, contract.partitioning, drift=True))
    start_contract_stream(event_stream(spark, sf_dir), contract, tables, scratch(spark, "checkpoint"), trigger=None, as_of=instant(AS_OF)).awaitTermination()
    unknown = F.array_join(F.sort_array(F.map_keys("unknown_fields")), ",").alias("unknown")
    return spark.table(tables.bronze).select("event_id", unknown, F.col("unknown_fields")["props"].alias("props"))
