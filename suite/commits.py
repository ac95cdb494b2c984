"""Both tables of a contract at one version, while more is loaded, and closed days in fewer files."""

from __future__ import annotations

from datetime import date
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow import scratch
from contractflow.functions import instant
from contractflow.operators import route
from contractflow.plans import Contract, rule_from_text
from contractflow.sources import CommitLog, Tables, closed_days, live_files, provision, replace_load, snapshot, upgrade
from contractflow.streaming import start_contract_stream
from suite.mappings import event_messages, row_stream
from suite.registry import AS_OF, query, reason_sql
from suite.routing import EVENT_REASON, tagged_events
from suite.rules import EVENT_VIOLATIONS, EVENTS
from suite.tables import new_database

PARTS = 3


def event_tables(spark: SparkSession) -> tuple[Tables, CommitLog]:
    db = new_database(spark)
    tables = provision(spark, EVENTS, Tables(f"{db}.events", f"{db}.events_quarantine", EVENTS.partitioning))
    return tables, CommitLog(spark, scratch(spark, "commits"))


def both(good: DataFrame, bad: DataFrame) -> DataFrame:
    raw = F.get_json_object("raw_payload", "$.event_id").cast("long").alias("event_id")
    return good.select(F.lit("bronze").alias("side"), "event_id").unionAll(bad.select(F.lit("quarantine").alias("side"), raw))


@query(f"SELECT CASE WHEN {EVENT_REASON} = '' THEN 'bronze' ELSE 'quarantine' END AS side, event_id FROM events WHERE event_id % {PARTS} < 2")
def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three streams load a third of the events each; read as of the version after the second, with both sides at once.

    By then the third has been committed, and rows of a load that never was lie in the tables.
    """
    tables, log = event_tables(spark)
    version = 0
    for part in range(PARTS):
        messages = event_messages(row_stream(spark, sf_dir, "events")).where(F.pmod("offset", F.lit(PARTS)) == part)  # the event's id
        start_contract_stream(messages, EVENTS, tables, scratch(spark, "checkpoint"), trigger=None, as_of=instant(AS_OF), log=log).awaitTermination()
        if part == 1:
            version = log.latest()
    replace_load(snapshot(log, tables, version)[0], tables.bronze, "never committed", tables.partitioning, fresh=True)
    return both(*snapshot(log, tables, version))


@query(
    f"SELECT CASE WHEN {EVENT_REASON} = '' THEN 'bronze' ELSE 'quarantine' END AS side, count(*) AS n, "
    "CAST(sum(event_id) AS BIGINT) AS ids, true AS same_as_before, true AS few_files FROM events GROUP BY 1"
)
def compacted_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small loads of a day, packed into files by size: the same rows before and after, in files bounded by bytes."""
    tables, log = event_tables(spark)
    good, bad = route(tagged_events(spark, sf_dir), EVENTS, AS_OF)
    share = F.pmod(F.xxhash64(F.coalesce("raw_payload", F.lit(""))), F.lit(PARTS))
    for part in range(PARTS):
        log.load({"bronze": good.where(F.pmod(F.col("event_id"), F.lit(PARTS)) == part), "quarantine": bad.where(share == part)}, tables)
    loaded = log.latest()
    target = 8 << 20
    closed_days(log, tables, ("bronze", "quarantine"), date(2100, 1, 1), target)
    sides = {"bronze": F.col("event_id"), "quarantine": F.get_json_object("raw_payload", "$.event_id").cast("long")}
    out = []
    for i, (side, event_id) in enumerate(sides.items()):

        def figures(version: int | None, mark: str, i: int = i, event_id: Column = event_id) -> DataFrame:
            return snapshot(log, tables, version)[i].agg(F.count("*").alias(f"n{mark}"), F.sum(event_id).cast("long").alias(f"ids{mark}"))

        files = live_files(log, tables, side).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [figures(None, ""), figures(loaded, "_before"), files])
        row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
        same = (F.col("n") == F.col("n_before")) & F.col("ids").eqNullSafe(F.col("ids_before"))
        few = F.col("files") <= F.ceil(2 * F.col("bytes") / target) + 1
        out.append(row.where("n > 0").select(F.lit(side).alias("side"), "n", "ids", same.alias("same_as_before"), few.alias("few_files")))
    return out[0].unionAll(out[1])


def newer_events() -> Contract:
    """The events contract with a rule dropped, one changed and one added, in another order."""
    rules = {r.name: r for r in EVENTS.active_rules}
    changed = rule_from_text("value-cap", "value <= 90")
    added = rule_from_text("user-seven", "user_id != 7")
    return replace(EVENTS, version="2.0.0", rules=(added, rules["ts-not-future"], rules["valid-event-type"], changed, rules["props-two-digits"]))


_OLD = dict(zip([r.name for r in EVENTS.active_rules], EVENT_VIOLATIONS, strict=True))
NEWER = reason_sql(
    "|",
    [
        ("user_id = 7", "RANGE_VIOLATION [user-seven]: 'user_id' failed 'user_id != 7'"),
        _OLD["ts-not-future"],
        _OLD["valid-event-type"],
        ("value > 90", "RANGE_VIOLATION [value-cap]: 'value' failed 'value <= 90'"),
        _OLD["props-two-digits"],
    ],
)


@query(f"SELECT CASE WHEN {NEWER} = '' THEN 'bronze' ELSE 'quarantine' END AS side, event_id, user_id, epoch_us(ts) AS ts_us, event_type, value, props, {NEWER} AS errors FROM events")
def contract_upgraded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads judged by one version of a contract, brought to the next by its changed rules: as if judged from scratch."""
    tables, log = event_tables(spark)
    good, bad = route(tagged_events(spark, sf_dir), EVENTS, AS_OF)
    raw = F.from_json("raw_payload", EVENTS.schema())
    for part in range(PARTS):
        mine = F.pmod(F.col("event_id"), F.lit(PARTS)) == part
        theirs = F.pmod(raw["event_id"], F.lit(PARTS)) == part
        log.load({"bronze": good.where(mine), "quarantine": bad.where(theirs)}, tables)
    upgrade(log, tables, EVENTS, newer_events(), AS_OF)
    good, bad = snapshot(log, tables)
    columns = ["event_id", "user_id", F.unix_micros("ts").alias("ts_us"), "event_type", "value", "props"]
    certified = good.select(F.lit("bronze").alias("side"), *columns, F.lit("").alias("errors"))
    refused = bad.select(raw.alias("raw"), F.array_join("validation_errors", "|").alias("errors")).select("raw.*", "errors")
    return certified.unionAll(refused.select(F.lit("quarantine").alias("side"), *columns, "errors"))
