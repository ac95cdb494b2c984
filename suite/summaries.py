"""Merged summaries, heavy keys, availability, and duplicates on a stream, against exact counts in SQL."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow import scratch
from contractflow.operators import availability, metrics, summaries
from contractflow.streaming import flag_duplicates
from suite.registry import query, table

KEYS = ("event_id", "user_id", "props")
LOADED = datetime(2024, 3, 1)


def event_summaries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The events with the time they were loaded, and a summary of each of their loads, written as a table."""
    events = table(spark, sf_dir, "events").withColumns({"load": F.col("event_id") % 7, "loaded": F.lit(LOADED)})
    path = scratch(spark, "summaries")
    summaries.summarised(events, ["load"], KEYS, "loaded", "ts").write.parquet(path)
    return events, spark.read.parquet(path)


@query(
    " UNION ALL ".join(
        f"SELECT '{key}' AS key, count(*) AS records, count(DISTINCT {key}) + max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END) AS distinct_ids, true AS within_bound FROM events"
        for key in KEYS
    )
)
def uniqueness_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys from the merged sketches of all loads: within three standard deviations of the exact count."""
    events, held = event_summaries(spark, sf_dir)
    out = []
    for key in KEYS:
        exact = metrics.uniqueness(events, key).select("records", "distinct_ids")
        merged = summaries.uniqueness_merged(held, key).select(F.col("records").alias("merged_records"), F.col("distinct_ids").alias("estimate"))
        stacked = exact.unionByName(merged, allowMissingColumns=True)
        row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
        near = F.abs(F.col("estimate") - F.col("distinct_ids")) <= 3 * summaries.SKETCH_ERROR * F.col("distinct_ids") + 1
        out.append(row.select(F.lit(key).alias("key"), "records", "distinct_ids", (near & (F.col("records") == F.col("merged_records"))).alias("within_bound")))
    return reduce(DataFrame.unionAll, out)


RANKS = (0.5, 0.9, 0.99, 1.0)


@query("SELECT CAST(r AS DOUBLE) AS rank, count(ts) AS records, true AS within_bound FROM events, (VALUES (0.5), (0.9), (0.99), (1.0)) t(r) GROUP BY r")
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the lag from merged sketches: the exact ranks of what they say are within the stated error."""
    events, held = event_summaries(spark, sf_dir)
    said = {r["rank"]: r["seconds"] for r in summaries.latency_quantiles(held, RANKS).collect()}
    lag = F.col("loaded").cast("long") - F.col("ts").cast("timestamp").cast("long")
    lines = [F.struct(F.lit(r).alias("rank"), F.count_if(lag < said[r]).alias("below"), F.count_if(lag <= said[r]).alias("upto"), F.count(lag).alias("records")) for r in RANKS]
    counted = events.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))
    slack = summaries.RANK_ERROR * F.col("records") + 1
    within = (F.col("below") - slack <= F.col("rank") * F.col("records")) & (F.col("upto") + slack >= F.col("rank") * F.col("records"))
    return counted.select("rank", "records", within.alias("within_bound"))


@query("SELECT source, count(*) AS copies FROM documents GROUP BY source HAVING count(*) > 1 ORDER BY copies DESC, source LIMIT 10")
def heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources with most documents, from summaries of each task and an exact count of the likely ones."""
    return summaries.heavy_hitters(table(spark, sf_dir, "documents"), ["source"], 10)


@query("SELECT l_partkey, l_returnflag, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY copies DESC, l_partkey, l_returnflag LIMIT 10")
def heavy_hitters_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are about equally frequent: the summaries cannot tell them apart, so all are counted."""
    return summaries.heavy_hitters(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_returnflag"], 10)


LIMIT, FIRST, LAST = 3_600, datetime(2024, 1, 2), datetime(2024, 1, 28)


def availability_sql(by: str, start: str, end: str) -> str:
    """Gaps between the seconds of each group; with bounds, from the start and to the end as well."""
    name = by or "'all'"
    where = f"epoch(ts) BETWEEN {start} AND {end}" if start else "ts IS NOT NULL"
    low, high = (start, end) if start else ("min(sec) OVER (PARTITION BY name)", "max(sec) OVER (PARTITION BY name)")
    return f"""
  SELECT name, count(*) FILTER (gap > {LIMIT}) AS outages, CAST(coalesce(sum(gap) FILTER (gap > {LIMIT}), 0) AS BIGINT) AS down_seconds,
    max(high) - max(low) AS period_seconds
  FROM (
    SELECT name, sec, unnest([sec - coalesce(lag(sec) OVER w, {low}), CASE WHEN lead(sec) OVER w IS NULL THEN {high} - sec ELSE 0 END]) AS gap, {low} AS low, {high} AS high
    FROM (SELECT DISTINCT {name} AS name, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events WHERE {where}) WINDOW w AS (PARTITION BY name ORDER BY sec))
  GROUP BY name"""


_BOUNDS = tuple(str(int((x - datetime(1970, 1, 1)).total_seconds())) for x in (FIRST, LAST))


@query(
    "SELECT *, round(100 * (1 - CAST(down_seconds AS DOUBLE) / period_seconds), 3) AS availability_pct, "
    "round(100 * (1 - CAST(down_seconds AS DOUBLE) / period_seconds), 3) >= 99.9 AS pass FROM ("
    + " UNION ALL ".join([availability_sql("", "", ""), availability_sql("event_type", "", ""), availability_sql("'period ' || event_type", *_BOUNDS)])
    + ")"
)
def sla_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Availability of the whole stream and of each kind of event, over all time and over a stated period."""
    events = table(spark, sf_dir, "events")
    kinds = [
        availability.availability(events, "ts", LIMIT).withColumn("name", F.lit("all")),
        availability.availability(events, "ts", LIMIT, ["event_type"]).withColumnRenamed("event_type", "name"),
        availability.availability(events, "ts", LIMIT, ["event_type"], FIRST, LAST).withColumn("name", F.concat(F.lit("period "), "event_type")).drop("event_type"),
    ]
    whole = reduce(DataFrame.unionByName, kinds)
    return availability.availability_verdict(whole, 99.9).select("name", "outages", "down_seconds", "period_seconds", "availability_pct", "pass")


@query("SELECT user_id, event_type, count(*) AS n, count(*) - 1 AS duplicates FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY ALL")
def stream_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that may come once, over a stream that is stopped and started again twice: one row of each is the first."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    source, target, checkpoint = (scratch(spark, name) for name in ("arrivals", "flagged", "checkpoint"))
    for part in range(3):
        events.where(F.pmod(F.xxhash64("user_id", "event_type", "ts"), F.lit(3)) == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        flagged = flag_duplicates(stream, ["user_id", "event_type"], "ts", "365 days")
        writer = flagged.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(target)
    return rows.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.count_if("is_duplicate").alias("duplicates"))
