"""Defect injection, one query per defect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow.operators.defects import (
    Defect,
    blank,
    constant,
    future_time,
    inject,
    inject_duplicates,
    null_out,
    unknown_value,
    whitespace,
)
from contractflow.operators.project import iso_text
from suite.alerts import CLOCK, CONTRACT, INJECTED_SQL, injected_alerts
from suite.mappings import events_sql, flat_events
from suite.registry import query, table


def _bucket(key: str, multiplier: int = 1, offset: int = 0) -> str:
    return f"((({key} % 100) * {multiplier} + {offset}) % 100)"


def _defect_query(name: str, source: str, key: str, columns: str, hit: str, bad: str, defect: Defect) -> None:
    """One defect on one column of a table: the new column and the ground truth."""
    kept = "" if defect.column == key else f"{key}, "
    changed = f"CASE WHEN {hit} THEN {bad} ELSE {defect.column} END AS {defect.column}"

    @query(
        f"SELECT {kept}{columns}{changed}, CASE WHEN {hit} THEN '{defect.name}' ELSE '' END AS defects FROM {source}",
        name,
    )
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = inject(table(spark, sf_dir, source), key, [defect])
        return df.withColumn("defects", F.array_join("injected_defects", ",")).selectExpr(
            *[c.strip() for c in f"{kept}{columns}{defect.column}, defects".split(",")]
        )


_defect_query(
    "inject_blank", "customer", "c_custkey", "", f"{_bucket('c_custkey', 37, 11)} < 10", "''",
    blank("c_name", 10, multiplier=37, offset=11),
)
_defect_query(
    "inject_unknown", "events", "event_id", "user_id, ", f"{_bucket('event_id', 71, 3)} < 5",
    "CASE event_id % 3 WHEN 0 THEN 'BAD' WHEN 1 THEN 'UNKNOWN' ELSE 'ERROR' END",
    unknown_value("event_type", 5, ["BAD", "UNKNOWN", "ERROR"], multiplier=71, offset=3),
)
_defect_query(
    "inject_negative", "orders", "o_orderkey", "o_custkey, ", f"{_bucket('o_orderkey', 53, 5)} < 20",
    "CAST(-50 AS DOUBLE)", constant("o_totalprice", 20, -50.0, "negative", multiplier=53, offset=5),
)
_defect_query(
    "inject_null", "customer", "c_custkey", "", f"{_bucket('c_custkey', 3, 50)} < 20", "NULL",
    null_out("c_mktsegment", 20, multiplier=3, offset=50),
)
_defect_query(
    "inject_whitespace", "part", "p_partkey", "", f"{_bucket('p_partkey', 7)} < 10", "'   '",
    whitespace("p_name", 10, multiplier=7),
)
_defect_query(
    "inject_out_of_range", "lineitem", "l_orderkey", "l_linenumber, ",
    f"{_bucket('l_orderkey', 11, 9)} BETWEEN 40 AND 49", "CAST(999 AS DOUBLE)",
    constant("l_quantity", 10, 999.0, "out_of_range", multiplier=11, offset=9, first=40),
)


@query(
    "SELECT event_id, CASE WHEN ((event_id % 100) * 53 + 5) % 100 < 10 THEN "
    "strftime(greatest(ts, TIMESTAMP '2024-01-25') + INTERVAL 3 HOURS, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' "
    "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS event_time, "
    "CASE WHEN ((event_id % 100) * 53 + 5) % 100 < 10 THEN 'future' ELSE '' END AS defects FROM events"
)
def inject_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hours after the clock, or after the event where that is later."""
    df = table(spark, sf_dir, "events").select("event_id", iso_text(F.col("ts").cast("timestamp")).alias("event_time"))
    defect = future_time("event_time", 10, CLOCK.replace(month=1, day=25), 3, multiplier=53, offset=5)
    return inject(df, "event_id", [defect]).select(
        "event_id", "event_time", F.array_join("injected_defects", ",").alias("defects")
    )


_SPARSE = "o_orderkey * 7"


def _duplicates_sql(key: str, shown: str) -> str:
    """The n-th hit row of a group of hundreds takes from the n-th other row."""
    numbered = f"(SELECT *, {key} AS number FROM orders)"
    ranked = (
        f"(SELECT *, number % 100 >= 85 AS hit, number // 100 % 1024 AS grp, row_number() OVER "
        f"(PARTITION BY number // 100 % 1024, number % 100 >= 85 ORDER BY number) AS n FROM {numbered})"
    )
    shown_source = shown.replace("number", "s.number")
    shown_row = shown.replace("number", "r.number")
    return (
        f"SELECT r.o_custkey, CASE WHEN s.n IS NOT NULL THEN {shown_source} ELSE {shown_row} END AS order_id, "
        f"CASE WHEN s.n IS NOT NULL THEN 'duplicate' ELSE '' END AS defects FROM {ranked} r "
        f"LEFT JOIN {ranked} s ON r.hit AND NOT s.hit AND r.grp = s.grp AND r.n = s.n"
    )


@query(_duplicates_sql(_SPARSE, "number"))
def inject_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True duplicates on a sparse key: each hit takes the id of one row that exists and is not hit."""
    df = table(spark, sf_dir, "orders").withColumn("order_id", F.expr(_SPARSE))
    df = df.withColumn("key", F.col("order_id"))
    return inject_duplicates(df, "key", "order_id", 15).select(
        "o_custkey", "order_id", F.array_join("injected_defects", ",").alias("defects")
    )


@query(_duplicates_sql("o_orderkey * 3 + 1", "'ORD-' || number"))
def inject_duplicate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a text key, numbered by the number it holds."""
    df = table(spark, sf_dir, "orders").withColumn("order_id", F.expr("'ORD-' || (o_orderkey * 3 + 1)"))
    number = F.substring("key", 5, 20).cast("long")
    return inject_duplicates(df.withColumn("key", F.col("order_id")), "key", "order_id", 15, number).select(
        "o_custkey", "order_id", F.array_join("injected_defects", ",").alias("defects")
    )


@query(f"SELECT {', '.join(CONTRACT.field_names)}, defects FROM {INJECTED_SQL}")
def inject_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation profile: four kinds of defect at once, overlaps allowed."""
    return injected_alerts(spark, sf_dir).select(
        *CONTRACT.field_names, F.array_join("injected_defects", ",").alias("defects")
    )


@query(
    "SELECT event_id, reading_id, CASE WHEN n % 100 < 10 THEN CAST(150 AS DOUBLE) ELSE temperature END AS temperature, "
    "CASE WHEN n % 100 BETWEEN 5 AND 14 THEN CAST(-5 AS DOUBLE) ELSE vibration_level END AS vibration_level "
    f"FROM (SELECT *, CAST(substr(event_id, 2) AS BIGINT) AS n FROM {events_sql('sensors.readings')})"
)
def inject_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomalies of the reading stream: hot machines and impossible vibrations."""
    flat = flat_events(spark, sf_dir, "sensors.readings").withColumn("n", F.expr("CAST(substr(event_id, 2) AS BIGINT)"))
    hot = constant("temperature", 10, 150.0, "hot")
    shaken = constant("vibration_level", 10, -5.0, "shaken", first=5)
    return inject(flat, "n", [hot, shaken]).select("event_id", "reading_id", "temperature", "vibration_level")
