"""Quality metrics over the alert tables and the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow.operators import metrics as M
from contractflow.operators.validate import ERRORS
from suite.alerts import (
    BRONZE_SQL,
    CLOCK_SECONDS,
    CONTRACT,
    QUARANTINE_SQL,
    TAGGED_SQL,
    alert_tables,
    tagged_alerts,
)
from suite.registry import query, table

REQUIRED = M.completeness_rules(CONTRACT)  # sensor_id and event_time with their rules

_LAG = f"({CLOCK_SECONDS} - CAST(floor(epoch(CAST(event_time AS TIMESTAMP))) AS BIGINT))"
_GOOD = (
    f"(SELECT count(*) AS total_valid, round(avg({_LAG}), 3) AS avg_freshness_seconds, "
    f"min({_LAG}) AS min_freshness_seconds, max({_LAG}) AS max_freshness_seconds FROM {BRONZE_SQL})"
)
_BAD = (
    "(SELECT count(*) AS total_invalid, "
    "count(*) FILTER (contains(errors, 'sensor-id-not-empty')) AS missing_sensor_id, "
    "count(*) FILTER (contains(errors, 'event-time-not-empty')) AS missing_event_time "
    f"FROM {QUARANTINE_SQL})"
)
_ROW = (
    "(SELECT *, total_valid + total_invalid AS total_records, "
    "total_valid / CAST(total_valid + total_invalid AS DOUBLE) * 100 AS conformity_pct, "
    "(total_valid + total_invalid - missing_sensor_id) / CAST(total_valid + total_invalid AS DOUBLE) * 100 "
    "AS sensor_id_completeness_pct, "
    "(total_valid + total_invalid - missing_event_time) / CAST(total_valid + total_invalid AS DOUBLE) * 100 "
    f"AS event_time_completeness_pct, CASE WHEN total_invalid > 0 THEN 100.0 ELSE 0.0 END AS detection FROM {_GOOD}, {_BAD})"
)


def alert_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.quality_row(*alert_tables(spark, sf_dir), REQUIRED)


@query(
    "SELECT total_valid AS valid_records, avg_freshness_seconds, min_freshness_seconds, max_freshness_seconds "
    f"FROM {_GOOD}"
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.freshness(alert_tables(spark, sf_dir)[0])


@query(
    "SELECT count(*) AS valid_records, "
    "round(avg(CAST(epoch(l_shipdate) AS BIGINT) - CAST(epoch(o_orderdate) AS BIGINT)), 3) AS avg_freshness_seconds, "
    "min(CAST(epoch(l_shipdate) AS BIGINT) - CAST(epoch(o_orderdate) AS BIGINT)) AS min_freshness_seconds, "
    "max(CAST(epoch(l_shipdate) AS BIGINT) - CAST(epoch(o_orderdate) AS BIGINT)) AS max_freshness_seconds "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)
def freshness_of_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order to shipping lag over an equi-join of two large tables.

    Lines of one order and day are counted first: an order with very many lines reaches the join as
    one row per day, whatever the number of its lines.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_shipdate").agg(F.count("*").alias("lines"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return M.freshness(joined, "l_shipdate", "o_orderdate", "lines")


@query("SELECT count(*) AS total FROM lineitem")
def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.row_count(table(spark, sf_dir, "lineitem"))


@query(f"SELECT total_valid, total_invalid, total_records, conformity_pct FROM {_ROW}")
def conformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.conformity(*alert_tables(spark, sf_dir))


@query(
    "SELECT total_records, missing_sensor_id, missing_event_time, sensor_id_completeness_pct, "
    "event_time_completeness_pct, least(sensor_id_completeness_pct, event_time_completeness_pct) "
    f"AS overall_completeness_pct FROM {_ROW}"
)
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_row(spark, sf_dir).select(
        "total_records",
        "missing_sensor_id",
        "missing_event_time",
        "sensor_id_completeness_pct",
        "event_time_completeness_pct",
        "overall_completeness_pct",
    )


@query(f"SELECT total_invalid AS detected_invalid, CAST(detection AS DOUBLE) AS detection_rate_pct FROM {_ROW}")
def detection_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detection rate as the original report defines it: refused rows over refused rows."""
    return alert_row(spark, sf_dir).select("detected_invalid", "detection_rate_pct")


_RATES = (
    "round(CASE WHEN true_positives + false_negatives > 0 THEN true_positives / "
    "CAST(true_positives + false_negatives AS DOUBLE) * 100 ELSE 0 END, 2) AS detection_rate_pct, "
    "round(CASE WHEN true_positives + false_positives > 0 THEN true_positives / "
    "CAST(true_positives + false_positives AS DOUBLE) * 100 ELSE 0 END, 2) AS precision_pct"
)


def _confusion_sql(source: str, truth: str, flagged: str) -> str:
    return (
        f"SELECT *, {_RATES} FROM (SELECT count(*) FILTER ({truth} AND {flagged}) AS true_positives, "
        f"count(*) FILTER ({truth} AND NOT {flagged}) AS false_negatives, "
        f"count(*) FILTER (NOT {truth} AND {flagged}) AS false_positives, "
        f"count(*) FILTER (NOT {truth} AND NOT {flagged}) AS true_negatives FROM {source})"
    )


@query(_confusion_sql(TAGGED_SQL, "(defects <> '')", "(errors <> '')"))
def detection_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detection against what was really injected; no rule finds the duplicates."""
    tagged = tagged_alerts(spark, sf_dir)
    return M.detection(tagged, F.size(M.INJECTED) > 0, ~F.col("is_valid"))


_PAIRS = {
    "sensor-id-not-empty": "blank_sensor",
    "event-time-not-future": "future_time",
    "valid-severity": "bad_severity",
    "valid-alert-type": "duplicate_id",
}


def _pair_sql(rule: str, defect: str) -> str:
    truth, flagged = f"contains(defects, '{defect}')", f"contains(errors, '[{rule}]')"
    return (
        f"SELECT '{rule}' AS rule, '{defect}' AS defect, count(*) FILTER ({truth} AND {flagged}) AS true_positives, "
        f"count(*) FILTER ({truth} AND NOT {flagged}) AS false_negatives, "
        f"count(*) FILTER (NOT {truth} AND {flagged}) AS false_positives FROM {TAGGED_SQL}"
    )


@query(f"SELECT *, {_RATES} FROM ({' UNION ALL '.join(_pair_sql(r, d) for r, d in _PAIRS.items())})")
def detection_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.detection_by_rule(tagged_alerts(spark, sf_dir), _PAIRS)


@query(
    f"SELECT *, {_RATES} FROM (SELECT "
    "count(*) FILTER (quality = 0 AND n_chars < 200) AS true_positives, "
    "count(*) FILTER (quality = 0 AND n_chars >= 200) AS false_negatives, "
    "count(*) FILTER (quality <> 0 AND n_chars < 200) AS false_positives, "
    "count(*) FILTER (quality <> 0 AND n_chars >= 200) AS true_negatives, "
    "count(*) FILTER (quality IS NULL) AS unlabelled "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)
def detection_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A length rule judged against the label table."""
    return M.detection_against_labels(
        table(spark, sf_dir, "documents"),
        F.col("n_chars") < 200,
        table(spark, sf_dir, "labels"),
        "doc_id",
        F.col("quality") == 0,
    )


@query(
    "SELECT count(*) AS records, count(DISTINCT alert_id) AS distinct_ids, "
    f"round(count(DISTINCT alert_id) / CAST(count(*) AS DOUBLE) * 100, 2) AS uniqueness_pct FROM {TAGGED_SQL}"
)
def uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.uniqueness(tagged_alerts(spark, sf_dir), "alert_id")


@query(
    "SELECT count(*) AS records, count(DISTINCT text) AS distinct_ids, "
    "round(count(DISTINCT text) / CAST(count(*) AS DOUBLE) * 100, 2) AS uniqueness_pct FROM documents"
)
def uniqueness_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts compared by digest."""
    return M.uniqueness(table(spark, sf_dir, "documents"), "text", digest=True)


@query("SELECT count(*) AS records, true AS close FROM lineitem")
def uniqueness_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sketch's distinct count, within four of the standard deviations that it states."""
    lineitem = table(spark, sf_dir, "lineitem")
    sketched = M.uniqueness(lineitem, "l_partkey", approximate=True, error=0.02).select("records", F.col("distinct_ids").alias("near"))
    exact = M.uniqueness(lineitem, "l_partkey").select("records", F.col("distinct_ids").alias("exact"))
    both = sketched.join(exact, "records")
    return both.select("records", (F.abs(F.col("near") - F.col("exact")) <= 0.08 * F.col("exact")).alias("close"))


@query(
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber "
    "HAVING count(*) > 1 ORDER BY copies DESC, l_orderkey, l_linenumber LIMIT 10"
)
def top_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most repeated line keys."""
    return M.top_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    f"SELECT alert_id, count(*) AS copies FROM {TAGGED_SQL} GROUP BY alert_id HAVING count(*) > 1 "
    "ORDER BY copies DESC, alert_id LIMIT 10"
)
def top_duplicate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.top_duplicates(tagged_alerts(spark, sf_dir), ["alert_id"])


_PROFILE = {
    "blank_sensor": (10, "sensor-id-not-empty"),
    "future_time": (10, "event-time-not-future"),
    "bad_severity": (5, "valid-severity"),
    "duplicate_id": (15, None),
}


@query(
    " UNION ALL ".join(
        f"SELECT '{defect}' AS defect, CAST(floor(count(*) * {pct} / 100) AS BIGINT) AS expected, "
        f"count(*) FILTER (contains(defects, '{defect}')) AS injected, "
        + (f"count(*) FILTER (contains(errors, '[{rule}]'))" if rule else "CAST(NULL AS BIGINT)")
        + f" AS observed FROM {TAGGED_SQL}"
        for defect, (pct, rule) in _PROFILE.items()
    )
)
def expected_vs_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.expected_vs_observed(tagged_alerts(spark, sf_dir), _PROFILE)


_OVERALL = "least(sensor_id_completeness_pct, event_time_completeness_pct)"


@query(
    f"SELECT 'completeness' AS sla, '>= 99.0' AS target, {_OVERALL} AS actual, {_OVERALL} >= 99 AS pass FROM {_ROW} "
    "UNION ALL SELECT 'dataFreshness', '<= 30.0', avg_freshness_seconds, avg_freshness_seconds <= 30 "
    f"FROM {_ROW} UNION ALL SELECT 'latency', '< 30.0', CAST(max_freshness_seconds AS DOUBLE), "
    f"max_freshness_seconds < 30 FROM {_ROW} UNION ALL SELECT 'max_latency_seconds', '<= 2592000.0', "
    f"CAST(max_freshness_seconds AS DOUBLE), max_freshness_seconds <= 2592000 FROM {_ROW}"
)
def sla_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of the alert contract, and a maximum latency of thirty days."""
    return M.sla_verdicts(alert_row(spark, sf_dir), {**CONTRACT.sla, "max_latency_seconds": 30 * 86400})


_REPORT = {
    "timeliness": [
        "total_valid AS valid_records",
        "avg_freshness_seconds",
        "min_freshness_seconds",
        "max_freshness_seconds",
    ],
    "conformity": ["total_records", "total_valid", "total_invalid", "conformity_pct"],
    "completeness": [
        "missing_sensor_id",
        "missing_event_time",
        "sensor_id_completeness_pct",
        "event_time_completeness_pct",
        f"{_OVERALL} AS overall_completeness_pct",
    ],
    "detection": ["total_invalid AS detected_invalid", "detection AS detection_rate_pct"],
}


@query(
    " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{item.split(' AS ')[-1]}' AS metric, "
        f"CAST({item.split(' AS ')[0]} AS DOUBLE) AS value FROM {_ROW}"
        for section, items in _REPORT.items()
        for item in items
    )
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report as rows, from one scan per table."""
    return M.quality_report(*alert_tables(spark, sf_dir), REQUIRED)


@query(
    "SELECT rule, count(*) AS violations FROM ("
    "SELECT unnest(regexp_extract_all(errors, '\\[([a-z-]+)\\]', 1)) AS rule "
    f"FROM {QUARANTINE_SQL}) GROUP BY rule"
)
def violations_per_alert_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations per rule read back from the quarantine rows."""
    return M.violations_per_rule(alert_tables(spark, sf_dir)[1].select(ERRORS))
