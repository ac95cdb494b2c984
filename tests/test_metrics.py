"""Quality figures against plain Python on small fixtures, empty tables and hot keys."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from contractflow import contract_from_dict
from contractflow.operators import metrics as M

BRONZE = "event_time string, ingested_at timestamp"
QUARANTINE = "validation_errors array<string>"
AT = datetime(2024, 1, 25)
REQUIRED = {"sensor_id": "sensor-id-not-empty", "event_time": "event-time-not-empty"}


def bronze(spark, *times):
    return spark.createDataFrame([(t, AT) for t in times], BRONZE)


def quarantine(spark, *errors):
    return spark.createDataFrame([(list(e),) for e in errors], QUARANTINE)


def test_empty_tables_give_zero_not_an_error(spark):
    row = M.quality_row(bronze(spark), quarantine(spark), REQUIRED).first()
    assert (row.total_records, row.conformity_pct, row.detection_rate_pct, row.overall_completeness_pct) == (0, 0, 0, 0)
    assert (row.avg_freshness_seconds, row.min_freshness_seconds) == (None, None)
    assert M.uniqueness(bronze(spark), "event_time").first().uniqueness_pct == 0
    assert M.top_duplicates(bronze(spark), ["event_time"]).isEmpty()
    assert M.violations_per_rule(quarantine(spark)).isEmpty()


def test_freshness_in_whole_seconds(spark):
    df = bronze(spark, "2024-01-24T23:59:50.999999+00:00", "2024-01-25T00:00:10Z", "junk", None, "2024-01-24T23:00:00+00:00")
    row = M.freshness(df).first()
    lags = [10, -10, 3600]
    assert row.valid_records == 5
    assert (row.min_freshness_seconds, row.max_freshness_seconds) == (min(lags), max(lags))
    assert row.avg_freshness_seconds == round(sum(lags) / len(lags), 3)


def test_weighted_freshness_equals_the_rows_it_stands_for(spark):
    times = ["2024-01-24T23:59:50Z"] * 5 + ["2024-01-24T23:00:01Z"] * 2 + [None] * 3
    plain = bronze(spark, *times)
    counted = plain.groupBy("event_time", "ingested_at").agg(F.count("*").alias("n"))
    assert M.freshness(counted, weight="n").collect() == M.freshness(plain).collect()
    empty = M.freshness(counted.limit(0), weight="n").first()
    assert (empty.valid_records, empty.avg_freshness_seconds) == (0, None)


def test_quality_figures(spark):
    good = bronze(spark, *["2024-01-24T23:59:59Z"] * 7)
    bad = quarantine(
        spark,
        ["NOT_EMPTY_VIOLATION [sensor-id-not-empty]: x"],
        ["NOT_EMPTY_VIOLATION [sensor-id-not-empty]: x", "NOT_EMPTY_VIOLATION [event-time-not-empty]: x"],
        ["NOT_EMPTY_VIOLATION [sensor-id-not-empty-2]: x"],
    )
    row = M.quality_row(good, bad, REQUIRED).first()
    assert (row.total_valid, row.total_invalid, row.total_records) == (7, 3, 10)
    assert row.conformity_pct == 70.0
    assert row.missing_sensor_id == 3  # a rule name that contains the other one counts here ...
    assert row.missing_event_time == 1
    assert (row.sensor_id_completeness_pct, row.overall_completeness_pct) == (70.0, 70.0)
    per_rule = {r.rule: r.violations for r in M.violations_per_rule(bad).collect()}
    assert per_rule == {"sensor-id-not-empty": 2, "event-time-not-empty": 1, "sensor-id-not-empty-2": 1}  # ... not here


def test_one_required_field(spark):
    bad = quarantine(spark, ["[a]"])
    row = M.quality_row(bronze(spark, "2024-01-24T23:59:59Z"), bad, {"a": "a"}, event=None).first()
    assert row.overall_completeness_pct == row.a_completeness_pct == 50.0


def test_report_is_the_row_in_long_form(spark):
    good, bad = bronze(spark, "2024-01-24T23:59:59Z"), quarantine(spark, ["[sensor-id-not-empty]"])
    row = M.quality_row(good, bad, REQUIRED).first().asDict()
    report = {(r.section, r.metric): r.value for r in M.quality_report(good, bad, REQUIRED).collect()}
    assert len(report) == 15
    assert all(value == row[metric] for (_, metric), value in report.items())


def test_completeness_rules():
    rules = [
        {"name": "a-there", "expr": "has(a)"},
        {"name": "b-there", "expr": "b != ''"},
        {"name": "c-in", "expr": "c in ['x']"},
        {"name": "d-off", "expr": "has(d)", "disabled": True},
    ]
    contract = contract_from_dict({"quality": {"rules": rules}})
    assert M.completeness_rules(contract) == {"a": "a-there", "b": "b-there"}


def test_uniqueness_like_a_counter(spark):
    keys = ["a", "a", "b", None, None, "c", "", ""]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    expected = len(Counter(keys))
    for digest in (False, True):
        row = M.uniqueness(df, "k", digest=digest).first()
        assert (row.records, row.distinct_ids) == (8, expected)
        assert row.uniqueness_pct == round(expected * 100 / len(keys), 2)
    assert M.uniqueness(df, "k", approximate=True).first().distinct_ids == expected


def test_top_duplicates_with_ties_and_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k")
    )
    counts = Counter(r.k for r in df.collect())
    expected = sorted(((-n, k) for k, n in counts.items() if n > 1))[:10]
    got = [(-r.copies, r.k) for r in M.top_duplicates(df, ["k"]).collect()]
    assert got == expected and got[0] == (-10_000, "hot")


def test_detection_against_labels_with_hot_and_unlabelled_keys(spark):
    rows = [(1, 5)] * 4000 + [(1, 500)] * 1000 + [(2, 5), (2, 500), (3, 5), (4, 500), (None, 5)]
    labels = [(1, 0), (1, 1), (2, 1), (3, 0), (9, 0)]
    df = spark.createDataFrame(rows, "doc int, n int")
    truth = {1: True, 2: False, 3: True}
    row = M.detection_against_labels(
        df, F.col("n") < 100, spark.createDataFrame(labels, "doc int, quality int"), "doc", F.col("quality") == 0
    ).first()
    labelled = [(truth[d], n < 100) for d, n in rows if d in truth]
    assert row.true_positives == sum(t and f for t, f in labelled)
    assert row.false_negatives == sum(t and not f for t, f in labelled)
    assert row.false_positives == sum(f and not t for t, f in labelled)
    assert row.true_negatives == sum(not t and not f for t, f in labelled)
    assert row.unlabelled == 2
    assert row.detection_rate_pct == round(4001 / 5001 * 100, 2)


@pytest.mark.parametrize(
    ("text", "number"), [("30 seconds", 30), ("< 30 seconds end-to-end", 30), (">= 99%", 99), ("99.9%", 99.9), (60, 60)]
)
def test_sla_numbers(text, number):
    assert M.sla_threshold(text) == number


def test_sla_verdicts(spark):
    schema = "overall_completeness_pct double, avg_freshness_seconds double, max_freshness_seconds int"
    row = spark.createDataFrame([(99.0, 30.0, 30)], schema)
    sla = {
        "availability": "99.9%",
        "completeness": ">= 99%",
        "dataFreshness": "30 seconds",
        "latency": "< 30 seconds",
        "max_latency_seconds": 60,
    }
    got = {r.sla: (r.target, r.actual, r["pass"]) for r in M.sla_verdicts(row, sla).collect()}
    assert got == {
        "completeness": (">= 99.0", 99.0, True),
        "dataFreshness": ("<= 30.0", 30.0, True),
        "latency": ("< 30.0", 30.0, False),
        "max_latency_seconds": ("<= 60.0", 30.0, True),
    }
    with pytest.raises(ValueError, match="no measurable"):
        M.sla_verdicts(row, {"availability": "99.9%"})
    with pytest.raises(ValueError, match="no number"):
        M.sla_threshold("soon")
