"""Quality metrics over the bronze and quarantine tables.

Every metric is an aggregate with map-side combine: a table is scanned once however many
metrics are asked for, ratios are columns, and nothing is collected on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.functions import epoch_seconds
from contractflow.operators.validate import ERRORS
from contractflow.plans import Contract

INJECTED = "injected_defects"


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, zero where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def mentions(rule: str, exact: bool = False) -> Column:
    """Whether a row's errors name a rule; not ``exact`` also matches a rule name it begins or ends."""
    return F.array_join(ERRORS, " ").contains(f"[{rule}]" if exact else rule)


def _one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row aggregates side by side without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def _freshness_columns(schema: T.StructType, ingested: str, event: str, weight: str | None = None) -> list[Column]:
    lag = epoch_seconds(F.col(ingested), schema[ingested].dataType) - epoch_seconds(F.col(event), schema[event].dataType)
    if weight is None:
        records, average = F.count("*"), F.avg(lag)
    else:
        times = F.col(weight)
        records = F.coalesce(F.sum(times), F.lit(0))
        exact = F.sum(lag.cast("decimal(18,0)") * times.cast("decimal(18,0)"))  # a sum of doubles is not repeatable
        average = F.try_divide(exact.cast("double"), F.sum(F.when(lag.isNotNull(), times)))
    return [
        records.alias("valid_records"),
        F.round(average, 3).alias("avg_freshness_seconds"),
        F.min(lag).alias("min_freshness_seconds"),
        F.max(lag).alias("max_freshness_seconds"),
    ]


def freshness(
    bronze: DataFrame, ingested: str = "ingested_at", event: str = "event_time", weight: str | None = None
) -> DataFrame:
    """Valid records and the average, smallest and largest lag in whole seconds.

    ``weight`` names a column saying how many records a row stands for, for rows counted beforehand.
    """
    return bronze.agg(*_freshness_columns(bronze.schema, ingested, event, weight))


def completeness_rules(contract: Contract) -> dict[str, str]:
    """Field name to the name of the rule that requires it."""
    kinds = ("not_empty", "not_blank", "required")
    return {r.field: r.name for r in contract.active_rules if r.kind in kinds and r.field}


def _conformity_columns() -> dict[str, Column]:
    valid, invalid = F.col("total_valid"), F.col("total_invalid")
    return {"total_records": valid + invalid, "conformity_pct": percent(valid, valid + invalid)}


def conformity(bronze: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Valid, invalid and total records and the conforming share."""
    return _one_row(
        bronze.agg(F.count("*").alias("total_valid")), quarantine.agg(F.count("*").alias("total_invalid"))
    ).withColumns(_conformity_columns())


def quality_row(
    bronze: DataFrame,
    quarantine: DataFrame,
    required: Mapping[str, str],
    ingested: str = "ingested_at",
    event: str | None = "event_time",
    rules: Sequence[str] = (),
) -> DataFrame:
    """All figures of the quality report in one row: one scan of each table.

    ``required`` maps a field to the rule that reports it missing; ``rules`` names the rules whose
    violations are counted, as ``violations``, an array of rule and count.
    """
    timely = _freshness_columns(bronze.schema, ingested, event) if event else []
    good = bronze.agg(F.count("*").alias("total_valid"), *timely)
    bad = quarantine.agg(
        F.count("*").alias("total_invalid"),
        *[F.count_if(mentions(rule)).alias(f"missing_{name}") for name, rule in required.items()],
        *([F.array(*[_counted(rule) for rule in rules]).alias("violations")] if rules else []),
    )
    row = _one_row(good, bad).withColumns(_conformity_columns())
    total = F.col("total_records")
    complete = {
        f"{name}_completeness_pct": percent(total - F.col(f"missing_{name}"), total) for name in required
    }
    row = row.withColumns(complete) if complete else row
    shares = [F.col(name) for name in complete]
    if shares:
        row = row.withColumn("overall_completeness_pct", F.least(*shares) if len(shares) > 1 else shares[0])
    invalid = F.col("total_invalid")
    return row.withColumns({"detected_invalid": invalid, "detection_rate_pct": percent(invalid, invalid)})


def _counted(rule: str) -> Column:
    return F.struct(F.lit(rule).alias("rule"), F.count_if(mentions(rule, exact=True)).alias("violations"))


# Sections and lines of the report, before the fields a contract requires.
REPORT_SECTIONS = {
    "timeliness": ["valid_records", "avg_freshness_seconds", "min_freshness_seconds", "max_freshness_seconds"],
    "conformity": ["total_records", "total_valid", "total_invalid", "conformity_pct"],
    "completeness": [],
    "detection": ["detected_invalid", "detection_rate_pct"],
}


def report_lines(row: DataFrame) -> DataFrame:
    """A :func:`quality_row` as rows of ``section, metric, value``."""
    required = [name for name in row.columns if name.startswith("missing_") or name.endswith("_completeness_pct")]
    sections = {**REPORT_SECTIONS, "completeness": required}
    lines = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(metric).alias("metric"),
            F.col(metric).cast("double").alias("value"),
        )
        for section, metrics in sections.items()
        for metric in metrics
        if metric in row.columns
    ]
    if "violations" in row.columns:
        each = F.transform(
            "violations",
            lambda v: F.struct(F.lit("violations").alias("section"), v["rule"].alias("metric"), v["violations"].cast("double").alias("value")),
        )
        return row.select(F.inline(F.concat(F.array(*lines), each)))
    return row.select(F.inline(F.array(*lines)))


def quality_report(
    bronze: DataFrame,
    quarantine: DataFrame,
    required: Mapping[str, str],
    ingested: str = "ingested_at",
    event: str | None = "event_time",
) -> DataFrame:
    """The quality report as rows of ``section, metric, value``."""
    return report_lines(quality_row(bronze, quarantine, required, ingested, event))


def violations_per_rule(quarantine: DataFrame) -> DataFrame:
    """Violations of each rule by exact name.

    Messages are counted before the rule name is cut out of them, so the pattern runs once per
    distinct message and only a few rows per task are shuffled.
    """
    # Exploding the bare column would make Spark add a filter on it, and so build computed errors twice.
    errors = F.when(F.size(ERRORS) > 0, F.col(ERRORS))
    return (
        quarantine.select(F.explode(errors).alias("message"))
        .groupBy("message")
        .agg(F.count("*").alias("violations"))
        .groupBy(F.regexp_extract("message", r"\[(.+?)\]", 1).alias("rule"))
        .agg(F.sum("violations").alias("violations"))
    )


def uniqueness(df: DataFrame, key: str, digest: bool = False, approximate: bool = False, error: float = 0.05) -> DataFrame:
    """Records, distinct keys and their share in percent; null counts as one key.

    ``digest`` compares SHA-256 digests, so that long texts are not shuffled whole. ``approximate`` counts
    with a sketch of fixed size; ``error`` is the relative standard deviation of such a count.
    """
    value = F.unhex(F.sha2(F.col(key).cast("string"), 256)) if digest else F.col(key)
    distinct = F.approx_count_distinct(value, error) if approximate else F.count_distinct(value)
    return (
        df.agg(
            F.count("*").alias("records"),
            (distinct + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).alias("distinct_ids"),
        ).withColumn("uniqueness_pct", F.round(percent(F.col("distinct_ids"), F.col("records")), 2))
    )


def top_duplicates(df: DataFrame, keys: Sequence[str], limit: int = 10) -> DataFrame:
    """The most repeated keys; ties are broken by the key."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
    return counted.orderBy(F.desc("copies"), *keys).limit(limit)


def _detection_rates(row: DataFrame) -> DataFrame:
    hit, missed, false = F.col("true_positives"), F.col("false_negatives"), F.col("false_positives")
    return row.withColumns(
        {
            "detection_rate_pct": F.round(percent(hit, hit + missed), 2),
            "precision_pct": F.round(percent(hit, hit + false), 2),
        }
    )


def detection(df: DataFrame, truth: Column, flagged: Column) -> DataFrame:
    """Detection rate and precision against a truth that travels with the row.

    Neither a null truth nor a null flag holds.
    """
    truth, flagged = (F.coalesce(c, F.lit(False)) for c in (truth, flagged))
    return _detection_rates(
        df.agg(
            F.count_if(truth & flagged).alias("true_positives"),
            F.count_if(truth & ~flagged).alias("false_negatives"),
            F.count_if(~truth & flagged).alias("false_positives"),
            F.count_if(~truth & ~flagged).alias("true_negatives"),
        )
    )


def detection_against_labels(
    df: DataFrame, flagged: Column, labels: DataFrame, key: str, truth: Column
) -> DataFrame:
    """The same against a label table; rows without a label are counted apart.

    Both sides are reduced to one row per key before they meet, on the partitioning the join
    needs anyway, so a key with very many rows costs one row per task.
    """
    rows = df.groupBy(key).agg(F.count("*").alias("n"), F.count_if(flagged).alias("n_flagged"))
    known = labels.groupBy(key).agg(F.max(truth).alias("bad"))
    clean = F.col("n") - F.col("n_flagged")

    def total(kept: Column, amount: Column) -> Column:
        return F.coalesce(F.sum(F.when(kept, amount)), F.lit(0))

    return _detection_rates(
        rows.join(known, key, "left").agg(
            total(F.col("bad"), F.col("n_flagged")).alias("true_positives"),
            total(F.col("bad"), clean).alias("false_negatives"),
            total(~F.col("bad"), F.col("n_flagged")).alias("false_positives"),
            total(~F.col("bad"), clean).alias("true_negatives"),
            total(F.col("bad").isNull(), F.col("n")).alias("unlabelled"),
        )
    )


def detection_by_rule(tagged: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Detection per rule; ``expected`` maps a rule to the injected defect it should find."""

    def counts(rule: str, defect: str) -> Column:
        truth, flagged = F.array_contains(INJECTED, defect), mentions(rule, exact=True)
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(defect).alias("defect"),
            F.count_if(truth & flagged).alias("true_positives"),
            F.count_if(truth & ~flagged).alias("false_negatives"),
            F.count_if(~truth & flagged).alias("false_positives"),
        )

    found = tagged.agg(F.array(*[counts(r, d) for r, d in expected.items()]).alias("rules"))
    return _detection_rates(found.select(F.inline("rules")))


def expected_vs_observed(tagged: DataFrame, profile: Mapping[str, tuple[int, str | None]]) -> DataFrame:
    """Expected, injected and reported rows per defect.

    ``profile`` maps a defect to its percentage and the rule that reports it, if there is one.
    """

    def line(defect: str, pct: int, rule: str | None) -> Column:
        return F.struct(
            F.lit(defect).alias("defect"),
            F.floor(F.count("*") * pct / 100).alias("expected"),
            F.count_if(F.array_contains(INJECTED, defect)).alias("injected"),
            (F.count_if(mentions(rule, exact=True)) if rule else F.lit(None).cast("long")).alias("observed"),
        )

    lines = [line(defect, pct, rule) for defect, (pct, rule) in profile.items()]
    return tagged.agg(F.array(*lines).alias("profile")).select(F.inline("profile"))


def sla_threshold(text: object) -> float:
    """The number in a target such as ``">= 99%"`` or ``"< 30 seconds end-to-end"``."""
    found = re.search(r"\d+(?:\.\d+)?", str(text))
    if found is None:
        raise ValueError(f"no number in SLA target {text!r}")
    return float(found.group())


# SLA names, the report metric each is judged on, and how a bare number compares.
SLA_METRICS = {
    "completeness": ("overall_completeness_pct", ">="),
    "dataFreshness": ("avg_freshness_seconds", "<="),
    "latency": ("max_freshness_seconds", "<="),
    "max_latency_seconds": ("max_freshness_seconds", "<="),
}


def sla_verdicts(row: DataFrame, sla: Mapping[str, object]) -> DataFrame:
    """``sla, target, actual, pass`` for each target the report has a figure for."""
    lines = []
    for name, (metric, default) in SLA_METRICS.items():
        if name not in sla or metric not in row.columns:
            continue
        stated = re.match(r"\s*(>=|<=|>|<)", str(sla[name]))
        sign, target = stated.group(1) if stated else default, sla_threshold(sla[name])
        actual = F.col(metric).cast("double")
        verdict = {">=": actual >= target, "<=": actual <= target, ">": actual > target, "<": actual < target}
        lines.append(
            F.struct(
                F.lit(name).alias("sla"),
                F.lit(f"{sign} {target}").alias("target"),
                actual.alias("actual"),
                verdict[sign].alias("pass"),
            )
        )
    if not lines:
        raise ValueError("the contract states no measurable SLA target")
    return row.select(F.inline(F.array(*lines)))
