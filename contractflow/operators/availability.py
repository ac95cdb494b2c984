"""Availability: the share of a period in which events kept coming.

Two events further apart than a limit have an outage between them. Events are first reduced to the distinct seconds in
which there were any, at most 86,400 a day however many events there are; gaps inside a day are found day by day, and
those across the borders of days, of any number of days without events, between the last and first seconds of the days.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractflow.functions import epoch_seconds, instant

DAY = 86_400


def outages(df: DataFrame, event: str, limit_seconds: int, by: Sequence[str] = (), start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """(by, began, ended, seconds): the stretches without an event that are longer than the limit, in epoch seconds.

    ``by`` looks at each sensor, topic or the like on its own. ``start`` and ``end`` bound the period: events outside do not
    count, and a silence at either end does, for every ``by`` that has an event in the period. Null times do not count.
    """
    at = epoch_seconds(F.col(event), df.schema[event].dataType).cast("long")
    bounds = [None if x is None else instant(x).cast("long") for x in (start, end)]
    rows = df.select(*by, at.alias("at")).where("at IS NOT NULL")
    for bound, keep in zip(bounds, (lambda b: F.col("at") >= b, lambda b: F.col("at") <= b), strict=True):
        if bound is not None:
            rows = rows.where(keep(bound))
    seconds = rows.groupBy(*by, F.floor(F.col("at") / DAY).alias("day"), "at").agg(F.lit(1).alias("one")).drop("one")
    inside = seconds.withColumn("before", F.lag("at").over(Window.partitionBy(*by, "day").orderBy("at")))
    within = inside.where(F.col("at") - F.col("before") > limit_seconds).select(*by, F.col("before").alias("began"), F.col("at").alias("ended"))
    days = seconds.groupBy(*by, "day").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    if by:
        over = Window.partitionBy(*by).orderBy("day")
    else:
        over = Window.partitionBy(F.lit(0)).orderBy("day")  # a row for each day
    edged = days.withColumns({"before": F.lag("last").over(over), "after": F.lead("first").over(over)})
    began = F.coalesce("before", bounds[0]) if bounds[0] is not None else F.col("before")
    across = edged.where(F.col("first") - began > limit_seconds).select(*by, began.alias("began"), F.col("first").alias("ended"))
    found = within.unionByName(across)
    if bounds[1] is not None:
        tail = edged.where(F.col("after").isNull() & (bounds[1] - F.col("last") > limit_seconds))
        found = found.unionByName(tail.select(*by, F.col("last").alias("began"), bounds[1].alias("ended")))
    return found.withColumn("seconds", F.col("ended") - F.col("began"))


def availability(df: DataFrame, event: str, limit_seconds: int, by: Sequence[str] = (), start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """(by, outages, down_seconds, period_seconds, availability_pct) over the period, or from the first to the last event.

    A period of no length, or without events, is available throughout if it has an event; without ``by`` an empty table
    gives one row of nulls, and with it no rows.
    """
    at = epoch_seconds(F.col(event), df.schema[event].dataType).cast("long")
    low, high = (None if x is None else instant(x).cast("long") for x in (start, end))
    rows = df.select(*by, at.alias("at")).where("at IS NOT NULL")
    if low is not None:
        rows = rows.where(F.col("at") >= low)
    if high is not None:
        rows = rows.where(F.col("at") <= high)
    first = F.min("at") if low is None else F.when(F.count("*") > 0, low)
    last = F.max("at") if high is None else F.when(F.count("*") > 0, high)
    none = F.lit(None).cast("long")
    period = rows.groupBy(*by).agg((last - first).alias("period_seconds")).select(*by, none.alias("seconds"), "period_seconds")
    stops = outages(df, event, limit_seconds, by, start, end).select(*by, "seconds", none.alias("period_seconds"))
    both = period.unionByName(stops).groupBy(*by)
    merged = both.agg(F.count("seconds").alias("outages"), F.coalesce(F.sum("seconds"), F.lit(0)).alias("down_seconds"), F.max("period_seconds").alias("period_seconds"))
    return merged.withColumn("availability_pct", availability_pct(F.col("down_seconds"), F.col("period_seconds")))


def availability_pct(down: Column, period: Column) -> Column:
    share = F.coalesce(F.try_divide(down, period), F.when(period == 0, F.lit(0.0)))
    return F.round(100 * (1 - share), 3)


def availability_verdict(row: DataFrame, target_pct: float) -> DataFrame:
    """The row of ``availability`` against the target of a contract, such as 99.9."""
    return row.withColumns({"target_pct": F.lit(float(target_pct)), "pass": F.col("availability_pct") >= target_pct})
