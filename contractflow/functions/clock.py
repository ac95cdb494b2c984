"""The one clock of a batch.

Every time-dependent rule and audit column takes the same instant. A batch job passes a fixed
``datetime``; a stream passes ``current_timestamp()`` *before* ``writeStream``, which Spark
replaces with the batch time kept in the offset log, so a replayed batch sees its first clock.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def require_utc(spark: SparkSession | None = None) -> None:
    """Raise in a session whose days and zone-less texts would not be read as UTC."""
    spark = spark or SparkSession.getActiveSession()
    zone = spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"the session's time zone is {zone}; call contractflow.pin(spark), which sets UTC")


def instant(as_of: datetime | Column) -> Column:
    """A timestamp column for ``as_of``; a zone-less datetime is taken as UTC."""
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    since = as_of - datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds
    return F.timestamp_micros(F.lit(micros))
