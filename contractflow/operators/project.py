"""Envelopes, keys and JSON on the way out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractflow.functions import instant
from contractflow.operators.validate import REASON, UNDECODED
from contractflow.plans import ENVELOPE, Domain


def fallback_key(business_id: Column | str, event_id: Column | str) -> Column:
    """The business id, or the event id where that is null or empty."""
    business = F.col(business_id) if isinstance(business_id, str) else business_id
    event = F.col(event_id) if isinstance(event_id, str) else event_id
    return F.coalesce(F.nullif(business, F.lit("")), event)


def wrap_event(
    df: DataFrame,
    domain: str,
    event_type: str,
    produced_at: datetime | Column,
    payload: Sequence[str],
    event_id: Column | None = None,
) -> DataFrame:
    """Payload columns wrapped in the standard envelope, as one ``event`` struct.

    Without ``event_id`` the ids are random, and new ones when a lost partition is computed again;
    pass a column where ids must be repeatable.
    """
    return df.withColumn(
        "event",
        F.struct(
            (F.uuid() if event_id is None else event_id).alias("event_id"),
            F.lit(domain).alias("domain"),
            F.lit(event_type).alias("event_type"),
            iso_text(instant(produced_at)).alias("produced_at"),
            F.struct(*payload).alias("payload"),
        ),
    )


def merge_event(
    df: DataFrame,
    domain: str,
    event_type: str,
    produced_at: datetime | Column,
    payload: Sequence[str],
    event_id: Column | None = None,
) -> DataFrame:
    """The flat variant: metadata beside the payload, the time in epoch seconds."""
    return df.withColumn(
        "event",
        F.struct(
            F.lit(domain).alias("domain"),
            F.lit(event_type).alias("event_type"),
            (F.uuid() if event_id is None else event_id).alias("event_id"),
            instant(produced_at).cast("long").alias("timestamp"),
            *payload,
        ),
    )


def iso_text(at: Column) -> Column:
    """ISO-8601 text in UTC with microseconds, the form events carry their times in.

    The text is made from the microseconds since the epoch, so it is the same in every session time zone.
    """
    micros = F.unix_micros(at)
    rest = F.pmod(micros, F.lit(86_400_000_000))
    day = F.date_add(F.lit(date(1970, 1, 1)), _whole(micros - rest, 86_400_000_000).cast("int"))
    second = _whole(rest, 1_000_000)
    clock = _whole(second, 3600) * 10_000 + F.pmod(_whole(second, 60), F.lit(60)) * 100 + F.pmod(second, F.lit(60))
    shown, fraction = (F.substring((x + 1_000_000).cast("string"), 2, 6) for x in (clock, F.pmod(rest, F.lit(1_000_000))))
    parts = [F.substring(shown, i, 2) for i in (1, 3, 5)]
    return F.concat(day.cast("string"), F.lit("T"), parts[0], F.lit(":"), parts[1], F.lit(":"), parts[2], F.lit("."), fraction, F.lit("+00:00"))


def _whole(number: Column, unit: int) -> Column:
    """How many whole units a long holds, in long arithmetic."""
    return F.call_function("div", number, F.lit(unit).cast("long"))


def message_json(domain: Domain, passed: Column, clock: Column) -> Column:
    """One JSON text per checked row.

    ``to_json`` leaves out null fields, so the same struct gives certified rows their
    ``validated_at`` and rejected rows their ``failed_at``; a message that could not be decoded is there whole,
    as base64 with its key.
    """
    reason = F.col(REASON) if domain.error_on_valid else F.nullif(F.col(REASON), F.lit(""))
    key = F.col("kafka_key") if domain.keeps_kafka_key else F.when(F.col(UNDECODED).isNotNull(), F.col("kafka_key"))
    return F.to_json(
        F.struct(
            key.alias("kafka_key"),
            F.base64(UNDECODED).alias("raw_payload_base64"),
            *ENVELOPE,
            *domain.columns,
            reason.alias(REASON),
            F.when(passed, clock).alias("validated_at"),
            F.when(~passed, clock).alias("failed_at"),
        )
    )
