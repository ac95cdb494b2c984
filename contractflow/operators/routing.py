"""Send each row to exactly one side.

Rows are tagged once against one clock and the sides are complements of the tag, so
valid + invalid is always the whole input.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractflow.functions import instant
from contractflow.operators.decode import PAYLOAD, RAW, RAW_BYTES, drift_fields
from contractflow.operators.project import message_json
from contractflow.operators.validate import ERRORS, REASON, UNDECODED, VALID
from contractflow.plans import Contract, Domain

DRIFT = "unknown_fields"


def audit_columns(contract: Contract, as_of: datetime | Column) -> list[Column]:
    return [
        instant(as_of).alias("ingested_at"),
        F.lit(contract.version).alias("schema_version"),
        F.lit(contract.format).alias("source_format"),
    ]


def project_fields(contract: Contract, payload: str | None = PAYLOAD) -> list[Column]:
    """The contract's fields in contract order."""
    prefix = f"{payload}." if payload else ""
    return [F.col(f"{prefix}`{name}`").alias(name) for name in contract.field_names]


def emit_where(df: DataFrame, condition: Column, *columns: Column | str) -> DataFrame:
    """``df.filter(condition).select(*columns)`` for a condition on costly derived columns.

    A filter would be pushed below the projection that decodes or derives those columns, which then
    run for the filter and again for the rows that are left. Emitting nought or one row per
    input row leaves them where they are, evaluated once.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def drift_column(contract: Contract) -> list[Column]:
    """The fields of a JSON message that the contract does not know, null where there are none."""
    unknown = drift_fields(F.col(RAW), contract.field_names)
    return [F.when(F.size(unknown) > 0, unknown).alias(DRIFT)]


def certified(
    tagged: DataFrame,
    contract: Contract,
    as_of: datetime | Column,
    payload: str | None = PAYLOAD,
    drift: bool = False,
) -> DataFrame:
    """Valid rows in the bronze layout; ``payload=None`` for a flat table, ``drift`` for the map of unknown fields."""
    columns = [*project_fields(contract, payload), *audit_columns(contract, as_of)]
    return emit_where(tagged, F.col(VALID), *columns, *(drift_column(contract) if drift else []))


def quarantined(tagged: DataFrame, contract: Contract, as_of: datetime | Column) -> DataFrame:
    """Invalid rows in the quarantine layout: the message as received and why it was refused."""
    kept_bytes = [RAW_BYTES] if RAW_BYTES in tagged.columns else []
    return emit_where(tagged, ~F.col(VALID), RAW, *audit_columns(contract, as_of), ERRORS, *kept_bytes)


def route(tagged: DataFrame, contract: Contract, as_of: datetime | Column) -> tuple[DataFrame, DataFrame]:
    return certified(tagged, contract, as_of), quarantined(tagged, contract, as_of)


def count_columns() -> list[Column]:
    return [
        F.count("*").alias("total"),
        F.count_if(F.col(VALID)).alias("valid"),
        F.count_if(~F.col(VALID)).alias("invalid"),
    ]


def batch_counts(tagged: DataFrame) -> DataFrame:
    """Total, valid and invalid rows in one pass."""
    return tagged.agg(*count_columns())


def with_undecoded(checked: DataFrame) -> DataFrame:
    """Rows that came from no message have none that could not be decoded."""
    none = {name: F.lit(None) for name in ("kafka_key", UNDECODED) if name not in checked.columns}
    kinds = {"kafka_key": "string", UNDECODED: "binary"}
    return checked.withColumns({name: value.cast(kinds[name]) for name, value in none.items()})


def refused_key(domain: Domain) -> Column:
    """The event id, or the message's own key where the event could not be read."""
    return F.when(F.col(UNDECODED).isNotNull(), F.col("kafka_key")).otherwise(F.col("event_id"))


def domain_messages(checked: DataFrame, domain: Domain, as_of: datetime | Column) -> DataFrame:
    """``key``, ``value`` and target ``topic`` of every checked row.

    A sink that routes by ``topic`` writes both sides in one pass: the source is read and
    decoded once, and nothing has to be cached.
    """
    passed = F.col(REASON) == ""
    checked = with_undecoded(checked)
    return checked.select(
        F.when(passed, F.col(domain.key)).otherwise(refused_key(domain)).alias("key"),
        message_json(domain, passed, instant(as_of)).alias("value"),
        F.when(passed, F.lit(domain.silver_topic)).otherwise(F.lit(domain.dlq_topic)).alias("topic"),
    )


def split_domain(checked: DataFrame, domain: Domain, as_of: datetime | Column) -> tuple[DataFrame, DataFrame]:
    """The same as two frames of ``key`` and ``value``: certified and rejected."""
    passed, clock = F.col(REASON) == "", instant(as_of)
    checked = with_undecoded(checked)
    value = message_json(domain, passed, clock).alias("value")
    silver = emit_where(checked, passed, F.col(domain.key).alias("key"), value)
    return silver, emit_where(checked, ~passed, refused_key(domain).alias("key"), value)
