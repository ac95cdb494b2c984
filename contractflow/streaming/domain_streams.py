"""The nine event streams: one query per topic, both outcomes in one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contractflow.operators.decode import decode_framed, flatten_event
from contractflow.operators.routing import domain_messages
from contractflow.operators.validate import check_domain
from contractflow.plans import DOMAINS, Domain
from contractflow.sources.kafka import DEFAULT_TRIGGER, kafka_sink, kafka_stream


def domain_stream(
    messages: DataFrame, domain: Domain, schema: T.StructType | str, as_of: Column | None = None
) -> DataFrame:
    """``key``, ``value``, ``topic`` for a message stream; map-only from source to sink."""
    flat = flatten_event(decode_framed(messages, schema), domain)
    return domain_messages(check_domain(flat, domain), domain, F.current_timestamp() if as_of is None else as_of)


def start_domain_streams(
    sources: Mapping[str, DataFrame],
    schemas: Mapping[str, T.StructType | str],
    sink: Callable[[DataFrame, str], StreamingQuery],
    as_of: Column | None = None,
) -> list[StreamingQuery]:
    """Start a query for each source; ``sink`` gets the messages and the stream's name."""
    return [
        sink(domain_stream(messages, DOMAINS[name], schemas[name], as_of), name) for name, messages in sources.items()
    ]


def run_on_kafka(
    spark: SparkSession,
    servers: str,
    schemas: Mapping[str, str],
    checkpoints: str,
    trigger: str | None = DEFAULT_TRIGGER,
) -> None:
    """Validate all nine topics until one of the queries ends."""
    sources = {name: kafka_stream(spark, d.bronze_topic, servers) for name, d in DOMAINS.items()}

    def sink(messages: DataFrame, name: str) -> StreamingQuery:
        return kafka_sink(messages, servers, f"{checkpoints}/{name.replace('.', '_')}", trigger=trigger)

    start_domain_streams(sources, schemas, sink)
    spark.streams.awaitAnyTermination()
