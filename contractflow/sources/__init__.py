"""Streams and tables the engine reads from and writes to."""

from contractflow.sources.commits import (
    CommitConflict,
    CommitLog,
    closed_days,
    compact,
    live_files,
    snapshot,
    upgrade,
    vacuum,
)
from contractflow.sources.kafka import (
    MESSAGE_SCHEMA,
    as_messages,
    contract_topic_stream,
    file_sink,
    file_stream,
    kafka_sink,
    kafka_stream,
    open_topics,
    table_stream,
    with_trigger,
)
from contractflow.sources.promotion import common_schema, least_common, promoted, rewrite_promoted, union_promoted
from contractflow.sources.tables import (
    Tables,
    append,
    bronze_schema,
    drop_expired,
    drop_load,
    namespace_statements,
    provision,
    provision_all,
    quarantine_schema,
    replace_load,
    retained,
    retention_days,
    table_ddl,
    union_widened,
    widen,
)

__all__ = [
    "MESSAGE_SCHEMA",
    "CommitConflict",
    "CommitLog",
    "Tables",
    "append",
    "as_messages",
    "bronze_schema",
    "closed_days",
    "common_schema",
    "compact",
    "contract_topic_stream",
    "drop_expired",
    "drop_load",
    "file_sink",
    "file_stream",
    "kafka_sink",
    "kafka_stream",
    "least_common",
    "live_files",
    "namespace_statements",
    "open_topics",
    "promoted",
    "provision",
    "provision_all",
    "quarantine_schema",
    "replace_load",
    "retained",
    "retention_days",
    "rewrite_promoted",
    "snapshot",
    "table_ddl",
    "table_stream",
    "union_promoted",
    "union_widened",
    "upgrade",
    "vacuum",
    "widen",
    "with_trigger",
]
