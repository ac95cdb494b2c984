"""The contract path as a stream: decode, tag, split, and record what happened."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contractflow.operators.decode import PAYLOAD, RAW, RAW_BYTES, decode_contract
from contractflow.operators.routing import audit_columns, count_columns, drift_column, project_fields
from contractflow.operators.validate import ERRORS, VALID, validate
from contractflow.plans import Contract
from contractflow.sources.commits import CommitLog
from contractflow.sources.kafka import DEFAULT_TRIGGER, with_trigger
from contractflow.sources.tables import (
    Tables,
    bronze_schema,
    drop_load,
    namespace_statements,
    quarantine_schema,
    replace_load,
    table_ddl,
)

STATS_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("valid", T.LongType()),
        T.StructField("invalid", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)


def tag_messages(
    messages: DataFrame,
    contract: Contract,
    as_of: Column | None = None,
    avro_schema: str | None = None,
    decode_check: bool = True,
    drift: bool = False,
) -> DataFrame:
    """Both sides' columns and the verdict, declared once on the stream.

    ``current_timestamp()`` in a streaming plan is the batch time from the offset log: one clock
    for the whole batch, and the same clock when the batch is replayed. The raw text is kept
    for refused rows only.
    """
    clock = F.current_timestamp() if as_of is None else as_of
    decoded = decode_contract(messages, contract, avro_schema)
    tagged = validate(decoded, contract, clock, PAYLOAD, decode_check=decode_check)
    return tagged.select(
        *project_fields(contract),
        *audit_columns(contract, clock),
        VALID,
        ERRORS,
        *(drift_column(contract) if drift else []),
        *[F.when(~F.col(VALID), F.col(name)).alias(name) for name in (RAW, RAW_BYTES) if name in tagged.columns],
    )


def provision_stats(spark: SparkSession, table: str, provider: str = "parquet") -> str:
    for statement in namespace_statements(table):
        spark.sql(statement)
    spark.sql(table_ddl(table, STATS_SCHEMA, provider=provider))  # without dates: rows of one plain table
    return table


def batch_writer(
    contract: Contract, tables: Tables, stats_table: str | None = None, log: CommitLog | None = None
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body: four actions at most, whatever the number of rules.

    Each output is written under a load id made of the query and batch ids. A batch that is
    replayed after a crash replaces its own rows, and a restart from a new checkpoint gets
    ids of its own instead of replacing another run's. Only the first batch after a start can
    be a replay, so only that one looks for rows of its own.

    With a log, both sides are written under an id of this attempt and become visible by one commit. A batch
    that was committed before a crash is not written again, and nothing is ever deleted.
    """
    bronze = bronze_schema(contract, tables.drift).fieldNames()
    written: set[int] = set()
    quarantine = quarantine_schema(contract).fieldNames()

    def write(batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        spark = batch.sparkSession
        load_id = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        fresh = bool(written) or log is not None
        if log is not None:
            if not written and log.committed(load_id):
                written.add(batch_id)
                return
            batch_load, load_id = load_id, f"{load_id}-{uuid.uuid4().hex[:8]}"
        # Cached for three short reads: compressing the columns would cost more than decoding them did.
        # The setting is that of the stream's own session.
        spark.conf.set("spark.sql.inMemoryColumnarStorage.compressed", "false")
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = batch.agg(*count_columns(), F.max(F.unix_micros("ingested_at")).alias("clock")).first()
            if counts["total"] == 0:
                written.add(batch_id)
                return
            # One clock for all rows: as a literal its date needs no sort before the partitioned write.
            clocked = batch.withColumn("ingested_at", F.timestamp_micros(F.lit(counts["clock"])))
            for table, columns, side, rows, partitioning in (
                (tables.bronze, bronze, F.col(VALID), counts["valid"], tables.partitioning),
                (
                    tables.quarantine,
                    quarantine,
                    ~F.col(VALID),
                    counts["invalid"],
                    tables.quarantine_partitioning,
                ),
            ):
                if rows:
                    load = clocked.filter(side).select(*columns)
                    replace_load(load, table, load_id, partitioning, tables.provider, fresh)
                elif not fresh:
                    drop_load(spark, table, load_id, tables.provider)
            if stats_table:
                line = (batch_id, counts["total"], counts["valid"], counts["invalid"], time.monotonic() - started)
                stats = spark.createDataFrame([line], STATS_SCHEMA)
                replace_load(stats, stats_table, load_id, (), tables.provider, fresh)
            if log is not None:
                log.commit_load(batch_load, load_id, counts["valid"], counts["invalid"])
            written.add(batch_id)
        finally:
            batch.unpersist()

    return write


def start_contract_stream(
    messages: DataFrame,
    contract: Contract,
    tables: Tables,
    checkpoint: str,
    stats_table: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    as_of: Column | None = None,
    avro_schema: str | None = None,
    decode_check: bool = True,
    log: CommitLog | None = None,
) -> StreamingQuery:
    """Route a message stream into the contract's tables; with a log, each batch is one commit of both."""
    tagged = tag_messages(messages, contract, as_of, avro_schema, decode_check, tables.drift)
    writer = tagged.writeStream.foreachBatch(batch_writer(contract, tables, stats_table, log))
    return with_trigger(writer.option("checkpointLocation", checkpoint), trigger).start()

