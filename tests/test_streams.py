"""Streams over several files: same rows as a batch, nothing twice after a crash, one clock."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from contractflow import contract_from_dict, scratch, validate
from contractflow.operators import decode_contract, event_schema
from contractflow.operators.decode import PAYLOAD
from contractflow.plans import DOMAINS
from contractflow.sources import (
    Tables,
    as_messages,
    file_sink,
    file_stream,
    kafka_sink,
    kafka_stream,
    provision,
    table_stream,
)
from contractflow.sources import kafka as K
from contractflow.streaming import domain_stream, provision_stats, start_contract_stream, start_domain_streams
from suite import streams
from suite.mappings import domain_messages_of

SF = "/root/testdata/sf0.001"
CONTRACT = contract_from_dict(
    {
        "info": {"title": "numbers", "version": "1"},
        "kafkaTopic": "bronze.test.numbers",
        "format": "json",
        "storage": {"partitioning": ["days(ingested_at)"]},
        "schema": {"fields": [{"name": "id", "type": "long"}, {"name": "seen"}]},
        "quality": {
            "rules": [{"name": "small", "expr": "id < 700"}, {"name": "past", "expr": "seen < now()"}]
        },
    }
)


def write_messages(spark, path: str, start: int, end: int, seen: str = "2020-01-01T00:00:00Z") -> None:
    rows = spark.range(start, end, 1, 2)
    value = F.to_json(F.struct("id", F.lit(seen).alias("seen")))
    as_messages(rows, F.col("id"), value, CONTRACT.topic, F.col("id"), F.lit(datetime(2024, 1, 1))).write.mode(
        "append"
    ).parquet(path)


def new_tables(spark, database) -> Tables:
    return provision(spark, CONTRACT, Tables(f"{database}.numbers", f"{database}.numbers_q", CONTRACT.partitioning))


def run(spark, path, tables, checkpoint, stats=None, one_file=False):
    source = file_stream(spark, path, {"maxFilesPerTrigger": "1"} if one_file else None)
    start_contract_stream(source, CONTRACT, tables, checkpoint, stats, trigger=None).awaitTermination()
    for name in (tables.bronze, tables.quarantine, *([stats] if stats else [])):
        spark.catalog.refreshTable(name)


def test_stream_equals_batch_and_restart_adds_only_new_rows(spark, database, tmp_path):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    tables, stats = new_tables(spark, database), provision_stats(spark, f"{database}.stats")
    write_messages(spark, path, 0, 600)
    write_messages(spark, path, 600, 1000)
    run(spark, path, tables, checkpoint, stats, one_file=True)

    batch = validate(decode_contract(spark.read.parquet(path), CONTRACT), CONTRACT, datetime(2024, 1, 1), PAYLOAD)
    assert {r.id for r in spark.table(tables.bronze).collect()} == {
        r.id for r in batch.filter("is_valid").select("parsed_payload.id").collect()
    }
    assert (spark.table(tables.bronze).count(), spark.table(tables.quarantine).count()) == (700, 300)
    lines = spark.table(stats).orderBy("batch_id").collect()
    assert len(lines) > 1 and [r.batch_id for r in lines] == list(range(len(lines)))
    assert sum(r.total for r in lines) == 1000 and sum(r.valid for r in lines) == 700
    assert all(r.total == r.valid + r.invalid and r.duration_seconds > 0 for r in lines)

    run(spark, path, tables, checkpoint, stats)
    assert spark.table(tables.bronze).count() == 700

    write_messages(spark, path, 1000, 1100)
    run(spark, path, tables, checkpoint, stats)
    assert (spark.table(tables.bronze).count(), spark.table(tables.quarantine).count()) == (700, 400)


def test_crash_between_the_two_writes(spark, database, tmp_path):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    tables = new_tables(spark, database)
    write_messages(spark, path, 0, 1000)
    spark.sql(f"DROP TABLE {tables.quarantine}")
    source = file_stream(spark, path)
    with pytest.raises(StreamingQueryException):
        start_contract_stream(source, CONTRACT, tables, checkpoint, trigger=None).awaitTermination()
    first = spark.table(tables.bronze).select("ingested_at").distinct().collect()
    assert spark.table(tables.bronze).count() == 700

    provision(spark, CONTRACT, tables)
    run(spark, path, tables, checkpoint)
    assert (spark.table(tables.bronze).count(), spark.table(tables.quarantine).count()) == (700, 300)
    assert spark.table(tables.bronze).select("ingested_at").distinct().collect() == first  # the batch keeps its clock
    assert spark.table(tables.quarantine).select("ingested_at").distinct().collect() == first


def test_two_runs_do_not_replace_each_other(spark, database, tmp_path):
    path = str(tmp_path / "topic")
    tables = new_tables(spark, database)
    write_messages(spark, path, 0, 100)
    run(spark, path, tables, str(tmp_path / "one"))
    run(spark, path, tables, str(tmp_path / "two"))
    assert spark.table(tables.bronze).count() == 200


def test_no_row_falls_between_the_sides_at_the_clock(spark, database, tmp_path):
    """Times a moment ahead of the batch end up on one side only, whichever it is."""
    path = str(tmp_path / "topic")
    tables = new_tables(spark, database)
    ahead = spark.sql("SELECT date_format(current_timestamp() + INTERVAL 2 SECONDS, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")")
    write_messages(spark, path, 0, 500, ahead.first()[0])
    run(spark, path, tables, str(tmp_path / "checkpoint"))
    assert spark.table(tables.bronze).count() + spark.table(tables.quarantine).count() == 500


def test_empty_source(spark, database, tmp_path):
    path = str(tmp_path / "topic")
    tables = new_tables(spark, database)
    write_messages(spark, path, 0, 0)
    run(spark, path, tables, str(tmp_path / "checkpoint"))
    assert spark.table(tables.bronze).isEmpty() and spark.table(tables.quarantine).isEmpty()


def test_one_sided_batches(spark, database, tmp_path):
    path = str(tmp_path / "topic")
    tables = new_tables(spark, database)
    write_messages(spark, path, 700, 800)
    run(spark, path, tables, str(tmp_path / "checkpoint"))
    assert (spark.table(tables.bronze).count(), spark.table(tables.quarantine).count()) == (0, 100)
    row = spark.table(tables.quarantine).first()
    assert row.raw_payload.startswith('{"id":7') and row.validation_errors == ["RANGE_VIOLATION [small]: 'id' failed 'id < 700'"]


def test_domain_stream_equals_batch_and_replays_exactly_once(spark, tmp_path):
    domain = DOMAINS["sales.transactions"]
    path, out = str(tmp_path / "topic"), str(tmp_path / "out")
    events = domain_messages_of(spark, SF, domain.name)
    events.write.parquet(path)
    schema = event_schema(domain)
    clock = F.lit(datetime(2024, 1, 1))
    for _ in range(2):
        queries = start_domain_streams(
            {domain.name: file_stream(spark, path)},
            {domain.name: schema},
            lambda m, name: file_sink(m, out, str(tmp_path / "checkpoint"), trigger=None),
            clock,
        )
        assert len(queries) == 1
        queries[0].awaitTermination()
    batch = domain_stream(spark.read.parquet(path), domain, schema, clock)
    got = spark.read.parquet(out).select("key", "value", "topic")
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
    assert got.count() == events.count()


def test_domain_streams_write_with_open_files_instead_of_a_sort(spark, tmp_path, monkeypatch):
    """The limit on open files is above a stream's two topics while it writes, and as it was afterwards."""
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    row = {"event_id": [1, 2, 300], "user_id": [7, 12, 19], "value": [30.0, None, 900.0]}
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = [(e, datetime(2024, 1, 1), u, "click", v, None) for e, u, v in zip(*row.values(), strict=True)]
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "events.parquet"))

    def sink(messages, path, checkpoint, trigger):
        running = file_sink(messages, path, checkpoint, trigger=trigger)
        running.awaitTermination()
        seen.append(int(spark.conf.get(name)))
        return running

    monkeypatch.setattr(streams, "file_sink", sink)
    for before in (None, "5"):
        if before:
            spark.conf.set(name, before)
        try:
            routed = streams.stream_domain(spark, str(tmp_path)).collect()
            assert spark.conf.get(name, None) == before
        finally:
            spark.conf.unset(name)
        assert sorted((r.key, r.topic.split(".")[0]) for r in routed) == [("E1", "dlq"), ("E300", "dlq"), ("R2", "silver")]
    assert seen == [K.OPEN_FILES, K.OPEN_FILES] and K.OPEN_FILES > 2


def test_kafka_options(spark, monkeypatch):
    """Kafka's package is absent here; the options that would reach it are what can be checked."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return "stream"

    class Session:
        readStream = Reader()

    assert kafka_stream(Session(), "bronze.a.b", "host:9092") == "stream"
    assert seen == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "bronze.a.b",
        "startingOffsets": "latest",
    }
    K.contract_topic_stream(Session(), "bronze.a.b", "host:9092")
    assert seen["failOnDataLoss"] == "false"


def test_kafka_without_its_package_says_so(spark, tmp_path):
    with pytest.raises(Exception, match="kafka"):
        kafka_stream(spark, "bronze.a.b", "host:9092")
    path = str(tmp_path / "topic")
    write_messages(spark, path, 0, 1)
    with pytest.raises(Exception, match="kafka"):
        kafka_sink(file_stream(spark, path), "host:9092", str(tmp_path / "checkpoint"), trigger=None)


def test_scratch_is_under_the_shared_folder(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch(spark, "x") != scratch(spark, "x")


def test_table_stream_reads_a_file_and_a_folder(spark, tmp_path):
    folder = str(tmp_path / "tables")
    spark.range(10).repartition(3).write.parquet(f"{folder}/many.parquet")
    spark.range(0).write.parquet(f"{folder}/none.parquet")
    for where, name, expected in ((folder, "many.parquet", 10), (folder, "none.parquet", 0), (SF, "nation.parquet", 25)):
        stream = table_stream(spark, where, name)
        seen = str(tmp_path / f"seen-{name}")
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"cp-{name}"))
        query.option("path", seen).trigger(availableNow=True).start().awaitTermination()
        assert spark.read.schema(stream.schema).parquet(seen).count() == expected


def test_the_users_session_keeps_its_settings(spark, database, tmp_path):
    before = spark.conf.get("spark.sql.inMemoryColumnarStorage.compressed")
    held = spark.sparkContext._jsc.sc().getPersistentRDDs
    cached = held().size()
    path = str(tmp_path / "topic")
    write_messages(spark, path, 0, 10)
    run(spark, path, new_tables(spark, database), str(tmp_path / "checkpoint"))
    assert spark.conf.get("spark.sql.inMemoryColumnarStorage.compressed") == before
    assert held().size() == cached
