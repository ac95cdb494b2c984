"""Message streams in and out.

Kafka itself and the file stand-ins share one column layout, so everything behind the source
is the same for both.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)
DEFAULT_TRIGGER = "30 seconds"
# Above the two topics of a stream: a task that reaches this number of open files sorts the rest of its rows.
OPEN_FILES = 8


def kafka_stream(
    spark: SparkSession, topic: str, servers: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Subscribe to one topic from its latest offset; ``options`` override and add."""
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest"}
    return spark.readStream.format("kafka").options(**{**settings, **(options or {})}).load()


def contract_topic_stream(spark: SparkSession, topic: str, servers: str) -> DataFrame:
    """The contract path goes on when old offsets have been deleted."""
    return kafka_stream(spark, topic, servers, {"failOnDataLoss": "false"})


def file_stream(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Messages in the same layout, from a folder of Parquet files."""
    return spark.readStream.schema(MESSAGE_SCHEMA).options(**(options or {})).parquet(path)


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder as a stream, with the table's own columns.

    The table is a folder of files, or a single file: the file source reads folders only, so a
    single file is picked out of the folder it lies in.
    """
    table = spark.read.parquet(f"{folder}/{name}")
    stream = spark.readStream.schema(table.schema)
    first = table.select("_metadata.file_name").first()
    if first is not None and first.file_name == name:
        return stream.option("pathGlobFilter", name).parquet(folder)
    return stream.parquet(f"{folder}/{name}")


def as_messages(df: DataFrame, key: Column, value: Column, topic: str, offset: Column, at: Column) -> DataFrame:
    """Rows in the message layout."""
    return df.select(
        key.cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("long").alias("offset"),
        at.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def with_trigger(writer: DataStreamWriter, trigger: str | None = DEFAULT_TRIGGER) -> DataStreamWriter:
    """A processing-time interval, or None to work off what is there and stop."""
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def kafka_sink(
    messages: DataFrame,
    servers: str,
    checkpoint: str,
    topic: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Append ``key`` and ``value`` to one topic, or to the topic each row names."""
    names = ["key", "value"] + ([] if topic else ["topic"])
    writer = messages.select(*names).writeStream.format("kafka").outputMode("append")
    writer = writer.option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)
    if topic:
        writer = writer.option("topic", topic)
    return with_trigger(writer, trigger).start()


def file_sink(
    messages: DataFrame, path: str, checkpoint: str, trigger: str | None = DEFAULT_TRIGGER
) -> StreamingQuery:
    """The same as Parquet files, one folder per topic; the file sink's log makes it exactly-once."""
    writer = messages.writeStream.format("parquet").outputMode("append").partitionBy("topic")
    return with_trigger(writer.option("path", path).option("checkpointLocation", checkpoint), trigger).start()


@contextmanager
def open_topics(spark: SparkSession, files: int = OPEN_FILES) -> Iterator[None]:
    """File sinks that run inside keep a file open for each topic.

    Without it a task sorts all its rows by topic before it writes, which holds or spills the whole split. The sink
    reads the setting when a batch is written, so the queries have to end inside.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    if before is None or int(before) < files:
        spark.conf.set(name, str(files))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
