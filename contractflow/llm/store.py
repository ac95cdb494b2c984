"""Tables kept in the folder that the cluster shares, so that a lost executor costs one task and no lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; only where that is unset, under the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


ROWS_A_TASK = 20_000


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df, written once as Parquet and read from there.

    ``rows`` is for a few numbers a row, of which there are about so many: as many tasks as that asks for write
    them, and not all of a session's shuffle partitions.
    """
    spark = df.sparkSession
    path = folder(spark, name)
    out = df if rows is None else df.coalesce(-(-rows // ROWS_A_TASK) or 1)
    out.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made; what was computed from them has been written by then."""
    for table in tables:
        remove(table.sparkSession, table.stored_at)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of few rows for the jobs run inside, so that Python and the JVM hold little of a task's texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
