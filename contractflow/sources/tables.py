"""Bronze and quarantine tables: layout, creation, replay-safe loads, widening, retention."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.functions import instant, require_utc, timestamp
from contractflow.operators.routing import DRIFT
from contractflow.plans import Contract, ContractError, active_contracts

LOAD_ID, BUCKET = "load_id", "load_bucket"
RETENTION_DAYS = 90

# Loads share this many partitions of each day, however many loads a day has.
LOAD_BUCKETS = 16

# Providers whose tables take DataFrameWriterV2, hidden partitions and row-level replacement.
V2_PROVIDERS = ("iceberg", "delta")

_AUDIT = [
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("schema_version", T.StringType()),
    T.StructField("source_format", T.StringType()),
]


def bronze_schema(contract: Contract, drift: bool = False) -> T.StructType:
    """The contract's fields and three audit columns; required-ness is left to the rules.

    ``drift`` adds a map of the fields that messages carry and the contract does not know.
    """
    unknown = [T.StructField(DRIFT, T.MapType(T.StringType(), T.StringType()))] if drift else []
    return T.StructType([T.StructField(f.name, f.dataType) for f in contract.schema()] + _AUDIT + unknown)


def quarantine_schema(contract: Contract | None = None) -> T.StructType:
    """Five fixed columns; binary payloads, which text cannot hold unharmed, are kept as base64 too."""
    kept_bytes = [T.StructField("raw_payload_base64", T.StringType())] if contract and contract.format == "avro" else []
    return T.StructType(
        [
            T.StructField("raw_payload", T.StringType()),
            *_AUDIT,
            T.StructField("validation_errors", T.ArrayType(T.StringType())),
            *kept_bytes,
        ]
    )


def date_column(transform: str) -> tuple[str, str]:
    """``days(x)`` as the derived date column and its source."""
    found = re.fullmatch(r"days\((\w+)\)", transform.strip())
    if found is None:
        raise ValueError(f"unsupported partitioning {transform!r}; use days(<column>)")
    return f"{found.group(1)}_date", found.group(1)


def stored_dates(schema: T.StructType, partitioning: Sequence[str], provider: str) -> list[tuple[str, str]]:
    """The date columns a table has to store: all of them, but where the provider derives them itself.

    V2 providers partition by the day of a time, not by the day of a text that holds one.
    """
    dates = [date_column(transform) for transform in partitioning]
    if provider not in V2_PROVIDERS:
        return dates
    return [(name, source) for name, source in dates if isinstance(schema[source].dataType, T.StringType)]


def with_dates(df: DataFrame, dates: Sequence[tuple[str, str]]) -> DataFrame:
    """Add date columns derived from other columns; a day is a day in UTC."""
    require_utc(df.sparkSession)
    derived = {name: F.to_date(timestamp(F.col(source), df.schema[source].dataType)) for name, source in dates}
    return df.withColumns(derived) if derived else df


def namespace_statements(table: str) -> list[str]:
    """``CREATE`` statements for a table's namespaces, outermost first."""
    parts = table.split(".")[:-1]
    if not parts:
        return []
    first = 2 if len(parts) >= 3 else len(parts)
    return [
        f"CREATE NAMESPACE IF NOT EXISTS {'.'.join(f'`{p}`' for p in parts[:depth])}"
        for depth in range(first, len(parts) + 1)
    ]


def table_ddl(
    table: str,
    schema: T.StructType,
    partitioning: Sequence[str] = (),
    provider: str = "parquet",
    properties: dict[str, str] | None = None,
) -> str:
    """``CREATE TABLE`` for a schema.

    V2 providers take the partition transforms as they are. Elsewhere a dated table is partitioned by
    the derived dates, so that queries prune and days expire, and below them by a bounded number of
    load buckets, so that a load is found again without reading its whole day.
    """
    stored = [name for name, _ in stored_dates(schema, partitioning, provider)]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    columns += [f"`{LOAD_ID}` string", *[f"`{name}` date" for name in stored]]
    partitions = []
    for transform in partitioning:
        name, _ = date_column(transform)
        partitions.append(f"`{name}`" if name in stored else transform)
    if partitions and provider not in V2_PROVIDERS:
        columns.append(f"`{BUCKET}` int")
        partitions.append(f"`{BUCKET}`")
    clauses = [f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING {provider}"]
    if partitions:
        clauses.append(f"PARTITIONED BY ({', '.join(partitions)})")
    if properties:
        clauses.append("TBLPROPERTIES (" + ", ".join(f"'{k}'='{v}'" for k, v in properties.items()) + ")")
    return " ".join(clauses)


class Tables(NamedTuple):
    """Names of a contract's tables and how they are laid out."""

    bronze: str
    quarantine: str
    partitioning: tuple[str, ...] = ()
    provider: str = "parquet"
    drift: bool = False

    @property
    def quarantine_partitioning(self) -> tuple[str, ...]:
        """Quarantine has no payload fields, only the dates of its audit columns."""
        return tuple(t for t in self.partitioning if date_column(t)[1] == "ingested_at")


# Table properties of the bronze table.
BRONZE_PROPERTIES = {
    "write.format.default": "parquet",
    "history.expire.max-snapshot-age-ms": "604800000",
    "write.spark.accept-any-schema": "true",
}


def provision(spark: SparkSession, contract: Contract, tables: Tables | None = None) -> Tables:
    """Create the namespaces and both tables of a contract, where they are missing.

    A table that is there already gets the columns that the contract has gained since.
    """
    tables = tables or Tables(contract.table, contract.quarantine_table, contract.partitioning)
    iceberg = tables.provider == "iceberg"
    for table, schema, partitioning, properties in (
        (tables.bronze, bronze_schema(contract, tables.drift), tables.partitioning, BRONZE_PROPERTIES),
        (
            tables.quarantine,
            quarantine_schema(contract),
            tables.quarantine_partitioning,
            {"write.format.default": "parquet"},
        ),
    ):
        for statement in namespace_statements(table):
            spark.sql(statement)
        spark.sql(table_ddl(table, schema, partitioning, tables.provider, properties if iceberg else None))
        widen(spark, table, schema)
    return tables


def provision_all(
    spark: SparkSession, contracts: Iterable[Contract], provider: str = "parquet"
) -> tuple[list[Tables], dict[str, str]]:
    """Create the tables of every contract's highest active version; those that fail are reported, the others go on."""
    done: list[Tables] = []
    active, failed = active_contracts(contracts)
    for contract in active:
        try:
            if not contract.table or not contract.quarantine_table:
                raise ContractError("the contract names no tables")
            tables = Tables(contract.table, contract.quarantine_table, contract.partitioning, provider)
            done.append(provision(spark, contract, tables))
        except (ContractError, ValueError, PySparkException) as error:
            failed[contract.name] = f"{type(error).__name__}: {error}"
    return done, failed


def replace_load(
    df: DataFrame,
    table: str,
    load_id: str,
    partitioning: Sequence[str] = (),
    provider: str = "parquet",
    fresh: bool = False,
) -> None:
    """Append one load, replacing whatever an earlier attempt of the same load left behind.

    ``fresh`` says that there can be no earlier attempt, which spares looking for one. Columns that the
    table lacks are added to it first, columns that the load lacks are null, and a column of another
    type raises: no value is lost without a word.

    A load usually falls on one ingestion date, so it is written as it is partitioned. Event dates
    can be many: rows are then rebalanced by date first, which keeps a day's rows in few files
    and lets adaptive execution split a day that is too large.
    """
    spark = df.sparkSession
    if not fresh:
        drop_load(spark, table, load_id, provider)
    dates = stored_dates(df.schema, partitioning, provider)
    widen(spark, table, df.schema)
    load = with_dates(df, dates).withColumn(LOAD_ID, F.lit(load_id))
    if provider in V2_PROVIDERS:
        load.writeTo(table).option("mergeSchema", "true").append()
        return
    scattered = [name for name, source in dates if source != "ingested_at"]
    if scattered:
        load = load.hint("rebalance", *scattered)
    stored = spark.table(table).schema
    load = load.withColumn(BUCKET, F.lit(load_bucket(load_id)))
    known = {name.lower(): name for name in load.columns}
    filled = [
        F.col(f"`{known[f.name.lower()]}`") if f.name.lower() in known else F.lit(None).cast(f.dataType).alias(f.name)
        for f in stored
    ]
    load.select(*filled).write.insertInto(table)


def load_bucket(load_id: str) -> int:
    return zlib.crc32(load_id.encode()) % LOAD_BUCKETS


def drop_load(spark: SparkSession, table: str, load_id: str, provider: str = "parquet") -> None:
    """Remove the rows of a load, if there are any.

    A file of a Parquet table holds rows of one load only, so the load's files are removed; the bucket
    keeps the search to a fraction of each day.
    """
    held = spark.table(table).where(F.col(LOAD_ID) == load_id)
    if BUCKET in held.columns:
        held = held.where(F.col(BUCKET) == load_bucket(load_id))
    if provider in V2_PROVIDERS:
        if not held.isEmpty():
            spark.sql(f"DELETE FROM {table} WHERE {LOAD_ID} = '{load_id}'")
        return
    drop_files(spark, table, held.select(F.col("_metadata.file_path").alias("file")).distinct())


def drop_files(spark: SparkSession, table: str, files: DataFrame) -> int:
    """Remove files of a Parquet table, those of a single load or of expired ones; returns how many."""
    jvm, dropped = spark.sparkContext._jvm, 0
    for row in files.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["file"]))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
        dropped += 1
    if dropped:
        spark.catalog.refreshTable(table)
    return dropped


def append(df: DataFrame, table: str, partitioning: Sequence[str] = (), provider: str = "parquet") -> None:
    """Append a batch under a load id of its own."""
    replace_load(df, table, uuid.uuid4().hex, partitioning, provider, fresh=True)


def widen(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Add the columns a table does not have yet; returns their names. A column of another type raises."""
    known = {f.name.lower(): f for f in spark.table(table).schema}
    added = [f for f in schema if f.name.lower() not in known]
    for f in schema:
        stored = known.get(f.name.lower())
        if stored is not None and stored.dataType.simpleString() != f.dataType.simpleString():
            raise ContractError(
                f"{table}: column {f.name!r} is {stored.dataType.simpleString()}, not {f.dataType.simpleString()}"
            )
    if added:
        spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({spec})")
    return [f.name for f in added]


def union_widened(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows written before and after a schema grew, under the wider schema."""
    return old.select("*").unionByName(new, allowMissingColumns=True)


def retained(df: DataFrame, as_of: datetime | Column, days: int = RETENTION_DAYS, column: str = "ingested_at") -> DataFrame:
    """Rows still inside the retention period.

    The bound is a constant compared with the bare column, so it reaches the scan; a derived
    date column next to it is bounded as well, which prunes whole partitions.
    """
    require_utc(df.sparkSession)
    bound = instant(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    kept = F.col(column) >= bound.cast(df.schema[column].dataType)
    if f"{column}_date" in df.columns:
        kept = kept & (F.col(f"{column}_date") >= F.to_date(bound))
    return df.filter(kept)


def retention_days(contract: Contract) -> int:
    """The period that the contract's SLA states (``90 days``), else ninety days."""
    stated = contract.sla.get("retentionPeriod")
    if stated is None:
        return RETENTION_DAYS
    found = re.fullmatch(r"\s*(\d+)\s*(days?|d)\s*", str(stated))
    if found is None:
        raise ContractError(f"contract {contract.name!r}: retention period {stated!r} is no number of days")
    return int(found.group(1))


def drop_expired(
    spark: SparkSession,
    table: str,
    as_of: datetime,
    days: int = RETENTION_DAYS,
    column: str = "ingested_at",
    provider: str = "parquet",
) -> int:
    """Remove what lies wholly before the period; returns the partitions and files removed.

    V2 tables delete by row. Of Parquet tables the partitions of expired days go in one statement. Rows without
    a date, where ``column`` is null, expire by the time they were ingested: a load has one such time,
    and a file one load, so whole files go.
    """
    bound = (as_of - timedelta(days=days)).date().isoformat()
    if provider in V2_PROVIDERS:
        expired = f"{column} < TIMESTAMP '{bound} 00:00:00'"
        if column != "ingested_at":
            expired += f" OR ({column} IS NULL AND ingested_at < TIMESTAMP '{bound} 00:00:00')"
        spark.sql(f"DELETE FROM {table} WHERE {expired}")
        return 0
    name = f"{column}_date"
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    day = F.regexp_extract("partition", rf"{name}=(\d{{4}}-\d{{2}}-\d{{2}})", 1)
    specs = []
    for row in listed.filter((day != "") & (day < bound)).toLocalIterator():
        parts = [part.split("=", 1) for part in row["partition"].split("/")]
        specs.append("PARTITION (" + ", ".join(_equals(*part) for part in parts) + ")")
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
    undated = 0
    if column != "ingested_at":
        held = spark.table(table).where(F.col(name).isNull()).groupBy(F.col("_metadata.file_path").alias("file"))
        old = held.agg(F.max("ingested_at").alias("last")).where(F.to_date("last") < F.lit(bound).cast("date"))
        undated = drop_files(spark, table, old.select("file"))
    return len(specs) + undated


def _equals(name: str, value: str) -> str:
    return f"`{name}` = null" if value == "__HIVE_DEFAULT_PARTITION__" else f"`{name}` = '{value}'"
