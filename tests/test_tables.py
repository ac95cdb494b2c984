"""Table layout, replaceable loads, widening, retention."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow import contract_from_dict
from contractflow.plans import ContractError
from contractflow.sources import (
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
from contractflow.sources.tables import LOAD_BUCKETS

CONTRACT = contract_from_dict(
    {
        "schema": {"fields": [{"name": "id", "type": "long"}, {"name": "at", "type": "string"}]},
        "storage": {"partitioning": ["days(ingested_at)", "days(at)"]},
    }
)


def test_layouts():
    assert [(f.name, f.dataType.simpleString()) for f in bronze_schema(CONTRACT)] == [
        ("id", "bigint"),
        ("at", "string"),
        ("ingested_at", "timestamp"),
        ("schema_version", "string"),
        ("source_format", "string"),
    ]
    assert CONTRACT.format == "avro" and quarantine_schema(CONTRACT).fieldNames()[-1] == "raw_payload_base64"
    assert [(f.name, f.dataType.simpleString()) for f in quarantine_schema()] == [
        ("raw_payload", "string"),
        ("ingested_at", "timestamp"),
        ("schema_version", "string"),
        ("source_format", "string"),
        ("validation_errors", "array<string>"),
    ]


def test_ddl():
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ingested_at", T.TimestampType())])
    assert table_ddl("a.b", schema, ["days(ingested_at)"]) == (
        "CREATE TABLE IF NOT EXISTS a.b (`id` bigint, `ingested_at` timestamp, `load_id` string, "
        "`ingested_at_date` date, `load_bucket` int) USING parquet PARTITIONED BY (`ingested_at_date`, `load_bucket`)"
    )
    assert table_ddl("c.a.b", schema, ["days(ingested_at)"], "iceberg", {"k": "v"}) == (
        "CREATE TABLE IF NOT EXISTS c.a.b (`id` bigint, `ingested_at` timestamp, `load_id` string) USING iceberg "
        "PARTITIONED BY (days(ingested_at)) TBLPROPERTIES ('k'='v')"
    )
    text_time = T.StructType([T.StructField("at", T.StringType())])
    assert table_ddl("c.a.b", text_time, ["days(at)"], "iceberg") == (
        "CREATE TABLE IF NOT EXISTS c.a.b (`at` string, `load_id` string, `at_date` date) USING iceberg "
        "PARTITIONED BY (`at_date`)"
    )
    with pytest.raises(ValueError, match="unsupported partitioning"):
        table_ddl("a.b", schema, ["bucket(4, id)"])


def test_namespaces():
    assert namespace_statements("lake.bronze.sensors.alerts") == [
        "CREATE NAMESPACE IF NOT EXISTS `lake`.`bronze`",
        "CREATE NAMESPACE IF NOT EXISTS `lake`.`bronze`.`sensors`",
    ]
    assert namespace_statements("lake.sensors.alerts") == ["CREATE NAMESPACE IF NOT EXISTS `lake`.`sensors`"]
    assert namespace_statements("sensors.alerts") == ["CREATE NAMESPACE IF NOT EXISTS `sensors`"]
    assert namespace_statements("alerts") == []


def bronze_rows(spark, count: int):
    return spark.range(count).select(
        "id",
        F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string"), F.lit("T10:00:00Z")).alias("at"),
        F.lit(datetime(2024, 1, 25)).alias("ingested_at"),
        F.lit("1").alias("schema_version"),
        F.lit("json").alias("source_format"),
    )


def test_loads_replace_themselves_only(spark, database):
    tables = provision(spark, CONTRACT, Tables(f"{database}.b", f"{database}.q", CONTRACT.partitioning))
    assert tables.quarantine_partitioning == ("days(ingested_at)",)
    replace_load(bronze_rows(spark, 30), tables.bronze, "x", tables.partitioning)
    replace_load(bronze_rows(spark, 6), tables.bronze, "y", tables.partitioning)
    assert spark.table(tables.bronze).count() == 36
    replace_load(bronze_rows(spark, 1), tables.bronze, "x", tables.partitioning)
    by_load = {r.load_id: r["count"] for r in spark.table(tables.bronze).groupBy("load_id").count().collect()}
    assert by_load == {"x": 1, "y": 6}
    drop_load(spark, tables.bronze, "z")
    replace_load(bronze_rows(spark, 0), tables.bronze, "x", tables.partitioning)
    assert spark.table(tables.bronze).filter("load_id = 'x'").isEmpty()
    drop_load(spark, tables.bronze, "x")
    days = spark.table(tables.bronze).select("at_date").distinct().orderBy("at_date").collect()
    assert [str(r.at_date) for r in days] == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_date_filter_prunes_partitions(spark, database):
    name = f"{database}.b"
    spark.sql(table_ddl(name, bronze_schema(CONTRACT), ["days(at)"]))
    append(bronze_rows(spark, 30), name, ["days(at)"])
    plan = spark.table(name).filter("at_date = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(at_date" in plan
    assert spark.table(name).filter("at_date = '2024-01-02'").count() == 10


def test_provision_twice_keeps_rows(spark, database):
    tables = Tables(f"{database}.b", f"{database}.q", CONTRACT.partitioning)
    provision(spark, CONTRACT, tables)
    append(bronze_rows(spark, 3), tables.bronze, tables.partitioning)
    provision(spark, CONTRACT, tables)
    assert spark.table(tables.bronze).count() == 3


def test_widening(spark, database):
    name = f"{database}.w"
    old = spark.range(3)
    new = spark.range(3, 5).withColumn("note", F.lit("n"))
    spark.sql(table_ddl(name, old.schema))
    append(old, name)
    assert widen(spark, name, new.schema) == ["note"]
    assert widen(spark, name, new.schema) == []
    append(new, name)
    got = {(r.id, r.note) for r in spark.table(name).collect()}
    assert got == {(0, None), (1, None), (2, None), (3, "n"), (4, "n")}
    assert {(r.id, r.note) for r in union_widened(old, new).collect()} == got


def test_retention_boundary(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 15)), (2, datetime(2024, 1, 14, 23, 59, 59)), (3, datetime(2030, 1, 1)), (4, None)],
        "id int, ingested_at timestamp",
    )
    assert [r.id for r in retained(df, datetime(2024, 1, 25), 10).orderBy("id").collect()] == [1, 3]


def test_expired_partitions(spark, database):
    name = f"{database}.d"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ingested_at", T.TimestampType())])
    spark.sql(table_ddl(name, schema, ["days(ingested_at)"]))
    days = spark.range(10).withColumn("ingested_at", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400))
    append(days, name, ["days(ingested_at)"])
    append(days.filter("id < 5"), name, ["days(ingested_at)"])
    assert drop_expired(spark, name, datetime(2024, 1, 8), 3) in (4, 8)  # the two loads share their buckets or not
    assert sorted(r.id for r in spark.table(name).collect()) == [4, 4, 5, 6, 7, 8, 9]
    assert drop_expired(spark, name, datetime(2024, 1, 8), 3) == 0


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_load_is_replaced_whole_in_either_overwrite_mode(spark, database, mode):
    tables = provision(spark, CONTRACT, Tables(f"{database}.b", f"{database}.q", CONTRACT.partitioning))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        replace_load(bronze_rows(spark, 30), tables.bronze, "x", tables.partitioning)
        replace_load(bronze_rows(spark, 30).filter("id % 3 = 0"), tables.bronze, "x", tables.partitioning)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert sorted(r.id for r in spark.table(tables.bronze).collect()) == list(range(0, 30, 3))


def test_event_dates_are_rebalanced_into_few_files(spark, database):
    name = f"{database}.b"
    spark.sql(table_ddl(name, bronze_schema(CONTRACT), ["days(at)"]))
    append(bronze_rows(spark, 900).repartition(8), name, ["days(at)"])
    files = spark.table(name).select(F.input_file_name().alias("f")).distinct().count()
    assert files == 3 and spark.table(name).count() == 900


def test_provision_all_reports_what_fails(spark, database):
    def contract(title: str, table: str, partitioning=()) -> object:
        storage = {"icebergTable": table, "quarantineTable": f"{table}_q", "partitioning": list(partitioning)}
        return contract_from_dict({"info": {"title": title}, "storage": storage, "schema": {"fields": [{"name": "a"}]}})

    done, failed = provision_all(
        spark,
        [
            contract("good", f"{database}.good"),
            contract("odd", f"{database}.odd", ["bucket(3, a)"]),
            contract("nowhere", "no_catalog.x.y.z"),
            contract_from_dict({"info": {"title": "tableless"}}),
        ],
    )
    assert [t.bronze for t in done] == [f"{database}.good"]
    assert sorted(failed) == ["nowhere", "odd", "tableless"]


def test_a_load_with_new_columns_widens_the_table(spark, database):
    tables = provision(spark, CONTRACT, Tables(f"{database}.b", f"{database}.q", CONTRACT.partitioning))
    append(bronze_rows(spark, 3), tables.bronze, tables.partitioning)
    append(bronze_rows(spark, 3).withColumn("note", F.lit("n")), tables.bronze, tables.partitioning)
    append(bronze_rows(spark, 3).drop("schema_version"), tables.bronze, tables.partitioning)
    got = spark.table(tables.bronze).groupBy("note", "schema_version").count().collect()
    assert {(r.note, r.schema_version, r["count"]) for r in got} == {(None, "1", 3), ("n", "1", 3), (None, None, 3)}


def test_a_grown_contract_widens_its_table(spark, database):
    tables = provision(spark, CONTRACT, Tables(f"{database}.b", f"{database}.q", CONTRACT.partitioning))
    grown = contract_from_dict(
        {"schema": {"fields": [{"name": "id", "type": "long"}, {"name": "at"}, {"name": "new", "type": "double"}]}}
    )
    provision(spark, grown, tables)
    assert "new" in spark.table(tables.bronze).columns


def test_a_column_of_another_type_raises(spark, database):
    tables = provision(spark, CONTRACT, Tables(f"{database}.b", f"{database}.q", CONTRACT.partitioning))
    with pytest.raises(ContractError, match="column 'id' is bigint, not string"):
        append(bronze_rows(spark, 3).withColumn("id", F.lit("x")), tables.bronze, tables.partitioning)


def test_many_loads_share_the_buckets_of_their_day(spark, database):
    name = f"{database}.m"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ingested_at", T.TimestampType())])
    spark.sql(table_ddl(name, schema, ["days(ingested_at)"]))
    for i in range(200):
        row = spark.createDataFrame([(i, datetime(2024, 1, 1 + i % 2))], schema)
        replace_load(row, name, f"load-{i}", ["days(ingested_at)"], fresh=True)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() <= 2 * LOAD_BUCKETS
    assert spark.table(name).count() == 200
    drop_load(spark, name, "load-7")
    assert sorted(r.id for r in spark.table(name).collect()) == [i for i in range(200) if i != 7]


def test_rows_without_an_event_date_expire_by_their_load(spark, database):
    name = f"{database}.n"
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("at", T.StringType()), T.StructField("ingested_at", T.TimestampType())]
    )
    spark.sql(table_ddl(name, schema, ["days(at)"]))
    for day in (1, 20):
        rows = [(day, None, datetime(2024, 1, day)), (day + 100, f"2024-01-{day:02d}T00:00:00Z", datetime(2024, 1, day))]
        append(spark.createDataFrame(rows, schema), name, ["days(at)"])
    drop_expired(spark, name, datetime(2024, 1, 25), 10, "at")
    assert sorted(r.id for r in spark.table(name).collect()) == [20, 120]


def test_the_period_is_the_contracts(spark):
    stated = contract_from_dict({"sla": {"retentionPeriod": "14 days"}})
    assert (retention_days(stated), retention_days(contract_from_dict({}))) == (14, 90)
    with pytest.raises(ContractError, match="no number of days"):
        retention_days(contract_from_dict({"sla": {"retentionPeriod": "a while"}}))


def test_only_the_highest_active_version_is_provisioned(spark, database):
    def contract(version: str, status: str, field: str) -> object:
        storage = {"icebergTable": f"{database}.v", "quarantineTable": f"{database}.v_q"}
        return contract_from_dict({"info": {"title": "v", "version": version, "status": status}, "storage": storage, "schema": {"fields": [{"name": field}]}})

    done, skipped = provision_all(spark, [contract("1", "active", "a"), contract("2", "active", "b"), contract("3", "draft", "c")])
    assert len(done) == 1 and "b" in spark.table(f"{database}.v").columns and "c" not in spark.table(f"{database}.v").columns
    assert skipped == {"v 1": "a higher version is active", "v 3": "status is 'draft'"}
