from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("contractflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    for row in session.sql("SHOW DATABASES LIKE 'cf_*'").collect():
        session.sql(f"DROP DATABASE {row[0]} CASCADE")


@pytest.fixture
def database(spark):
    from suite.tables import new_database

    name = new_database(spark)
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
