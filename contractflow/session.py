"""Session helpers: the one time zone every rule assumes, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def pin(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC; zone-less times in tables and payloads are read as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder, or without one, under the warehouse.

    Both are seen by every executor; a folder of one machine would not be.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{base.rstrip('/')}/contractflow/{name}-{uuid.uuid4().hex}"
