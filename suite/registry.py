"""Register a query under its function name, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from contractflow import pin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CONTRACTS = Path(__file__).resolve().parent.parent / "contracts"
AS_OF = datetime(2024, 1, 25)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def reason_sql(separator: str, violations: list[tuple[str, str]]) -> str:
    """The joined messages of the conditions that hold."""
    cases = ", ".join(f"CASE WHEN {condition} THEN {quote(message)} END" for condition, message in violations)
    return f"concat_ws({quote(separator)}, {cases})"
