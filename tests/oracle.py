"""Run a query on Spark and its SQL on DuckDB and compare names, types and the multiset of rows.

``python -m tests.oracle [folder] [query ...]`` checks from the command line.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _row(values: list) -> tuple:
    return tuple(round(v, 9) if isinstance(v, float) else v for v in values)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    wanted = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in con.description}
    rows = wanted.fetchall()
    names = list(theirs)
    ours = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    kinds = {name: (ours[name], theirs[name]) for name in names if ours[name] != theirs[name]}
    expected = Counter(_row(r) for r in rows)
    got = Counter(_row(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if got != expected:
        extra, missing = got - expected, expected - got
        return (
            f"rows {got.total()} vs {expected.total()}: {extra.total()} extra, e.g. {next(iter(extra), None)}; "
            f"{missing.total()} missing, e.g. {next(iter(missing), None)}"
        )
    return f"types {kinds}" if kinds else None


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("contractflow-check")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    from suite import ORACLES, QUERIES

    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        started = time.monotonic()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = difference(df, con, ORACLES[name]) if name in ORACLES else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001  a failing query is reported, the others still run
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.monotonic() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(names or QUERIES)} queries, {failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
