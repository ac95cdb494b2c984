"""Snapshots of both tables: crashes between the sides, later loads, compaction, conflicts, folded states, vacuum."""

from __future__ import annotations

from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from contractflow import scratch
from contractflow.sources import (
    CommitConflict,
    CommitLog,
    Tables,
    compact,
    file_stream,
    live_files,
    provision,
    replace_load,
    snapshot,
    vacuum,
)
from contractflow.sources import commits as C
from contractflow.streaming import start_contract_stream
from tests.test_streams import CONTRACT, write_messages


@pytest.fixture
def tables(spark, database):
    return provision(spark, CONTRACT, Tables(f"{database}.numbers", f"{database}.numbers_q", CONTRACT.partitioning))


@pytest.fixture
def log(spark):
    return CommitLog(spark, scratch(spark, "commits"))


def bronze_rows(spark, tables, start, end, day="2024-01-01"):
    columns = spark.table(tables.bronze).drop("load_id", "load_bucket", "ingested_at_date").schema
    rows = [(i, "x", datetime.fromisoformat(day), "1", "json") for i in range(start, end)]
    return spark.createDataFrame(rows, columns)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def run(spark, path, tables, checkpoint, log):
    start_contract_stream(file_stream(spark, path), CONTRACT, tables, checkpoint, trigger=None, log=log).awaitTermination()


def test_a_crash_between_the_sides_shows_nothing(spark, tables, log, tmp_path):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    write_messages(spark, path, 600, 800)
    spark.sql(f"ALTER TABLE {tables.quarantine} RENAME TO {tables.quarantine}_away")
    with pytest.raises(StreamingQueryException):
        run(spark, path, tables, checkpoint, log)
    spark.sql(f"ALTER TABLE {tables.quarantine}_away RENAME TO {tables.quarantine}")
    spark.catalog.refreshTable(tables.bronze)
    assert spark.table(tables.bronze).count() > 0 and log.latest() == 0
    assert [d.count() for d in snapshot(log, tables)] == [0, 0]
    run(spark, path, tables, checkpoint, log)
    good, bad = snapshot(log, tables)
    held = ids(good)
    assert held == list(range(600, 700)) and bad.count() == 100
    orphans = spark.table(tables.bronze).count() - 100
    assert orphans > 0
    assert vacuum(log, tables, log.latest()) == 0  # they may be of a load under way
    assert vacuum(log, tables, log.latest(), grace_seconds=0) > 0
    assert spark.table(tables.bronze).count() == 100 and ids(snapshot(log, tables)[0]) == held  # read anew


def test_a_crash_after_the_commit_writes_nothing_again(spark, tables, log, tmp_path, monkeypatch):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    write_messages(spark, path, 690, 710)
    whole = CommitLog.commit_load

    def then_die(self, *args):
        whole(self, *args)
        raise RuntimeError("killed after the commit")

    monkeypatch.setattr(CommitLog, "commit_load", then_die)
    with pytest.raises(StreamingQueryException):
        run(spark, path, tables, checkpoint, log)
    monkeypatch.setattr(CommitLog, "commit_load", whole)
    version = log.latest()
    run(spark, path, tables, checkpoint, log)
    assert [d.count() for d in snapshot(log, tables)] == [10, 10]
    assert log.latest() >= version == 1
    stats = log.statistics().collect()
    assert sum(r["total"] for r in stats) == 20 and sum(r["valid"] for r in stats) == 10


def test_versions_and_odd_loads(spark, tables, log):
    assert log.latest() == 0 and [d.count() for d in snapshot(log, tables)] == [0, 0]
    assert log.load({"bronze": bronze_rows(spark, tables, 0, 5)}, tables, "one") == 1
    assert log.load({"bronze": bronze_rows(spark, tables, 0, 5)}, tables, "one") is None
    assert log.load({"bronze": bronze_rows(spark, tables, 5, 5)}, tables, "empty") == 2
    assert log.load({"bronze": bronze_rows(spark, tables, 5, 9)}, tables) == 3
    assert [ids(snapshot(log, tables, v)[0]) for v in range(4)] == [[], list(range(5)), list(range(5)), list(range(9))]
    with pytest.raises(ValueError, match="not committed"):
        snapshot(log, tables, 4)


def test_compaction_keeps_rows_and_bounds_files(spark, tables, log):
    for i in range(9):
        log.load({"bronze": bronze_rows(spark, tables, 10 * i, 10 * i + 10, f"2024-01-0{1 + i % 3}")}, tables)
    log.load({"bronze": bronze_rows(spark, tables, 1000, 1010, "2024-01-09")}, tables)
    before = ids(snapshot(log, tables)[0])
    columns = [c for c in spark.table(tables.bronze).columns if c not in ("load_id", "load_bucket")]
    content = {tuple(r) for r in snapshot(log, tables)[0].select(*columns).collect()}
    assert live_files(log, tables, "bronze").count() >= 10
    version = compact(log, tables, "bronze", date(2024, 1, 9))
    assert version == 11 and ids(snapshot(log, tables)[0]) == before == ids(snapshot(log, tables, 10)[0])
    assert {tuple(r) for r in snapshot(log, tables)[0].select(*columns).collect()} == content
    files = live_files(log, tables, "bronze").groupBy("__day").count().collect()
    assert {r["__day"]: r["count"] for r in files if r["__day"] < "2024-01-09"} == dict.fromkeys(("2024-01-01", "2024-01-02", "2024-01-03"), 1)
    assert compact(log, tables, "bronze", date(2024, 1, 9)) is None  # nothing is left to pack

    log.load({"bronze": bronze_rows(spark, tables, 500, 505, "2024-01-02")}, tables)  # late rows of a closed day
    assert ids(snapshot(log, tables)[0]) == sorted([*before, *range(500, 505)])
    assert ids(snapshot(log, tables, version)[0]) == before
    again = compact(log, tables, "bronze", date(2024, 1, 9))
    assert ids(snapshot(log, tables, again)[0]) == sorted([*before, *range(500, 505)])
    assert vacuum(log, tables, again) > 0
    assert ids(snapshot(log, tables)[0]) == sorted([*before, *range(500, 505)])
    assert spark.table(tables.bronze).count() == len(before) + 5


def test_loads_during_a_compaction_stay_and_a_second_one_of_the_day_gives_way(spark, tables, log, monkeypatch):
    for i in range(3):
        log.load({"bronze": bronze_rows(spark, tables, 10 * i, 10 * i + 10)}, tables)
    whole = CommitLog._commit

    def late(self, entry, since=None):
        if since is not None:
            monkeypatch.setattr(CommitLog, "_commit", whole)
            log.load({"bronze": bronze_rows(spark, tables, 100, 110)}, tables)
            whole(self, entry | {"ids": ["other"], "days": [d | {"held": ["other"]} for d in entry["days"]]}) if conflict else None
        return whole(self, entry, since)

    conflict = False
    monkeypatch.setattr(CommitLog, "_commit", late)
    compact(log, tables, "bronze", date(2024, 2, 1))
    expected = [*range(30), *range(100, 110)]
    assert ids(snapshot(log, tables)[0]) == expected
    conflict = True
    monkeypatch.setattr(CommitLog, "_commit", late)
    with pytest.raises(CommitConflict):
        compact(log, tables, "bronze", date(2024, 2, 1))


def test_writers_at_once_get_versions_of_their_own(spark, log):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda i: log.commit_load(f"l{i}", f"l{i}", 1, 0), range(12)))
    assert sorted(versions) == list(range(1, 13))
    assert log.state()[0].count() == 12


def test_folded_states(spark, tables, log, monkeypatch):
    monkeypatch.setattr(C, "FOLD", 3)
    monkeypatch.setattr(C, "BLOCK", 2)
    for i in range(8):
        log.load({"bronze": bronze_rows(spark, tables, i, i + 1)}, tables, f"load{i}")
        if i == 4:
            compact(log, tables, "bronze", date(2024, 2, 1))
    assert sorted(log._names("folded")) == ["000000000003", "000000000006", "000000000009"]
    assert ids(snapshot(log, tables)[0]) == list(range(8))
    assert [len(ids(snapshot(log, tables, v)[0])) for v in range(10)] == [0, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert log.committed("load2") and not log.committed("load9")


def test_rows_without_a_day_and_tables_without_days(spark, database, log):
    plain = provision(spark, CONTRACT, Tables(f"{database}.p", f"{database}.p_q"))
    columns = spark.table(plain.bronze).drop("load_id").schema
    log.load({"bronze": spark.createDataFrame([(1, "x", None, "1", "json")], columns)}, plain)
    assert ids(snapshot(log, plain)[0]) == [1]
    assert compact(log, plain, "bronze", date(2024, 2, 1)) is None


def test_orphans_are_in_no_snapshot(spark, tables, log):
    log.load({"bronze": bronze_rows(spark, tables, 0, 3)}, tables)
    replace_load(bronze_rows(spark, tables, 7, 9), tables.bronze, "stray", tables.partitioning, fresh=True)
    assert ids(snapshot(log, tables)[0]) == [0, 1, 2]
    assert spark.table(tables.bronze).where(F.col("load_id") == "stray").count() == 2


@pytest.mark.parametrize("seed", range(20))
def test_packing_fills_files(seed):
    import random

    rng = random.Random(seed)
    sizes = [rng.choice([1, 10, 30, 74, 75, 100, 250]) for _ in range(rng.randint(0, 60))]
    files = [rng.choice([1, 1, 2, 5]) for _ in sizes]
    day = pd.DataFrame({"__day": "d", "__id": [str(i) for i in range(len(sizes))], "bytes": pd.Series(sizes, dtype="int64"), "files": pd.Series(files, dtype="int64")})
    out = C.packed(day, 100)
    assert sorted(out["__id"]) == sorted(day["__id"])
    stay, moved = out[out["bin"].isna()], out[out["bin"].notna()]
    sums = moved.groupby("bin").agg(bytes=("bytes", "sum"), pieces=("pieces", "max"))
    assert (sums["bytes"] <= 100 * sums["pieces"]).all()
    after = int(stay["files"].sum() + sums["pieces"].sum())
    assert after <= 2 * sum(sizes) / 100 + 2
    again = pd.DataFrame({"__day": "d", "__id": [f"n{i}" for i in range(len(sums))], "bytes": sums["bytes"].astype("int64").tolist(), "files": sums["pieces"].tolist()})
    both = pd.concat([stay[["__day", "__id", "bytes", "files"]], again])
    assert C.packed(both, 100)["bin"].isna().all()  # a second packing has nothing to do
