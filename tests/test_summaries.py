"""Merged sketches, heavy keys, availability and duplicates on a stream, against plain counts."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from contractflow.operators import metrics, summaries
from contractflow.operators.availability import availability, availability_verdict, outages
from contractflow.streaming import flag_duplicates, with_duplicate_rule

START = datetime(2024, 1, 1)


def loads(spark, rows):
    return spark.createDataFrame(rows, "load int, id string, seen timestamp, loaded timestamp")


def test_merged_summaries(spark):
    rng = random.Random(1)
    rows = [(i % 5, rng.choice([None, "", *map(str, range(700))]), START if i % 10 else None, START + timedelta(seconds=rng.randint(0, 1000))) for i in range(3000)]
    df = loads(spark, rows)
    held = summaries.summarised(df, ["load"], ["id"], "loaded", "seen")
    assert held.count() == 5
    exact, got = metrics.uniqueness(df, "id").first(), summaries.uniqueness_merged(held, "id").first()
    assert got["records"] == exact["records"] == 3000
    assert abs(got["distinct_ids"] - exact["distinct_ids"]) <= 3 * summaries.SKETCH_ERROR * exact["distinct_ids"] + 1
    lags = sorted((r[3] - r[2]).seconds for r in rows if r[2])
    for r in summaries.latency_quantiles(held).collect():
        below, upto = sum(x < r["seconds"] for x in lags), sum(x <= r["seconds"] for x in lags)
        assert below / len(lags) - summaries.RANK_ERROR <= r["rank"] <= upto / len(lags) + summaries.RANK_ERROR
    late = summaries.latency_verdict(held, 995.0).first()
    assert late["pass"] and late["rank"] == 0.99 and max(lags) > 995


def test_summaries_of_nothing(spark):
    held = summaries.summarised(loads(spark, []), ["load"], ["id"], "loaded", "seen")
    assert tuple(summaries.uniqueness_merged(held, "id").first()) == (0, 0, 0.0)
    assert [r["seconds"] for r in summaries.latency_quantiles(held).collect()] == [None] * 4
    untimed = summaries.summarised(loads(spark, [(1, None, None, None)]), ["load"], ["id"], "loaded", "seen")
    assert tuple(summaries.uniqueness_merged(untimed, "id").first()) == (1, 1, 100.0)
    assert [r["seconds"] for r in summaries.latency_quantiles(untimed).collect()] == [None] * 4


def keyed(spark, keys, parts=4):
    return spark.createDataFrame(keys, "a string, b int").repartition(parts)


@pytest.mark.parametrize("seed, counters", [(0, 3), (1, 10), (2, 50), (3, 1000)])
def test_heavy_hitters_are_the_top_duplicates(spark, seed, counters):
    rng = random.Random(seed)
    keys = [(rng.choice([None, "x", "y"]), None) for _ in range(400)] + [(f"k{int(rng.paretovariate(0.8))}", rng.randint(0, 1)) for _ in range(1500)] + [(f"u{i}", i) for i in range(800)]
    df = keyed(spark, keys)
    for names, limit in ((["a", "b"], 5), (["a"], 1), (["b"], 3)):
        assert summaries.heavy_hitters(df, names, limit, counters).collect() == metrics.top_duplicates(df, names, limit).collect()


def test_heavy_hitters_of_odd_tables(spark):
    for keys in ([], [("a", 1)], [("a", 1), ("a", 1)], [(None, None)] * 5, [(f"k{i}", 1) for i in range(50)]):
        df = keyed(spark, keys, 1)
        assert summaries.heavy_hitters(df, ["a", "b"], 3, 4).collect() == metrics.top_duplicates(df, ["a", "b"], 3).collect()


@pytest.mark.parametrize("seed", range(3))
def test_summaries_of_keys_keep_their_bounds(spark, seed):
    rng = random.Random(seed)
    keys = [(f"k{int(rng.paretovariate(0.5)) % 300}", 1) for _ in range(3000)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        parts = summaries.key_summaries(keyed(spark, keys, 3), ["a"], 20).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    missed = sum({r["part"]: r["missed"] for r in parts}.values())
    assert 0 < missed <= 3000 / 20 and max(Counter(r["part"] for r in parts).values()) <= 20
    least = Counter()
    for r in parts:
        least[r["k0"]] += r["at_least"]
    for key, n in Counter(a for a, _ in keys).items():
        assert least[key] <= n <= least[key] + missed


def times(spark, rows):
    return spark.createDataFrame([(s, None if t is None else START + timedelta(seconds=t)) for s, t in rows], "s string, t timestamp")


def test_outages_across_days(spark):
    rows = [("a", t) for t in (0, 10, 10, 500, 86_399, 86_401, 86_400 * 4 + 5, None)] + [("b", 7)]
    base = int((START - datetime(1970, 1, 1)).total_seconds())
    found = outages(times(spark, rows).where("s = 'a'"), "t", 100).orderBy("began").collect()
    assert [(r["began"] - base, r["ended"] - base, r["seconds"]) for r in found] == [(10, 500, 490), (500, 86_399, 85_899), (86_401, 345_605, 259_204)]
    row = {r["s"]: r for r in availability(times(spark, rows), "t", 100, ["s"]).collect()}
    assert (row["a"]["outages"], row["a"]["down_seconds"], row["a"]["period_seconds"]) == (3, 490 + 85_899 + 259_204, 345_605)
    assert (row["b"]["outages"], row["b"]["period_seconds"], row["b"]["availability_pct"]) == (0, 0, 100.0)


def test_a_stated_period_counts_silence_at_its_ends(spark):
    rows = [("a", -50), ("a", 200), ("a", 250), ("a", 900)]
    period = (START, START + timedelta(seconds=500))
    got = availability(times(spark, rows), "t", 100, (), *period).first()
    assert (got["outages"], got["down_seconds"], got["period_seconds"], got["availability_pct"]) == (2, 200 + 250, 500, 10.0)
    assert not availability_verdict(availability(times(spark, rows), "t", 100, (), *period), 99.9).first()["pass"]
    late = availability(times(spark, [("a", 86_400 * 9)]), "t", 100, (), *period).first()
    assert late["period_seconds"] is None and late["availability_pct"] is None
    assert availability(times(spark, []), "t", 100).first()["outages"] == 0
    assert availability(times(spark, []), "t", 100, ["s"]).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_outages_against_a_plain_walk(spark, seed):
    rng = random.Random(seed)
    at = sorted({rng.randint(0, 86_400 * 6) for _ in range(60)})
    found = outages(times(spark, [("a", t) for t in at] * 2), "t", 3000).collect()
    assert sorted(r["seconds"] for r in found) == sorted(b - a for a, b in zip(at, at[1:], strict=False) if b - a > 3000)


ROW = "k string, j int, t timestamp, v int"


def arrive(spark, tmp_path, rows, horizon="1 day", parts=2):
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, ROW).repartition(parts).write.mode("append").parquet(source)
    flagged = flag_duplicates(spark.readStream.schema(ROW).parquet(source), ["k", "j"], "t", horizon)
    writer = flagged.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(str(tmp_path / "out")).collect()


def test_duplicates_over_restarts(spark, tmp_path):
    at = lambda hours: START + timedelta(hours=hours)
    out = arrive(spark, tmp_path, [("hot", 1, at(0), i) for i in range(200)] + [("a", 1, at(1), 0), ("a", 2, at(1), 0), (None, 1, at(1), 0), (None, 1, at(1), 0), ("n", 1, None, 0), ("n", 1, None, 1)])
    assert len(out) == 206 and sum(not r["is_duplicate"] for r in out if r["k"] == "hot") == 1
    assert not any(r["is_duplicate"] for r in out if r["k"] in (None, "n", "a"))
    out = arrive(spark, tmp_path, [("hot", 1, at(2), 900), ("a", 1, at(2), 901), ("b", 1, at(2), 902), ("1:a", 1, at(2), 903)])
    assert {r["v"]: r["is_duplicate"] for r in out if r["v"] and r["v"] >= 900} == {900: True, 901: True, 902: False, 903: False}
    arrive(spark, tmp_path, [("late", 1, at(72), 910)])
    arrive(spark, tmp_path, [("late", 2, at(73), 911)])  # by now the watermark has passed what the first keys were kept for
    out = arrive(spark, tmp_path, [("hot", 1, at(74), 920), ("late", 1, at(74), 921)])
    assert {r["v"]: r["is_duplicate"] for r in out if r["v"] in (920, 921)} == {920: False, 921: True}


def test_many_keys_share_few_states(spark, tmp_path, monkeypatch):
    """A call and a state row for each key cost ten milliseconds a key; keys of one hash bucket share both."""
    monkeypatch.setattr("contractflow.streaming.duplicates.BUCKETS", 8, raising=False)
    schema, source = "k string, v long, t timestamp", str(tmp_path / "in")
    at = lambda hours: START + timedelta(hours=hours)
    big = 2**53 + 1  # not exact as a double

    def arrived(rows):
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(source)
        flagged = flag_duplicates(spark.readStream.schema(schema).parquet(source), ["k"], "t", "1 day")
        assert [(f.name, f.dataType.simpleString()) for f in flagged.schema] == [("k", "string"), ("v", "bigint"), ("t", "timestamp"), ("is_duplicate", "boolean")]
        writer = flagged.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        run = writer.trigger(availableNow=True).start()
        run.awaitTermination()
        assert run.lastProgress.stateOperators[0].numRowsTotal <= 8
        return Counter(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = [(f"k{i}", None if i % 2 else big + i, at(i / 100)) for i in range(300)]
    assert arrived(first) == (had := Counter((*r, False) for r in first))
    again = [(f"k{i}", big, at(4)) for i in range(400)]
    assert arrived(again) == (had := had + Counter((*r, i < 300) for i, r in enumerate(again)))
    had += Counter({("far", 1, at(50), False): 1})
    assert arrived([("far", 1, at(50))]) == had  # the watermark is now at hour 26: keys below k200 have expired
    last = [(f"k{i}", None, at(51)) for i in range(400) if i != 200]
    got = arrived(last) - had
    assert got == Counter((*r, int(r[0][1:]) > 200) for r in last)


def test_a_duplicate_breaks_a_rule(spark):
    rows = spark.createDataFrame([(["x"], False, True), ([], True, True), ([], True, False)], "validation_errors array<string>, is_valid boolean, is_duplicate boolean")
    got = with_duplicate_rule(rows, "once", "id").collect()
    message = "DUPLICATE_VIOLATION [once]: 'id' came before"
    assert [(r["validation_errors"], r["is_valid"]) for r in got] == [(["x", message], False), ([message], False), ([], True)]
