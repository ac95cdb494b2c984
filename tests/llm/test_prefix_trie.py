from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contractflow.llm import prefix_trie
from contractflow.llm.prefix_trie import conversation_trie, sketch
from contractflow.llm.scan import Running, running

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Every node from all prefixes of all conversations. Ties of a turn must be alike in role and text."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    convs = {c: tuple(t for _, t in sorted(turns, key=lambda x: x[0])) for c, turns in convs.items()}
    members = {}
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members.setdefault(convs[c][:d], []).append(c)
    out = []
    for p, own in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below)
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in own if convs[c] == p)
        out.append((own[0], len(p), members[p[:-1]][0] if p else None, len(own), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def same(spark, rows):
    got = conversation_trie(spark.createDataFrame(rows, TURNS)).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def random_rows(seed, convs=40):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.choice([1, 1, 2, 3, 5])):
            rows.append((c * 3, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "é", ""])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_all_prefixes(spark, seed):
    same(spark, random_rows(seed))


def test_a_sketch_without_room_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LEAST_CELLS", 16)
    monkeypatch.setattr(prefix_trie, "MOST_CELLS", 16)
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    same(spark, random_rows(5))


def test_odd_rows(spark):
    rows = [(None, 0, "user", "left out"), (1, None, "user", "first"), (1, 0, None, None), (2, None, "user", "first"), (2, 3, "", "")]
    rows += [(3, 0, "user", "twice"), (3, 0, "user", "twice"), (4, 0, "us", "ertwice"), (5, 0, "user", "x" * 100_000), (6, 0, "user", "x" * 100_000), (7, 0, "", ""), (-8, 0, "user", "twice")]
    same(spark, rows)
    assert conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    more = spark.createDataFrame(rows[1:5], TURNS).withColumns({"conv": F.lit("theirs"), "depth": F.lit(1), "p": F.lit(2)})
    assert conversation_trie(more).count() == 3


def test_borders_and_hot_conversations(spark):
    """A conversation that fills most partitions, and a list of ends longer than a chunk."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        rows = [(1, t, "user", str(t % 2)) for t in range(150)] + [(2, t, "user", str(t % 2)) for t in range(151)] + [(100 + i, 0, "user", "hello") for i in range(60)]
        same(spark, rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_running_values_cross_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 1, 1, 1, 2, 3]), i, rng.choice([None, 1, 5])) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, o long, v long").repartition(5)
    out = running(df, "g", ["o"], {"s": Running("v", start=2, was=True), "m": Running("v", start=1, factor=7, modulus=(1 << 127) - 1)}).collect()
    for g in {r[0] for r in rows}:
        s, m = 2, 1
        mine = sorted((r for r in out if r["g"] == g), key=lambda r: r["o"])
        assert len(mine) == sum(r[0] == g for r in rows)
        for i, r in enumerate(mine):
            assert r["s_was"] == s
            if r["v"] is not None:
                s, m = s + r["v"], (7 * m + r["v"]) % ((1 << 127) - 1)
            assert (r["s"], int.from_bytes(r["m"], "big")) == (s, m)
            assert r["last"] == (i + 1 == len(mine))
    assert running(df.limit(0), "g", ["o"], {"s": Running("v")}).count() == 0


def test_the_sketch_never_counts_too_few(spark):
    rng = random.Random(1)
    digests = [rng.randbytes(16) for _ in range(500)]
    shown = digests + digests[:100]
    width = prefix_trie.LEAST_CELLS
    bits = sketch(spark.createDataFrame([(bytearray(d),) for d in shown], "p binary").repartition(3), width)
    many = np.unpackbits(bits, bitorder="little").astype(bool)
    import pyarrow as pa

    estimated = np.ones(500, bool)
    for row, at in enumerate(prefix_trie.cells(pa.array(digests, pa.binary()), width)):
        estimated &= many[at + row * width]
    assert estimated[:100].all() and estimated[100:].mean() < 0.02
