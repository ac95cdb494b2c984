from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contractflow.llm import factorisation as fm
from tests.llm.support import ODD_TEXTS, documents

SF = "/root/testdata/sf0.01"


def test_pairs_are_scored_by_squares_and_sums():
    rng = np.random.default_rng(4)
    m = fm.Machine(0.3, rng.normal(0, 1, 30), rng.normal(0, 1, (30, 5)))
    rows = [(rng.choice(30, n, replace=False), rng.normal(0, 1, n)) for n in (0, 1, 2, 9, 30)]
    row = np.repeat(np.arange(5), [len(f) for f, _ in rows])
    margin, _ = m.margins(row, np.concatenate([f for f, _ in rows]), np.concatenate([v for _, v in rows]), 5)
    for got, (f, v) in zip(margin, rows, strict=True):
        pairs = sum(m.factors[f[i]] @ m.factors[f[j]] * v[i] * v[j] for i in range(len(f)) for j in range(i))
        assert got == pytest.approx(0.3 + m.weights[f] @ v + pairs)


def test_steps_follow_the_gradient():
    rng = np.random.default_rng(5)
    m = fm.Machine(0.1, rng.normal(0, 0.3, 6), rng.normal(0, 0.3, (6, 3)))
    feature, value = np.array([0, 2, 5]), np.array([0.5, 1.0, -0.7])

    def loss(machine):
        margin = machine.margins(np.zeros(3, int), feature, value, 1)[0][0]
        return np.log1p(np.exp(-margin))

    after = fm.trained(m, [(feature, value, 1.0)], 1e-4, 0.0, 1)
    for f in (0, 2, 5):
        for j in range(3):
            near = fm.Machine(m.bias, m.weights, m.factors.copy())
            near.factors[f, j] += 1e-5
            slope = (loss(near) - loss(m)) / 1e-5
            assert after.factors[f, j] - m.factors[f, j] == pytest.approx(-4e-4 * slope, rel=1e-3, abs=1e-9)


def test_pairs_learn_what_single_features_cannot():
    rows = [(np.array([a, 2 + b]), np.ones(2), float(a == b)) for a in (0, 1) for b in (0, 1)] * 20
    m = fm.Machine.fresh(4, 0.0)
    for i in range(60):
        m = fm.trained(m, rows, 0.3, 0.0, i)
    for f, v, y in rows[:4]:
        assert (m.scores(np.zeros(2, int), f, v, 1)[0] > 0.5) == (y == 1)


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "n_chars")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    m = fm.fit(fm.labelled(docs, labels.where(~out)), metadata=("n_chars",))
    rows = fm.score(docs.join(labels.where(out), "doc_id"), m, metadata=("n_chars",)).collect()
    good, bad = [r["score"] for r in rows if r["label"] == 1], [r["score"] for r in rows if r["label"] == 0]
    assert len(good) > 50 and len(bad) > 8
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([r["predicted"] == r["label"] for r in rows]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_odd_texts(spark):
    docs = documents(spark, ODD_TEXTS).withColumns({"label": F.col("doc_id") % 2, "score": F.lit("theirs"), "Predicted": F.lit(7)})
    m = fm.fit(docs, rounds=2, metadata=("n_chars",))
    rows = fm.score(docs.withColumn("n_chars", F.nullif("n_chars", F.lit(0))), m, metadata=("n_chars",)).collect()
    assert len(rows) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", "label", "score", "predicted"}
    twins = [r["score"] for r in rows if r["text"] == ODD_TEXTS[5]]
    assert len(twins) == 2 and twins[0] == twins[1]
    assert fm.score(docs.limit(0), m, metadata=("n_chars",)).count() == 0


def test_no_labels_and_odd_labels(spark):
    docs = documents(spark, ["a good text", "a bad one", None])
    blank = fm.fit(docs.withColumn("label", F.lit(None).cast("int")), rounds=2)
    assert [r["score"] for r in fm.score(docs, blank).collect()] == [0.5] * 3
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (1, 0), (None, 1), (2, 5), (9, 1)], "doc_id long, label int")
    taught = fm.labelled(docs.withColumn("Label", F.lit("theirs")), labels)
    assert [(r["doc_id"], r["label"]) for r in taught.collect()] == [(1, 0)]
    leaning = fm.fit(taught, rounds=3)
    assert all(r["score"] < 0.5 for r in fm.score(docs, leaning).collect())
    many = documents(spark, [f"text {i}" for i in range(500)])
    assert 50 < fm.labelled(many, many.select("doc_id", F.lit(1).alias("label")), most_rows=100).count() < 150


def test_statistics_are_shares():
    stats = fm.shares(pa.array(ODD_TEXTS))
    assert stats.shape == (len(ODD_TEXTS), len(fm.STATS)) and ((stats >= 0) & (stats <= 1)).all()
    row, feature, value = fm.vectors(pa.array(ODD_TEXTS), [np.array([float("nan")] * len(ODD_TEXTS))])
    assert (np.diff(row) >= 0).all() and feature.max() < fm.width(1) and (value > 0).all()
