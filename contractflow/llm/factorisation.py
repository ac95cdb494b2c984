"""A quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a short sparse vector: its words, hashed into buckets and weighted by the logarithm of how often they
occur; shares of letters, symbols, repeated lines and the like, each in one of a few steps; and the steps of
numeric metadata columns. The model has a weight for each feature and one for each pair of them, the latter as
the product of two short factor vectors. All pairs are scored in time linear in the features, since the sum over
pairs is half of (the square of the sum minus the sum of the squares) of the factors.

The model is fitted on a bounded sample of the labelled rows. Tasks run stochastic steps over their share of
it, from the same parameters, and the parameters are averaged after each round, weighted by rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.llm.quality import measure
from contractflow.llm.store import discard, written
from contractflow.llm.text import LOWER, NOT_SPACE, U64, append, byte_table, find_words, lean, parts, utf8, without

BUCKETS = 1 << 14
STEPS = 12
SHARES = 4  # of the rows to learn from, each trained on by one task
MOST_ROWS = 40_000  # to learn from
STATS = ("length", "word length", "symbols", "repeated lines", "repeated words", "letters", "sentences", "capitals", "digits", "distinct words", "line length")
FACTORS = 8
CAPITALS = byte_table((0x41, 0x5A))
DIGITS = byte_table((0x30, 0x39))


def shares(texts: pa.Array) -> np.ndarray:
    """The structure statistics of each text, every one between 0 and 1; nothing is 0."""
    data, offsets = utf8(texts)
    n_words, chars, symbols, dup, repeat, lines, letters, stops = (x.astype(float) for x in measure(texts))
    words = find_words(LOWER[data], offsets, NOT_SPACE)
    hashes = words.hashes() ^ (words.text.astype(U64) * U64(0x9E3779B97F4A7C15))
    distinct = np.bincount(words.text[np.unique(hashes, return_index=True)[1]], minlength=len(texts))

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    def share(part: np.ndarray, whole: np.ndarray, top: float = 1.0) -> np.ndarray:
        return np.clip(part / np.maximum(whole, 1) / top, 0, 1)

    return np.stack(
        [
            np.clip(np.log2(n_words + 1) / 16, 0, 1),
            share(chars, n_words, 16),
            share(symbols, n_words, 2),
            share(dup, lines),
            share(repeat, n_words),
            share(letters, chars),
            share(stops, n_words),
            share(per_text(CAPITALS[data]), chars),
            share(per_text(DIGITS[data]), chars),
            share(distinct, n_words),
            np.clip(np.log2(n_words / np.maximum(lines, 1) + 1) / 12, 0, 1),
        ],
        1,
    )


def vectors(texts: pa.Array, metadata: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and value of every feature that is not zero, by text.

    Words come first, then a feature for each step of each statistic, a text's two neighbouring steps sharing a
    value of one, then one for each power of two of each metadata column (its last for a null or a negative number).
    """
    data, offsets = utf8(texts)
    words = find_words(LOWER[data], offsets, NOT_SPACE)
    bucket = (words.hashes() % U64(BUCKETS)).astype(np.int64)
    pairs, times = np.unique(words.text * np.int64(BUCKETS) + bucket, return_counts=True)
    text, feature = np.divmod(pairs, BUCKETS)
    value = np.log1p(times.astype(float))
    norm = np.sqrt(np.bincount(text, value * value, minlength=len(texts)))
    rows, features, values = [text], [feature], [value / norm[text]]
    every = np.arange(len(texts))
    first = BUCKETS
    for stat in shares(texts).T:
        place = np.sqrt(stat) * (STEPS - 2)  # finer for small shares
        low = np.floor(place).astype(np.int64)
        rows += [every, every]
        features += [first + low, first + low + 1]
        values += [1 - (place - low), place - low]
        first += STEPS
    for numbers in metadata:
        known = ~np.isnan(numbers) & (numbers >= 0)
        power = np.where(known, np.minimum(np.log2(np.where(known, numbers, 0) + 1), 30), 31).astype(np.int64)
        rows.append(every)
        features.append(first + power)
        values.append(np.ones(len(texts)))
        first += 32
    row, feature, value = np.concatenate(rows), np.concatenate(features), np.concatenate(values)
    order = np.argsort(row, kind="stable")
    used = order[value[order] > 0]
    return row[used], feature[used], value[used]


def width(n_metadata: int) -> int:
    return BUCKETS + STEPS * len(STATS) + 32 * n_metadata


@dataclass
class Machine:
    """Bias, a weight and a factor vector for each feature, and the means by which scores are set."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    @classmethod
    def fresh(cls, n: int, bias: float) -> Machine:
        return cls(bias, np.zeros(n), np.random.default_rng(7).normal(0, 0.05, (n, FACTORS)))

    def margins(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """The log odds of each row, and the sums of its factors, by the identity of squares and sums."""
        out = self.bias + np.bincount(row, self.weights[feature] * value, rows)
        sums = np.empty((rows, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            one = self.factors[feature, f] * value
            sums[:, f] = np.bincount(row, one, rows)
            out += 0.5 * (sums[:, f] ** 2 - np.bincount(row, one * one, rows))
        return out, sums

    def scores(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(row, feature, value, rows)[0], -50, 50)))


def trained(machine: Machine, rows: list[tuple[np.ndarray, np.ndarray, float]], rate: float, keep: float, seed: int, batch: int = 16) -> Machine:
    """The machine after steps over all rows (features, values, label), in an order drawn from the seed."""
    m = Machine(machine.bias, machine.weights.copy(), machine.factors.copy())
    order = np.random.default_rng(seed).permutation(len(rows))
    for at in range(0, len(order), batch):
        some = [rows[i] for i in order[at : at + batch]]
        sizes = [len(r[0]) for r in some]
        row, feature, value = np.repeat(np.arange(len(some)), sizes), np.concatenate([r[0] for r in some]), np.concatenate([r[1] for r in some])
        margin, sums = m.margins(row, feature, value, len(some))
        wrong = np.array([r[2] for r in some]) - 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        used, which = np.unique(feature, return_inverse=True)
        push = wrong[row] * value
        m.bias += rate * wrong.mean()
        m.weights[used] += rate * (np.bincount(which, push) / len(some) * 4 - keep * m.weights[used])
        slope = np.empty((len(used), m.factors.shape[1]))
        for f in range(m.factors.shape[1]):
            slope[:, f] = np.bincount(which, push * (sums[row, f] - m.factors[feature, f] * value)) / len(some) * 4
        m.factors[used] += rate * (slope - keep * m.factors[used])
    return m


def some_of(rows: DataFrame, count: int, most: int, *by: str) -> DataFrame:
    """About ``most`` of the ``count`` rows, drawn by a hash; all where there are no more."""
    return rows if count <= most else rows.where(F.pmod(F.xxhash64(*by), F.lit(1 << 30)) < int(most / count * (1 << 30)))


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "label", most_rows: int = MOST_ROWS) -> DataFrame:
    """The rows of docs with a label, which joins them as ``label``; about ``most_rows`` of the labels where there are more.

    Only the drawn labels are sent to the tasks; no text moves. A doc_id with labels that differ has none, and
    neither has a null doc_id; rows of docs that share a doc_id share its label. A column ``label`` of docs gives way.
    """
    one = labels.where(F.col(f"`{label}`").isin(0, 1)).groupBy(F.col(f"`{doc_id}`").alias(doc_id)).agg(F.min(f"`{label}`").alias("label"), F.max(f"`{label}`").alias("__top"))
    one = one.where("label = __top").drop("__top")
    return without(docs, "label").join(F.broadcast(some_of(one, one.count(), most_rows, doc_id)), doc_id)


def fit(
    docs: DataFrame,
    label: str = "label",
    text: str = "text",
    metadata: tuple[str, ...] = (),
    most_rows: int = MOST_ROWS,
    rounds: int = 12,
    rate: float = 0.5,
    keep: float = 1e-4,
) -> Machine:
    """A machine fitted on rows of docs with a label of 0 or 1.

    Rows with another label or none teach nothing. Of more than ``most_rows`` labelled rows about that many are
    drawn, by a hash of their text; the model, of ``width`` features, and the parameters of each of ``SHARES``
    shares of the rows are all that reaches the driver. Without labelled rows every score is one half; with labels
    of one kind, or of both for the same text, scores lean as far as the labels do.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{label}`").cast("double").alias("y"), F.col(f"`{text}`").cast("string").alias("text"), *[F.col(f"`{c}`").cast("double").alias(f"m{i}") for i, c in enumerate(metadata)]).where("y IN (0, 1)")
    count, good = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    n = width(len(metadata))
    machine = Machine.fresh(n, float(np.log((good + 0.5) / (count - good + 0.5))))
    if not count:
        machine.factors[:] = 0
        return machine
    rows = some_of(rows, count, most_rows, "text")

    def featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 1):
                extra = [part.column(2 + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(metadata))]
                row, feature, value = vectors(part.column(1), extra)
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(cuts, feature.astype(np.int32)), pa.ListArray.from_arrays(cuts, value.astype(np.float32))], ["y", "feature", "value"])

    made = rows.mapInArrow(lean(featurised), "y double, feature array<int>, value array<float>")
    shared = written(made, "features")
    held = shared.coalesce(SHARES)  # no shuffle: a task takes some of the files
    for i in range(rounds):
        sent = spark.sparkContext.broadcast(machine)

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, i=i) -> Iterator[pa.RecordBatch]:
            some = []
            for batch in batches:
                for y, feature, value in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                    some.append((feature.values.to_numpy().astype(np.int32), value.values.to_numpy(), y))
            if not some:
                return
            share = TaskContext.get().partitionId()
            some.sort(key=lambda r: (len(r[0]), zlib.crc32(r[0].tobytes()), r[1].tobytes(), r[2]))  # files may come in any order
            m = trained(sent.value, some, rate / (1 + i / 4), keep, seed=1000 * i + share)
            flat = np.concatenate([[m.bias], m.weights, m.factors.ravel()]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([share], pa.int32()), pa.array([len(some)]), pa.array([zlib.compress(flat.tobytes(), 1)], pa.binary())], ["share", "n", "parameters"])

        found = sorted(held.mapInArrow(lean(learn), "share int, n long, parameters binary").collect(), key=lambda r: r["share"])
        total = sum(r["n"] for r in found)
        mean = sum(np.frombuffer(zlib.decompress(r["parameters"]), np.float32).astype(float) * (r["n"] / total) for r in found)
        machine = Machine(float(mean[0]), mean[1 : n + 1], mean[n + 1 :].reshape(n, FACTORS))
        sent.destroy()
    discard(shared)
    return machine



def score(docs: DataFrame, machine: Machine, text: str = "text", metadata: tuple[str, ...] = ()) -> DataFrame:
    """docs with ``score``, between 0 and 1 and higher where label 1 is likelier, and ``predicted``, 1 from one half on.

    Null and empty texts are scored by their statistics and metadata alone. Columns of docs with one of
    the new names give way; repeated rows have one score; texts of any length are read whole.
    """
    taken = ("score", "predicted")
    rest = [c for c in docs.columns if c.lower() not in taken]
    names = [f"`{c}`" for c in rest]
    extra = [F.col(f"`{c}`").cast("double").alias(f"__m{i}") for i, c in enumerate(metadata)]
    whole = docs.select(*names, *extra, F.col(f"`{text}`").cast("string").alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    out = T.StructType([*docs.select(*names).schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, n = sent.value, len(rest)
        for batch in batches:
            for part in parts(batch, batch.num_columns - 1):
                numbers = [part.column(n + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(metadata))]
                row, feature, value = vectors(part.column(part.num_columns - 1), numbers)
                scores = m.scores(row, feature, value, part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], list(out.names))

    return whole.mapInArrow(lean(run), out)
