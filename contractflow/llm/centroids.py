"""Centroid clustering of integer vectors, exact to the last tie, with ns-bounds.

The history of all centroids is kept (rounds times centroids times components, whatever the number of
vectors). A vector stores the squared distance to its own centroid and, for each group of centroids, the least
distance to any other of the group, each with the round in which it was evaluated. Later a stored bound is
loosened by the norm of the total displacement of the centroid since that round, read off the history, and not by
the sum of the drifts of every round in between, which can only be larger. A group is evaluated again, exactly and
in integers, only where its loosened bound does not prove that the vector's own centroid is nearer.

A round is one pass of Spark tasks over the vectors, which yields their new state and, in the same table, a
row of component sums for each cluster of a task. A round's table replaces the one before it. Only the
sums for each cluster reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow.llm.store import discard, written

GROUP = 5  # centroids that share a bound
LARGEST = 1 << 27  # of a component's size: squared distances over up to 256 of them then fit 64 bits
SLACK = 1e-9  # by which a rounded norm may be wrong, relatively
SLICE = 1 << 13  # vectors at a time
FAR = np.iinfo(np.int64).max


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors x (n, d) from c (m, d)."""
    top = int(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * top * top < 1 << 53:  # every partial sum is a whole number that a double holds
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.zeros((len(x), len(c)), np.int64)
    for j in range(len(c)):
        away = x - c[j]
        out[:, j] = (away * away).sum(1)
    return out


def lowered(distance: np.ndarray) -> np.ndarray:
    """Norms of squared distances as short floats, never above their true value; FAR is infinite."""
    short = (np.sqrt(distance.astype(np.float64)) * (1 - SLACK)).astype(np.float32)
    return np.where(distance == FAR, np.float32(np.inf), np.nextafter(short, np.float32(-np.inf)))


@dataclass
class History:
    """The centroids of every round, the last ones being those in force, and how far they came since each."""

    rounds: list[np.ndarray]

    def __post_init__(self) -> None:
        self.now = self.rounds[-1]
        k = len(self.now)
        self.groups = [np.arange(i, min(i + GROUP, k)) for i in range(0, k, GROUP)]
        apart = [((self.now - then).astype(np.float64) ** 2).sum(1) for then in self.rounds]
        self.moved = np.sqrt(np.array(apart)) * (1 + SLACK)  # (round, centroid)
        self.group_moved = np.stack([self.moved[:, g].max(1) for g in self.groups], 1)  # (round, group)


@dataclass
class State:
    """Of each vector: its cluster, the squared distance to that centroid, and for each group a lower bound
    on the distance to its other centroids; ``*_at`` are the rounds in which these were evaluated."""

    cluster: np.ndarray
    far: np.ndarray
    far_at: np.ndarray
    low: np.ndarray
    low_at: np.ndarray


def opening(x: np.ndarray, history: History) -> State:
    """The state of vectors that have none yet."""
    n, groups = len(x), len(history.groups)
    away = squared(x, history.now)
    cluster = away.argmin(1)  # the first of equals
    far = away[np.arange(n), cluster]
    away[np.arange(n), cluster] = FAR
    low = np.stack([lowered(away[:, g].min(1)) for g in history.groups], 1)
    at = len(history.rounds) - 1
    return State(cluster, far, np.full(n, at), low, np.full((n, groups), at))


def step(x: np.ndarray, was: State, history: History) -> tuple[State, int]:
    """The state under the centroids now in force, and how many distances had to be evaluated."""
    at, k = len(history.rounds) - 1, len(history.now)
    cluster, far, far_at, low, low_at = (a.copy() for a in (was.cluster, was.far, was.far_at, was.low, was.low_at))
    loose = low - history.group_moved[low_at, np.arange(low.shape[1])]
    near = np.sqrt(far.astype(np.float64)) * (1 + SLACK) + history.moved[far_at, cluster]
    rows = np.flatnonzero((loose <= near[:, None]).any(1))  # a tie is in doubt, too
    if not len(rows):
        return State(cluster, far, far_at, low, low_at), 0
    some, old = x[rows].astype(np.int64), cluster[rows]
    away = some - history.now[old]
    best = (away * away).sum(1)
    doubt = loose[rows] <= (np.sqrt(best.astype(np.float64)) * (1 + SLACK))[:, None]
    seen, own, evaluated = np.full((len(rows), k), FAR), old.copy(), len(rows)

    def evaluate(mask: np.ndarray, group: np.ndarray) -> None:
        nonlocal evaluated
        r = np.flatnonzero(mask)
        if len(r):
            seen[r[:, None], group] = squared(some[r], history.now[group])
            evaluated += len(r) * len(group)

    for g, group in enumerate(history.groups):
        evaluate(doubt[:, g], group)
        least = seen[:, group].min(1)
        number = group[seen[:, group].argmin(1)]
        better = doubt[:, g] & ((least < best) | ((least == best) & (number < own)))
        best, own = np.where(better, least, best), np.where(better, number, own)
    changed = own != old
    for g, group in enumerate(history.groups):  # the centroid that was left is now one of the others of its group
        lost = changed & (old // GROUP == g) & ~doubt[:, g]
        evaluate(lost, group)
        doubt[:, g] |= lost
    seen[np.arange(len(rows)), own] = FAR
    for g, group in enumerate(history.groups):
        r = np.flatnonzero(doubt[:, g])
        low[rows[r], g] = lowered(seen[r][:, group].min(1))
        low_at[rows[r], g] = at
    cluster[rows], far[rows], far_at[rows] = own, best, at
    return State(cluster, far, far_at, low, low_at), evaluated


def matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width).astype(kind)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width, dtype=np.int32) if n else np.zeros(1, np.int32), pa.array(values.ravel(), kind))


STATE = "x array<int>, cluster int, far long, far_at tinyint, low array<float>, low_at array<tinyint>"
SUMS = "held long, evaluated long, total array<long>"  # of a task's cluster; null for a vector


def pass_over(vectors: DataFrame, history: History, last: bool) -> DataFrame:
    """The vectors with their state under the history, and the sums of each task's clusters."""
    sent = vectors.sparkSession.sparkContext.broadcast(history.rounds)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    fresh = "cluster" not in vectors.columns
    out = f"vec_id {kind}, " + ("cluster int, far long, " if last else f"{STATE}, ") + SUMS
    names = [part.split()[0] for part in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = History(sent.value)
        k, d = h.now.shape
        held, evaluated, far = np.zeros(k, np.int64), np.zeros(k, np.int64), [0] * k
        total = np.zeros((k, d), np.int64)
        ids = pa.array([])
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                rows = batch.slice(start, SLICE)
                n, ids = rows.num_rows, rows.column(0)
                x = matrix(rows.column(1), d, np.int64)
                if int(np.abs(x).max(initial=0)) > LARGEST:
                    raise ValueError(f"a component is larger than {LARGEST}, so that squared distances would not fit 64 bits")
                if fresh:
                    s, cost = opening(x, h), n * k
                else:
                    own, far_now, far_at = (rows.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4))
                    s = State(own, far_now, far_at, matrix(rows.column(5), len(h.groups), np.float32), matrix(rows.column(6), len(h.groups), np.int64))
                    s, cost = step(x, s, h)
                if last:
                    away = x - h.now[s.cluster]
                    s.far = (away * away).sum(1)
                    made = [pa.array(s.cluster, pa.int32()), pa.array(s.far)]
                else:
                    made = [rows.column(1), pa.array(s.cluster, pa.int32()), pa.array(s.far), pa.array(s.far_at, pa.int8())]
                    made += [lists(s.low, pa.float32()), lists(s.low_at, pa.int8())]
                held += np.bincount(s.cluster, minlength=k)
                evaluated[0] += cost
                order = np.argsort(s.cluster, kind="stable")
                firsts = np.searchsorted(s.cluster[order], np.arange(k))
                for j in np.flatnonzero(np.bincount(s.cluster, minlength=k)).tolist():
                    members = order[firsts[j] : firsts[j + 1] if j + 1 < k else n]
                    total[j] += x[members].sum(0)
                    far[j] += sum(s.far[members].tolist())
                nulls = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([ids, *made, *nulls], names)
        some = np.flatnonzero(held)
        if len(some):
            blank = {c: pa.nulls(len(some), t) for c, t in (("x", pa.list_(pa.int32())), ("far_at", pa.int8()), ("low", pa.list_(pa.float32())), ("low_at", pa.list_(pa.int8())))}
            given = {"vec_id": pa.nulls(len(some), ids.type), "cluster": pa.array(some, pa.int32()), "far": pa.array([far[j] for j in some], pa.int64())}
            given |= {"held": pa.array(held[some]), "evaluated": pa.array(evaluated[some]), "total": lists(total[some], pa.int64())}
            yield pa.RecordBatch.from_arrays([(blank | given)[c] for c in names], names)

    columns = ["vec_id", "x"] if fresh else ["vec_id", "x", "cluster", "far", "far_at", "low", "low_at"]
    return written(vectors.select(*columns).mapInArrow(run, out), "round")


def summed(table: DataFrame, k: int, d: int) -> tuple[list[int], list[list[int]], list[int], int]:
    """Vectors, component sums and squared distances of every cluster, and the distances evaluated."""
    parts = table.where("held IS NOT NULL").select("cluster", "far", "held", "evaluated", "total")
    wide = "decimal(38,0)"
    held, far, total, cost = [0] * k, [0] * k, [[0] * d for _ in range(k)], 0
    for r in parts.groupBy("cluster").agg(*[F.sum(F.col(c).cast(wide)).alias(c) for c in ("held", "far", "evaluated")]).collect():
        held[r["cluster"]], far[r["cluster"]], cost = int(r["held"]), int(r["far"]), cost + int(r["evaluated"])
    for r in parts.select("cluster", F.posexplode("total").alias("at", "v")).groupBy("cluster", "at").agg(F.sum(F.col("v").cast(wide)).alias("v")).collect():
        total[r["cluster"]][r["at"]] = int(r["v"])
    return held, total, far, cost


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, x): the vectors of exactly ``dims`` components, none null or non-finite, each as floor(scale * it)."""
    x = F.col(f"`{embedding}`")

    def finite(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))

    whole = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("int"))
    return vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.when((F.size(x) == dims) & F.forall(x, finite), whole).alias("x")).where("x IS NOT NULL")


def seeds(vectors: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; of equal ids those with the smallest components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select(digest.alias("digest"), "x").orderBy(F.col("digest").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), dims)


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    seed: int = 2,
    log: Callable[[str], None] = lambda line: None,
) -> tuple[DataFrame, list[dict]]:
    """(vec_id, cluster, distance) for every vector kept, and one dict for each cluster: its final centroid, the
    number of its vectors, and the sum of their squared distances.

    A vector is kept if it has exactly ``dims`` components, none of them null or non-finite; others, null vectors
    included, are in no result. The k kept vectors with the smallest hashes of their ids are the first
    centroids (all of them where fewer are kept; a null id comes last). A tie goes to the centroid of the smaller
    number; a cluster without vectors keeps its centroid. Repeated rows are vectors each; other columns are not
    read; an empty table gives no rows. Components beyond ``LARGEST`` after scaling raise.
    """
    kept = whole_vectors(vectors, vec_id, embedding, dims, scale)
    history = [seeds(kept, k, seed, dims)]
    kind = kept.schema["vec_id"].dataType.simpleString()
    if not len(history[0]):
        return kept.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), []
    k, state = len(history[0]), kept
    for i in range(rounds):
        table = pass_over(state, History(history), last=False)
        held, total, _, cost = summed(table, k, dims)
        log(f"round {i}: {cost} distances evaluated")
        history.append(np.array([[v // n for v in row] if n else then for n, row, then in zip(held, total, history[-1].tolist(), strict=True)], np.int64))
        if i:
            discard(state.table)
        state = table.where("held IS NULL")
        state.table = table
    table = pass_over(state, History(history), last=True)
    held, _, far, cost = summed(table, k, dims)
    log(f"last: {cost} distances evaluated")
    if rounds:
        discard(state.table)
    found = [{"cluster": j, "centroid": history[-1][j].tolist(), "vectors": held[j], "inertia": far[j]} for j in range(k)]
    return table.where("held IS NULL").select("vec_id", "cluster", F.col("far").alias("distance")), found


def described(spark: SparkSession, found: list[dict]) -> DataFrame:
    """(cluster, cluster_inertia, inertia, centroid_sha256), a row for each centroid."""
    every = sum(c["inertia"] for c in found)
    digest = [hashlib.sha256(",".join(map(str, c["centroid"])).encode()).hexdigest() for c in found]
    rows = [(c["cluster"], Decimal(c["inertia"]), Decimal(every), h) for c, h in zip(found, digest, strict=True)]
    table = spark.createDataFrame(rows, "cluster int, own decimal(38,0), every decimal(38,0), centroid_sha256 string")
    return table.select("cluster", F.col("own").cast("long").alias("cluster_inertia"), F.col("every").cast("long").alias("inertia"), "centroid_sha256")
