"""Roles of transcript lines by a hidden Markov model, and canonical turns.

A transcript is a sequence of lines, some of which begin with a speaker marker. Hidden states say who
speaks and whether the line begins a turn; markers and other features of a line are what is observed.
The model is counted from transcripts with known roles. Viterbi finds the best states of each transcript.

Lines are range-sorted by transcript and place, so a transcript of any length spreads over as many partitions
as it fills. A partition sums up its part of a transcript that crosses its border as a matrix of best scores
from state to state; the driver joins those matrices (two a partition at most) and tells each partition
in which states its border transcripts are entered and left. The result is that of one long Viterbi.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractflow.llm.store import folder

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2 * role, plus 1 where a turn begins

# How transcripts mark their speakers.
MARKERS = {
    "system": "system|instructions?|context",
    "user": "user|human|customer|question|prompt|q",
    "assistant": "assistant|ai|bot|agent|model|answer|response|a",
}
OPEN, CLOSE = r"(?i)^[\s#*<|\[>(]{0,6}(?:", r")[\s*>|\])]{0,4}(?:[:：]\s*|[>|\])]+\s*|$)"
ANYONE = r"^\s{0,3}\p{L}[\p{L}\p{N} ._-]{0,24}[:：](?:\s|$)"
SIZES = {"marker": len(ROLES) + 2, "ask": 2, "length": 4}


def marker_pattern(role: str) -> str:
    return OPEN + MARKERS[role] + CLOSE


def marker(line: Column) -> Column:
    """0 for no marker, 1 + the role's number, or the last number for some other name."""
    kind = F.when(line.rlike(marker_pattern(ROLES[0])), F.lit(1))
    for i, role in enumerate(ROLES[1:], 2):
        kind = kind.when(line.rlike(marker_pattern(role)), F.lit(i))
    return kind.when(line.rlike(ANYONE), F.lit(len(ROLES) + 1)).otherwise(F.lit(0)).cast("int")


def features(line: Column) -> dict[str, Column]:
    n = F.length(line)
    return {
        "marker": marker(line),
        "ask": line.rlike(r"[?？]\s*$").cast("int"),
        "length": F.when(n == 0, 0).when(n < 60, 1).when(n < 240, 2).otherwise(3).cast("int"),
    }


@dataclass
class Model:
    """Log probabilities of the first state, of state after state, and of each feature's values by state."""

    start: np.ndarray
    step: np.ndarray
    seen: dict[str, np.ndarray]


def sorted_lines(lines: DataFrame) -> DataFrame:
    """Lines (conv, turn, tie, line, text and any others) with features, sorted over fixed partitions."""
    spark = lines.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder(spark, "checkpoints"))
    order = ["conv", "turn", "tie", "line"]
    observed = lines.withColumns(features(F.col("text")))
    return observed.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()


def runs(conv: np.ndarray) -> np.ndarray:
    """The first place of every transcript in a partition's lines."""
    return np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]])) if len(conv) else np.empty(0, np.int64)


@dataclass
class Part:
    """A partition's lines: a number for each transcript, the features, and other columns as Arrow tables."""

    table: pa.Table
    conv: np.ndarray
    names: list

    @classmethod
    def of(cls, batches: Iterator[pa.RecordBatch]) -> Part | None:
        held = [b for b in batches if b.num_rows]
        if not held:
            return None
        table = pa.Table.from_batches(held)
        coded = table["conv"].combine_chunks().dictionary_encode(null_encoding="encode")
        return cls(table, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist())

    def scores(self, model: Model) -> np.ndarray:
        out = np.zeros((len(self.conv), STATES))
        for name, table in model.seen.items():
            out += table.T[self.table[name].to_numpy()]
        return out


def matrix(scores: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best score from each state before a run of lines to each state at its end."""
    best = step + scores[0]
    for row in scores[1:]:
        best = (best[:, :, None] + step[None]).max(1) + row
    return best


def decode(scores: np.ndarray, firsts: np.ndarray, entry: np.ndarray, last: dict[int, int | None], step: np.ndarray) -> np.ndarray:
    """The best states of every transcript; ``entry`` has the scores of its first state, ``last`` the last
    states that are given. A step takes the next line of every transcript that has one."""
    size = np.diff(np.append(firsts, len(scores)))
    order = np.argsort(-size, kind="stable")
    first, size = firsts[order], size[order]
    live = np.searchsorted(-size, -np.arange(int(size[0])), "left")
    back = np.zeros((len(scores), STATES), np.int8)
    best = entry[order] + scores[first]
    for i, n in enumerate(live.tolist()):
        if i:
            moves = best[:n, :, None] + step[None]
            back[first[:n] + i] = moves.argmax(1)
            best[:n] = moves.max(1) + scores[first[:n] + i]
    now = best.argmax(1)
    for run, state in last.items():
        if state is not None:
            now[np.flatnonzero(order == run)] = state
    states = np.zeros(len(scores), np.int8)
    for i in range(len(live) - 1, -1, -1):
        at = first[: live[i]] + i
        states[at] = now[: live[i]]
        now[: live[i]] = back[at, now[: live[i]]]
    return states


def known_states() -> Column:
    """The state of a line whose role is known; null roles and other names are null."""
    role = F.when(F.col("known") == ROLES[0], 0)
    for i, name in enumerate(ROLES[1:], 1):
        role = role.when(F.col("known") == name, i)
    return (2 * role + (F.col("line") == 0).cast("int")).cast("int")


COUNTS = pa.schema([("kind", pa.string()), ("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64())])
ENDS = pa.schema(
    [("part", pa.int32()), ("place", pa.int32()), ("conv", pa.string()), ("first", pa.int32()), ("last", pa.int32())]
    + [("opened", pa.list_(pa.float64())), ("moved", pa.list_(pa.float64()))]
)
ENDS_DDL = "part int, place int, conv string, first int, last int, opened array<double>, moved array<double>"


def chains(ordered: DataFrame, model: Model | None) -> list[list[dict]]:
    """The first and last transcript of every partition, in order, grouped by transcript.

    With a model, ``opened`` has the best scores of the states at the end of that part of the transcript
    if it opens there, and ``moved`` those from each state before it.
    """
    sent = ordered.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, m = Part.of(batches), sent.value
        if part is None:
            return
        firsts = runs(part.conv)
        state = part.table["state"].to_pylist() if m is None else [None] * len(part.conv)
        rows = []
        for place, (start, stop) in enumerate({(0, int(np.append(firsts, len(part.conv))[1])): 0, (int(firsts[-1]), len(part.conv)): 1}):
            name = part.names[part.conv[start]]
            opened = moved = None
            if m is not None:
                scores = part.scores(m)[start:stop]
                opened = m.start + scores[0]
                for row in scores[1:]:
                    opened = (opened[:, None] + m.step).max(0) + row
                opened, moved = opened.tolist(), matrix(scores, m.step).ravel().tolist()
            rows.append((TaskContext.get().partitionId(), place, None if name is None else str(name), state[start], state[stop - 1], opened, moved))
        yield pa.RecordBatch.from_pylist([dict(zip(ENDS.names, r, strict=True)) for r in rows], ENDS)

    out: list[list[dict]] = []
    for row in sorted((r.asDict() for r in ordered.mapInArrow(run, ENDS_DDL).collect()), key=lambda r: (r["part"], r["place"])):
        if out and row["place"] == 0 and out[-1][-1]["conv"] == row["conv"]:
            out[-1].append(row)
        else:
            out.append([row])
    return out


def fit(ordered: DataFrame) -> Model:
    """Count states, successions and features over all lines with a known role; every count starts at one half.

    Each partition sends counts of fixed size, and its border states for successions that cross it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Part.of(batches)
        if part is None:
            return
        state = np.array([-1 if x is None else x for x in part.table["state"].to_pylist()])
        known, rows = state >= 0, []

        def add(kind: str, i: np.ndarray, j: np.ndarray, width: int) -> None:
            grid = np.bincount(i * width + j, minlength=STATES * width).reshape(STATES, width)
            rows.extend((kind, int(a), int(b), int(grid[a, b])) for a, b in np.argwhere(grid))

        for name, width in SIZES.items():
            add(name, state[known], part.table[name].to_numpy()[known], width)
        both = (part.conv[1:] == part.conv[:-1]) & known[1:] & known[:-1]
        add("step", state[:-1][both], state[1:][both], STATES)
        opens = state[runs(part.conv)[1:]]  # the first transcript may have begun in an earlier partition
        add("start", opens[opens >= 0], np.zeros(int((opens >= 0).sum()), int), 1)
        yield pa.RecordBatch.from_pylist([dict(zip(COUNTS.names, r, strict=True)) for r in rows], COUNTS)

    counts = {"start": np.full((STATES, 1), 0.5), "step": np.full((STATES, STATES), 0.5)} | {k: np.full((STATES, n), 0.5) for k, n in SIZES.items()}
    for r in ordered.mapInArrow(count, "kind string, i int, j int, n long").groupBy("kind", "i", "j").agg(F.sum("n").alias("n")).collect():
        counts[r["kind"]][r["i"], r["j"]] += r["n"]
    for chain in chains(ordered, None):
        if chain[0]["place"] == 0 and chain[0]["first"] is not None:
            counts["start"][chain[0]["first"], 0] += 1
        for one, two in zip(chain, chain[1:], strict=False):
            if one["last"] is not None and two["first"] is not None:
                counts["step"][one["last"], two["first"]] += 1
    start = counts["start"][:, 0]
    start[0::2] = 1e-300  # a transcript opens with a turn
    normal = lambda x: np.log(x / x.sum(1, keepdims=True))
    return Model(np.log(start / start.sum()), normal(counts["step"]), {k: normal(counts[k]) for k in SIZES})


def told(ordered: DataFrame, model: Model) -> dict[tuple[int, int], tuple[int | None, int | None, bool]]:
    """For the border transcripts of partitions: the state before (None where the transcript opens), the
    state at the end (None where it is free), and whether the transcript goes on."""
    out = {}
    for chain in chains(ordered, model):
        best, ways = np.array(chain[0]["opened"]), []
        for row in chain[1:]:
            moves = best[:, None] + np.array(row["moved"]).reshape(STATES, STATES)
            ways.append(moves.argmax(0))
            best = moves.max(0)
        state = int(best.argmax())
        for i in range(len(chain) - 1, -1, -1):
            before = int(ways[i - 1][state]) if i else None
            out[chain[i]["part"], chain[i]["place"]] = (before, state, i + 1 < len(chain))
            state = before
    return out


def parse(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(conv, turn, line, role, begins, rendered and the columns ``keep``) for every line of the transcripts.

    ``lines`` has conv, turn, tie and line, which order the lines of a transcript, text, and ``known``: the role
    if it is known, from which the model is counted and which no line's own prediction sees. ``rendered``, put
    together in order, is the transcript in canonical form: each turn opens with its role and is closed.
    A marker that agrees with the role is taken off. A null text is an empty line; null conv are one transcript;
    lines that tie in all four columns keep some order. An empty table gives no rows.
    """
    blank = lines.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("state", known_states())
    ordered = sorted_lines(blank)
    model = fit(ordered)
    sent = ordered.sparkSession.sparkContext.broadcast((model, told(ordered, model)))
    fields = ["conv", "turn", "line", *keep]
    schema = ", ".join(f"`{c}` {ordered.schema[c].dataType.simpleString()}" for c in fields) + ", role string, begins boolean, rendered string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Part.of(batches)
        if part is None:
            return
        (m, ends), number = sent.value, TaskContext.get().partitionId()
        firsts, scores = runs(part.conv), part.scores(m)
        entry = np.tile(m.start, (len(firsts), 1))
        before, end, goes_on = ends[number, 0]
        if before is not None:
            entry[0] = m.step[before]
        last = {0: end}
        if len(firsts) > 1:
            _, last[len(firsts) - 1], goes_on = ends[number, 1]
        states = decode(scores, firsts, entry, last, m.step)
        opens, closes = np.zeros(len(states), bool), np.zeros(len(states), bool)
        opens[firsts] = True
        opens[0] = before is None
        closes[np.append(firsts[1:], len(states)) - 1] = True
        closes[-1] = not goes_on
        patterns = [re.compile(marker_pattern(r)) for r in ROLES]
        rendered = []
        columns = (part.table["text"].to_pylist(), states.tolist(), part.table["marker"].to_pylist(), opens.tolist(), closes.tolist())
        for text, state, mark, first, final in zip(*columns, strict=True):
            out = []
            if state & 1:
                out += [] if first else ["<|end|>"]
                out.append(f"<|{ROLES[state // 2]}|>")
                if mark == state // 2 + 1:
                    text = patterns[state // 2].sub("", text, count=1) or None
            out += [] if text is None else [text]
            out += ["<|end|>"] if final else []
            rendered.append("".join(f"{x}\n" for x in out))
        table = part.table.select(fields)
        table = table.append_column("role", pa.array([ROLES[x // 2] for x in states.tolist()], pa.string()))
        table = table.append_column("begins", pa.array((states & 1).astype(bool)))
        yield from table.append_column("rendered", pa.array(rendered, pa.string())).to_batches(max_chunksize=10_000)

    return ordered.mapInArrow(run, schema)
