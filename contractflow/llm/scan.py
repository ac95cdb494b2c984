"""Running values along sorted groups of any size, exact across the borders of partitions.

The rows are range-sorted, so that one large group is spread over as many tasks as its rows need. Every value
follows v = v * factor + row (modulo a number), so a task can sum up what a run of rows does to a value that
it does not know yet. A first pass sends that for the first and the last group of each partition, the driver
carries the values over the borders (some numbers a partition), and a second pass writes them to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from contractflow.llm.store import folder


@dataclass(frozen=True)
class Running:
    """``value`` names a long or binary column; a null leaves the running value as it is.

    Results are longs, or 16 bytes where ``modulus`` is larger than a long; ``was`` also keeps the value before the row.
    """

    value: str
    start: int = 0
    factor: int = 1
    modulus: int | None = None
    was: bool = False

    @property
    def wide(self) -> bool:
        return self.modulus is not None and self.modulus > 1 << 63

    def step(self, state: int, value: int | bytes) -> int:
        state = state * self.factor + (int.from_bytes(value, "big") if isinstance(value, bytes) else value)
        return state if self.modulus is None else state % self.modulus

    def after(self, state: int, rows: int, done: int) -> int:
        """The value after ``rows`` steps that would have made ``done`` of nothing."""
        if self.modulus is None:
            return state * self.factor**rows + done
        return (state * pow(self.factor, rows, self.modulus) + done) % self.modulus

    def array(self, values: list[int]) -> pa.Array:
        return pa.array([v.to_bytes(16, "big") for v in values], pa.binary()) if self.wide else pa.array(values, pa.int64())


def fixed(df: DataFrame, *order: str) -> DataFrame:
    """df sorted over partitions that stay as they are, by a reliable checkpoint."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder(spark, "checkpoints"))
    return df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()


def running(df: DataFrame, group: str, order: list[str], columns: dict[str, Running]) -> DataFrame:
    """df with the running value of each of ``columns`` (and of ``<name>_was`` where asked for), and ``last``: whether
    the row is the last of its group. Rows that tie in group and order keep some order among them."""
    held = fixed(df, group, *order)
    names, steps = list(held.columns), list(columns.values())
    at_group, at_value = names.index(group), [names.index(s.value) for s in steps]

    def follow(batch: pa.RecordBatch) -> Iterator[tuple]:
        yield from zip(batch.column(at_group).to_pylist(), *[batch.column(i).to_pylist() for i in at_value], strict=True)

    def shown(group) -> str | None:
        return None if group is None else str(group)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the first group's rows of a partition do to the values, and likewise the last group's."""
        first = now = None
        for batch in batches:
            for g, *values in follow(batch):
                if now is None or now[0] != g:
                    if now is not None and first is None:
                        first = now
                    now = (g, [0] * len(steps), [0] * len(steps))
                for j, v in enumerate(values):
                    if v is not None:
                        now[1][j] += 1
                        now[2][j] = steps[j].step(now[2][j], v)
        if now is None:
            return
        runs = [now] if first is None else [first, now]
        rows = [(TaskContext.get().partitionId(), i, shown(g), n, [str(x) for x in done]) for i, (g, n, done) in enumerate(runs)]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "place", "name", "rows", "done"])

    found = held.mapInArrow(ends, "part int, place int, name string, rows array<long>, done array<string>").collect()
    entry: dict[int, tuple[list[int], str | None]] = {}  # of each partition that goes on with the group before
    follows: dict[int, tuple[str | None]] = {}  # the group that comes next after each partition
    before: tuple | None = None
    for r in sorted(found, key=lambda r: (r["part"], r["place"])):
        starts = [s.start for s in steps]
        if r["place"] == 0 and before is not None:
            follows[before[0]] = (r["name"],)
            if before[1] == r["name"]:
                starts = before[2]
                entry[r["part"]] = (starts, r["name"])
        before = (r["part"], r["name"], [s.after(x, n, int(d)) for s, x, n, d in zip(steps, starts, r["rows"], r["done"], strict=True)])
    sent = df.sparkSession.sparkContext.broadcast((entry, follows))

    new = []
    for name, s in columns.items():
        new += [(n, T.BinaryType() if s.wide else T.LongType()) for n in ([name, f"{name}_was"] if s.was else [name])]
    out = T.StructType([*held.schema.fields, *[T.StructField(n, t) for n, t in new], T.StructField("last", T.BooleanType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (entry, follows), part = sent.value, TaskContext.get().partitionId()
        state, now, waiting = [s.start for s in steps], None, None
        if part in entry:
            state, name = list(entry[part][0]), entry[part][1]

        def made(batch: pa.RecordBatch, values: list[list[int]], was: list[list[int]], last: list[bool]) -> pa.RecordBatch:
            arrays = []
            for s, v, w in zip(steps, values, was, strict=True):
                arrays += [s.array(v), s.array(w)] if s.was else [s.array(v)]
            return pa.RecordBatch.from_arrays([*batch.columns, *arrays, pa.array(last, pa.bool_())], list(out.names))

        for batch in batches:
            values, was, last = [[] for _ in steps], [[] for _ in steps], []
            for g, *row in follow(batch):
                if now is None or now[0] != g:
                    if now is not None or part not in entry or shown(g) != name:
                        state = [s.start for s in steps]
                    if last:
                        last[-1] = True
                    elif waiting:
                        waiting[3][-1] = True
                    now = (g,)
                for j, v in enumerate(row):
                    was[j].append(state[j])
                    if v is not None:
                        state[j] = steps[j].step(state[j], v)
                    values[j].append(state[j])
                last.append(False)
            if last:
                if waiting:
                    yield made(*waiting)
                waiting = (batch, values, was, last)
        if waiting:
            waiting[3][-1] = part not in follows or follows[part][0] != shown(now[0])
            yield made(*waiting)

    return held.mapInArrow(walk, out)
