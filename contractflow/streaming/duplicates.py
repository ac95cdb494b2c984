"""The rule that a key may come once, on a stream: duplicates are flagged as they arrive, and keys expire.

Of rows that arrive together a task settles repeated keys among its own rows first, without state, so a hot key costs
the stateful step a row a task and not a row a message. The first row of each task and key is held against
the state, which remembers a key until the watermark has passed the key's first time by the horizon. The state lives in
the checkpoint, so a restart knows what came before it. Keys share their state and the call that judges them with all keys of
the same hash bucket: a call for each key took some ten milliseconds a key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from contractflow.operators.validate import ERRORS, VALID

DUPLICATE = "is_duplicate"

# Hash buckets of keys; a checkpoint holds the state of these, so another number needs a new checkpoint.
BUCKETS = 1024
# What a bucket remembers: its keys as texts, their first times and when they expire, in milliseconds.
HELD = "keys array<string>, firsts array<long>, expiries array<long>"


def _again(rows: DataFrame) -> DataFrame:
    """rows (with __key) and whether the task has had the key in this batch already."""
    out = T.StructType([*rows.schema.fields, T.StructField("__again", T.BooleanType())])
    at = rows.columns.index("__key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            again = []
            for key in batch.column(at).to_pylist():
                again.append(key in seen)
                seen.add(key)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(again, pa.bool_())], list(out.names))

    return rows.mapInArrow(run, out)


def _exact(kind: T.DataType) -> T.DataType:
    """The type with texts for longs: pandas holds longs beside nulls as doubles, which are not exact."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _exact(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_exact(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(_exact(kind.keyType), _exact(kind.valueType), kind.valueContainsNull)
    return T.StringType() if isinstance(kind, T.LongType) else kind


def flag_duplicates(stream: DataFrame, keys: Sequence[str], event: str, horizon: str = "1 day") -> DataFrame:
    """The rows of a stream with ``is_duplicate``: whether their key came before, within ``horizon`` of event time.

    Of rows with one key in one batch one is no duplicate, if the key is new. A row whose key has a null part, or without an
    event time, is never a duplicate. A row that comes later than the watermark, ``horizon`` behind the latest event, is judged by
    what the state still knows. Columns keep their order; the flag comes last.
    """
    columns = stream.columns
    known = F.col(event).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    # the key as text: lengths tell parts apart
    text = F.concat(*[F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")) for k in keys])
    timed = stream.withColumns({"__key": text, "__time": F.col(event).cast("timestamp")}).withWatermark("__time", horizon)
    settled = _again(timed.where(known))
    seconds = int(pd.Timedelta(horizon).total_seconds())
    exact = {f.name: _exact(f.dataType) for f in stream.schema.fields}
    schema = T.StructType([*[T.StructField(name, kind) for name, kind in exact.items()], T.StructField(DUPLICATE, T.BooleanType())])

    def judge(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {k: (first, expiry) for k, first, expiry in zip(*state.get, strict=True)} if state.exists else {}
        came: dict[str, int] = {}
        if not state.hasTimedOut:
            for frame in frames:
                flags = []
                # whole milliseconds, rounded down like the watermark's
                times = frame["__time"].dt.as_unit("ms").astype("int64").tolist()
                for key, at in zip(frame["__key"].tolist(), times, strict=True):
                    flags.append(key in held or key in came)
                    came[key] = min(at, came.get(key, at))
                yield frame[columns].assign(**{DUPLICATE: flags})
        now = state.getCurrentWatermarkMs()
        kept = {k: times for k, times in held.items() if times[1] >= now}
        for key, at in came.items():
            first = min(at, held[key][0]) if key in held else at
            kept[key] = first, max(first + 1000 * seconds, now + 1)
        if not kept:
            state.remove()
            return
        firsts, expiries = zip(*kept.values(), strict=True)
        state.update((list(kept), list(firsts), list(expiries)))
        state.setTimeoutTimestamp(max(min(expiries), now + 1))

    bucket = F.pmod(F.xxhash64("__key"), F.lit(BUCKETS))
    fresh = settled.where("NOT __again").drop("__again").withColumns({**{name: F.col(name).cast(kind) for name, kind in exact.items()}, "__bucket": bucket})
    told = fresh.groupBy("__bucket").applyInPandasWithState(judge, schema, HELD, "append", GroupStateTimeout.EventTimeTimeout)
    judged = told.select(*[F.col(f.name).cast(f.dataType) for f in stream.schema.fields], DUPLICATE)
    repeated = settled.where("__again").select(*columns, F.lit(True).alias(DUPLICATE))
    unkeyed = timed.where(~known).select(*columns, F.lit(False).alias(DUPLICATE))
    return judged.union(repeated).union(unkeyed)


def with_duplicate_rule(flagged: DataFrame, rule: str, field: str) -> DataFrame:
    """The flag as a broken rule of tagged rows: its message is added to the errors, and the row is no longer valid."""
    message = F.lit(f"DUPLICATE_VIOLATION [{rule}]: '{field}' came before")
    errors = F.when(F.col(DUPLICATE), F.array_append(ERRORS, message)).otherwise(F.col(ERRORS))
    return flagged.withColumns({ERRORS: errors, VALID: F.col(VALID) & ~F.col(DUPLICATE)}).drop(DUPLICATE)
