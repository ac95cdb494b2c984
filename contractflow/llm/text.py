"""Words of whole batches of texts, found and hashed by array operations on their UTF-8 bytes.

A word never spans two texts; no text is cut. Memory is bounded by ``PART_BYTES`` of text or by the
longest single text, times about sixty bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART_BYTES = 3 << 17

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

U64 = np.uint64
_STEP = U64(0xD6E8FEB86659FD93)
_KEY = U64(0x243F6A8885A308D3)
LONG = 512  # bytes; longer runs are hashed and compared one at a time
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)  # the first n bytes of eight


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes of the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


SPACE = byte_table((0x20, 0x20), (0x09, 0x0D))
NOT_SPACE = ~SPACE  # words [^\x20\x09-\x0D]+
ALNUM = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32  # A-Z only


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of x over the result; a bijection of 64-bit numbers."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; past the end come zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run: eight bytes at a time are mixed in, so that no sum of powers can cancel out.

    Equal hashes only suggest equal bytes: ``same_runs`` tells.
    """
    lengths = ends - starts
    out = mix(lengths.astype(U64) * _STEP + _KEY)
    long = np.flatnonzero(lengths > LONG)
    at, live, i = eights(data), np.flatnonzero((lengths > 0) & (lengths <= LONG)), 0
    while len(live):
        block = at[starts[live] + i] & _KEEP[np.minimum(lengths[live] - i, 8)]
        out[live] = mix((out[live] ^ block) + _STEP)
        i += 8
        live = live[lengths[live] > i]
    for j in long.tolist():
        out[j] = int.from_bytes(blake2b(data[starts[j] : ends[j]], digest_size=8).digest(), "little")
    return out


def same_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, from_: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether run i of data has the bytes of run i of the other data."""
    lengths = ends - starts
    same = lengths == to - from_
    one, two, live, i = eights(data), eights(other) if other is not data else None, np.flatnonzero(same & (lengths > 0) & (lengths <= LONG)), 0
    two = one if two is None else two
    while len(live):
        keep = _KEEP[np.minimum(lengths[live] - i, 8)]
        equal = (one[starts[live] + i] & keep) == (two[from_[live] + i] & keep)
        same[live[~equal]] = False
        i += 8
        live = live[equal & (lengths[live] > i)]
    for j in np.flatnonzero(same & (lengths > LONG)).tolist():
        same[j] = data[starts[j] : ends[j]].tobytes() == other[from_[j] : to[j]].tobytes()
    return same


def intern(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte run, equal for equal bytes only; the first run of each number; that run's hash."""
    hashes = run_hashes(data, starts, ends)
    keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    rep = first[which]
    wrong = np.flatnonzero(~same_runs(data, starts, ends, data, starts[rep], ends[rep]))
    if len(wrong):
        names: dict[bytes, int] = {}
        added = []
        for i in wrong.tolist():
            raw = data[starts[i] : ends[i]].tobytes()
            if raw not in names:
                names[raw] = len(first) + len(added)
                added.append(i)
            which[i] = names[raw]
        first = np.concatenate([first, added]).astype(np.int64)
        keys = np.concatenate([keys, hashes[added]])
    return which, first, keys


@dataclass
class Words:
    """The words of a run of texts, in order. ``text`` is the row of each word, ``count`` words per row."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    count: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """The index of each row's first word."""
        return np.cumsum(self.count) - self.count

    def hashes(self) -> np.ndarray:
        return run_hashes(self.data, self.starts, self.ends)


def edges(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, broken where a text begins."""
    if not len(mask):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before = np.empty_like(mask)
    before[0] = False
    before[1:] = mask[:-1]
    begins = offsets[:-1][offsets[:-1] < len(mask)]
    before[begins] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty_like(mask)
    after[-1] = False
    after[:-1] = mask[1:]
    after[begins[begins > 0] - 1] = False
    return starts, np.flatnonzero(mask & ~after) + 1


def row_of(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, at, "right") - 1


def find_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    starts, ends = edges(is_word[data], offsets)
    text = row_of(offsets, starts)
    return Words(data, offsets, starts, ends, text, np.bincount(text, minlength=len(offsets) - 1))


def windows(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the index of their first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    out = hashes[:n] + U64(size)
    for j in range(1, size):
        out ^= out >> U64(29)
        out *= _STEP
        out += hashes[j : j + n]
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    return mix(out[at]), at


def parts(batch: pa.RecordBatch, column: int | str, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows of about ``size`` bytes of text each."""
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def trim() -> None:
    """Give memory that is free in this process back to the machine, where the C library can."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def lean(run: Batches) -> Batches:
    """run, which a task ends by giving back what its arrays took: workers live on from task to task."""

    @wraps(run)
    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return trimmed


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns of these names, in whatever case they are written."""
    gone = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def append(df: DataFrame, text: str, make: Callable[[pa.Array], list], schema: str, size: int = PART_BYTES) -> DataFrame:
    """df with the columns that ``make`` computes from its texts; columns of the same names give way.

    ``make`` gets a slice of the text column, of about ``size`` bytes, cast to string, and returns one array for each
    new column.
    """
    new = T._parse_datatype_string(schema)
    rest = without(df, *new.names)
    whole = df.select(*[F.col(f"`{c}`") for c in rest.columns], F.col(f"`{text}`").cast("string").alias("__text"))
    out = T.StructType(rest.schema.fields + new.fields)
    names = list(out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, batch.num_columns - 1, size):
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in make(part.column(part.num_columns - 1))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names)

    return whole.mapInArrow(lean(run), out)
