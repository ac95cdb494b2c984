"""Best-fit decreasing packing of token runs into sequences of bounded length.

Best-fit decreasing sees only lengths, and there are no more distinct lengths than tokens in a sequence.
So the driver packs the histogram of lengths, whatever the number of documents: runs of equal
documents go into runs of equal bins, and a segment tree over remaining capacities finds the tightest
open bins in logarithmic time. The result is that of best fit run document by document. The plan
(which ranks of a length go to which bins, at which offset) is sent to the tasks, which place their own pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.llm.pretokens import cut, lexicon
from contractflow.llm.store import written
from contractflow.llm.text import lean, parts, utf8


class OpenBins:
    """Runs of bins by remaining capacity, with a segment tree that tells which capacities are in use."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.used = bytearray(2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def _mark(self, room: int) -> None:
        i = room + self.size
        self.used[i] = bool(self.runs[room])
        while i > 1:
            i //= 2
            self.used[i] = self.used[2 * i] or self.used[2 * i + 1]

    def add(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.runs[room].append((first, count))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._mark(room)
        return run

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of at least ``length`` that some open bin has."""
        i = length + self.size
        while not self.used[i]:
            while i & 1:  # a right child: nothing to the right below this parent
                i //= 2
            if not i:
                return None
            i += 1
            if i & (i - 1) == 0:  # past the end of a level
                return None
        while i < self.size:
            i = 2 * i if self.used[2 * i] else 2 * i + 1
        return i - self.size


def plan(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing on a histogram: rows (length, first rank, count, first bin, offset), and the number of bins."""
    open_bins, rows, bins = OpenBins(capacity), [], 0
    for at in np.argsort(-lengths):
        length, left, rank = int(lengths[at]), int(counts[at]), 0
        while left:
            room = open_bins.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                first, many = bins, -(-left // each)
                bins += many
            else:
                first, many = open_bins.take(room)
                each = room // length
            # a bin that has taken one piece is tighter than before, so it takes all that fit
            full = min(many, left // each)
            spare = left - full * each if full < many else 0
            for j in range(each if full else 0):
                rows.append((length, rank, full, first, capacity - room + j * length))
                rank += full
            open_bins.add(room - each * length, first, full)
            if spare:
                for j in range(spare):
                    rows.append((length, rank, 1, first + full, capacity - room + j * length))
                    rank += 1
                open_bins.add(room - spare * length, first + full, 1)
            untouched = many - full - (spare > 0)
            open_bins.add(room, first + full + (spare > 0), untouched)
            left -= full * each + spare
    return np.array(rows, np.int64).reshape(-1, 5), bins


def token_runs(docs: DataFrame, tokenizer_path: str, text: str, doc_id: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """The pieces of all documents, numbered within their partition among pieces of the same length."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType)]).simpleString()[7:-1].replace(":", " ", 1)
    schema += ", piece int, start long, length long, ids_crc32 long, part int, nth long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for one in parts(batch, 1):
                texts = one.column(1)
                data, starts, ends, row = cut(texts, tokenizer_path, spaces=False)
                words = lexicon(tokenizer_path, True)
                slots = words.slots(data, starts, ends) if len(starts) else np.empty(0, np.int64)
                size = words.sizes()[slots] if len(slots) else slots
                total = np.bincount(row, size, len(texts)).astype(np.int64) + 1
                stop = np.cumsum(total)
                ids = np.full(int(stop[-1]), end_id, np.uint32)
                inside = np.ones(len(ids), bool)
                inside[stop - 1] = False
                before = np.cumsum(size) - size
                ids[inside] = words.ids[np.arange(int(size.sum())) + np.repeat(words.first[slots] - before, size)]
                n_pieces = -(-total // capacity)
                doc = np.repeat(np.arange(len(total)), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * capacity
                length = np.minimum(total[doc] - start, capacity)
                begin = (stop - total)[doc] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                kinds, first, times = np.unique(length[order], return_index=True, return_counts=True)
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - np.repeat(first, times) + seen[length[order]]
                seen[kinds] += times
                columns = [one.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), start, length, pa.array(crc, pa.int64()), np.full(len(doc), part, np.int32), nth]
                columns = [pa.array(c) if isinstance(c, np.ndarray) else c for c in columns]
                if with_ids:
                    cuts = np.append(begin, len(ids)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(cuts, ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"][: len(columns)])

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(lean(run), schema)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    capacity: int = 4096,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset, and ids if asked for.

    A document is its token ids and ``end_id``; a null or empty text has ``end_id`` alone. Only documents
    longer than ``capacity`` are cut, into pieces of that length and a rest. Repeated rows are packed one by
    one; a null doc_id stays null; other columns of docs are not read. An empty table gives no rows.
    The tokenizer must lower-case and drop white space, as ``Lexicon`` says.

    A histogram of at most ``capacity`` lengths reaches the driver, and the plan's size depends on the
    capacity alone. Pieces are written once to the shared folder, which fixes their numbering.
    """
    pieces = written(token_runs(docs, tokenizer_path, text, doc_id, capacity, end_id, with_ids), "pieces")
    local = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = local.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    found = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    rows, _ = plan(np.array([r["length"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64), capacity)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    sent = docs.sparkSession.sparkContext.broadcast(rows)
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("base")).drop("part", "nth", "base")
    out = T.StructType([*ranked.drop("rank").schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        keys = (table[:, 0] << 44) | table[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("length", "rank"))
            at = np.searchsorted(keys, (length << 44) | rank, "right") - 1
            bins = table[at, 3] + rank - table[at, 1]
            rest = [batch.column(name) for name in out.names[:-2]]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(bins), pa.array(table[at, 4])], out.names)

    return ranked.mapInArrow(place, out)
