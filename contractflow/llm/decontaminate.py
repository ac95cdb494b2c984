"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item is cut into windows of ``window`` words (a shorter item is one window). A window is a
set of word shingles, and a text contains the window only if it contains all of them; so of its
shingles, ordered by how rare they are in the whole corpus, the rarest alone is the necessary prefix.
Documents are probed with those prefix shingles. A match must leave room for the whole window before and
after it in the document (length and positional bound), and is then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractflow.llm.store import written
from contractflow.llm.text import ALNUM, LOWER, U64, append, find_words, lean, parts, run_hashes, utf8, windows

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct (item, words): the windows of all items; an item with a null text or no word has none."""
    lowered = F.translate(F.col(f"`{text}`").cast("string"), CAPITALS, SMALL)
    words = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    each = words.where(F.size("w") > 0).select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))
    return each.distinct()


@dataclass
class Block:
    """A bounded number of windows, as arrays: word hashes (padded), sizes, items and text of each."""

    words: np.ndarray
    size: np.ndarray
    items: list[str | None]
    text: list[bytes]
    shingle: int

    @classmethod
    def of(cls, rows: list, window: int, shingle: int) -> Block:
        texts = [[w.encode() for w in r["words"]] for r in rows]
        flat = [w for t in texts for w in t]
        ends = np.cumsum([len(w) for w in flat])
        hashes = run_hashes(np.frombuffer(b"".join(flat), np.uint8), ends - [len(w) for w in flat], ends)
        size = np.array([len(t) for t in texts])
        words = np.zeros((len(rows), window), U64)
        words[np.arange(window) < size[:, None]] = hashes
        return cls(words, size, [r["item"] for r in rows], [b" ".join(t) for t in texts], shingle)

    def shingles(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each shingle size in use: windows, offsets in them and hashes. Windows too short for the
        usual size are one shingle."""
        for width in np.unique(np.minimum(self.size, self.shingle)):
            rows = np.flatnonzero(np.minimum(self.size, self.shingle) == width)
            longest = int(self.size[rows].max())
            flat = self.words[rows, :longest].ravel()
            hashes, at = windows(flat, np.repeat(np.arange(len(rows)), longest), int(width))
            row, offset = np.divmod(at, longest)
            inside = offset + width <= self.size[rows][row]
            yield int(width), rows[row[inside]], offset[inside], hashes[inside]


@dataclass
class Probe:
    """The prefix of each window of a block: its rarest shingle, sorted by hash for each shingle size."""

    block: Block
    prefix: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, block: Block, seen: dict[tuple[int, int], int]) -> Probe:
        prefix = []
        for width, row, offset, hashes in block.shingles():
            times = np.array([seen.get((width, int(h)), 0) for h in hashes.view(np.int64)], np.int64)
            order = np.lexsort((offset, hashes, times, row))
            rarest = order[np.unique(row[order], return_index=True)[1]]
            by_hash = rarest[np.argsort(hashes[rarest], kind="stable")]
            prefix.append((width, hashes[by_hash], row[by_hash], offset[by_hash]))
        return cls(block, prefix)

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, object]:
        """For every occurrence of a window: its text, first word and window; and the words."""
        data, offsets = utf8(texts)
        data = LOWER[data]
        words = find_words(data, offsets, ALNUM)
        hashes = words.hashes()
        first, found = words.first, []
        for width, keys, row, offset in self.prefix:
            shingles, at = windows(hashes, words.text, width)
            low = np.searchsorted(keys, shingles, "left")
            hit = np.flatnonzero((low < len(keys)) & (keys[np.minimum(low, len(keys) - 1)] == shingles))
            low, at = low[hit], at[hit]
            many = np.searchsorted(keys, shingles[hit], "right") - low
            entry = np.arange(int(many.sum())) + np.repeat(low - (np.cumsum(many) - many), many)
            at = np.repeat(at, many)
            window, start = row[entry], at - offset[entry]
            text = words.text[at]
            size = self.block.size[window]
            room = (start >= first[text]) & (start + size <= first[text] + words.count[text])
            found.append((text[room], start[room], window[room]))
        text, start, window = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))
        size = self.block.size[window]
        same = np.ones(len(text), bool)
        for j in range(self.block.words.shape[1]):
            used = same & (size > j)
            same[used] = hashes[start[used] + j] == self.block.words[window[used], j]
        keep = np.flatnonzero(same)
        exact = []
        for i in keep.tolist():
            a, n = int(start[i]), int(size[i])
            run = zip(words.starts[a : a + n].tolist(), words.ends[a : a + n].tolist(), strict=True)
            exact.append(b" ".join([data[s:e].tobytes() for s, e in run]) == self.block.text[window[i]])
        keep = keep[np.array(exact, bool)] if exact else keep
        return text[keep], start[keep], window[keep], words


def shingle_counts(docs: DataFrame, text: str, block) -> dict[tuple[int, int], int]:
    """How often each shingle of a block occurs in all documents; at most as many rows as the block has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [(width, np.unique(hashes)) for width, _, _, hashes in block.value.shingles()]
        total = [np.zeros(len(keys), np.int64) for _, keys in wanted]
        for batch in batches:
            for part in parts(batch, 0):
                data, offsets = utf8(part.column(0))
                words = find_words(LOWER[data], offsets, ALNUM)
                hashes = words.hashes()
                for (width, keys), times in zip(wanted, total, strict=True):
                    shingles, _ = windows(hashes, words.text, width)
                    at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
                    times += np.bincount(at[keys[at] == shingles], minlength=len(keys))
        for (width, keys), times in zip(wanted, total, strict=True):
            some = times > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.full(int(some.sum()), width, np.int32)), pa.array(keys[some].view(np.int64)), pa.array(times[some])], ["width", "hash", "n"])

    counted = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(lean(run), "width int, hash long, n long")
    return {(r["width"], r["hash"]): r["n"] for r in counted.groupBy("width", "hash").agg(F.sum("n").alias("n")).collect()}


SCHEMA = "n_words long, hit_spans array<struct<start:int,stop:int>>, item_ids array<string>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def runs(covered: np.ndarray) -> list[dict[str, int]]:
    """The runs of true values."""
    turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [{"start": int(a), "stop": int(b)} for a, b in zip(turns[::2], turns[1::2], strict=True)]


def find(docs: DataFrame, text: str, probe) -> DataFrame:
    def make(texts: pa.Array) -> list[pa.Array]:
        p = probe.value
        text_at, start, window, words = p.hits(texts)
        spans: list[list] = [[]] * len(texts)
        items: list[list] = [[]] * len(texts)
        order = np.argsort(text_at, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(text_at[order])) + 1) if len(order) else []:
            row = int(text_at[at[0]])
            covered = np.zeros(int(words.count[row]), bool)
            for a, w in zip((start[at] - words.first[row]).tolist(), window[at].tolist(), strict=True):
                covered[a : a + int(p.block.size[w])] = True
            spans[row] = runs(covered)
            items[row] = sorted({p.block.items[w] for w in window[at].tolist()} - {None})
        return [pa.array(words.count.astype(np.int64)), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))]

    return append(docs, text, make, SCHEMA)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 5,
    block_windows: int = 200_000,
) -> DataFrame:
    """docs with ``n_words``, ``hit_spans`` (runs of hit words, from 0), ``item_ids`` (sorted as strings),
    ``n_hit`` and ``contaminated``.

    A null or empty text has no words and is clean; so is everything if there are no items. Items with
    a null or empty text have no windows; an item with a null id marks words but is in no list. Repeated
    items count once, repeated documents are judged one by one. Columns of docs named like new ones give way.

    A pass takes at most about ``block_windows`` windows, which are sent to every task; a larger benchmark
    takes more passes over all documents, each kept in the shared folder, so that memory does not grow.
    """
    spark = docs.sparkSession
    found = written(item_windows(items, item_id, item_text, window), "windows")
    blocks = max(1, -(-found.count() // block_windows))
    numbered = found.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        block = Block.of(numbered.where(F.col("block") == b).collect(), window, shingle)
        sent = spark.sparkContext.broadcast(block)
        probe = spark.sparkContext.broadcast(Probe.of(block, shingle_counts(docs, text, sent)))
        if out is None:
            out = find(docs, text, probe)
        else:
            before = out.withColumnsRenamed({"hit_spans": "__spans", "item_ids": "__items"})
            out = find(written(before, "hits"), text, probe)
            out = out.withColumn("item_ids", F.sort_array(F.array_distinct(F.concat("__items", "item_ids"))))
            out = out.withColumn("hit_spans", merged(F.concat("__spans", "hit_spans"))).drop("__spans", "__items")
    total = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"]))
    named = out.select(*[F.col(f"`{c}`") for c in out.columns if c.lower() not in ("n_hit", "contaminated")], total.alias("n_hit"))
    return named.withColumn("contaminated", F.col("n_hit") > 0)


def merged(spans):
    """Sorted spans, joined where they meet or overlap."""

    def add(done, s):
        last = F.element_at(done, -1)
        meets = (F.size(done) > 0) & (s["start"] <= F.when(F.size(done) > 0, last["stop"]))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        return F.when(F.coalesce(meets, F.lit(False)), joined).otherwise(F.concat(done, F.array(s)))

    none = F.array().cast("array<struct<start:int,stop:int>>")
    return F.aggregate(F.sort_array(spans), none, add)
