"""Near-duplicate classes by an exact join in Jaccard space.

The Jaccard distance is a metric. Pivots drawn from all documents would divide nothing: unrelated texts are
at distance 1 from each other and from every pivot, so each would lie in every window. So the space is
first divided where distances differ. Shingles are ordered by how rare they are; two sets
closer than the radius share one of the rarest few shingles of each (the prefix), so the sets with one such
shingle form a region, and the region of the first shingle that two sets share answers for the pair.
Then, recursively and exactly:

* every region has a pivot; a set's cell is that of the pivot it shares most prefix shingles with, and
  its distance to that pivot is computed;
* two sets are compared whole only if their prefixes share as many shingles as close sets must;
* sets within the radius of their pivot are linked to it, and what is linked needs no other comparison;
* regions that still hold sets of several components are joined again around more pivots. Of two sets in
  one cell only those are compared whose distances to the cell's pivot differ by the radius at most
  (triangle inequality); size and position in the order bound what any two sets can share. A set that
  was a pivot has met its whole region and leaves it, until no region holds two components.

Equal sets are one node throughout. Sets are compared as 64-bit hashes of their shingles.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractflow.llm.components import components, roots
from contractflow.llm.store import discard, small_batches, written
from contractflow.llm.text import LOWER, NOT_SPACE, U64, find_words, lean, mix, parts, utf8, windows

SKETCH_BITS = (21, 24)  # of the shingle's hash, by the number of documents: counts for the order by rarity
CHUNK = 1 << 14
FILTER_BITS = 27  # of a row's hash: which texts to read again
FIRST_PIVOTS = 64
SENT_NODES = 500_000  # of at most 24 bytes each


def packed(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every shingle. Fewer words than ``size`` are one shingle; no words are none."""
    data, offsets = utf8(texts)
    words = find_words(LOWER[data], offsets, NOT_SPACE)
    hashes = words.hashes()
    full, at = windows(hashes, words.text, size)
    text = words.text[at]
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(short):
        first = words.first
        some = np.array([windows(hashes[first[i] : first[i] + words.count[i]], np.zeros(words.count[i], np.int64), int(words.count[i]))[0][0] for i in short], U64)
        text, full = np.concatenate([text, short]), np.concatenate([full, some])
        order = np.argsort(text, kind="stable")
        text, full = text[order], full[order]
    return text, full


def sketch(docs: DataFrame, size: int, bits: int) -> np.ndarray:
    """How often shingles occur in all documents, by the leading bits of their hash: an array of fixed size.

    A task sends what it has counted, in chunks, full ones whole and others as the cells in use.
    """
    cells = 1 << bits
    names = ["chunk", "at", "counts"]

    def sent(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        rows = []
        for chunk, counts in total.items():
            used = np.flatnonzero(counts)
            if len(used):
                whole = 4 * len(used) > 3 * CHUNK
                rows.append((chunk, b"" if whole else used.astype(np.uint16).tobytes(), packed(counts if whole else counts[used])))
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting = np.zeros(cells, np.int64), []

        def settle() -> None:
            used, times = np.unique(np.concatenate(waiting), return_counts=True)
            total[used] += times
            waiting.clear()

        for batch in batches:
            for part in parts(batch, 0):
                _, hashes = shingles(part.column(0), size)
                waiting.append((hashes >> U64(64 - bits)).astype(np.uint32))
                if sum(map(len, waiting)) > cells // 4:
                    settle()
        if waiting:
            settle()
        yield sent({i // CHUNK: total[i : i + CHUNK] for i in range(0, cells, CHUNK)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                counts = unpacked(row["counts"], np.int64)
                total.setdefault(row["chunk"], np.zeros(CHUNK, np.int64))[np.frombuffer(row["at"], np.uint16) if row["at"] else slice(None)] += counts
        yield sent(total)

    schema = "chunk int, at binary, counts binary"
    out = np.zeros((cells // CHUNK, CHUNK), np.int64)
    for row in docs.select("text").mapInArrow(lean(count), schema).repartition(16, "chunk").mapInArrow(add, schema).toLocalIterator():
        out[row["chunk"], np.frombuffer(row["at"], np.uint16) if row["at"] else slice(None)] = unpacked(row["counts"], np.int64)
    return out.ravel()


def distinct(text: np.ndarray, hashes: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash), by text and within a text from rare to common: by rarity class, then by hash."""
    if not len(text):
        return text, hashes
    rank = rarity[(hashes >> U64(64 - (len(rarity).bit_length() - 1))).astype(np.int64)]
    if text[-1] < 1 << 16:
        key = (text.astype(U64) << U64(48)) | (rank.astype(U64) << U64(32)) | (hashes >> U64(32))
        order = np.argsort(key)
        sorted_key = key[order]
        tied = (sorted_key[1:] == sorted_key[:-1]) & (hashes[order[1:]] != hashes[order[:-1]])
        if tied.any():
            order = np.lexsort((hashes, rank, text))
    else:
        order = np.lexsort((hashes, rank, text))
    text, hashes = text[order], hashes[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[first], hashes[first]


def signatures(text: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two sums over mixed shingles for each text: equal for equal sets."""
    n = np.bincount(text, minlength=rows)
    first = (np.cumsum(n) - n)[n > 0]
    sums = []
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(rows, U64)
        if len(first):
            total[n > 0] = np.add.reduceat(mix(hashes ^ U64(seed)), first)
        sums.append(total.view(np.int64))
    return n.astype(np.int64), *sums


def measured(docs: DataFrame, size: int, percent: int, rarity) -> DataFrame:
    """(doc_id, k, n, sig_a, sig_b, prefix) of every document; k is a hash of its id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 1):
                text, hashes = distinct(*shingles(part.column(1), size), rarity.value)
                n, a, b = signatures(text, hashes, part.num_rows)
                length = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
                place = np.arange(len(text)) - (np.cumsum(n) - n)[text]
                tokens = hashes[place < length[text]].view(np.int64)
                prefix = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length)]).astype(np.int32), tokens)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n), pa.array(a), pa.array(b), prefix], ["doc_id", "k", "n", "sig_a", "sig_b", "prefix"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(lean(run), f"doc_id {kind}, k long, n long, sig_a long, sig_b long, prefix array<long>")


KEY = ["sig_a", "sig_b", "n"]


def sets_of(docs: DataFrame, wanted: DataFrame, size: int, rarity, rows: int) -> DataFrame:
    """(sig_a, sig_b, n, shingles) of the wanted nodes, from the text of one row of each.

    A filter of fixed size over the rows' hashes k goes to all tasks, so that only the wanted rows (and
    chance matches) are read again into shingles; nothing is shuffled, unless rows are repeated.
    """
    cells, word = 1 << FILTER_BITS, F.pmod("k", F.lit(1 << FILTER_BITS))
    words = wanted.groupBy(F.floor(word / 64).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(k, {cells}) % 64 AS INT))")).alias("bits"))
    table = words.toArrow()
    bits = np.zeros(cells // 64, np.int64)
    bits[table["word"].to_numpy()] = table["bits"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = sent.value, set()
        for batch in batches:
            k = batch.column(2).to_numpy(zero_copy_only=False)
            at = k & (cells - 1)
            hit = [i for i in np.flatnonzero((held[at >> 6] >> (at & 63)) & 1).tolist() if not (k[i] in seen or seen.add(k[i]))]
            for part in parts(batch.take(pa.array(hit, pa.int64())), 1):
                text, hashes = distinct(*shingles(part.column(1), size), rarity.value)
                n, a, b = signatures(text, hashes, part.num_rows)
                sets = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), hashes.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n), sets], [*KEY, "shingles"])

    found = written(docs.mapInArrow(lean(run), "sig_a long, sig_b long, n long, shingles array<long>"), "shingles")
    sent.destroy()
    twice = written(found.groupBy(*KEY).agg(F.count("*").alias("held")).where("held > 1").select(*KEY), "twice", rows)
    some = twice.count()
    if not some:
        discard(twice)
        return found
    few = F.broadcast(twice) if some <= SENT_NODES else twice
    again = found.join(few, KEY, "left_semi").groupBy(*KEY).agg(F.first("shingles").alias("shingles"))
    out = written(found.join(few, KEY, "left_anti").unionByName(again), "shingles")
    discard(found, twice)
    return out


def could_share(percent: int, n: Column, pos: Column, m: Column, at: Column) -> Column:
    """Whether sets of n and m shingles whose first shared one is at these places can be close enough:
    they need an overlap of percent/(100+percent) of both sizes, and no more than the rest can be shared."""
    return F.least(n - pos, m - at) * (100 + percent) >= percent * (n + m)


def ends_of(pairs: DataFrame, rows: int) -> DataFrame:
    return written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "ends", rows)


def possible(pairs: DataFrame, ends: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes share as much as close sets must.

    Sets of n and m shingles that are close share a number o of them. The i-th shared one has at most
    n - o shingles before it in the one set that the other lacks, so at least o - n + p of the shared ones lie in
    a prefix of p, and the lesser such number in both. And o is no more than either size.
    """
    held = nodes.select("node", "n", "prefix").join(F.broadcast(ends) if ends.count() <= SENT_NODES else ends, "node")
    one, two = (held.select(*[F.col(c).alias(f"{c}_{x}") for c in held.columns]) for x in "ab")
    both = pairs.hint("merge").join(two, F.col("b") == F.col("node_b")).hint("merge").join(one, F.col("a") == F.col("node_a"))
    n, m = F.col("n_a"), F.col("n_b")
    least = F.ceil(percent * (n + m) / F.lit(100 + percent))
    lie = F.least(least - n + F.size("prefix_a"), least - m + F.size("prefix_b"))
    shared = F.size(F.array_intersect("prefix_a", "prefix_b"))
    return both.where((least <= F.least(n, m)) & (shared >= lie)).select("a", "b")


def verified(pairs: DataFrame, wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, total) for pairs of nodes: sizes of the intersection and of the union.

    Both joins read the sets by one shuffle. They are merge joins at any size, so that a larger input
    does the same work.
    """
    ends = [wanted.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in KEY]) for x in "ab"]
    keyed = pairs.join(ends[0], "a").join(ends[1], "b").hint("merge")

    def on(x: str):
        return [F.col(f"{c}_{x}") == sets[c] for c in KEY]

    one = keyed.join(sets, on("b")).withColumnRenamed("shingles", "s_b").drop(*KEY).hint("merge")
    both = one.join(sets, on("a"))
    common = F.size(F.array_intersect("s_b", "shingles")).cast("long").alias("common")
    return both.select("a", "b", common, (F.col("n_a") + F.col("n_b")).alias("both")).select("a", "b", "common", (F.col("both") - F.col("common")).alias("total"))


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = 4,
    percent: int = 85,
    log: Callable[[str], None] = lambda line: None,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs.

    Two documents link when 100 * intersection >= percent * union of their shingle sets; the
    component is the smallest doc_id that links reach, itself included. A null or empty text, or one without
    words, has an empty set, links with nothing and is its own component. A null doc_id is kept and is
    the smallest of no component that holds another; repeated rows are returned each. Other columns are not read.
    Large intermediate tables are written to the shared folder; only fixed-size sketches reach the driver.
    """
    with small_batches(docs.sparkSession):  # every job over texts runs in here
        return _near_duplicates(docs, text, doc_id, size, percent, log)


def _near_duplicates(docs: DataFrame, text: str, doc_id: str, size: int, percent: int, log: Callable[[str], None]) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).withColumn("k", F.xxhash64("doc_id", "text"))
    count = docs.count()
    least, most = SKETCH_BITS
    counts = sketch(docs, size, min(max(count.bit_length(), least), most))
    rarity = spark.sparkContext.broadcast(np.round(np.log2(1.0 + counts) * 1000).astype(np.uint16))
    rows = written(measured(docs, size, percent, rarity), "sets")
    classes = rows.where("n > 0").groupBy(*KEY).agg(F.min("doc_id").alias("low"), F.first("prefix").alias("prefix"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k"))["k"].alias("k"))
    nodes = written(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    del counts
    tokens = nodes.select(F.posexplode("prefix").alias("pos", "token"), "node", "n")
    pivots = tokens.groupBy("token").agg(F.count("*").alias("held"), F.min("node").alias("pivot")).where("held > 1")
    regions = written(tokens.join(pivots, "token").select("token", "node", "n", "pos", "pivot"), "regions")

    # cells: the pivot with which a set shares most of its prefix; a pivot is the region's least node
    shared = regions.where("node <> pivot").select("node", "pivot").repartition("node").groupBy("node", "pivot").agg(F.count("*").alias("times"))
    cells = shared.groupBy("node").agg(F.max_by("pivot", F.struct("times", -F.col("pivot"))).alias("pivot"))
    pairs = written(cells.select(F.col("pivot").alias("a"), F.col("node").alias("b")), "pairs", count)

    def measure(pairs: DataFrame) -> DataFrame:
        some = max(pairs.count(), 1)
        ends = ends_of(pairs, some)
        close = written(possible(pairs, ends, nodes, percent), "close", some)
        discard(ends)
        ends = ends_of(close, some)
        wanted = written(nodes.select("node", *KEY, "k").join(ends, "node"), "wanted", some)
        sets = sets_of(docs, wanted, size, rarity, some)
        out = written(verified(close, wanted, sets), "distances")
        discard(ends, close, wanted, sets)
        return out

    near = F.col("common") * 100 >= percent * F.col("total")
    distances = measure(pairs)
    homes = distances.select(F.col("b").alias("node"), F.col("a").alias("home"), (1 - F.col("common") / F.col("total")).alias("away"))
    part = written(roots(distances.where(near).select(F.col("b").alias("node"), F.col("a").alias("parent")), count), "components", count)

    held = regions.count()
    tested, active, slots, radius = pairs, regions.drop("pivot"), FIRST_PIVOTS, 1 - percent / 100
    while True:
        state = active.join(part.withColumnRenamed("component", "c"), "node", "left").withColumn("c", F.coalesce("c", "node"))
        mixed = state.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("token")
        state = written(state.join(mixed, "token").join(homes, "node", "left"), "state", held)
        left = held = state.count()
        log(f"{left} rows of unresolved regions, {slots} pivots each")
        if not left:
            break
        slot = F.pmod(F.xxhash64("node", F.lit(slots)), F.lit(slots))
        drawn = state.groupBy("token", slot.alias("slot")).agg(F.min(F.struct("node", "n", "pos", "c", "home", "away")).alias("q")).select("token", "q")
        window = F.col("home").isNull() | F.col("q.home").isNull() | (F.col("home") != F.col("q.home")) | (F.abs(F.col("away") - F.col("q.away")) <= radius + 1e-9)
        fits = could_share(percent, F.col("n"), F.col("pos"), F.col("q.n"), F.col("q.pos"))
        met = state.join(drawn, "token").where((F.col("node") != F.col("q.node")) & (F.col("c") != F.col("q.c")) & fits & window)
        pairs = met.select(F.least("node", "q.node").alias("a"), F.greatest("node", "q.node").alias("b")).distinct()
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), "pairs", left)
        if not pairs.isEmpty():
            distances = measure(pairs)
            tested = tested.union(pairs)
            new = distances.where(near).select("a", "b")
            if not new.isEmpty():
                old, part = part, written(components(part.select(F.col("node").alias("a"), F.col("component").alias("b")).union(new), count), "components", count)
                discard(old)
            discard(distances)
        used = drawn.select("token", F.col("q.node").alias("node"))
        active = state.select("token", "node", "n", "pos").join(used, ["token", "node"], "left_anti")
        slots *= 4

    joined = nodes.join(part, "node", "left").select(*KEY, "low", F.coalesce("component", "node").alias("component"))
    joined = written(joined, "members", count)
    rarity.destroy()
    least = joined.groupBy("component").agg(F.min("low").alias("component_id"))
    ids = joined.join(least, "component").select(*KEY, "component_id")
    out = rows.drop("prefix", "k").join(ids, KEY, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
