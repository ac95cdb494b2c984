"""The trie of conversation prefixes: which conversations begin alike, and how far.

Every prefix of every conversation has a digest, which follows turn by turn. A count-min sketch over all digests
screens them: a prefix whose estimate is one belongs to a single conversation, as the sketch never counts too few,
and so do all that go on from it. Such tails are nodes already and are emitted where they are. Only prefixes that may be
shared are shuffled and grouped exactly; a chance estimate of two merely sends a single prefix that way.

Sums over a node's subtree need no walk over levels: what a node is worth is credited to its smallest member, summed from
the end of that conversation up to each of its prefixes, and added up by prefix. Texts are read once, into digests of turns.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractflow.llm.scan import Running, running
from contractflow.llm.store import discard, written

PRIME = (1 << 127) - 1
BASE = 0x5BE0CD19137E2179_1F83D9ABFB41BD6B % PRIME
ROOT = (1).to_bytes(16, "big")  # the digest of no turns
CHUNK = 1 << 14  # cells
LEAST_CELLS, MOST_CELLS = 1 << 14, 1 << 26  # of a row of the sketch; a cell takes a bit where it is sent
IDS = 4096  # ids in a chunk of a list
NOTHING = hashlib.sha256(b"").hexdigest()


def hashed_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, unset, turn, digest, tie, n_bytes) of every turn: its order, and what tells it from others.

    The digest is of role and text; null ones are empty. Turns with a null conv belong to no conversation and are left out.
    """
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    whole = F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said).cast("binary")
    out = turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").isNotNull().alias("unset"),
        F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("digest"),
        F.octet_length(said[1]).cast("long").alias("n_bytes"),
    )
    return written(out.withColumn("tie", F.monotonically_increasing_id()), "turns")


def numbered(hashed: DataFrame) -> DataFrame:
    """(conv, nth, digest, n_bytes): the turns of each conversation numbered from 1 in order of turn, null first; of
    turns that tie the one with the smaller digest is first."""
    rows = running(hashed.withColumn("one", F.lit(1).cast("long")), "conv", ["unset", "turn", "digest", "tie"], {"nth": Running("one")})
    return written(rows.select("conv", "nth", "digest", "n_bytes"), "numbered")


def prefixes(rows: DataFrame, order: list[str]) -> DataFrame:
    """(conv, depth, p, up, n_bytes, last) for every prefix of every conversation, the empty one included.

    ``rows`` has the turns (conv, digest, n_bytes and the columns ``order``), and for each conversation a first row
    with a null digest. p and up are the digests of the prefix and of the one before it.
    """
    steps = {"depth": Running("turned"), "p": Running("digest", start=1, factor=BASE, modulus=PRIME, was=True)}
    walked = running(rows.withColumn("turned", F.when(F.col("digest").isNull(), 0).otherwise(1).cast("long")), "conv", order, steps)
    return written(walked.select("conv", "depth", "p", F.col("p_was").alias("up"), "n_bytes", "last"), "prefixes")


def cells(digests: pa.Array, width: int) -> list[np.ndarray]:
    """The cells of 16-byte digests in both rows of a sketch."""
    raw = np.frombuffer(b"".join(digests.to_pylist()), ">u8").reshape(len(digests), 2)
    return [(raw[:, i].astype(np.uint64) & np.uint64(width - 1)).astype(np.int64) for i in (0, 1)]


def sketch(digests: DataFrame, width: int) -> np.ndarray:
    """Which cells of the two rows were counted twice or more, as bits: a count-min sketch that stops counting at two."""
    names = ["chunk", "counts"]

    def sent(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        rows = [(c, zlib.compress(x.tobytes(), 1)) for c, x in total.items() if x.any()]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * width, np.uint8)
        for batch in batches:
            if batch.num_rows:
                for i, at in enumerate(cells(batch.column(0), width)):
                    used, times = np.unique(at + i * width, return_counts=True)
                    total[used] = np.minimum(total[used] + np.minimum(times, 2), 2)
        yield sent({c: total[c * CHUNK : (c + 1) * CHUNK] for c in range(2 * width // CHUNK)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = total.setdefault(chunk, np.zeros(CHUNK, np.uint8))
                np.minimum(held + np.frombuffer(zlib.decompress(counts), np.uint8), 2, out=held)
        yield sent(total)

    schema = "chunk int, counts binary"
    out = np.zeros(2 * width // 8, np.uint8)
    for r in digests.mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema).toLocalIterator():
        many = np.frombuffer(zlib.decompress(r["counts"]), np.uint8) > 1
        out[r["chunk"] * CHUNK // 8 : (r["chunk"] + 1) * CHUNK // 8] = np.packbits(many, bitorder="little")
    return out


def screened(rows: DataFrame, bits: np.ndarray, width: int) -> DataFrame:
    """rows (with p and up) and whether each of the two may be shared: a bit set in both rows of the sketch."""
    sent = rows.sparkSession.sparkContext.broadcast(bits)
    names = [*rows.columns, "many", "up_many"]
    at = [rows.columns.index(c) for c in ("p", "up")]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            flags = []
            for i in at:
                many = np.ones(batch.num_rows, bool)
                if batch.num_rows:
                    for row, cell in enumerate(cells(batch.column(i), width)):
                        cell = cell + row * width
                        many &= ((held[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1).astype(bool)
                flags.append(pa.array(many))
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], names)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", many boolean, up_many boolean"
    return rows.mapInArrow(probe, schema)


def listed(ends: DataFrame) -> DataFrame:
    """(p, ends_sha256): the digest of the ids that end at p, in order and joined by commas.

    The ids of one p are joined in chunks by as many tasks as hold them, and the chunks are hashed one after the
    other, so that no list is ever whole in memory.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = [i for i in range(len(ps)) if not i or ps[i] != ps[i - 1]]
            cuts = sorted({*cuts, *range(0, len(ps), IDS)})
            spans = list(zip(cuts, [*cuts[1:], len(ps)], strict=True))
            texts = [",".join(map(str, ids[a:b])) for a, b in spans]
            yield pa.RecordBatch.from_arrays([pa.array([ps[a] for a, _ in spans], pa.binary()), batch.column(1).take(pa.array([a for a, _ in spans], pa.int64())), pa.array(texts, pa.string())], ["p", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for p, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if p != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = p, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], ["p", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["p", "ends_sha256"])

    kind = ends.schema["conv"].dataType.simpleString()
    joined = ends.select("p", "conv").repartitionByRange("p", "conv").sortWithinPartitions("p", "conv").mapInArrow(join, f"p binary, first {kind}, ids string")
    return joined.repartition("p").sortWithinPartitions("p", "first").mapInArrow(digest, "p binary, ends_sha256 string")


def trie(rows: DataFrame, order: list[str], cells_each: int = 4) -> DataFrame:
    """A row for each distinct prefix: conv_id (its smallest member), depth, parent_conv_id (its parent's conv_id, null at
    the root), n_convs (members), n_children, n_leaves (nodes of its subtree without children), saved_tokens (over
    its subtree, members but one times the bytes of the last text) and ends_sha256 (of the members that end there).

    ``rows`` as in ``prefixes``; no rows give no nodes. Conversations that are alike are members each. The sketch has about
    ``cells_each`` cells a prefix in each of two rows, up to ``MOST_CELLS``; with fewer more prefixes are grouped exactly and
    the result is the same.
    """
    whole = prefixes(rows, order)
    root = whole.where("depth = 0").agg(F.count("*").alias("n"), F.min("conv").alias("conv")).first()
    kind = whole.schema["conv"].dataType.simpleString()
    out = f"conv_id {kind}, depth long, parent_conv_id {kind}, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    if not root["n"]:
        return rows.sparkSession.createDataFrame([], out)
    width = 1 << max(0, int(cells_each * whole.count() - 1)).bit_length()
    width = min(max(width, LEAST_CELLS), MOST_CELLS)
    bits = sketch(whole.where("depth > 0").select("p"), width)
    turned = written(screened(whole.where("depth > 0"), bits, width), "screened")
    ended = whole.where("depth = 0 AND last").select("p", "conv")
    tails, shared = turned.where("NOT many"), turned.where("many")

    n = F.count("*").alias("n_convs")
    same = [F.max(c).alias(c) for c in ("depth", "n_bytes", "up", "up_many")]
    grouped = written(shared.groupBy("p").agg(F.min("conv").alias("conv"), n, *same), "nodes")
    births = grouped.select(F.col("up").alias("p")).union(tails.where("up_many OR depth = 1").select(F.col("up").alias("p")))
    children = written(births.groupBy("p").agg(F.count("*").alias("n_children")), "children")
    nodes = written(grouped.join(children, "p", "left").na.fill(0, ["n_children"]), "nodes")

    worth = nodes.select("conv", "depth", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("worth"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    credited = shared.select("conv", "depth", "p").join(worth, ["conv", "depth"], "left").select("conv", (-F.col("depth")).alias("back"), "p", "worth", "leaf")
    leaves = tails.where("last").select("conv", (-F.col("depth")).alias("back"), F.lit(None).cast("binary").alias("p"), F.lit(0).cast("long").alias("worth"), F.lit(1).cast("long").alias("leaf"))
    sums = running(credited.union(leaves), "conv", ["back"], {"saved": Running("worth"), "below": Running("leaf")})
    totals = sums.where("p IS NOT NULL").groupBy("p").agg(F.sum("saved").alias("saved_tokens"), F.sum("below").alias("n_leaves"))
    ends = written(listed(shared.where("last").select("p", "conv").union(ended)), "ends")
    found = written(nodes.join(totals, "p").join(ends, "p", "left").na.fill(NOTHING, ["ends_sha256"]), "found")

    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    own = F.when(F.col("last"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(F.lit(NOTHING))
    one = F.lit(1).cast("long")
    single = tails.select("up", "up_many", F.col("conv").alias("conv_id"), "depth", one.alias("n_convs"), (~F.col("last")).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), own.alias("ends_sha256"))
    every = found.select("up", "up_many", F.col("conv").alias("conv_id"), *single.columns[3:]).union(single)
    asked = every.where("up_many AND depth > 1").join(nodes.select(F.col("p").alias("up"), F.col("conv").alias("parent_conv_id")), "up").select(*result)
    parent = F.when(F.col("depth") == 1, F.lit(root["conv"])).otherwise(F.col("conv_id"))
    known = every.where("NOT up_many OR depth = 1").withColumn("parent_conv_id", parent).select(*result)

    first = children.where(F.col("p") == F.lit(ROOT)).first()
    top = nodes.agg(F.sum(F.expr("(n_convs - 1) * n_bytes")).alias("saved"), F.sum(F.expr("CAST(n_children = 0 AS BIGINT)")).alias("leaves")).first()
    n_leaves = (top["leaves"] or 0) + tails.where("last").count()
    said = ends.where(F.col("p") == F.lit(ROOT)).first()
    row = (root["conv"], 0, None, root["n"], first["n_children"] if first else 0, n_leaves or 1, top["saved"] or 0, said["ends_sha256"] if said else NOTHING)
    discard(whole, grouped)
    return known.union(asked).union(rows.sparkSession.createDataFrame([row], out))


def conversation_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations as they are; see ``trie``, ``hashed_turns`` and ``numbered`` for odd rows."""
    rows = numbered(hashed_turns(turns, conv, turn, role, text))
    return trie(rows.union(starts(rows)), ["nth"])


def starts(rows: DataFrame) -> DataFrame:
    """For each conversation of numbered turns the row that stands before its first turn."""
    return rows.where("nth = 1").select("conv", F.lit(0).cast("long").alias("nth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n_bytes"))
