"""Shards by extendible hashing, in DataFrame operations only.

A shard is a bucket of rows whose keys' hashes begin with the same bits. The directory has an entry for
every prefix of as many bits as the deepest bucket has; entries that share a bucket point to the same shard.
A bucket within the byte limit stays; one beyond it, and no other, is split on another bit. As a
prefix's bytes only shrink with more bits, the bucket of a row is its shortest prefix within the limit,
which sums over prefixes give for all depths at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractflow.llm.store import written

KEY_BITS, ROW_BITS = 64, 64


def hash_bits(text: Column) -> Column:
    """The first 64 bits of the MD5 of a string, as a string of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(text.cast("binary")), 1, 16), 16, 2), 64, "0")


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 64 << 20) -> DataFrame:
    """(key, n_bytes, shard, depth, shard_bytes, shard_docs) for every row of docs.

    ``shard`` is the bucket's prefix of ``depth`` bits. A null text has no bytes. Rows with the same key hash
    alike; should they fill a bucket beyond the limit after all 64 bits, it is split further on bits of a hash
    of their row number, so no key is too hot. Only a row that is larger than the limit by itself fills a
    shard beyond it, alone (with rows without bytes that hash alike). A null key is a key like any other.
    An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    bits = F.concat(hash_bits(F.coalesce(F.col("key").cast("string"), F.lit("\u0000"))), hash_bits(F.col("row").cast("string")))
    step = min(24, max(0, total // max(1, limit)).bit_length() + 4)  # bits a round; deeper buckets take more rounds
    left, done, known = rows, 0, []
    while True:
        last = min(done + step, KEY_BITS + ROW_BITS)
        cells = left.groupBy(F.substring(bits, 1, last).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"))
        cells = written(cells, "cells")
        prefixes = cells.select("cell", "bytes", "rows", F.explode(F.sequence(F.lit(done), F.lit(last))).alias("depth"))
        prefixes = prefixes.withColumn("shard", F.substring("cell", 1, F.col("depth")))
        sums = prefixes.groupBy("depth", "shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_docs"))
        fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == KEY_BITS + ROW_BITS))
        least = F.min_by(F.struct("shard", "depth", "shard_bytes", "shard_docs"), "depth")
        found = prefixes.drop("bytes", "rows").join(fits, ["depth", "shard"]).groupBy("cell").agg(least.alias("s"))
        here = written(left.withColumn("cell", F.substring(bits, 1, last)).join(found, "cell", "left"), "shards")
        known.append(here.where("s IS NOT NULL").select("key", "n_bytes", "s.*"))
        left = here.where("s IS NULL").select("key", "n_bytes", "row")
        if last == KEY_BITS + ROW_BITS or left.isEmpty():
            break
        done = last + 1
    out = known[0]
    for more in known[1:]:
        out = out.union(more)
    return out.withColumnRenamed("key", key)


def directory(shards: DataFrame) -> DataFrame:
    """(entry, shard): every prefix of the global depth and the bucket it points to."""
    buckets = shards.select("shard", "depth").distinct()
    depth = buckets.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    rest = depth - F.col("depth")
    number = F.explode(F.sequence(F.lit(0).cast("long"), (F.pow(F.lit(2.0), rest) - 1).cast("long")))
    return buckets.select("shard", rest.alias("rest"), number.alias("number")).select(F.concat("shard", F.when(F.col("rest") > 0, F.lpad(F.bin("number"), F.col("rest"), F.lit("0"))).otherwise("")).alias("entry"), "shard")


def numbered(rows: DataFrame, kind: list[str]) -> DataFrame:
    """rows with ``n``, counting the rows that are alike in the columns ``kind``, by ``row``, a row number in a written table.

    Rows are counted by input partition and partitions get offsets, so that no task sorts all rows of a hot key.
    """
    part = rows.withColumn("part", F.shiftright("row", 33))
    place = F.row_number().over(Window.partitionBy(*kind, "part").orderBy("row"))
    before = F.sum("held").over(Window.partitionBy(*kind).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = part.groupBy(*kind, "part").agg(F.count("*").alias("held"))
    offsets = counts.select(*[F.col(c).alias(f"_{c}") for c in [*kind, "part"]], F.coalesce(before, F.lit(0)).alias("offset"))
    same = [part[c].eqNullSafe(offsets[f"_{c}"]) for c in [*kind, "part"]]
    return part.withColumn("place", place).join(offsets, same).select(*kind, "row", (F.col("offset") + F.col("place")).alias("n"))


def write_shards(docs: DataFrame, shards: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write docs into one folder per shard (``shard=<bits>``, ``shard=all`` for the empty prefix).

    ``shards`` is what :func:`shard` returned for docs. Every row of docs is written once, null and repeated keys
    included: rows of one key that lie in several shards are dealt to them by size, so that each shard holds
    the rows and bytes that ``shards`` gives it. A row that ``shards`` lacks raises. docs are copied
    once to the shared folder, so that their row numbers hold.
    """
    size = F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)).cast("long")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{key}`").alias("key"), size.alias("n_bytes"))
    held = written(held.withColumn("row", F.monotonically_increasing_id()), "docs")
    name = F.when(F.col("depth") == 0, "all").otherwise(F.col("shard"))
    named = shards.select(F.col(f"`{key}`").alias("key"), "n_bytes", name.alias("shard"))
    named = written(named.withColumn("row", F.monotonically_increasing_id()), "named")
    kind = ["key", "n_bytes"]
    places = numbered(held.select(*kind, "row"), kind)
    targets = numbered(named, kind).join(named.select("row", "shard"), "row").select(*[F.col(c).alias(f"_{c}") for c in [*kind, "n"]], "shard")
    same = [places[c].eqNullSafe(targets[f"_{c}"]) for c in [*kind, "n"]]
    found = written(places.join(targets, same).select("row", "shard"), "places")
    lost = F.raise_error(F.lit("shards lacks a row of docs")).cast("string")
    out = held.join(found, "row", "left").select("doc.*", F.coalesce("shard", lost).alias("shard"))
    out.repartition("shard").write.partitionBy("shard").parquet(path)
