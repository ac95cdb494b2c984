from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from contractflow.llm.sharding import directory, shard, write_shards
from tests.llm.support import ODD_TEXTS, clashing, documents


def plain(rows, limit):
    """Extendible hashing one bucket at a time, on the first 64 bits."""
    bits = {i: f"{int(hashlib.md5(str(i).encode()).hexdigest()[:16], 16):064b}" for i, _ in rows}
    out, todo = {}, [("", rows)]
    while todo:
        prefix, held = todo.pop()
        if sum(n for _, n in held) <= limit or len(held) == 1:
            out.update({i: (prefix, len(prefix), sum(n for _, n in held), len(held)) for i, _ in held})
        else:
            for bit in "01":
                if part := [r for r in held if bits[r[0]][len(prefix)] == bit]:
                    todo.append((prefix + bit, part))
    return out


def test_against_plain_splitting(spark):
    docs = clashing(documents(spark, ["x" * (i * 37 % 101) for i in range(300)]), "shard", "DEPTH", "n_bytes", "cell")
    for limit in (100_000, 900, 60, 1):
        got = {r["doc_id"]: (r["shard"], r["depth"], r["shard_bytes"], r["shard_docs"]) for r in shard(docs, limit=limit).collect()}
        assert got == plain([(i, i * 37 % 101) for i in range(300)], limit)


def test_directory_covers_every_entry_once(spark):
    rows = shard(documents(spark, ["x" * (i % 50) for i in range(200)]), limit=300)
    entries = [r["entry"] for r in directory(rows).collect()]
    depth = rows.agg(F.max("depth")).first()[0]
    assert sorted(entries) == [f"{i:0{depth}b}" for i in range(2**depth)]


def test_one_key_in_all_rows_splits(spark):
    rows = shard(documents(spark, ["y" * 10] * 300, ids=[7] * 300), limit=200)
    sizes = rows.groupBy("shard").agg(F.sum("n_bytes").alias("n"), F.max("shard_bytes").alias("m")).collect()
    assert sum(r["n"] for r in sizes) == 3000 and all(r["n"] == r["m"] <= 200 for r in sizes)


def test_odd_rows(spark):
    docs = documents(spark, ODD_TEXTS, ids=[None, None, *range(len(ODD_TEXTS) - 2)])
    rows = shard(docs, limit=1000).collect()
    assert sorted(r["n_bytes"] for r in rows) == sorted(len((t or "").encode()) for t in ODD_TEXTS)
    assert all(r["shard_bytes"] <= 1000 or r["shard_docs"] == 1 for r in rows)
    assert shard(docs.limit(0)).count() == 0
    assert directory(shard(docs.limit(0))).count() == 0


def test_written_folders(spark, tmp_path):
    docs = documents(spark, ["z" * 30] * 20)
    write_shards(docs, shard(docs, limit=100), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 20
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).where("n > 100").count() == 0


def test_written_rows_of_null_and_repeated_keys(spark, tmp_path):
    texts = [("t%03d" % i) * (1 + i % 5) for i in range(200)] + [None, "", "same", "same"]
    ids = [7 if i < 120 else None if i < 160 else i for i in range(200)] + [None, 7, 7, 7]
    docs = clashing(documents(spark, texts, ids=ids), "key", "n", "row", "part").repartition(5)
    for limit in (10**6, 300, 40):
        rows = shard(docs, limit=limit)
        path = f"{tmp_path}/{limit}"
        write_shards(docs, rows, path)
        back = spark.read.option("basePath", path).schema(StructType([*docs.schema.fields, StructField("shard", StringType())])).parquet(path)
        wanted = sorted(zip(ids, texts, strict=True), key=str)
        assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == wanted
        size = F.coalesce(F.octet_length("text"), F.lit(0))
        got = {r["shard"]: (r["n"], r["b"]) for r in back.groupBy("shard").agg(F.count("*").alias("n"), F.sum(size).alias("b")).collect()}
        said = {r["shard"] or "all": (r["shard_docs"], r["shard_bytes"]) for r in rows.select("shard", "shard_docs", "shard_bytes").distinct().collect()}
        assert got == said
        assert all(b <= limit or n == 1 for n, b in got.values())


def test_row_without_a_shard_raises(spark, tmp_path):
    docs = documents(spark, ["a", "b"])
    with pytest.raises(Exception, match="lacks a row"):
        write_shards(docs, shard(docs).where("doc_id = 0"), f"{tmp_path}/out")
