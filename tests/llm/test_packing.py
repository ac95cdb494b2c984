from __future__ import annotations

import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from contractflow.llm.packing import pack, plan
from contractflow.llm.pretokens import tokenizer
from tests.llm.support import ODD_TEXTS, clashing, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, capacity):
    """Best fit decreasing, document by document; the number of bins."""
    rooms, bins = [], 0
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        if i == len(rooms):
            bins, room = bins + 1, capacity
        else:
            room = rooms.pop(i)
        if room > n:
            bisect.insort(rooms, room - n)
    return bins


@pytest.mark.parametrize("seed", range(60))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 7, 10, 33, 64, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
    kinds, counts = np.unique(np.array(lengths, np.int64), return_counts=True)
    rows, bins = plan(kinds, counts, capacity)
    assert bins == one_by_one(lengths, capacity)
    held, placed = {}, []
    for length, rank, count, first, offset in rows.tolist():
        for i in range(count):
            held.setdefault(first + i, []).append((offset, length))
            placed.append((length, rank + i))
    assert sorted(placed) == sorted((int(k), i) for k, c in zip(kinds, counts, strict=True) for i in range(c))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity


def check(spark, texts, capacity, ids=None, **options):
    docs = clashing(documents(spark, texts, ids=ids), "piece", "length", "rank", "PART", "offset")
    got = pack(docs, PATH, capacity=capacity, **options).collect()
    wanted = []
    for i, text in zip(range(len(texts)) if ids is None else ids, texts, strict=True):
        tokens = [*tokenizer(PATH).encode(text or "", add_special_tokens=False).ids, 1]
        for p in range(0, len(tokens), capacity):
            part = tokens[p : p + capacity]
            wanted.append((i, p // capacity, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=str) == sorted(wanted, key=str)
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(held) == one_by_one([w[3] for w in wanted], capacity)
    return got


def test_odd_texts(spark):
    check(spark, ODD_TEXTS, 64)


def test_ids_and_repeated_rows(spark):
    got = check(spark, ["one two three", None, "one two three", "four"], 3, ids=[None, 2, 2, None], with_ids=True)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]


def test_many_partitions(spark):
    texts = [" ".join(["word"] * (i % 40)) for i in range(300)]
    docs = documents(spark, texts).repartition(9)
    got = pack(docs, PATH, capacity=50).collect()
    assert len({r["doc_id"] for r in got}) == 300
    assert len({r["sequence_id"] for r in got}) == one_by_one([r["length"] for r in got], 50)


def test_empty_table(spark):
    assert pack(documents(spark, ["x"]).limit(0), PATH).count() == 0
