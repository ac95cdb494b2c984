"""Every registered query that SQL can express against DuckDB."""

from __future__ import annotations

import os
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from contractflow.llm.html_text import page_text
from contractflow.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def texts(con):
    return dict(con.sql("SELECT doc_id, text FROM documents").fetchall())


def test_language_is_told_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").where("lang IS NOT NULL")
    rows = QUERIES["op3_language_id"](spark, sf).join(known, "doc_id").collect()
    for out in (False, True):
        some = [r for r in rows if r["held_out"] == out]
        assert len(some) > 100 and sum(r["lang_pred"] == r["lang"] for r in some) > 0.97 * len(some)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_token_counts_are_the_librarys(spark, con):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op4_token_counts"](spark, SF_DIR).collect()}
    counts = {i: len(whole.encode(t or "", add_special_tokens=False).ids) for i, t in texts(con).items()}
    assert got == {i: (len((t or "").encode()), counts[i], counts[i] > 1024) for i, t in texts(con).items()}


QUALITY = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
twice AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
runs AS (SELECT doc_id, i, list_slice(w, i, i + 2) AS run FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 0) + 1)) AS i FROM docs)),
again AS (SELECT doc_id, i FROM runs QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
hit AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS place FROM again) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(twice.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(hit.n, 0) AS BIGINT) AS n_repeat_words, len(w) < 50 OR 100 * coalesce(hit.n, 0) > 50 * len(w) AS base_failed
FROM docs LEFT JOIN twice USING (doc_id) LEFT JOIN hit USING (doc_id)
"""


def test_quality_counts_match_sql(spark, con):
    judged = QUERIES["op5_quality_rules"](spark, SF_DIR)
    assert difference(judged.drop("kept", "posterior"), con, QUALITY) is None
    rows = judged.collect()
    assert not any(r["kept"] and r["base_failed"] for r in rows) and all(r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5) for r in rows)


def test_quality_keeps_good_documents_and_not_bad_ones(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op5_quality_rules"](spark, sf).join(labels, "doc_id").where("NOT base_failed").collect()
    good, bad = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert len(good) > 100 and sum(r["kept"] for r in good) > 0.99 * len(good)
    assert len(bad) > 10 and sum(r["kept"] for r in bad) < 0.1 * len(bad)


def test_roles_and_pages_are_whole(spark, con):
    lines = QUERIES["op7_chat_formatting"](spark, SF_DIR).collect()
    assert {r["conv_id"] for r in lines} == {i for (i,) in con.sql("SELECT DISTINCT conv_id FROM conversations").fetchall()}
    pages = {r["page_id"]: r["page_text"] for r in QUERIES["op8_html_extraction"](spark, SF_DIR).collect()}
    assert pages == {i: page_text(h) for i, h in con.sql("SELECT page_id, html FROM pages").fetchall()}


def test_packing_is_whole_gapless_and_tight(spark, con):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = QUERIES["op10_best_fit_packing"](spark, SF_DIR).collect()
    docs, bins = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    for i, text in texts(con).items():
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = sorted(docs[i], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in pieces] == [(n, s, min(4096, len(ids) - s)) for n, s in enumerate(range(0, len(ids), 4096))]
        assert [r["ids_crc32"] for r in pieces] == [zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[r["start"] : r["start"] + r["length"]])) for r in pieces]
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
    total = sum(r["length"] for r in rows)
    assert len(bins) <= 1.1 * total / 4096 + 1
