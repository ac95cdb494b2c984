"""The registered queries of this subpackage, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow.llm import centroids, chat, factorisation, prefix_trie
from contractflow.llm.decontaminate import CAPITALS, SMALL, WORD, decontaminate
from contractflow.llm.html_text import extract_text
from contractflow.llm.jaccard_join import near_duplicates
from contractflow.llm.langid import fit, label
from contractflow.llm.packing import pack
from contractflow.llm.quality import judge
from contractflow.llm.sharding import shard
from contractflow.llm.store import folder
from contractflow.llm.token_counts import count_tokens
from contractflow.llm.warc_zip import page_of, read_packages, write_packages

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered_words(column: str) -> str:
    return f"regexp_extract_all(translate({column}, '{CAPITALS}', '{SMALL}'), '{WORD}')"


@query(f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {lowered_words("text")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, array_to_string(list_slice(w, i, i + 9), ' ') AS run, least(len(w), 10) AS size
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
docs AS (SELECT doc_id, coalesce({lowered_words("text")}, []) AS w FROM documents),
places AS (
  SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS run
  FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, item, i, size FROM places JOIN windows USING (size, run)),
words AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
lists AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(lists.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN lists USING (doc_id)
""")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@query("""
WITH rows AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, min(page_id) AS low FROM rows GROUP BY html),
digits AS (SELECT html, low, list_transform(range(0, 40), lambda i: strpos('0123456789abcdef', sha1(html)[i + 1]) - 1) AS d FROM firsts),
bits AS (SELECT html, low, array_to_string(list_transform(d, lambda x: CAST(x // 8 AS VARCHAR) || CAST(x // 4 % 2 AS VARCHAR) || CAST(x // 2 % 2 AS VARCHAR) || CAST(x % 2 AS VARCHAR)), '') AS b FROM digits),
codes AS (SELECT html, low, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(b[5 * i + j + 1] AS INTEGER) * CAST(power(2, 4 - j) AS INTEGER))) AS INTEGER) + 1, 1)), '') AS code FROM bits)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, code AS payload_digest,
  CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> low THEN low END AS refers_to
FROM rows JOIN codes USING (html)
""")
def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = folder(spark, "packages")
    write_packages(pages, path)
    kind = pages.schema["page_id"].dataType

    records = read_packages(spark, path)
    return records.select(page_of("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").cast(kind).alias("refers_to"))


@query()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = fit(docs.where(~out))
    return label(docs.select("doc_id", out.alias("held_out"), "text"), model).drop("text", "lang_spans")


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


@query()
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(docs).select("doc_id", *base, "base_failed", "kept", "posterior")


SHARD_BYTES, LEAST_SHARDS = 64 << 20, 12  # a table of less than so many shards gets smaller ones


def sharding_sql() -> str:
    digits = "strpos('0123456789abcdef', md5(CAST(doc_id AS VARCHAR))[i]) - 1"
    four = " || ".join(f"CAST(x // {p} % 2 AS VARCHAR)" for p in (8, 4, 2, 1))
    return f"""
WITH rows AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes,
    array_to_string(list_transform(list_transform(range(1, 17), lambda i: {digits}), lambda x: {four}), '') AS bits FROM documents),
prefixes AS (SELECT doc_id, n_bytes, depth, substr(bits, 1, depth) AS shard FROM rows, (SELECT unnest(range(0, 65)) AS depth)),
sums AS (SELECT depth, shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs FROM prefixes GROUP BY ALL),
most AS (SELECT least({SHARD_BYTES}, greatest(1, sum(n_bytes) // {LEAST_SHARDS})) AS bytes FROM rows),
fits AS (SELECT * FROM prefixes JOIN sums USING (depth, shard), most WHERE shard_bytes <= bytes OR shard_docs = 1)
SELECT doc_id, n_bytes, shard, CAST(depth AS INTEGER) AS depth, shard_bytes, shard_docs FROM fits
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""


@query(sharding_sql())
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return shard(docs, limit=min(SHARD_BYTES, max(1, total // LEAST_SHARDS)))


# how the transcripts of the conversations are written, by conversation; the last without any markers
STYLES = [
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "[system] ", "user": "Human: ", "assistant": "AI: "},
    {"system": "### Context\n", "user": "### Question\n", "assistant": "### Answer\n"},
    {},
]


def transcript_lines(turns: DataFrame) -> DataFrame:
    """The conversations as raw transcripts, line by line, with the roles they were made from."""
    style = F.pmod(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")), F.lit(len(STYLES)))
    said = F.lit("")
    for i, style_marks in enumerate(STYLES):
        for role, mark in style_marks.items():
            said = F.when((style == i) & (F.col("role") == role), F.lit(mark)).otherwise(said)
    raw = F.split(F.concat(said, F.coalesce(F.col("text"), F.lit(""))), "\n", -1)
    numbered = turns.select(F.col("conv_id").alias("conv"), "turn", F.col("role").alias("known"), F.monotonically_increasing_id().alias("tie"), raw.alias("lines"))
    return numbered.select("conv", "turn", "known", "tie", F.posexplode("lines").alias("line", "text"))


@query()
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model is counted from three conversations in four; the fourth, marked ``held_out``, is only parsed."""
    lines = transcript_lines(table(spark, sf_dir, "conversations"))
    out = F.coalesce(F.pmod(F.crc32(F.reverse(F.col("conv").cast("string")).cast("binary")), F.lit(4)) == 2, F.lit(False))
    shown = lines.withColumn("held_out", out).withColumn("known", F.when(~F.col("held_out"), F.col("known")))
    return chat.parse(shown, ("held_out",)).withColumnRenamed("conv", "conv_id")


@query()
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = extract_text(table(spark, sf_dir, "pages").select("page_id", "html")).drop("html")
    return text.withColumn("n_chars", F.length("page_text").cast("long")).withColumn("n_lines", F.size(F.split("page_text", "\n")).cast("long"))


_RAW = "regexp_extract_all(translate(coalesce(text, ''), '" + CAPITALS + "', '" + SMALL + "'), '[^\\x20\\x09-\\x0D]+')"


@query(f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_RAW} AS w FROM documents),
runs AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM runs x JOIN runs y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM docs UNION SELECT reach.doc_id, b FROM reach JOIN links ON a = other)
SELECT docs.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, low AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) USING (doc_id)
""")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def clustering_sql(k: int, rounds: int, dims: int) -> str:
    """Every round as tables of its own: the centroids in rows, all distances, the nearest, the floors of the means."""
    first = f"""
SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), x) - 1 AS INTEGER) AS cluster, x AS c
FROM kept ORDER BY cluster LIMIT {k}"""
    nearest = """
SELECT row, x, cluster, d FROM (SELECT row, x, cluster, list_sum(list_transform(range(1, {dims} + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d FROM kept, c{i})
QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, cluster) = 1"""
    means = """
SELECT cluster, list(CAST((v - ((v % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
  SELECT cluster, i, CAST(sum(x[i]) AS BIGINT) AS v, count(*) AS n FROM a{i}, (SELECT unnest(range(1, {dims} + 1)) AS i) GROUP BY ALL) GROUP BY cluster"""
    tables = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {dims})""",
        f"c0 AS MATERIALIZED ({first})",
    ]
    for i in range(rounds + 1):
        tables.append(f"a{i} AS MATERIALIZED ({nearest.format(i=i, dims=dims)})")
        if i < rounds:
            tables.append(f"m{i} AS MATERIALIZED ({means.format(i=i, dims=dims)})")
            tables.append(f"c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))")
    return f"""
WITH {", ".join(tables)}
SELECT vec_id, cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (row) JOIN c{rounds} USING (cluster)
"""


@query(clustering_sql(40, 5, 64))
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed=2)
    return rows.join(F.broadcast(centroids.described(spark, found)), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query()
def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")

    def out(doc_id: str):
        return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))

    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where(~out("doc_id"))
    machine = factorisation.fit(factorisation.labelled(docs, labels), metadata=("n_chars",))
    scored = factorisation.score(docs.select("doc_id", out("doc_id").alias("held_out"), "text", "n_chars"), machine, metadata=("n_chars",))
    return scored.select("doc_id", "held_out", "score", "predicted")


def rebuilt(turns: DataFrame, most: int = 9, apart: int = 5) -> DataFrame:
    """Conversations that share beginnings: c opens with the first h turns of c - c % apart and goes on with its own after its first h."""
    rows = prefix_trie.numbered(prefix_trie.hashed_turns(turns))
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    openings = rows.where(F.col("nth") < most).select(F.col("conv").alias("source"), "nth", "digest", "n_bytes")
    first = prefix_trie.starts(rows)
    given = first.select("conv", (F.col("conv") - F.col("conv") % apart).alias("source"), h.alias("h")).join(openings, "source").where("nth <= h")
    order = lambda n: F.lit(n).alias("source")
    parts = [first.select("conv", order(0), "nth", "digest", "n_bytes"), given.select("conv", order(1), "nth", "digest", "n_bytes")]
    parts.append(rows.where(F.col("nth") > h).select("conv", order(2), "nth", "digest", "n_bytes"))
    return parts[0].union(parts[1]).union(parts[2])


_SHIFT = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
_CRC = "xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda s, b: list_reduce(list_concat([xor(s, b)], range(0, 8)), lambda x, y: " + _SHIFT + ")), 4294967295)"


@query(f"""
WITH RECURSIVE own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS nth
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS source, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT c.conv_id, 1 AS part, nth, role, text FROM convs c JOIN own o ON o.conv_id = c.source AND nth <= h
  UNION ALL SELECT conv_id, 2, nth, role, text FROM convs JOIN own USING (conv_id) WHERE nth > h),
placed AS (
  SELECT conv_id, row_number() OVER w AS depth, octet_length(encode(text)) AS bytes,
    array_agg(sha256(role || chr(1) || text)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, nth)),
prefixes AS (
  SELECT conv_id, depth, bytes, p FROM placed UNION ALL SELECT conv_id, 0, 0, CAST([] AS VARCHAR[]) FROM convs),
flagged AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM prefixes),
nodes AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes, list_slice(p, 1, depth - 1) AS up,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM flagged GROUP BY p, depth),
children AS (SELECT up AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up),
filled AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (p)),
below AS (
  SELECT list_slice(p, 1, d) AS p, sum((n - 1) * bytes) AS saved, sum(CAST(n_children = 0 AS INTEGER)) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM filled) GROUP BY list_slice(p, 1, d))
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, CASE WHEN f.depth > 0 THEN u.conv_id END AS parent_conv_id, CAST(f.n AS BIGINT) AS n_convs,
  CAST(f.n_children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ids) AS ends_sha256
FROM filled f JOIN below ON below.p = f.p LEFT JOIN filled u ON u.p = f.up AND f.depth > 0
""")
def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(rebuilt(table(spark, sf_dir, "conversations")), ["source", "nth"])
