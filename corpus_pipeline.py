"""From raw documents to packed training sequences.

Each stage works on all that its predecessor kept, and every stage but the last returns the columns of
documents, whatever they are called: the operators see the text and their own columns only. Null and
empty texts are rejected by the first stage (they have no language), repeated rows by the third.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow.llm.decontaminate import decontaminate
from contractflow.llm.jaccard_join import near_duplicates
from contractflow.llm.langid import UNKNOWN, fit, label
from contractflow.llm.packing import pack
from contractflow.llm.quality import judge
from contractflow.llm.store import written

TOKENIZER = "word_bpe_49k.json"
SENT_ROWS = 500_000  # of about fifty bytes each
NEAR_WORDS, NEAR_PERCENT = 5, 80  # near copies in the pipeline; the query op9 has limits of its own


def few_rows(spark: SparkSession) -> None:
    """Hand texts to Python a thousand rows at a time, so that tasks hold little of them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def apart(docs: DataFrame) -> DataFrame:
    """The text beside a struct of all other columns, so that no new column meets one of the same name."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others, F.lit(0).alias("__")).alias("__row"), "text")


def together(held: DataFrame, docs: DataFrame) -> DataFrame:
    return held.select(*[F.col("text") if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, and nothing else.

    A text in several languages is kept, however its letters are shared out. The model learns from the rows with a
    label, of this stage's own input; if they teach it no language, every word is of one unknown language.
    """
    few_rows(spark)
    model = fit(docs)
    if not model.languages:
        model = replace(model, languages=[UNKNOWN])
    return together(label(apart(docs), model).where("score > 0"), docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that fail the base rule or are more probably bad than good."""
    few_rows(spark)
    return together(judge(apart(docs)).where("kept"), docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves of each group of near copies the row with the smallest doc_id, and of repeated rows one.

    Near copies share 80 % of their five-word shingles or more. Rows with a null doc_id come after all others; rows
    that share their doc_id but differ otherwise are told apart by a hash of all columns. Up to ``SENT_ROWS``
    rows that go are sent to all tasks, so that no text is shuffled; more are joined.
    """
    few_rows(spark)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*docs.columns).alias("row"))
    keyed = docs.withColumn("__key", key)
    classes = written(near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text"), size=NEAR_WORDS, percent=NEAR_PERCENT), "classes")
    goes = written(classes.where("doc_id <> component_id").select(F.col("doc_id").alias("__key")).distinct(), "goes")
    kept = keyed.join(F.broadcast(goes) if goes.count() <= SENT_ROWS else goes, "__key", "left_anti")
    if not classes.groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["__key"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which ten words in a row of a benchmark item occur, or all of a shorter item."""
    few_rows(spark)
    found = decontaminate(apart(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return together(found.where(~F.col("contaminated")), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence of at most 4096 tokens."""
    few_rows(spark)
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Language models, expectation maximisation and tokenizers are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
