"""Small tables with every odd case, and plain versions of what the operators compute."""

from __future__ import annotations

import re

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "the quick brown fox jumps over the lazy dog near a quiet river bank while seven old friends walk home"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))

ODD_TEXTS = [None, "", " \n\t", "one", "two words", LINE, LINE, f"{LINE} again", LINE.upper(), "…!? 123", "é à ü ñ ß", "a\x00b\x0bc", "x y  z", LONG]


def documents(spark, texts, columns=DOC, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts, strict=True)], columns)


def clashing(df, *names):
    """df with more columns, of the names that an operator gives to its own."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("theirs"))
    return df


def words(text, pattern=r"[^\x20\x09-\x0D]+", lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(pattern, text)
