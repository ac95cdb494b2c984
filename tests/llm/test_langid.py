from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from contractflow.llm import langid as L
from tests.llm.support import ODD_TEXTS, clashing, documents

TRAIN = [("the house and the garden are with that which there were things", "en"), ("der garten und das haus sind nicht für schöne zeit über straße", "de"), ("дом и сад это не очень большой город", "ru"), (None, "en"), ("no label", None)] * 5


def model(spark, **options):
    return L.fit(spark.createDataFrame(TRAIN, "text string, lang string"), **options)


def test_viterbi_against_all_paths():
    import itertools

    rng = np.random.default_rng(5)
    for _ in range(30):
        count = rng.integers(0, 6, 4)
        scores = rng.normal(size=(int(count.sum()), 3)).round(3)
        got, at = L.viterbi(scores, count, 0.7), 0
        for n in count:
            total = lambda path: sum(scores[at + i, s] for i, s in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:], strict=False))  # noqa: E731, B023
            best = max((total(p) for p in itertools.product(range(3), repeat=n)), default=0)
            assert abs(total(got[at : at + n].tolist()) - best) < 1e-9
            at += n


def test_words_and_scripts():
    w = L.letters(["Ab1c", None, "", "-", "Дом x"])
    assert w.text.tolist() == [0, 0, 4, 4]
    assert w.size.tolist() == [2, 1, 3, 1]
    names = [n for n, _ in L.SCRIPTS]
    assert [names[s] for s in w.script] == ["latin", "latin", "cyrillic", "latin"]


def test_spans_and_odd_texts(spark):
    mixed = "the garden and the things der garten und das haus дом и сад"
    texts = [*ODD_TEXTS, mixed, "город", "1234 !?"]
    docs = clashing(documents(spark, texts), "lang_pred", "SCORE", "lang_spans")
    got = L.label(docs, model(spark), penalty=3.0).orderBy("doc_id").collect()
    by = {r["text"]: r for r in got}
    assert [(s["lang"], s["words"]) for s in by[mixed]["lang_spans"]] == [("en", 5), ("de", 5), ("ru", 3)]
    assert by["город"]["lang_pred"] == "ru"
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert (r["score"] > 0) == letters and 0 <= r["score"] <= 1
    assert len(got) == len(texts)


def test_tables_without_rows_or_labels(spark):
    docs = documents(spark, ["some text"])
    nothing = L.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert L.label(docs, nothing).first()["lang_pred"] == "und"
    assert L.label(docs.limit(0), model(spark)).count() == 0


def test_bounded_sample(spark):
    rows = [(f"the garden number {i} and the house", "en") for i in range(400)] + [(f"das haus nummer {i} und der garten", "de") for i in range(400)]
    m = L.fit(spark.createDataFrame(rows, "text string, lang string"), most_rows=100)
    assert m.languages == ["de", "en"]


def test_held_out_accuracy(spark):
    from contractflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    share = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.98


def test_the_script_of_a_word_is_that_of_most_letters():
    latin, cyrillic = L.letters(["word", "слово"]).script.tolist()
    assert latin != cyrillic
    assert L.letters(["aб", "aaб aбб", "б", "ab"]).script.tolist() == [max(latin, cyrillic), latin, cyrillic, cyrillic, latin]
