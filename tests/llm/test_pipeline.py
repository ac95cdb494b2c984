"""The pipeline's stages held against plain versions of what they decide."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from contractflow.llm.queries import QUERIES
from tests.llm.support import LINE, ODD_TEXTS
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_jaccard_join import plain as plain_classes
from tests.llm.test_packing import one_by_one

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, n_words string, node string"


def prose(seed, n=120):
    rng = random.Random(seed)
    made = [f"{rng.choice(LINE.split())}{rng.choice(LINE.split())}" for _ in range(n)]
    return "".join(f"{w}. " if i % 9 == 8 else f"{w} " for i, w in enumerate(made))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    clean = [prose(i) for i in range(20)]
    item = " ".join(prose(500, 24).split())
    texts = [*clean, *ODD_TEXTS, clean[0], clean[0], f"{clean[1]} changed", "# $ % & " * 100, f"{prose(77)} {item} {prose(78)}", clean[2]]
    rows = [(i if i != 25 else None, t, "en", "s", 1, "theirs", "theirs", "theirs", "theirs") for i, t in enumerate(texts)]
    rows.append(rows[3])
    spark.createDataFrame(rows, DOC).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        docs = P.written(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        assert docs.where("score <> 'theirs' or node <> 'theirs'").count() == 0
        kept[name] = docs.collect()
    assert all(any(c.isalpha() for c in r["text"]) for r in kept["language_id"])
    assert all(len(r["text"].split()) >= 50 for r in kept["quality_rules"])
    assert {r["doc_id"] for r in kept["quality_rules"]} >= set(range(20))
    before = kept["quality_rules"]
    classes = plain_classes([(r["doc_id"], i) for i, r in enumerate(before)], [r["text"] for r in before])
    assert len(kept["jaccard_join"]) == len({c[2] for c in classes})
    assert {r["doc_id"] for r in kept["jaccard_join"]} == {c[2][0] for c in classes}
    before = kept["jaccard_join"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r, (_, hits, _) in zip(before, plain_hits([r["text"] for r in before], items), strict=True) if not hits]
    assert sorted(r["doc_id"] for r in kept["decontamination"]) == sorted(clean)
    assert len(clean) == len(before) - 1
    packed = P.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == set(clean)
    assert len({r["sequence_id"] for r in packed}) == one_by_one([r["length"] for r in packed], 4096)


def test_near_copies_share_five_words_and_four_fifths(spark):
    base = [f"w{i}" for i in range(500)]

    def changed(times):
        return " ".join(f"c{i}" if i % 40 == 20 and i // 40 < times else w for i, w in enumerate(base))

    other = [f"v{i}" for i in range(500)]
    texts = [" ".join(base), changed(11), " ".join(other), " ".join(other[:410])]
    far = [f"u{i}" for i in range(500)]
    texts += [" ".join(far), " ".join(f"c{i}" if i % 40 == 20 else w for i, w in enumerate(far))]  # 12 words: 0.780
    rows = [(i, t, "en", "s", 1, "theirs", "theirs", "theirs", "theirs") for i, t in enumerate(texts)]
    kept = P.jaccard_join(spark, spark.createDataFrame(rows, DOC), "").collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 2, 4, 5]
    classes = plain_classes(list(range(6)), texts, size=5, percent=80)
    assert sorted({c[2] for c in classes}) == [0, 2, 4, 5]
    assert len({c[2] for c in plain_classes(list(range(6)), texts)}) == 6


def language_rows(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "theirs", "theirs", "theirs", "theirs") for i, (t, lang) in enumerate(rows)], DOC)


def test_without_any_label_only_letterless_texts_go(spark):
    for lettered in ([("some words", None), ("жук", None)], [("some words", None), ("жук", None), ("12 34", "en")]):
        docs = language_rows(spark, [*lettered, ("12 34 !", None), ("", None), (None, None)])
        assert {r["text"] for r in P.language_id(spark, docs, "").collect()} == {"some words", "жук"}


def test_texts_of_many_languages_stay(spark):
    known = [("the quick brown fox", "en"), ("быстрая лиса бежит", "ru"), ("γρήγορη αλεπού τρέχει", "el"), ("שועל מהיר רץ", "he")]
    mixed = " ".join(t for t, _ in known)
    docs = language_rows(spark, [*known, (mixed, None), ("12", None)])
    assert P.label(docs, P.fit(docs)).where("text = '" + mixed + "'").first()["score"] < 0.5
    assert {r["doc_id"] for r in P.language_id(spark, docs, "").collect()} == {0, 1, 2, 3, 4}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_clean_documents_pass_the_filters(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = docs.join(labels.where("quality = 1"), "doc_id").where(F.size(F.split("text", r"\s+")) >= 60).select(docs.columns)
    for name, stage in P.STAGES[:2]:
        assert stage(spark, good, sf).count() >= 0.99 * good.count(), name
