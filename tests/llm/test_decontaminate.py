from __future__ import annotations

from contractflow.llm.decontaminate import WORD, decontaminate
from tests.llm.support import LINE, ODD_TEXTS, clashing, documents, words


def plain(texts, items):
    """Every occurrence of every window, by comparing lists of words."""
    out = []
    for text in texts:
        w, hit, ids = words(text, WORD, lower=True), set(), set()
        for item, body in items:
            v = words(body, WORD, lower=True)
            n = min(10, len(v))
            for i in range(len(v) - n + 1 if v else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        hit.update(range(j, j + n))
                        ids |= {str(item)} if item is not None else set()
        out.append((len(w), len(hit), sorted(ids)))
    return out


ITEMS = [(1, LINE + " and then some more words follow here"), (2, "tiny"), (3, "Two words"), (4, None), (5, ""), (None, "seven old friends walk home"), (1, LINE), (10, "a b a b a b a b a b a b a b"), (11, "the lazy dog near a quiet river bank while seven old")]
TEXTS = [*ODD_TEXTS, f"pre {LINE} and then some more words follow here post", f"{LINE} {LINE}", "tiny, TINY! tiny-ish", "a b " * 30, LINE.replace("lazy", "idle"), "seven old friends walk home", "old friends walk home"]


def check(spark, **options):
    docs = clashing(documents(spark, TEXTS), "n_words", "N_HIT", "item_ids", "contaminated", "hit_spans")
    got = decontaminate(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), **options).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_hit"], r["item_ids"]) for r in got] == plain(TEXTS, ITEMS)
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["source"] == "s" for r in got)
    for r in got:
        spans = [(s["start"], s["stop"]) for s in r["hit_spans"]]
        assert sum(b - a for a, b in spans) == r["n_hit"]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_against_plain_search(spark):
    check(spark)


def test_many_blocks_give_the_same(spark):
    check(spark, block_windows=12)


def test_empty_tables(spark):
    docs, items = documents(spark, TEXTS), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items.limit(0)).where("contaminated or n_hit <> 0 or size(item_ids) <> 0").count() == 0


def test_random_texts(spark):
    import random

    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))) for i in range(40)]
    got = decontaminate(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_hit"], r["item_ids"]) for r in got] == plain(texts, items)
