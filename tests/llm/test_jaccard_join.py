from __future__ import annotations

import random

from contractflow.llm.components import components, roots
from contractflow.llm.jaccard_join import near_duplicates
from tests.llm.support import LINE, ODD_TEXTS, clashing, documents, words


def plain(ids, texts, size=4, percent=85):
    sets = []
    for t in texts:
        w = words(t, lower=True)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    up = list(range(len(texts)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                up[find(i)] = find(j)
    out = []
    for i, x in enumerate(sets):
        group = [ids[j] for j in range(len(ids)) if find(j) == find(i) and ids[j] is not None]
        out.append((ids[i], len(x), min(group, default=None) if x else ids[i]))
    return sorted(out, key=str)


def check(spark, texts, ids=None, **options):
    ids = list(range(len(texts))) if ids is None else ids
    docs = clashing(documents(spark, texts, ids=ids), "n", "prefix", "node", "component", "K", "n_shingles")
    got = sorted((tuple(r) for r in near_duplicates(docs, **options).collect()), key=str)
    assert got == plain(ids, texts)


def test_odd_texts(spark):
    check(spark, ODD_TEXTS)


def test_null_and_repeated_ids(spark):
    check(spark, [LINE, LINE, f"{LINE} x", "lone words here", "lone words here", None, LINE], [None, 5, 5, None, None, None, 9])


def test_empty_table(spark):
    assert near_duplicates(documents(spark, ["x"]).limit(0)).count() == 0


def edited(rng, base, times):
    out = list(base)
    for _ in range(times):
        out[rng.randrange(len(out))] = f"e{rng.random():.9f}"
    return " ".join(out)


def test_chains_and_groups_of_near_copies(spark):
    rng = random.Random(11)
    texts = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(60)}" for _ in range(rng.randint(5, 220))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 14)):  # each a little further from the first, or from the last
            source = texts[-1].split() if rng.random() < 0.5 else base
            texts.append(edited(rng, source, rng.choice([0, 1, 1, 2, 3, 5])))
    check(spark, texts)


def test_common_passages_link_nothing_by_themselves(spark):
    rng = random.Random(4)
    shared = [f"common{i}" for i in range(40)]
    texts = [" ".join([*shared, *[f"u{i}x{j}" for j in range(rng.randint(0, 90))]]) for i in range(60)]
    texts += [" ".join(shared[:k]) for k in range(1, 41)]
    check(spark, texts)


def test_many_regions_with_few_words(spark):
    rng = random.Random(8)
    check(spark, [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 24))) for _ in range(150)])


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7), (None, 3)]
    up = {}

    def find(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in links:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            up[high] = low
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: find(i) for i in list(up)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_roots(spark):
    parents = [(i, i // 2) for i in range(1, 60) if i // 2 != i and i % 7] + [(100, 99), (99, 98)]
    up = dict(parents)

    def find(i):
        return find(up[i]) if i in up else i

    got = {r["node"]: r["component"] for r in roots(spark.createDataFrame(parents, "node long, parent long")).collect()}
    assert got == {i: find(i) for i in {x for p in parents for x in p}}
