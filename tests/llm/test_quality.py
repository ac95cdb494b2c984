from __future__ import annotations

import re

import numpy as np

from contractflow.llm import quality as Q
from tests.llm.support import LINE, ODD_TEXTS, clashing, documents, words

TEXTS = [*ODD_TEXTS, "a b c a b c", "x\nx\n\nx\n \ny", f"{LINE}\n" * 6, f"{LINE}. " * 2 + "#$%", "\n".join(f"line {i} of some text with words." for i in range(30)), "#### $$$ *** " * 40, " a\na \n a"]


def plain(text):
    w, at = words(text), {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    again = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def test_against_plain_counts(spark):
    docs = clashing(documents(spark, TEXTS), "n_words", "KEPT", "base_failed", "vote_length", "posterior")
    got = Q.judge(docs).orderBy("doc_id").collect()
    for r, text in zip(got, TEXTS, strict=True):
        n, chars, symbols, lines, repeats = plain(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeats)
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (r["base_failed"] and r["kept"]) and 0 <= r["posterior"] <= 1
    assert Q.judge(docs.limit(0)).count() == 0


def test_expectation_maximisation_finds_the_accuracies():
    rng = np.random.default_rng(1)
    truth = np.where(rng.random(40_000) < 0.7, 1, -1)
    accuracy = np.array([0.9, 0.85, 0.75, 0.7, 0.6])
    votes = np.where(rng.random((40_000, 5)) < accuracy, truth[:, None], -truth[:, None])
    votes[rng.random(votes.shape) < 0.3] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = Q.fit(patterns, counts, tuple("abcde"))
    assert np.abs(np.array(model.accuracy) - accuracy).max() < 0.04
    assert abs(1 / (1 + np.exp(-model.prior)) - 0.7) < 0.04


def test_rules_that_see_one_fault_each():
    """Bad documents break one rule of six and keep the others; each rule alarms falsely on one good document in 400."""
    rng = np.random.default_rng(2)
    good, bad = np.ones((9_000, 6), int), np.ones((1_000, 6), int)
    good[rng.random(good.shape) < 0.0025] = -1
    bad[np.arange(1_000), rng.integers(0, 6, 1_000)] = -1
    votes = np.concatenate([good, bad])
    votes[rng.random(votes.shape) < 0.1] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = Q.fit_bounded(patterns, counts, tuple("abcdef"))
    odds = np.array(model.odds)
    total = model.prior + (votes[:, :, None] == np.array([-1, 0, 1])).astype(float).reshape(len(votes), -1) @ odds.ravel()
    kept = total >= 0
    flagged = (votes == -1).any(1)
    assert kept[~flagged].all() and not kept[flagged].any()
    assert (odds[:, 0] < 0).all() and (odds[:, 2] > 0).all()


def test_bounded_rates_on_clean_and_empty_tables():
    model = Q.fit_bounded(np.empty((0, 2), int), np.empty(0, int), ("a", "b"))
    assert abs(1 / (1 + np.exp(-model.prior)) - 0.8) < 1e-9
    clean = Q.fit_bounded(np.ones((1, 3), int), np.array([500]), ("a", "b", "c"))
    assert clean.prior > 3 and all(g > 0 > b for b, _, g in clean.odds)


def test_votes_of_a_model_without_rows():
    model = Q.fit(np.empty((0, 2), int), np.empty(0, int), ("a", "b"))
    assert model.accuracy == (0.8, 0.8)


def test_clean_text_stays_and_junk_goes(spark):
    clean = [" ".join(f"{w}{i % 13}{j}" if j % 3 else w for j, w in enumerate(LINE.split())) + f". Some ending number {i} stands here.\n" for i in range(4)]
    texts = ["".join(f"{c}{k} " for c in clean) for k in "abcdefgh"] + ["#### $$$ *** %%% " * 30, "&& " * 100]
    got = [r["kept"] for r in Q.judge(documents(spark, texts)).orderBy("doc_id").collect()]
    assert got == [True] * 8 + [False] * 2
