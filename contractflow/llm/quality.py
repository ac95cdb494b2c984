"""Quality rules as weak supervision.

Every rule votes good, votes bad or abstains. Expectation maximisation over the counts of vote
patterns estimates how accurate each rule is, without labels, and a document is judged by its
posterior probability of being good instead of by all rules at once. The counts cover all documents;
there are at most 3**rules patterns, whatever the number of documents.

A rule that calls a good document bad does so rarely, while it calls a bad one good whenever that is bad in
another way: most junk breaks one rule and keeps the others. So a rule has two rates, that of its false alarms, which
is bounded, and that of its detections.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractflow.llm.text import NOT_SPACE, U64, Words, append, byte_table, edges, find_words, intern, mix, row_of, same_runs, utf8, windows

SYMBOLS = byte_table(*[(b, b) for b in b"#*$%&|<>"])
GOOD, BAD, ABSTAIN = 1, -1, 0
FALSE_ALARM = 0.005  # of a rule's votes on good documents, at most this share says bad
FEW_LINES = 10  # with fewer, a share of repeated lines tells nothing bad

FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_letters long, n_stops long"
)
LETTERS = byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
SENTENCE_END = byte_table(*[(b, b) for b in b".!?"])


def repeated_windows(words: Words, size: int) -> np.ndarray:
    """The first words of the windows whose words occur, in this order, twice or more in their text."""
    hashes, at = windows(words.hashes(), words.text, size)
    keys = mix(hashes ^ mix(words.text[at].astype(U64) + U64(1)))
    _, first, which, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(times[which] > 1)
    one, two = at[twice], at[first[which[twice]]]
    same = words.text[one] == words.text[two]
    for j in range(size):
        same &= same_runs(words.data, words.starts[one + j], words.ends[one + j], words.data, words.starts[two + j], words.ends[two + j])
    if same.all():
        return one
    word, _, _ = intern(words.data, words.starts, words.ends)  # different windows have one hash: count them by their words
    rows = np.stack([words.text[at], *[word[at + j] for j in range(size)]], 1)
    _, which, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    return at[times[which.ravel()] > 1]


def measure(texts: pa.Array) -> list[np.ndarray]:
    """The counts of FEATURES for each text; a null or empty text has zeros."""
    data, offsets = utf8(texts)
    rows = len(offsets) - 1
    words = find_words(data, offsets, NOT_SPACE)
    inside = np.concatenate([[0], np.cumsum(NOT_SPACE[data] & ((data & 0xC0) != 0x80))])

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    repeated = np.zeros(len(words.starts), bool)
    twice = repeated_windows(words, 3)
    for j in range(3):
        repeated[twice + j] = True

    starts, ends = edges(data != 0x0A, offsets)
    line_text = row_of(offsets, starts)
    with_word = np.add.reduceat(NOT_SPACE[data].astype(np.int64), starts)[: len(starts)] > 0 if len(starts) else np.empty(0, bool)
    starts, ends, line_text = starts[with_word], ends[with_word], line_text[with_word]
    line, _, _ = intern(data, starts, ends)
    again = np.ones(len(line), bool)
    again[np.unique(line_text * np.int64(len(line) + 1) + line, return_index=True)[1]] = False

    count = lambda index: np.bincount(index, minlength=rows).astype(np.int64)
    return [
        words.count.astype(np.int64),
        inside[offsets[1:]] - inside[offsets[:-1]],
        per_text(SYMBOLS[data]),
        count(line_text[again]),
        count(words.text[repeated]),
        count(line_text),
        per_text(LETTERS[data] & ((data & 0xC0) != 0x80)),
        per_text(SENTENCE_END[data]),
    ]


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs and their FEATURES."""
    return append(docs, text, measure, FEATURES)


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN)).cast("byte")


def rules() -> dict[str, Column]:
    """The votes. Between a rule's two bounds it abstains; so does a rule without enough text to tell."""
    n, chars = F.col("n_words"), F.col("word_chars")
    enough = n >= 20
    return {
        "length": vote(n >= 80, n < 50),
        "word_length": vote((chars >= 3 * n) & (chars <= 9 * n) & enough, (chars < 2 * n) | (chars > 14 * n)),
        "symbols": vote((50 * F.col("n_symbols") <= n) & enough, 5 * F.col("n_symbols") > n),
        "repeated_lines": vote((20 * F.col("n_dup_lines") <= F.col("n_lines")) & (F.col("n_lines") > 1), (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")) & (F.col("n_lines") >= FEW_LINES)),
        "repeated_words": vote((10 * F.col("n_repeat_words") <= n) & enough, 100 * F.col("n_repeat_words") > 30 * n),
        "letters": vote((10 * F.col("n_letters") >= 8 * chars) & enough, 10 * F.col("n_letters") < 6 * chars),
        "sentences": vote((F.col("n_stops") > 0) & (40 * F.col("n_stops") >= n), (n >= 80) & (F.col("n_stops") == 0)),
    }


@dataclass(frozen=True)
class LabelModel:
    """Naive Bayes over votes: log odds of good for each rule's vote of bad, none and good, and of the prior.
    ``accuracy`` is the share of right votes, the mean of both classes' where these have rates of their own."""

    names: tuple[str, ...]
    prior: float
    odds: tuple[tuple[float, float, float], ...]
    accuracy: tuple[float, ...]

    def posterior(self) -> Column:
        """The probability that a document is good, from its vote columns."""
        total = F.lit(self.prior)
        for name, (bad, none, good) in zip(self.names, self.odds, strict=True):
            v = F.col(f"vote_{name}")
            total = total + F.when(v == BAD, F.lit(bad)).when(v == GOOD, F.lit(good)).otherwise(F.lit(none))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(patterns: np.ndarray, counts: np.ndarray, names: tuple[str, ...], rounds: int = 100) -> LabelModel:
    """Expectation maximisation over distinct vote patterns, weighted by how many documents show each.

    It starts from rules that are right four times in five, which tells the two classes apart, and keeps
    every rule's accuracy among its own votes above one half: a vote never speaks for its opposite. An
    empty table gives the starting model. Whether a rule abstains is taken to say nothing of quality.
    """
    m = patterns.shape[1]
    weight = counts.astype(float)
    accuracy, prior = np.full(m, 0.8), 0.8
    for _ in range(rounds if weight.sum() else 0):
        lean = np.log(accuracy) - np.log1p(-accuracy)
        good = 1.0 / (1.0 + np.exp(-(np.log(prior) - np.log1p(-prior) + patterns @ lean)))
        right = np.where(patterns == GOOD, good[:, None], 1 - good[:, None])
        voted = (patterns != ABSTAIN) * weight[:, None]
        updated = ((right * voted).sum(0) + 4.0) / (voted.sum(0) + 5.0)
        updated = np.clip(updated, 0.55, 0.99)
        new_prior = float(np.clip((good @ weight + 4.0) / (weight.sum() + 5.0), 0.05, 0.99))
        settled = np.abs(updated - accuracy).max() < 1e-9 and abs(new_prior - prior) < 1e-9
        accuracy, prior = updated, new_prior
        if settled:
            break
    lean = np.log(accuracy) - np.log1p(-accuracy)
    return LabelModel(names, float(np.log(prior) - np.log1p(-prior)), tuple((-float(x), 0.0, float(x)) for x in lean), tuple(map(float, accuracy)))


def fit_bounded(patterns: np.ndarray, counts: np.ndarray, names: tuple[str, ...], false_alarm: float = FALSE_ALARM, rounds: int = 500) -> LabelModel:
    """The same with a rate of false alarms, of ``false_alarm`` at most, and a rate of detections for each rule.

    It starts from rules that raise half as many false alarms and find three bad documents in ten; a rule always finds more
    than it raises falsely, so that no vote speaks for its opposite. At least half of the documents are taken to be good:
    one that no rule calls bad is always kept. An empty table gives the starting model.
    """
    m, weight = patterns.shape[1], counts.astype(float)
    bad, good = (patterns == BAD).astype(float), (patterns == GOOD).astype(float)
    false, found, prior = np.full(m, false_alarm / 2), np.full(m, 0.3), 0.8

    def odds() -> tuple[np.ndarray, np.ndarray]:
        return np.log(false / found), np.log1p(-false) - np.log1p(-found)

    for _ in range(rounds if weight.sum() else 0):
        against, for_ = odds()
        fine = 1.0 / (1.0 + np.exp(-np.clip(np.log(prior) - np.log1p(-prior) + bad @ against + good @ for_, -500, 500)))

        def share(of: np.ndarray, said: float, votes: float) -> np.ndarray:
            return ((bad * of[:, None]).sum(0) + said) / (((bad + good) * of[:, None]).sum(0) + votes)

        now_false = np.clip(share(fine * weight, 10 * false_alarm, 20), 1e-6, false_alarm)
        now_found = np.clip(share((1 - fine) * weight, 6, 20), 2 * false_alarm, 0.99)
        now_prior = float(np.clip((fine @ weight + 4.0) / (weight.sum() + 5.0), 0.5, 0.99))
        settled = max(np.abs(now_false - false).max(), np.abs(now_found - found).max(), abs(now_prior - prior)) < 1e-9
        false, found, prior = now_false, now_found, now_prior
        if settled:
            break
    against, for_ = odds()
    lean = tuple((float(a), 0.0, float(f)) for a, f in zip(against, for_, strict=True))
    return LabelModel(names, float(np.log(prior) - np.log1p(-prior)), lean, tuple(map(float, (1 - false + found) / 2)))


def learn(voted: DataFrame, names: tuple[str, ...]) -> LabelModel:
    """The label model, with bounded false alarms, of all rows of a table with vote columns; only pattern counts reach the driver."""
    rows = voted.groupBy(*[f"vote_{n}" for n in names]).agg(F.count("*").alias("n")).orderBy(*[f"vote_{n}" for n in names]).collect()
    patterns = np.array([[r[f"vote_{n}"] for n in names] for r in rows], int).reshape(len(rows), len(names))
    return fit_bounded(patterns, np.array([r["n"] for r in rows]), names)


def judge(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs with features, votes, ``base_failed``, ``posterior`` and ``kept``.

    A null or empty text has no words and fails the base rule. Repeated rows are judged one by one and
    alike. A column of docs whose name is one of the new names gives way to the new one. Texts are measured twice,
    once to learn from all votes and once to judge: that moves and stores nothing but pattern counts.
    """
    n = F.col("n_words")
    votes = rules()
    taken = ["base_failed", "posterior", "kept", *[f"vote_{k}" for k in votes]]
    measured = features(docs.drop(*[c for c in docs.columns if c.lower() in taken and c != text]), text)
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    voted = measured.select("*", *[v.alias(f"vote_{k}") for k, v in votes.items()], failed.alias("base_failed"))
    model = learn(voted, tuple(votes))
    scored = voted.withColumn("posterior", model.posterior())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
