"""Language of every word and of whole texts, mixed-language texts included.

Words are runs of letters. Each character's script narrows which languages a word can be in. A word
scores under a language by its character trigrams, counted over labelled texts, and Viterbi with a
penalty for every change of language labels the words, all texts of a slice together, word by word.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractflow.llm.text import U64, append, lean, parts

BUCKETS = 1 << 16
UNKNOWN = "und"

# First and last code points of scripts, after the Unicode blocks; what is in none is "other".
SCRIPTS = [
    ("latin", [(0x41, 0x24F), (0x1E00, 0x1EFF)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF)]),
    ("hangul", [(0x1100, 0x11FF), (0xAC00, 0xD7AF)]),
    ("kana", [(0x3040, 0x30FF)]),
    ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)]),
]
LANG_LIMIT = 512


@cache
def characters() -> np.ndarray:
    """For every code point 0 for no letter, else 1 + its script's number."""
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    table[[c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "L"]] = len(SCRIPTS) + 1
    for i, (_, ranges) in enumerate(SCRIPTS):
        for low, high in ranges:
            table[low : high + 1][table[low : high + 1] > 0] = i + 1
    return table


@dataclass
class Letters:
    """The words of some texts as lower-case code points, each followed by a blank."""

    code: np.ndarray  # code points of all words, with a 0 before and after each word
    start: np.ndarray  # first trigram of each word; a word of n letters has n of them
    size: np.ndarray
    text: np.ndarray
    script: np.ndarray  # the script of most letters, as a number; of equals the higher
    trigram: np.ndarray  # bucket of every trigram


def letters(texts: list[str | None]) -> Letters:
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum([len(t) for t in low])
    kind = characters()[code]
    is_letter = kind > 0
    begins = np.zeros(len(code) + 1, bool)
    begins[ends] = True
    begins[0] = True
    begins = begins[:-1]
    before = np.concatenate([[False], is_letter[:-1]])[: len(code)]
    first = np.flatnonzero(is_letter & (~before | begins))
    opens = np.zeros(len(code) + 1, bool)
    opens[first] = True
    last = np.flatnonzero(is_letter & (np.concatenate([~is_letter[1:], [True]])[: len(code)] | np.concatenate([begins[1:], [True]])[: len(code)]))
    size = last - first + 1
    text = np.searchsorted(ends, first, "right")
    script = np.zeros(len(first), np.uint8)
    if len(first):
        high = np.maximum.reduceat(np.where(is_letter, kind, 0), first).astype(np.int64)
        mixed = np.flatnonzero(high != np.minimum.reduceat(np.where(is_letter, kind, 255), first))
        if len(mixed):  # words of several scripts are few: count their letters by script
            width = int(high.max()) + 1
            held_in = np.repeat(np.arange(len(mixed)), size[mixed])
            letter = np.arange(len(held_in)) - np.repeat(np.cumsum(size[mixed]) - size[mixed], size[mixed]) + first[mixed][held_in]
            counts = np.bincount(held_in * width + kind[letter], minlength=len(mixed) * width).reshape(len(mixed), width)
            high[mixed] = width - 1 - counts[:, ::-1].argmax(1)
        script = (high - 1).astype(np.uint8)
    # a blank on either side of each word, so that its first and last letters make trigrams of their own
    held = code[is_letter].astype(U64)
    at = np.cumsum(size) - size
    left = np.concatenate([[0], held[:-1]]).astype(U64)[: len(held)]
    left[at] = 0
    right = np.concatenate([held[1:], [0]]).astype(U64)[: len(held)]
    right[at + size - 1] = 0
    hashed = (left * U64(0x9E3779B97F4A7C15) ^ held * U64(0xC2B2AE3D27D4EB4F) ^ right * U64(0x165667B19E3779F9)) * U64(0xD6E8FEB86659FD93)
    return Letters(held, at, size, text, script, (hashed >> U64(48)).astype(np.int64))


@dataclass
class Model:
    """Log probabilities of trigrams (buckets by languages) and which languages each script can be in."""

    languages: list[str]
    scores: np.ndarray
    allowed: np.ndarray  # scripts by languages


def counted(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, kind, bucket, n): trigram counts (kind 0) and letters by script (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in parts(batch, 0):
                langs = np.array(part.column(1).to_pylist(), object)
                words = letters(part.column(0).to_pylist())
                for name in set(langs.tolist()):
                    mine = langs[words.text] == name
                    own = np.repeat(mine, words.size)
                    counts = total.setdefault(name, np.zeros(BUCKETS + len(SCRIPTS) + 1, np.int64))
                    counts[:BUCKETS] += np.bincount(words.trigram[own], minlength=BUCKETS)
                    counts[BUCKETS:] += np.bincount(words.script[mine], words.size[mine], len(SCRIPTS) + 1).astype(np.int64)
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "bucket", "n"])

    rows = labelled.select(F.col(f"`{text}`").cast("string"), F.col(f"`{lang}`").cast("string")).mapInArrow(lean(run), "lang string, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", most_rows: int = 200_000, seed: int = 7) -> Model:
    """Learn from rows with a label and a text.

    Of more than ``most_rows`` such rows a random share of about that many is read, chosen by a hash of the
    text. The model's size depends on the number of languages alone; more than 512 are refused.
    """
    rows = labelled.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    total = rows.count()
    if total > most_rows:
        share = round(most_rows / total * (1 << 32))
        rows = rows.where(F.pmod(F.xxhash64(F.col(f"`{text}`"), F.lit(seed)), F.lit(1 << 32)) < share)
    table = counted(rows, text, lang).toArrow()
    names = np.array(table["lang"].to_pylist(), object)
    languages = sorted(set(names.tolist()))
    if len(languages) > LANG_LIMIT:
        raise ValueError(f"{len(languages)} languages; at most {LANG_LIMIT} are learned")
    counts = np.zeros((BUCKETS + len(SCRIPTS) + 1, max(1, len(languages))))
    where = np.searchsorted(languages, names.astype(str)) if len(languages) else np.empty(0, int)
    counts[table["bucket"].to_numpy(), where] = table["n"].to_numpy()
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    share = (grams + 0.05) / (grams.sum(0) + 0.05 * BUCKETS)
    allowed = scripts > 0.001 * np.maximum(scripts.sum(0), 1)
    return Model(languages, np.log(share).astype(np.float32), allowed)


def viterbi(scores: np.ndarray, count: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word; rows of ``scores`` are the words of texts of ``count`` words each.

    A step takes the next word of every text that has one: as many steps as the longest text has words.
    """
    states = scores.shape[1]
    order = np.argsort(-count, kind="stable")
    first = (np.cumsum(count) - count)[order]
    size = count[order]
    live = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")  # texts longer than each step
    best = np.zeros((len(count), states), np.float64)
    back = np.zeros(scores.shape, np.int16 if states > 127 else np.int8)
    own = np.arange(states)
    for step, n in enumerate(live.tolist()):
        at = first[:n] + step
        if step:
            held = best[:n]
            top = held.argmax(1)
            change = held[np.arange(n), top] - penalty
            move = held < change[:, None]
            back[at] = np.where(move, top[:, None], own)
            best[:n] = np.where(move, change[:, None], held) + scores[at]
        else:
            best[:n] = scores[at]
    label = np.zeros(len(scores), np.int64)
    now = best.argmax(1)
    for step in range(len(live) - 1, -1, -1):
        n = live[step]
        at = first[:n] + step
        label[at] = now[:n]
        now[:n] = back[at, now[:n]]
    return label


SLICE = 1 << 20  # bytes: a step of the search takes a word of every text of a slice, so more texts make cheaper steps
SCHEMA = "lang_pred string, score double, lang_spans array<struct<lang:string,words:int>>"
SPANS = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))


def label(docs: DataFrame, model: Model, text: str = "text", penalty: float = 8.0) -> DataFrame:
    """docs with ``lang_pred``, ``score`` and ``lang_spans``.

    The spans are the runs of words of one language, in order. The prediction is the language of most
    letters (of equals, the first by name) and the score is its share of all letters. A text that is null or
    has no letter, or any text under a model that has learned nothing, is ``und`` with score 0 and no span.
    Repeated rows are labelled alike; columns of docs named like new ones give way.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: pa.Array) -> list[pa.Array]:
        m = sent.value
        words = letters(texts.to_pylist())
        none = [pa.array([UNKNOWN] * len(texts)), pa.array(np.zeros(len(texts))), pa.array([[]] * len(texts), SPANS)]
        if not len(words.text) or not m.languages:
            return none
        scores = np.add.reduceat(m.scores[words.trigram], words.start, axis=0)
        allowed = m.allowed[words.script]
        scores = np.where(allowed | ~allowed.any(1, keepdims=True), scores, scores - 1000.0)
        count = np.bincount(words.text, minlength=len(texts))
        labels = viterbi(scores, count, penalty)
        states = len(m.languages)
        total = np.bincount(words.text * states + labels, words.size, len(texts) * states).reshape(len(texts), states)
        have = total.sum(1)
        top = total.argmax(1)
        names = np.array([*m.languages, UNKNOWN], object)
        pred = names[np.where(have > 0, top, states)]
        score = np.divide(total.max(1), have, out=np.zeros(len(have)), where=have > 0)
        turn = np.ones(len(labels), bool)
        turn[1:] = (labels[1:] != labels[:-1]) | (words.text[1:] != words.text[:-1])
        at = np.flatnonzero(turn)
        length = np.diff(np.append(at, len(labels))).astype(np.int32)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(words.text[at], minlength=len(texts)))]).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(names[labels[at]].tolist(), pa.string()), pa.array(length)], ["lang", "words"])
        return [pa.array(pred.tolist(), pa.string()), pa.array(score), pa.ListArray.from_arrays(cuts, spans).cast(SPANS)]

    return append(docs, text, make, SCHEMA, SLICE)
