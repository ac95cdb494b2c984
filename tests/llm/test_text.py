"""Equality is decided by bytes: crafted words, hashes that collide, and odd white space."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from contractflow.llm import pretokens, quality, text
from contractflow.llm.jaccard_join import near_duplicates
from contractflow.llm.packing import pack
from contractflow.llm.pretokens import Lexicon, cut
from contractflow.llm.quality import judge
from contractflow.llm.token_counts import count_tokens
from tests.llm.support import documents

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def crafted(letters="ab", doublings=10):
    """Two words that no sum of powers modulo 2**64 tells apart."""
    word = [0]
    for _ in range(doublings):
        word += [1 - x for x in word]
    return "".join(letters[x] for x in word), "".join(letters[1 - x] for x in word)


ONE, TWO = crafted()


def test_crafted_words_through_the_operators(spark):
    filler = " ".join(f"w{i}" for i in range(60))
    docs = documents(spark, [ONE, TWO, f"{filler}\n{ONE}\n{TWO}\n{ONE}", f"{ONE} x y z", f"{TWO} x y z", f"a b {ONE} a b {TWO}"])
    held = [r["text"] for r in docs.orderBy("doc_id").collect()]
    counted = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs, BYTES).collect()}
    assert counted == {i: len(Tokenizer.from_file(BYTES).encode(t, add_special_tokens=False).ids) for i, t in enumerate(held)}
    packed = pack(docs, WORDS, with_ids=True).orderBy("doc_id", "piece").collect()
    for i, t in enumerate(held):
        assert sum((r["ids"] for r in packed if r["doc_id"] == i), []) == [*Tokenizer.from_file(WORDS).encode(t, add_special_tokens=False).ids, 1]
    judged = {r["doc_id"]: r for r in judge(docs).collect()}
    assert judged[2]["n_dup_lines"] == 1 and judged[5]["n_repeat_words"] == 0
    joined = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert joined == {i: i for i in range(6)}


@pytest.fixture(params=[0, 3])
def few_hashes(request, monkeypatch):
    """Hashes of no or three bits, so that nearly all words collide."""
    whole = text.run_hashes
    few = lambda data, starts, ends: whole(data, starts, ends) & np.uint64((1 << request.param) - 1)
    monkeypatch.setattr(text, "run_hashes", few)


def test_equality_survives_colliding_hashes(few_hashes):
    texts = pa.array(["a b c a b c d", "x\ny\nx\nz\n\ny", "the cat the dog the cat", None, "", "b a c a b"])
    expected = [[7, 7, 0, 0, 6, 1, 7, 0], [5, 5, 0, 2, 0, 5, 5, 0], [6, 18, 0, 0, 0, 1, 18, 0], [0] * 8, [0] * 8, [5, 5, 0, 0, 0, 1, 5, 0]]
    assert np.stack(quality.measure(texts), 1).tolist() == expected
    for path, lowered in ((BYTES, False), (WORDS, True)):
        words, whole = Lexicon(path, lowered), Tokenizer.from_file(path)
        for again in range(3):
            column = pa.array([f"one two three one TWO {again} four", "two four", "", "five two"])
            data, starts, ends, row = cut(column, path, spaces=not lowered)
            slots = words.slots(data, starts, ends)
            ids = [[x for s in slots[row == i] for x in words.ids[words.first[s] : words.first[s + 1]].tolist()] for i in range(4)]
            assert ids == [whole.encode(t, add_special_tokens=False).ids for t in column.to_pylist()]


def test_odd_space_and_special_strings_are_cut_round():
    marks = [" ", " ", "\u0085", "<|endoftext|>", " <|endoftext|> ", "[UNK]", "</s>", "<s>", "<unk>"]
    texts = [f"{a}{m}{b}" for m in marks for a in ("", "one two", "one, ", " ", "  ", "\n\n") for b in ("", "three four", " three,x", "  \n y", "   z", "<|endoftext|>q r")]
    for path, lowered in ((BYTES, False), (WORDS, True)):
        whole = Tokenizer.from_file(path)
        data, starts, ends, row = cut(pa.array(texts), path, spaces=not lowered)
        words = Lexicon(path, lowered)
        slots = words.slots(data, starts, ends)
        got = [[x for s in slots[row == i] for x in words.ids[words.first[s] : words.first[s + 1]].tolist()] for i in range(len(texts))]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path, lowered", [(BYTES, False), (WORDS, True)])
def test_a_lexicon_is_bounded_by_bytes(path, lowered):
    words = Lexicon(path, lowered, most=1 << 20)
    for i in range(60):
        column = pa.array([" ".join(f"q{i}z{j}" for j in range(2_000)), " ".join(f"odd{i}x{j}" for j in range(2_000)), f"{i}" * 200_000])
        data, starts, ends, _ = cut(column, path, spaces=not lowered)
        words.slots(data, starts, ends)
        assert words.kept[1] < (1 << 20) + 40_000 and words.kept[0] < 40_000
    assert len(words.keys) + len(words.new_keys) == words.kept[0] - 1


def test_runs_of_any_length_are_compared():
    runs = [b"", b"a", b"b", b"abcdefgh", b"abcdefgi", b"abcdefghi", b"x" * 512, b"x" * 513, b"x" * 5000, b"x" * 4999 + b"y", b"a", b"x" * 5000]
    data = np.frombuffer(b"".join(runs), np.uint8)
    ends = np.cumsum([len(r) for r in runs])
    starts = ends - [len(r) for r in runs]
    which, first, keys = text.intern(data, starts, ends)
    assert [runs[first[w]] for w in which] == runs and len(first) == len(set(runs)) == len(keys)
    assert len(pretokens.apart(BYTES)[0]) > 3
