from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contractflow.llm.pretokens import Lexicon, cut, tokenizer
from contractflow.llm.token_counts import count_tokens
from tests.llm.support import ODD_TEXTS, clashing, documents

SPECIAL = ["a<|endoftext|>b", " <|endoftext|> c", "it's We'll DON'T x'", "naïve café　x", "日本語 テスト。ok", "İstanbul ẞ Σας", "a  \n\n b \r\n", "é ö", "1,234.5 $9 a.b.c"]
FILES = {"byte_bpe_50k.json": False, "word_bpe_49k.json": True}


def counts(path, lowered, texts, most=2_000_000):
    words = Lexicon(path, lowered, most)
    data, starts, ends, row = cut(pa.array(texts, pa.string()), path, spaces=not lowered)
    slots = words.slots(data, starts, ends)
    out = [0] * len(texts)
    for r, n in zip(row.tolist(), words.sizes()[slots].tolist(), strict=True):
        out[r] += n
    return out


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text("aB .,'s\n é<|>1", max_size=30), st.sampled_from(SPECIAL)), max_size=5))
def test_any_text(file, texts):
    path = public_tokenizers.path(file)
    assert counts(path, FILES[file], texts) == [len(tokenizer(path).encode(t, add_special_tokens=False).ids) for t in texts]


def test_a_full_lexicon_begins_anew():
    path = public_tokenizers.path("byte_bpe_50k.json")
    words = Lexicon(path, False, most=5)
    for text in ("one two three four", "five six seven", "one two nine"):
        data, starts, ends, _ = cut(pa.array([text]), path)
        slots = words.slots(data, starts, ends)
        assert words.sizes()[slots].sum() == len(tokenizer(path).encode(text).ids)


def test_table(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*ODD_TEXTS, *SPECIAL]
    docs = clashing(documents(spark, texts), "n_bytes", "N_TOKENS", "over_limit")
    got = count_tokens(docs, path).orderBy("doc_id").collect()
    plain = [len(tokenizer(path).encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert [r["n_tokens"] for r in got] == plain
    assert [r["n_bytes"] for r in got] == [len((t or "").encode()) for t in texts]
    assert [r["over_limit"] for r in got] == [n > 1024 for n in plain]
    assert count_tokens(docs.limit(0), path).count() == 0
