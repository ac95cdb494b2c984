"""Token counts without token ids.

A text is cut into pre-tokens, and the pieces of each distinct pre-token are counted once. The counts
join the frequencies of pre-tokens in each document and are summed; ids are never laid out per document.
Distinct means distinct within what a worker remembers (a bounded lexicon kept between its tasks):
joining through a shuffle would move a row for almost every word of the corpus (see README).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from contractflow.llm.pretokens import cut, lexicon
from contractflow.llm.text import append, utf8


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """docs with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    A null text counts as empty, with no bytes and no tokens. Repeated rows are counted alike; columns of
    docs that have one of the new names give way. Special strings in a text are what the tokenizer makes
    of them by default; no begin or end tokens are added and nothing is truncated.
    """

    def count(texts: pa.Array) -> list[np.ndarray]:
        _, offsets = utf8(texts)
        data, starts, ends, row = cut(texts, tokenizer_path)
        words = lexicon(tokenizer_path, False)
        slots = words.slots(data, starts, ends)
        pairs, times = np.unique(row * np.int64(len(words.first)) + slots, return_counts=True)
        rows, slot = np.divmod(pairs, len(words.first))  # frequency of each pre-token in each document
        tokens = np.bincount(rows, times * words.sizes()[slot], len(offsets) - 1).astype(np.int64)
        return [np.diff(offsets), tokens, tokens > limit]

    return append(docs, text, count, "n_bytes long, n_tokens long, over_limit boolean")
