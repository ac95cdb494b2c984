"""Pre-tokens: pieces of text that a tokenizer treats apart from their neighbours.

Texts are cut only where both byte-level and word tokenizers start afresh whatever stands on either
side: before ASCII white space that follows anything else, and between an ASCII letter or digit and ASCII
punctuation other than the apostrophe (which may begin a contraction). No cut touches white space beyond ASCII, since
a run of white space could reach across it, nor one of the tokenizer's special strings. The tokens of a text are
the tokens of its pre-tokens in order, so each distinct pre-token is given to the tokenizer once.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from contractflow.llm.text import LOWER, SPACE, byte_table, intern, row_of, same_runs, utf8

# White space beyond ASCII, as Unicode has it.
ODD_SPACES = [chr(c) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
LETTER = byte_table((0x41, 0x5A), (0x61, 0x7A))
ALNUM = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
MARK = byte_table((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))  # no apostrophe


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@cache
def apart(path: str) -> tuple[list[bytes], re.Pattern[bytes], re.Pattern[bytes] | None]:
    """What no cut may touch: bytes by which to see quickly whether there is any, white space beyond ASCII, and the
    tokenizer's special strings in any case, with the white space round them."""
    special = [re.escape(t.content.encode().lower()) for t in tokenizer(path).get_added_tokens_decoder().values() if t.content.strip()]
    quick = {c.encode()[:2] for c in ODD_SPACES if ord(c) < 0x1000 or 0x2000 <= ord(c) < 0x3000}
    quick |= {c.encode() for c in ODD_SPACES if c.encode()[:2] not in quick}
    quick |= {re.sub(rb"\\(.)", rb"\1", x) for x in special}
    odd = re.compile(b"|".join(c.encode() for c in ODD_SPACES))
    return list(quick), odd, re.compile(rb"(?=(" + b"|".join(special) + rb"))") if special else None


def cut(texts: pa.Array, path: str, spaces: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the texts, start and end of each pre-token, and its text's index.

    Without ``spaces``, ASCII white space that stands alone is no part of any pre-token.
    """
    data, offsets = utf8(texts)
    if not len(data):
        return data, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    space = SPACE[data]
    begins = np.zeros(len(data), bool)
    turn = space[1:] & ~space[:-1] if spaces else space[1:] != space[:-1]
    begins[1:] = turn | (MARK[data[1:]] & ALNUM[data[:-1]])
    raw, (quick, odd, special) = LOWER[data].tobytes(), apart(path)
    if any(x in raw for x in quick):
        whole = [m.span() for m in odd.finditer(raw)]
        for m in special.finditer(raw) if special else ():
            start, end = m.span(1)
            while start and space[start - 1]:
                start -= 1
            while end < len(data) and space[end]:
                end += 1
            whole.append((start, end))
        for start, end in whole:
            begins[start : end + 1] = False
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    if not spaces:
        blank = np.logical_and.reduceat(space, starts)
        starts, ends = starts[~blank], ends[~blank]
    return data, starts, ends, row_of(offsets, starts)


@cache
def byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write each byte: itself where it prints, else from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Grown:
    """An array that grows by doubling."""

    def __init__(self, kind: type):
        self.held, self.size = np.empty(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.held):
            held = np.empty(max(need, 2 * len(self.held)), self.held.dtype)
            held[: self.size] = self.held[: self.size]
            self.held = held
        self.held[self.size : need] = values
        self.size = need

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.size]


class Lexicon:
    """Token ids of pre-tokens, remembered by their bytes while these, the ids and the index take ``most`` bytes at
    most, and then begun anew. Pre-tokens of more than ``LONGEST`` bytes are never remembered.

    ``lowered`` tells that the tokenizer lower-cases and drops white space. Plain words go straight to the
    tokenizer's model, anything else through the whole tokenizer.
    """

    LONGEST = 64
    EACH = 48  # bytes of index for a pre-token

    def __init__(self, path: str, lowered: bool, most: int = 32 << 20):
        self.whole, self.lowered, self.most = tokenizer(path), lowered, most
        self.forget()

    def forget(self) -> None:
        self.keys, self.slot = np.empty(0, np.uint64), np.empty(0, np.int64)  # in order of keys
        self.new_keys, self.new_slot = self.keys, self.slot  # the latest ones, likewise
        self.ends, self.id_ends = Grown(np.int64), Grown(np.int64)  # of each slot's bytes and ids
        self.bytes, self.all_ids = Grown(np.uint8), Grown(np.uint32)
        self.ends.add(np.zeros(1, np.int64))
        self.id_ends.add(np.zeros(1, np.int64))
        self.kept = (1, 0, 0)

    @property
    def first(self) -> np.ndarray:
        """Where each slot's ids begin, and where the last slot's end."""
        return self.id_ends.values

    @property
    def ids(self) -> np.ndarray:
        return self.all_ids.values

    def held(self) -> int:
        return self.bytes.size + 4 * self.all_ids.size + self.EACH * self.ends.size

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(starts)
        model, letters, odd, pieces = self.whole.model.tokenize, byte_letters(), [], []
        lead = (data[starts] == 0x20) & (ends > starts + 1)
        is_letter = np.concatenate([[0], np.cumsum(LETTER[data])])
        simple = is_letter[ends] - is_letter[starts + lead] == ends - starts - lead
        raw = (LOWER[data] if self.lowered else data).tobytes()
        space = "" if self.lowered else letters[0x20]
        for i, (start, end, led, ascii_word) in enumerate(zip(starts.tolist(), ends.tolist(), lead.tolist(), simple.tolist(), strict=True)):
            word = raw[start + led : end].decode("utf-8", "replace")
            if ascii_word:
                out[i] = [t.id for t in model(space + word if led else word)]
            elif PLAIN.fullmatch(word):
                word = (word.lower() if self.lowered else word).encode().decode("latin-1").translate(letters)
                out[i] = [t.id for t in model(space + word if led else word)]
            else:
                odd.append(i)
                pieces.append(data[start:end].tobytes().decode("utf-8", "replace"))
        for i, one in zip(odd, self.whole.encode_batch_fast(pieces, add_special_tokens=False), strict=True):
            out[i] = one.ids
        return out

    def found(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        out = np.full(len(keys), -1)
        for held, slot in ((self.keys, self.slot), (self.new_keys, self.new_slot)):
            if len(held):
                place = np.minimum(np.searchsorted(held, keys), len(held) - 1)
                hit = held[place] == keys
                out[hit] = slot[place[hit]]
        return out

    def index(self, keys: np.ndarray, slot: np.ndarray) -> None:
        """Take new keys into the latest ones, and these into the others when they are a quarter as many."""

        def merged(keys: np.ndarray, slot: np.ndarray, more: np.ndarray, their: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            keys, slot = np.concatenate([keys, more]), np.concatenate([slot, their])
            order = np.argsort(keys, kind="stable")
            return keys[order], slot[order]

        self.new_keys, self.new_slot = merged(self.new_keys, self.new_slot, keys, slot)
        if 4 * len(self.new_keys) > len(self.keys):
            self.keys, self.slot = merged(self.keys, self.slot, self.new_keys, self.new_slot)
            self.new_keys, self.new_slot = self.keys[:0], self.slot[:0]

    def add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """New slots for the pre-tokens."""
        ids = self.encode(data, starts, ends)
        sizes, lengths = np.fromiter(map(len, ids), np.int64, len(ids)), ends - starts
        slot = np.arange(len(ids)) + self.ends.size - 1
        held = LOWER[data] if self.lowered else data
        self.bytes.add(held[np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)])
        self.ends.add(self.ends.values[-1] + np.cumsum(lengths))
        self.all_ids.add(np.fromiter((x for one in ids for x in one), np.uint32, int(sizes.sum())))
        self.id_ends.add(self.id_ends.values[-1] + np.cumsum(sizes))
        return slot

    def slots(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of each pre-token, good until the next call; unseen ones are encoded, each once."""
        if self.held() > self.most:
            self.forget()
        self.ends.size, self.bytes.size, self.all_ids.size = self.kept
        self.id_ends.size = self.ends.size
        shown = LOWER[data] if self.lowered else data
        which, at, keys = intern(shown, starts, ends)
        starts, ends = starts[at], ends[at]
        slot = self.found(keys)
        old = np.flatnonzero(slot >= 0)
        known = self.ends.values
        same = same_runs(shown, starts[old], ends[old], self.bytes.values, known[slot[old]], known[slot[old] + 1])
        taken = old[~same]  # another pre-token of this hash is remembered
        slot[taken] = -1
        keep = (slot < 0) & (ends - starts <= self.LONGEST)
        keep[taken] = False
        keep[len(np.unique(keys)) :] = False  # of several with one hash the first
        new, brief = np.flatnonzero(keep), np.flatnonzero((slot < 0) & ~keep)
        if len(new):
            slot[new] = self.add(data, starts[new], ends[new])
            self.index(keys[new], slot[new])
            self.kept = (self.ends.size, self.bytes.size, self.all_ids.size)
        if len(brief):
            slot[brief] = self.add(data, starts[brief], ends[brief])
        return slot[which]

    def sizes(self) -> np.ndarray:
        """The number of ids in each slot."""
        return np.diff(self.first)


@cache
def lexicon(path: str, lowered: bool) -> Lexicon:
    """The lexicon of this worker process, kept from task to task."""
    return Lexicon(path, lowered)
