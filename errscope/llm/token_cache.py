"""Token ids of whole texts, word by word.

The tokenizer drops white space and never joins across it, so the ids of a text
are those of its white-space separated words in order; a comma or full stop
that ends a word behind a letter is a token run of its own. Words are hashed for
a whole slice of texts at once, each distinct one is looked up in an open
hash table, and only words not met before go to the tokenizer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

from .common import NON_SPACE, Words, text_slices, words_in

_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
_MARK = np.array([b in b".," for b in range(256)])
_EMPTY = np.uint64(0)


def _marks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a comma or full stop ends a word behind an ASCII letter."""
    at = np.flatnonzero(_MARK[data])
    at = at[at > 0]
    behind = at + 1
    ends = behind == len(data)
    ends[~ends] = ~NON_SPACE[data[behind[~ends]]]
    ends |= np.isin(behind, offsets)
    return at[_LETTER[data[at - 1]] & ends & ~np.isin(at, offsets)]


class TokenCache:
    """Ids of words, kept for up to ``entries`` words; then it starts anew."""

    def __init__(self, path: str, entries: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.entries = entries
        self.slots = 1 << (2 * entries - 1).bit_length()
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0x80, 0x100) if chr(c).isalpha()]
        self.letters = {ord(c): "".join(x for x, _ in byte_level.pre_tokenize_str(c)) for c in letters}
        self._reset()

    def _reset(self) -> None:
        self.key = np.zeros(self.slots, np.uint64)
        self.entry = np.zeros(self.slots, np.int32)
        self.start = np.zeros(self.entries + 1, np.int64)  # of each entry in the pool
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _slot(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot, found) by linear probing; the slot of an absent hash is free."""
        mask = self.slots - 1
        slot = (hashes & np.uint64(mask)).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            here = self.key[slot[todo]]
            todo = todo[(here != hashes[todo]) & (here != _EMPTY)]
            slot[todo] = (slot[todo] + 1) & mask
        return slot, self.key[slot] == hashes

    def word_ids(self, word: str) -> list[int]:
        if word.isalpha() and ord(max(word)) < 0x100:  # one run of letters whose normal form is the lower case
            return [t.id for t in self.tokenizer.model.tokenize(word.lower().translate(self.letters))]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _add(self, hashes: np.ndarray, words: list[str]) -> None:
        mask = self.slots - 1
        for h, word in zip(hashes.tolist(), words):
            ids = self.word_ids(word)
            at, n = int(self.start[self.used]), len(ids)
            while at + n > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[at : at + n] = ids
            slot = h & mask
            while self.key[slot]:
                slot = (slot + 1) & mask
            self.key[slot], self.entry[slot] = h, self.used
            self.used += 1
            self.start[self.used] = at + n

    def _ids_of(self, data: np.ndarray, w: Words, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each word)."""
        distinct, first, place = np.unique(w.hash, return_index=True, return_inverse=True)
        ids, count = [], []
        # distinct words in groups that the table can hold together
        for at in range(0, len(distinct), self.entries):
            some, some_first = distinct[at : at + self.entries], first[at : at + self.entries]
            slot, found = self._slot(some)
            missing = np.flatnonzero(~found)
            if self.used + len(missing) > self.entries:
                self._reset()
                missing = np.arange(len(some))
            if len(missing):
                raw = data.tobytes()
                k = some_first[missing]
                self._add(some[missing], [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[k].tolist(), end[k].tolist())])
                slot, _ = self._slot(some)
            entry = self.entry[slot]
            n = self.start[entry + 1] - self.start[entry]
            ids.append(self.pool[_ranges(self.start[entry], n)])
            count.append(n)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        n = np.concatenate(count) if count else np.zeros(0, np.int64)
        where = np.concatenate([[0], np.cumsum(n)])
        return flat[_ranges(where[place], n[place])], n[place]

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, bounds) of runs of rows: ids[bounds[i]:bounds[i + 1]] belong to row i of the run."""
        for first, data, offsets in text_slices(texts):
            raw = data.tobytes()
            if b"<|" in raw:  # may hold special tokens, which are case-sensitive
                rows = [self.tokenizer.encode(raw[a:b].decode("utf-8", "replace"), add_special_tokens=False).ids for a, b in zip(offsets, offsets[1:])]
                yield first, np.array([x for r in rows for x in r], np.uint32), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
                continue
            w, start, end = words_in(data, offsets, NON_SPACE, _marks(data, offsets))
            ids, count = self._ids_of(data, w, start, end)
            total = np.concatenate([[0], np.cumsum(count)])
            yield first, ids, total[w.bounds]


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each count, one after another."""
    total = np.cumsum(count)
    n = int(total[-1]) if len(total) else 0
    return np.arange(n) + np.repeat(start - (total - count), count)


_caches: dict[str, TokenCache] = {}


def token_cache(path: str) -> TokenCache:
    """One cache per Python worker."""
    if path not in _caches:
        _caches[path] = TokenCache(path)
    return _caches[path]
