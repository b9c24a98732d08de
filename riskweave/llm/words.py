"""Token ids of texts by way of their distinct words: each is encoded once and kept."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_words(texts: pa.Array, separator: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of each word, offsets by text); empty words are among them."""
    parts = pc.split_pattern(texts, separator)
    coded = parts.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    off = np.asarray(parts.offsets, np.int64) - parts.offsets[0].as_py()
    return coded.dictionary, np.asarray(coded.indices).astype(np.int64), off


def split_codes(texts: pa.Array, separator: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``split_words`` with the distinct words as a list."""
    words, codes, off = split_words(texts, separator)
    return words.to_pylist(), codes, off


class IdStore:
    """Word to token ids; with more than ``limit`` words it keeps the half that most calls asked for."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids, self.n_ids = np.zeros(1 << 16, np.int32), 0
        self.at, self.n, self.hits = (np.zeros(1 << 16, t) for t in (np.int64, np.int32, np.int32))

    def _trim(self) -> None:
        """Keep the ``limit // 2`` words asked for in most calls; a call counts half after each trim."""
        k, most = len(self.slot), self.limit // 2
        keep = np.sort(np.argpartition(-self.hits[:k], most)[:most])
        kept = np.zeros(k, bool)
        kept[keep] = True
        # slots are numbered in the order of the dict
        self.slot = dict(zip(compress(self.slot, kept.tolist()), range(most), strict=True))
        at, n = self.at[keep], self.n[keep]
        ends = np.cumsum(n, dtype=np.int64)
        self.n_ids = int(ends[-1]) if most else 0
        self.ids[:self.n_ids] = self.ids[np.repeat(at - (ends - n), n) + np.arange(self.n_ids)]
        self.at[:most], self.n[:most] = ends - n, n
        self.hits[:most] = self.hits[keep] // 2

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of these new words one after another, how many each has)."""
        raise NotImplementedError

    def _learn(self, words: list[str]) -> None:
        ids, n = self.encode_words(words)
        k, total = len(self.slot), self.n_ids + len(ids)
        while total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while k + len(words) > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            self.n = np.concatenate([self.n, np.zeros_like(self.n)])
            self.hits = np.concatenate([self.hits, np.zeros_like(self.hits)])
        self.ids[self.n_ids:total] = ids
        self.n[k:k + len(words)] = n
        self.at[k:k + len(words)] = self.n_ids + np.cumsum(n) - n
        self.hits[k:k + len(words)] = 0
        self.n_ids = total
        self.slot.update(zip(words, range(k, k + len(words)), strict=True))

    def lookup(self, words: list[str], codes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text) of coded words; ``words`` are distinct."""
        if len(self.slot) > self.limit:
            self._trim()
        new = [w for w in words if w not in self.slot]
        if new:
            self._learn(new)
        slot = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
        self.hits[slot] += 1
        codes = slot[codes] if len(codes) else np.zeros(0, np.int64)
        n = self.n[codes]
        ends = np.cumsum(n, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, self.n_ids) < 1 << 30 else np.int64
        at = np.repeat((self.at[codes] - (ends - n)).astype(kind), n)
        at += np.arange(total, dtype=kind)
        ids = self.ids[at]
        return ids, np.concatenate([[0], ends])[off]
