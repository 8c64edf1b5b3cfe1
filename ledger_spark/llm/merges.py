"""Byte-pair merges of many words at once, in vectorised rounds.

All words lie in one flat symbol array. A round finds the smallest pair rank of each word (a
segmented minimum), merges every leftmost occurrence of it at once, closes the gaps and takes
out the words that have no pair left. Only pairs next to a merge are looked up again.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import count, islice

import numpy as np

NONE = np.int32(2**31 - 1)
# Words of more symbols (runs of blanks, junk) would need too many rounds of their own.
LONG_WORD = 1024


class PairTable:
    """Ranks and results of the symbol pairs that may merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.rank = np.append(rank[order].astype(np.int32), NONE)
        self.merged = np.append(merged[order].astype(np.int32), np.int32(-1))
        # A merge is hazardous if its result can merge on at the same or an earlier rank: the
        # next merge of that word may then not be another occurrence of the same pair.
        symbols = int(max(left.max(), right.max(), merged.max())) + 1
        onward = np.full(symbols, NONE, dtype=np.int32)
        np.minimum.at(onward, left, rank)
        np.minimum.at(onward, right, rank)
        self.hazard = np.zeros(int(rank.max()) + 1, dtype=bool)
        np.logical_or.at(self.hazard, rank, onward[merged] <= rank)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair; the last index stands for pairs that never merge."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, at, len(self.keys)).astype(np.int32)

    @cached_property
    def entries(self) -> dict[int, tuple[int, int]]:
        rows = zip(self.keys.tolist(), self.rank.tolist(), self.merged.tolist(), strict=False)
        return {key: (rank, merged) for key, rank, merged in rows}


def merge_queue(symbols: list[int], table: PairTable) -> list[int]:
    """The same merges for one long word, by a queue of (rank, place)."""
    sym, entries, n = list(symbols), table.entries, len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        if (entry := entries.get((sym[i] << 32) | sym[i + 1])) is not None:
            queue.append((entry[0], i, sym[i], sym[i + 1]))
    heapify(queue)
    while queue:
        _, i, a, b = heappop(queue)
        j = after[i]
        if sym[i] != a or j >= n or sym[j] != b:
            continue  # one of the two was merged meanwhile
        sym[i], sym[j] = entries[(a << 32) | b][1], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for x in (before[i], i):
            y = after[x] if x >= 0 else n
            if y < n and (entry := entries.get((sym[x] << 32) | sym[y])) is not None:
                heappush(queue, (entry[0], x, sym[x], sym[y]))
    return [s for s in sym if s >= 0]


def merge_words(
    symbols: np.ndarray, lengths: np.ndarray, table: PairTable
) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words after every merge, and how many each word has.

    ``lengths`` has the number of symbols of each word, at least one. Equals a queue that always
    merges the pair of smallest rank, the leftmost of equals.
    """
    none = np.int32(len(table.keys))
    sym = symbols.astype(np.int32)
    word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    done_word, done_sym = [], []
    if (long := np.flatnonzero(lengths > LONG_WORD)).size:
        ends = np.cumsum(lengths)
        for i in long.tolist():
            merged = merge_queue(sym[ends[i] - lengths[i] : ends[i]].tolist(), table)
            done_word.append(np.full(len(merged), i, dtype=np.int32))
            done_sym.append(np.array(merged, dtype=np.int32))
        short = np.repeat(lengths <= LONG_WORD, lengths)
        sym, word = sym[short], word[short]
    pair = np.full(len(sym), none, dtype=np.int32)
    inner = np.flatnonzero(word[1:] == word[:-1])
    pair[inner] = table.find(sym[inner], sym[inner + 1])
    while len(sym):
        rank = table.rank[pair]
        first = np.append(True, word[1:] != word[:-1])
        starts = np.flatnonzero(first)
        least = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(sym)))
        live = least != NONE
        if not live.all():
            keep = np.repeat(live, sizes)
            done_word.append(word[~keep])
            done_sym.append(sym[~keep])
            sym, word, pair, rank = sym[keep], word[keep], pair[keep], rank[keep]
            least, sizes = least[live], sizes[live]
            if not len(sym):
                break
        hit = rank == np.repeat(least, sizes)
        at = np.flatnonzero(hit)
        # Overlapping hits: every second one, counted from the start of their run.
        new_run = np.append(True, np.diff(at) != 1)
        run_start = at[np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))]
        chosen = (at - run_start) % 2 == 0
        careful = table.hazard[rank[at]]
        if careful.any():
            leftmost = np.append(True, word[at[1:]] != word[at[:-1]])
            chosen &= ~careful | leftmost
        at = at[chosen]
        sym[at] = table.merged[pair[at]]
        keep = np.ones(len(sym), dtype=bool)
        keep[at + 1] = False
        sym, word, pair = sym[keep], word[keep], pair[keep]
        at = at - np.arange(len(at))
        near = np.zeros(len(sym) + 1, dtype=bool)
        near[at] = True
        near[at - 1] = True  # -1 marks the place after the last symbol
        pair[near[:-1]] = none
        inner = np.flatnonzero(near[:-2] & (word[1:] == word[:-1]))
        pair[inner] = table.find(sym[inner], sym[inner + 1])
    if not done_word:
        return np.empty(0, np.int32), np.zeros(len(lengths), np.int64)
    words, flat = np.concatenate(done_word), np.concatenate(done_sym)
    order = np.argsort(words, kind="stable")
    return flat[order], np.bincount(words, minlength=len(lengths))


class WordCache:
    """Token ids of the words met so far; starts anew beyond so many words or characters."""

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        limit: int = 100_000,
        characters: int = 2_000_000,
    ):
        self.encode, self.limit, self.characters = encode, limit, characters
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = defaultdict(count().__next__)
        self.flat = np.empty(0, np.int32)
        self.counts = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)
        self.held = 0

    def codes(self, words: list[str]) -> np.ndarray:
        """A code for each word; ``counts`` and ``ids`` take codes of the latest call."""
        if len(self.index) > self.limit or self.held > self.characters:
            self._clear()
        index, known = self.index, len(self.index)
        codes = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        if len(index) > known:
            new = list(islice(index, known, None))
            self.held += sum(map(len, new))
            flat, counts = self.encode(new)
            starts = len(self.flat) + np.cumsum(counts) - counts
            self.flat = np.concatenate([self.flat, flat])
            self.counts = np.concatenate([self.counts, counts])
            self.starts = np.concatenate([self.starts, starts])
        return codes

    def ids(self, codes: np.ndarray) -> np.ndarray:
        """The ids of the coded words, one after another."""
        counts = self.counts[codes]
        shift = self.starts[codes] - (np.cumsum(counts) - counts)
        return self.flat[np.repeat(shift, counts) + np.arange(counts.sum())]
