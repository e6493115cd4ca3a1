"""Word-level suffix arrays: built by prefix doubling, searched by vectorised binary search.

Words are numbered by their hash's place in the array's vocabulary, from 1; texts
end in 0, so a suffix never runs into the next text. Suffixes that are equal to
their texts' ends stand in any order.
"""

from __future__ import annotations

import numpy as np

#: Most words in the key that suffixes are sorted by at first.
HEAD = 8


class SuffixArray:
    """Of texts laid end to end: hashes of their words, and each word's text, ascending."""

    def __init__(self, hashes: np.ndarray, text: np.ndarray):
        self.vocabulary, number = np.unique(hashes, return_inverse=True)
        n = len(hashes)
        self.ids = number.astype(np.int64) + 1
        self.text = text
        last = np.flatnonzero(np.append(text[1:] != text[:-1], True)) + 1 if n else np.zeros(0, np.int64)
        self.end = np.repeat(last, np.diff(last, prepend=0))
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.head = max(1, min(HEAD, 63 // self.bits))
        key = np.zeros(n, np.uint64)
        for k in range(self.head):
            key = (key << np.uint64(self.bits)) | self.word(np.arange(n), k).astype(np.uint64)
        self.order = np.argsort(key)
        self.keys = key[self.order]
        self.refine()

    def __len__(self) -> int:
        return len(self.ids)

    def word(self, at: np.ndarray, depth: int | np.ndarray) -> np.ndarray:
        """The number of the word so many after each place, 0 beyond the text's end."""
        place = at + depth
        return np.where(place < self.end[at], self.ids[np.minimum(place, len(self.ids) - 1)], 0) if len(at) else np.zeros(0, np.int64)

    def refine(self) -> None:
        """Sort by ever twice as many words, groups of equal keys alone, until none can be parted."""
        n, depth = len(self), self.head
        new = np.ones(n, bool)
        new[1:] = self.keys[1:] != self.keys[:-1]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, n))
        rank = np.empty(n, np.int64)
        rank[self.order] = np.repeat(begin, size) + 1
        slots = np.flatnonzero(np.repeat(size > 1, size))
        while len(slots):
            at = self.order[slots]
            group = rank[at]
            far = at + depth
            second = np.where(far < self.end[at], rank[np.minimum(far, n - 1)], 0)
            by = np.argsort(group.astype(np.uint64) * np.uint64(n + 1) + second.astype(np.uint64))
            at, group, second = at[by], group[by], second[by]
            self.order[slots] = at
            new = np.ones(len(at), bool)
            new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(at)))
            rank[at] = np.repeat(slots[first], size) + 1
            slots = slots[np.repeat(size > 1, size) & (second > 0)]
            depth *= 2

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Words in this array's numbers, 0 where it has none such."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int64)

    def narrow(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of ranges whose suffixes agree in depth words, the parts that go on with these words."""
        out = []
        for right in (False, True):
            a, b = low.copy(), high.copy()
            open_ = np.flatnonzero(a < b)
            while len(open_):
                middle = (a[open_] + b[open_]) >> 1
                seen = self.word(self.order[middle], depth)
                go = seen <= word[open_] if right else seen < word[open_]
                a[open_[go]] = middle[go] + 1
                b[open_[~go]] = middle[~go]
                open_ = open_[a[open_] < b[open_]]
            out.append(a)
        return out[0], out[1]

    def find(self, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each pattern words[start : start + length], one word long or more."""
        low, high = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        absent = np.concatenate([[0], np.cumsum(words == 0)])
        open_ = np.flatnonzero(absent[start + length] == absent[start])
        if not len(open_) or not len(self):
            return low, high
        begin, size = start[open_], length[open_]
        key = np.zeros(len(open_), np.uint64)
        for k in range(self.head):
            word = np.where(k < size, words[np.minimum(begin + k, len(words) - 1)], 0)
            key = (key << np.uint64(self.bits)) | word.astype(np.uint64)
        step = np.uint64(1) << (np.uint64(self.bits) * (self.head - np.minimum(size, self.head)).astype(np.uint64))
        low[open_] = np.searchsorted(self.keys, key)
        high[open_] = np.searchsorted(self.keys, key + step)
        for depth in range(self.head, int(size.max())):
            open_ = open_[(high[open_] > low[open_])]
            more = open_[length[open_] > depth]
            if not len(more):
                break
            low[more], high[more] = self.narrow(low[more], high[more], depth, words[start[more] + depth])
        return low, np.maximum(low, high)

    def longest(self, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The most words of words[start : end] that any suffix begins with, and the range of those that do."""
        length, low, high = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), np.full(len(start), len(self), np.int64)
        open_ = np.arange(len(start))
        depth = 0
        while len(open_):
            open_ = open_[start[open_] + depth < end[open_]]
            a, b = self.narrow(low[open_], high[open_], depth, words[np.minimum(start[open_] + depth, len(words) - 1)])
            on = (a < b) & (words[np.minimum(start[open_] + depth, len(words) - 1)] > 0)
            open_ = open_[on]
            low[open_], high[open_] = a[on], b[on]
            depth += 1
            length[open_] = depth
        return length, low, high
