"""Piece lattices of many words at once, as arrays: which pieces match at which places."""

from __future__ import annotations

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = -1


class Table:
    """Whole numbers from 0 to whole numbers from 0, for arrays of keys: open addressing, at most half full."""

    def __init__(self, keys=(), values=(), most: int = 0):
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int32)
        self.bits = max(4, int(4 * max(most, len(keys), 1) - 1).bit_length())
        self.keys, self.values, self.n = np.full(1 << self.bits, _EMPTY, np.int64), np.full(1 << self.bits, _EMPTY, np.int32), 0
        self.add(keys, values)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * _FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that the table does not have."""
        self.n += len(keys)
        if 2 * self.n > len(self.keys):
            raise OverflowError("the table is full")
        at = self._slots(keys)
        while len(keys):
            free = self.keys[at] == _EMPTY
            self.keys[at[free]] = keys[free]
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], (at[~won] + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        at = self._slots(keys)
        found, out = self.keys[at], self.values[at]
        rest = np.flatnonzero((found != keys) & (found != _EMPTY))
        while len(rest):
            at[rest] = (at[rest] + 1) & (len(self.keys) - 1)
            found, out[rest] = self.keys[at[rest]], self.values[at[rest]]
            rest = rest[(found != keys[rest]) & (found != _EMPTY)]
        return out


class Trie:
    """All matches of a set of strings in many words."""

    def __init__(self, entries: list[tuple[str, int]]):
        steps: dict[int, int] = {}
        values, deepest = {}, 0
        for text, value in entries:
            node = 0
            for c in text:
                node = steps.setdefault(node << 21 | ord(c), len(steps) + 1)
            values[node] = value
            deepest = max(deepest, len(text))
        self.steps, self.deepest = Table(list(steps), list(steps.values())), deepest
        self.values = np.full(len(steps) + 1, -1, np.int32)
        self.values[list(values)] = list(values.values())
        self.first = np.full(1 << 21, -1, np.int32)
        for key, node in steps.items():
            if key < 1 << 21:
                self.first[key] = node

    def matches(self, words: list[str]):
        """(lengths, bounds, places, ends, values): matches in groups of one offset and one length, shorter offsets first.

        Group k is places[bounds[k]:bounds[k + 1]], in which no two have one
        end. Places count the characters of all words, one more for each word.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        at = np.arange(len(codes))
        offset = at - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = lengths[word] - offset
        node, found = self.first[codes], []
        for d in range(1, self.deepest + 1):
            alive = node >= 0
            at, node = at[alive], node[alive]
            value = self.values[node]
            hit = value >= 0
            found.append((at[hit], np.full(np.count_nonzero(hit), d), value[hit]))
            more = left[at] > d
            at, node = at[more], node[more]
            if not len(at):
                break
            node = self.steps.get(node.astype(np.int64) << 21 | codes[at + d])
        at, d, value = (np.concatenate(x) for x in zip(*found))
        group = offset[at] * (self.deepest + 1) + d
        order = np.argsort(group.astype(np.uint16) if len(group) and group.max() < 1 << 16 else group, kind="stable")
        group = group[order]
        bounds = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)] if len(group) else np.zeros(1, np.int64)
        places = (at + word[at])[order]
        return lengths, bounds, places, places + d[order], value[order]
