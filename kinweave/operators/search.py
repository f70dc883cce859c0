"""Exact cosine top-k search in the memory of a task: one shard of the targets' vectors against many queries.

Weights are whole numbers, so every sum below 2^53 is exact in a double. Lists are
read from each query's rarest term on, only as far as a target that has none of the
terms read could still reach the k best found (MaxScore); the rest of a target's
score comes from its own vector.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Postings read to find a first k-th score, and entries of vectors rescored at once.
FIRST, ENTRIES = 256, 1_000_000


def ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers begin .. begin + size - 1 of each pair, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


class Shard:
    """Distinct vectors of one source (table: terms, w, nums, ids), each with its members, smallest number first."""

    def __init__(self, source: int, table: pa.Table):
        self.source = source
        column = lambda name: table[name].combine_chunks()
        lists = lambda name: (np.diff(column(name).offsets.to_numpy()), column(name).flatten())
        self.sizes, terms = lists("terms")
        coded = terms.dictionary_encode()
        self.names, self.terms = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        self.weights = lists("w")[1].to_numpy().astype(np.int32)
        self.members, nums = lists("nums")
        self.nums, self.ids = nums.to_numpy(), lists("ids")[1]

    @cached_property
    def begins(self):
        return np.cumsum(self.sizes) - self.sizes

    @cached_property
    def lists(self):
        """Of each term: begin and length of its list, and the largest weight in it; then the vectors and weights of all lists."""
        order = np.argsort(self.terms, kind="stable")
        df = np.bincount(self.terms, minlength=len(self.names))
        begins = np.cumsum(df) - df
        vectors = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)[order]
        weights = self.weights[order].astype(np.float64)
        most = np.maximum.reduceat(weights, begins) if len(begins) else np.empty(0)
        return begins, df, most, vectors, weights

    @cached_property
    def norm(self):
        """The largest length of a vector: about SCALE, as weights are rounded."""
        w = self.weights.astype(np.float64)
        return float(np.sqrt(np.add.reduceat(w * w, self.begins).max())) if len(w) else 0.0

    @cached_property
    def _query(self):
        return np.zeros(len(self.names))

    def number(self, terms: pa.Array) -> np.ndarray:
        """Numbers of terms, -1 for those that no vector here has."""
        return pc.fill_null(pc.index_in(terms, value_set=self.names), -1).to_numpy(zero_copy_only=False)

    def _read(self, t, w):
        """Vectors in the lists of the terms, and their sums."""
        begins, df, _, vectors, weights = self.lists
        n = df[t]
        at = ranges(begins[t], n)
        found, x = vectors[at], weights[at] * np.repeat(w, n)
        if 8 * len(at) > len(self.sizes):
            sums = np.bincount(found, x, len(self.sizes))
            found = np.flatnonzero(sums)
            return found, sums[found]
        found, place = np.unique(found, return_inverse=True)
        return found, np.bincount(place, x, len(found))

    def scores(self, found: np.ndarray, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The whole score of each of these vectors."""
        self._query[t] = w
        out, n = np.zeros(len(found)), self.sizes[found]
        ends = np.cumsum(n)
        at = 0
        while at < len(found):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ENTRIES, "right")))
            entry = ranges(self.begins[found[at:to]], n[at:to])
            x = self._query[self.terms[entry]] * self.weights[entry]
            out[at:to] = np.add.reduceat(x, np.cumsum(n[at:to]) - n[at:to])
            at = to
        self._query[t] = 0
        return out

    def search(self, t: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """All vectors that may be among the k best (ties with the k-th included), with their scores. t: numbers of distinct terms."""
        _, df, most, _, _ = self.lists
        order = np.argsort(df[t], kind="stable")
        t, w = t[order], w[order].astype(np.float64)
        read = np.cumsum(df[t])
        # what the terms from each on can add at most; doubles round, so a little more
        left = np.minimum(np.cumsum((w * most[t])[::-1])[::-1], np.sqrt(np.cumsum((w * w)[::-1])[::-1]) * self.norm * (1 + 1e-9) + 1)
        to = min(len(t), int(np.searchsorted(read, FIRST)) + 1)
        found, sums = self._read(t[:to], w[:to])
        if to < len(t):
            least = 0.0
            if len(found) >= k:
                best = np.argpartition(-sums, k - 1)[: 4 * k]
                least = np.partition(self.scores(found[best], t, w), len(best) - k)[len(best) - k]
            enough = np.flatnonzero(left < least)
            end = int(enough[0]) if len(enough) else len(t)
            if 2 * read[end - 1] > read[-1]:  # the rest costs less than to look at what was found
                end = len(t)
            if end > to:
                found, sums = self._read(t[:end], w[:end])
            end = max(to, end)
            if end < len(t):
                found = found[sums + left[end] >= least]
                # an entry of a vector costs more than one of a list, as it is read out of order
                if 4 * self.sizes[found].sum() < read[-1]:
                    sums = self.scores(found, t, w)
                else:
                    found, sums = self._read(t, w)
        good = sums > 0
        if good.sum() > k:
            good &= sums >= np.partition(sums[good], good.sum() - k)[good.sum() - k]
        return found[good], sums[good]

    def top(self, found: np.ndarray, sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best members of these vectors, ties to the smaller number: their places in nums and ids, and in found."""
        n = self.members[found]
        place, vector = ranges((np.cumsum(self.members) - self.members)[found] if len(found) else found, n), np.repeat(np.arange(len(found)), n)
        order = np.lexsort((self.nums[place], -sums[vector]))[:k]
        return place[order], vector[order]
