"""Periodic runs of words, found by the branching-tandem test on an enhanced suffix array.

A run is a longest stretch of words with a smallest period: "ha ha ha ha", a
line pasted again and again, a looping generator.  Texts of a batch share one
suffix array whose keys begin with the text, so no match crosses texts:

1. Prefix doubling ranks every suffix; suffixes that are alone in their rank
   drop out of the later rounds, and the ranks of each round are kept.
2. The common prefixes of neighbours follow from the kept ranks, and the extent
   of each (an LCP interval and its split into children) from a stack of
   boundaries; no tree nodes are made.
3. Branching tandem test: a square of root length d whose next word breaks the
   period is a pair of suffixes i and i + d with common prefix d, which meet in
   an LCP interval of depth d, in different children.  For each split the
   suffixes of the smaller side look up whether i + d or i - d is ranked in the
   other side: n log n look-ups at most, however periodic the text.
4. Such a square is the last of its run.  It is rotated to the left as far as
   the period holds, by the kept ranks in halving steps.  Squares of a multiple
   of the period give the same stretch, of which the smallest period stays.

The work is a column function: one scan, nothing is shuffled, and a lost task
is run again on its own.

Defined cases: a null text has no words (n_words 0, no runs, an empty collapsed
text), and so have empty texts and texts of separators alone.  Repeated rows and
equal texts are each worked on by themselves, so ties cannot occur; runs come
by start, then period.  An empty table gives no rows.  The function sees the
text column alone, so other columns may have any name.  A very long text is a
batch of its own: some 4 bytes a word for each doubling round, of which there
are as many as the logarithm of its longest repeat.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

MIN_LENGTH = 6  # words of a run
MIN_EXPONENT = 4  # periods of a run
BATCH_WORDS = 1 << 18  # words of one suffix array, unless a single text has more
PAIRS = 1 << 21  # look-ups at once

RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class SuffixArray:
    """Suffixes of several texts in order, with the ranks of each doubling round.

    ``keys`` has a number a word, equal for equal words of the same text and
    never for words of two texts; texts follow one another, ``starts`` has
    where.  ``levels[k][i]`` is the rank of the 2**k words from i (fewer at the
    end of a text), ``order`` the suffixes in order, ``rank`` its inverse.
    """

    def __init__(self, keys: np.ndarray, starts: np.ndarray):
        n = len(keys)
        sizes = np.diff(np.append(starts, n))
        self.starts, self.text = starts, np.repeat(np.arange(len(starts)), sizes)
        ends = starts + sizes
        order = np.argsort(keys, kind="stable")
        fresh = np.append(True, keys[order][1:] != keys[order][:-1])
        slots = np.arange(n)
        heads = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank = np.empty(n, dtype=np.int32)
        rank[order] = heads
        self.levels, split_at = [rank], np.full(n, -1, dtype=np.int8)  # level at which a boundary parts
        tied, step = slots[_shared(heads)], 1
        while len(tied):
            at = order[tied]
            after = at + step
            inside = after < ends[self.text[at]]
            second = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
            key = rank[at].astype(np.int64) << 32 | second
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            order[tied] = at
            fresh = np.append(True, key[1:] != key[:-1])
            parts = fresh.copy()
            parts[1:] &= key[1:] >> 32 == key[:-1] >> 32  # inside a former rank
            parts[0] = False
            split_at[tied[parts]] = len(self.levels) - 1
            heads = np.maximum.accumulate(np.where(fresh, tied, 0))
            rank = rank.copy()
            rank[at] = heads
            self.levels.append(rank)
            tied, step = tied[_shared(heads)], step * 2
        self.order, self.rank = order, rank
        self._measure(split_at)

    def _measure(self, split_at: np.ndarray) -> None:
        """``lcp[b]``: common prefix of the suffixes at slots b - 1 and b."""
        self.lcp = np.zeros(len(split_at), dtype=np.int32)
        slots = np.flatnonzero(split_at >= 0)
        level, i, j = split_at[slots], self.order[slots - 1], self.order[slots]
        shared = 1 << level.astype(np.int64)
        for k in range(int(level.max(initial=0)) - 1, -1, -1):
            at = np.flatnonzero(level > k)
            a, b = i[at] + shared[at], j[at] + shared[at]
            within = (a < len(self.rank)) & (b < len(self.rank))
            ranks = self.levels[k]
            same = ranks[np.where(within, a, 0)] == ranks[np.where(within, b, 0)]
            shared[at] += np.where(within & same, 1 << k, 0)
        self.lcp[slots] = shared

    def splits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(left, b, right) of each boundary b of positive depth: slots [left, b) and [b, right) share that depth."""
        bs = np.flatnonzero(self.lcp)
        depth = self.lcp[bs].tolist()
        left, right, stack = [0] * len(bs), [0] * len(bs), []
        before = -1
        for x, (b, d) in enumerate(zip(bs.tolist(), depth)):
            if b != before + 1:  # a boundary of depth 0 lies between
                for y in stack:
                    right[y] = before + 1
                stack = []
                floor = b - 1
            while stack and depth[stack[-1]] >= d:
                right[stack.pop()] = b
            left[x] = int(bs[stack[-1]]) if stack else floor
            stack.append(x)
            before = b
        for y in stack:
            right[y] = before + 1
        return np.array(left, dtype=np.int64), bs, np.array(right, dtype=np.int64)

    def branching_squares(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(i, d): squares of root length d from i whose next word breaks the period, each once."""
        left, b, right = self.splits()
        small_left = b - left <= right - b
        size = np.where(small_left, b - left, right - b)
        from_, lo, hi = np.where(small_left, left, b), np.where(small_left, b, left), np.where(small_left, right, b)
        depth = self.lcp[b].astype(np.int64)
        blocks = np.searchsorted(np.cumsum(size), np.arange(PAIRS, int(size.sum()) + PAIRS, PAIRS), side="right")
        at = 0
        for end in blocks.tolist():
            end = min(max(end, at + 1), len(b))
            if at >= len(b):
                break
            n = size[at:end]
            node = np.repeat(np.arange(at, end), n)
            i = self.order[from_[node] + np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n)]
            for j, start in ((i + depth[node], i), (i - depth[node], i - depth[node])):
                within = (j >= 0) & (j < len(self.rank))
                slot = self.rank[np.where(within, j, 0)]
                found = within & (slot >= lo[node]) & (slot < hi[node])
                yield start[found], depth[node[found]]
            at = end

    def rotated(self, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """How many words to the left of i the period d of the square at i holds."""
        first, back = self.starts[self.text[i]], np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 2, -1, -1):
            p = i - back - (1 << k)
            within = p >= first
            p = np.where(within, p, 0)
            ranks = self.levels[k]
            back += np.where(within & (ranks[p] == ranks[p + np.where(within, d, 0)]), 1 << k, 0)
        return back


def _shared(heads: np.ndarray) -> np.ndarray:
    """True for the members of ranks with several members; ``heads`` has each one's first slot, ascending."""
    same = heads[1:] == heads[:-1]
    out = np.zeros(len(heads), dtype=bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def find_runs(keys: np.ndarray, starts: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Rows (text, start, length, period) by text, start and period; ``starts``: where the (non-empty) texts begin."""
    if not len(keys):
        return np.zeros((0, 4), dtype=np.int64)
    array, found = SuffixArray(keys, starts), []
    for i, d in array.branching_squares():
        back = array.rotated(i, d)
        length = back + 2 * d
        keep = (length >= min_length) & (length >= min_exponent * d)
        found.append(np.stack([i - back, length, d])[:, keep])
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), dtype=np.int64)
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.ones(len(by), dtype=bool)  # of equal stretches the smallest period
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    text = array.text[start]
    rows = np.stack([text, start - starts[text], length, period], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _words(text: str | None) -> list[bytes]:
    """Splitting bytes parts at ASCII white space alone, which is [\\x20\\x09-\\x0D]."""
    return text.encode().split() if text else []


def _collapse(words: list[bytes], runs: np.ndarray) -> str:
    """The words without those that a run repeats: its first period stays."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 1] + runs[:, 3], 1)
    np.add.at(edge, runs[:, 1] + runs[:, 2], -1)
    keep = np.cumsum(edge[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()]).decode()


def _batch(texts: Sequence[list[bytes]], min_length: int, min_exponent: int) -> pd.DataFrame:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    filled = np.flatnonzero(sizes)
    number = defaultdict(count().__next__)
    ids = np.fromiter((number[w] for i in filled.tolist() for w in texts[i]), dtype=np.int64, count=int(sizes.sum()))
    keys = np.repeat(np.arange(len(filled)), sizes[filled]) * max(len(number), 1) + ids
    rows = find_runs(keys, np.cumsum(sizes[filled]) - sizes[filled], min_length, min_exponent)
    bounds = np.searchsorted(rows[:, 0], np.arange(len(filled) + 1))
    runs, collapsed = [[] for _ in texts], [""] * len(texts)
    for x, i in enumerate(filled.tolist()):
        own = rows[bounds[x] : bounds[x + 1]]
        runs[i] = [dict(zip(("start", "length", "period"), r)) for r in own[:, 1:].tolist()]
        collapsed[i] = _collapse(texts[i], own) if len(own) else b" ".join(texts[i]).decode()
    return pd.DataFrame({"n_words": sizes, "runs": pd.Series(runs, dtype=object), "collapsed": pd.Series(collapsed, dtype=object)})


def periodic_runs(text: Column, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> Column:
    """struct<n_words, runs, collapsed> of each text (see RESULT).

    A run has at least ``min_length`` words and ``min_exponent`` (2 or more)
    times its period; start counts words from 0.  ``collapsed`` is the text's
    words joined by a space, without those that a run has after its first period.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats: min_exponent is 2 at least")

    @F.pandas_udf(RESULT)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            held, size = [], 0
            for t in s:
                words = _words(t)
                if held and size + len(words) > BATCH_WORDS:
                    yield _batch(held, min_length, min_exponent)
                    held, size = [], 0
                held.append(words)
                size += len(words)
            yield _batch(held, min_length, min_exponent)

    return of(text)
