"""Byte-level BPE encoding and decoding with numpy matrices.

A text is split into pieces by the tokenizer's pattern.  A piece that is a
token is one id; the other distinct pieces of a batch go, by length bucket,
into padded matrices of ids, one piece a row.  In each round every row merges
its leftmost pair of minimum rank: the ranks of neighbours come from a hash
table over pairs, only the two pairs beside a merge are looked up anew, and the
merged column is closed up, so the matrix gets narrower by one each round.
Rows without a mergeable pair leave.  Pieces over ``LONG_PIECE`` bytes (one a
row would need as many rounds as bytes) merge by the same rule on a heap.

The rank file's path is a parameter.  The driver reads it, and the tables
reach the workers as one broadcast, bounded by ``MAX_VOCABULARY`` tokens.

Defined cases: a null text is encoded as empty; an empty text has no ids;
null ids decode to nothing.  Texts are cut at piece boundaries into segments
before they are split, so a very long text needs little memory at once.
"""

from __future__ import annotations

import base64
import heapq
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

MAX_VOCABULARY = 1_000_000
LONG_PIECE = 2048  # bytes
CELLS = 1 << 20  # of one matrix
SEGMENT = 1 << 18  # characters split at once
GROUP_CHARS = 1 << 20  # characters whose distinct pieces are merged together
CACHED_PIECES = 100_000
NONE = np.int64(1) << 62  # rank of a pair that does not merge


class PairTable:
    """Open-addressing hash table from (left id, right id) to the merged id."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int64)
        todo, slot = np.arange(len(pairs)), self._slot(pairs)
        while len(todo):
            free = self.keys[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]], self.values[slot[put]] = pairs[todo[put]], merged[todo[put]]
            rest = np.ones(len(todo), dtype=bool)
            rest[put] = False
            todo, slot = todo[rest], slot[rest] + 1 & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair; NONE where there is none or a side is padding (negative)."""
        out = np.full(left.shape, NONE, dtype=np.int64)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[todo].astype(np.int64) << 32) | right[todo]
        slot = self._slot(keys)
        while len(todo):
            there = self.keys[slot]
            hit = there == keys
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            todo, keys, slot = todo[on], keys[on], slot[on] + 1 & (1 << self.bits) - 1
        return out


class Vocabulary:
    """Ranks of byte strings, and what encoding and decoding derive from them."""

    def __init__(self, lines: list[bytes]):
        self.token_of = [b""] * (1 + max((int(x.split()[1]) for x in lines), default=-1))
        self.rank_of: dict[bytes, int] = {}
        for line in lines:
            token, rank = line.split()
            self.rank_of[base64.b64decode(token)] = int(rank)
        for token, rank in self.rank_of.items():
            self.token_of[rank] = token
        self.token_bytes = np.frombuffer(b"".join(self.token_of), dtype=np.uint8)
        self.token_size = np.array([len(t) for t in self.token_of], dtype=np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        rank_of = self.rank_of
        pairs, merged = [], []
        for token, rank in rank_of.items():
            for cut in range(1, len(token)):
                a, b = rank_of.get(token[:cut]), rank_of.get(token[cut:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    merged.append(rank)
        self.pairs = PairTable(np.array(pairs, dtype=np.int64), np.array(merged, dtype=np.int64))
        self.of_byte = np.array([rank_of.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        if (self.of_byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size): the ids of piece i (bytes, not empty) are ``ids[start[i] : start[i] + size[i]]``."""
        whole = [self.rank_of.get(p, -1) for p in pieces]
        flat = [np.array(whole, dtype=np.int32)]
        start, size, at = np.arange(len(pieces)), np.ones(len(pieces), dtype=np.int64), len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, (p, rank) in enumerate(zip(pieces, whole)):
            if rank >= 0:
                continue
            if len(p) > LONG_PIECE:
                flat.append(self._merge_long(p))
                start[i], size[i] = at, len(flat[-1])
                at += len(flat[-1])
            else:
                buckets.setdefault(_bucket(len(p)), []).append(i)
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for first in range(0, len(members), step):
                rows = members[first : first + step]
                ids, begin, n = self._merge_rows([pieces[r] for r in rows], width)
                flat.append(ids)
                start[rows], size[rows] = at + begin, n
                at += len(ids)
        return np.concatenate(flat), start, size

    def _merge_rows(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode_pieces``, for pieces of at most ``width`` bytes in one matrix."""
        lengths = np.array([len(p) for p in pieces])
        padded = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), dtype=np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < lengths[:, None], self.of_byte[padded], -1)
        ranks = self.pairs.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        flat, start, size, done = [], np.zeros(len(pieces), dtype=np.int64), np.zeros(len(pieces), dtype=np.int64), 0
        rows = np.arange(len(pieces))
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NONE)
            on = best < NONE
            there = ids[~on] >= 0
            flat.append(ids[~on][there].astype(np.int32))
            n = there.sum(axis=1)
            start[rows[~on]], size[rows[~on]] = done + np.cumsum(n) - n, n
            done += len(flat[-1])
            rows, ids, ranks, at, best = rows[on], ids[on], ranks[on], at[on], best[on]
            if not len(rows):
                break
            each = np.arange(len(rows))
            ids[each, at] = best
            keep = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, keep + (keep > at[:, None]), axis=1)
            keep = keep[:-1]
            ranks = np.take_along_axis(ranks, keep + (keep >= at[:, None]), axis=1)
            for shift in (-1, 0):  # the pairs that end or begin with the merged id
                p = at + shift
                ok = (p >= 0) & (p < ranks.shape[1])
                ranks[each[ok], p[ok]] = self.pairs.ranks(ids[each[ok], p[ok]], ids[each[ok], p[ok] + 1])
        return np.concatenate(flat), start, size

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.of_byte[np.frombuffer(piece, dtype=np.uint8)]
        n = len(ids)
        first = self.pairs.ranks(ids[:-1], ids[1:])
        left, right = np.arange(-1, n - 1).tolist(), np.arange(1, n + 1).tolist()
        values, alive = ids.tolist(), [True] * n
        heap = [(int(r), i, values[i], values[i + 1]) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or values[i] != a or values[j] != b:
                continue  # one of the two has merged since
            values[i], alive[j], right[i] = rank, False, right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n:
                    r = int(self.pairs.ranks(np.array([values[x]]), np.array([values[y]]))[0])
                    if r < NONE:
                        heapq.heappush(heap, (r, x, values[x], values[y]))
        return np.array([v for v, on in zip(values, alive) if on], dtype=np.int32)

    def decode(self, ids) -> bytes:
        return b"".join([self.token_of[i] for i in ids])

    def decode_all(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, ends): the bytes of all ids, and where those of each id end."""
        size = self.token_size[ids]
        ends = np.cumsum(size)
        return self.token_bytes[_spans(self.token_start[ids], size, ends)], ends


def _spans(start: np.ndarray, size: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places start[0], start[0] + 1, ... of all spans one after the other; ``ends``: the sums of the sizes."""
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _bucket(length: int) -> int:
    """Widths 2, 3, 4, 6, 8, 12, 16, ...: at most half of a row is padding."""
    top = 1 << (length - 1).bit_length()
    return top * 3 // 4 if top >= 4 and length <= top * 3 // 4 else top


#: A non-space before a space ends a piece of every such pattern.
_CUT = re.compile(r"(?<=\S)(?=\s)")


def segments(text: str, cut_at: re.Pattern = _CUT) -> Iterator[str]:
    """The text in parts of SEGMENT characters or little more, cut where pieces end."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = cut_at.search(text, at + SEGMENT)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:]


class Encoder:
    """Splits and encodes texts; remembers the ids of pieces."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.split = regex.compile(pattern)
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.start, self.size = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def encode(self, text: str | None) -> np.ndarray:
        parts = [self._ids(self.split.findall(s))[0] for s in segments(text or "")]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)

    def _learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.index]
        if len(self.index) + len(new) > CACHED_PIECES:
            self._forget()
            new = list(pieces)
        if new:
            self.index.update(zip(new, range(len(self.start), len(self.start) + len(new))))
            ids, start, size = self.vocabulary.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new])
            start = start + len(self.ids)
            self.ids, self.start, self.size = (np.concatenate(x) for x in ((self.ids, ids), (self.start, start), (self.size, size)))

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all pieces, and where those of each piece end."""
        self._learn(set(pieces))
        index = np.fromiter(map(self.index.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        size = self.size[index]
        ends = np.cumsum(size)
        return self.ids[_spans(self.start[index], size, ends)], ends

    def encode_flat(self, texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, bounds) of one group of texts after another; the distinct pieces of a group are merged together.

        The ids of the group's text i are ``ids[bounds[i] : bounds[i + 1]]``.
        """
        group: list[str] = []
        size = 0
        for t in texts:
            t = t or ""
            if group and size + len(t) > GROUP_CHARS:
                yield self._group(group)
                group, size = [], 0
            if len(t) > GROUP_CHARS:
                ids = self.encode(t)
                yield ids, np.array([0, len(ids)])
                continue
            group.append(t)
            size += len(t)
        if group:
            yield self._group(group)

    def encode_many(self, texts) -> list[np.ndarray]:
        return [ids[a:b] for ids, bounds in self.encode_flat(texts) for a, b in zip(bounds[:-1], bounds[1:])]

    def _group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self.split.findall(t) for t in texts]
        ids, ends = self._ids([p for pieces in split for p in pieces])
        last = np.cumsum([0, *map(len, split)])
        return ids, np.concatenate([[0], ends])[last]


def _lists(ids: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))


_encoders: dict[str, Encoder] = {}


class ByteBPE:
    """Columns that encode texts and decode ids by one rank file."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            lines = [x for x in f.read().splitlines() if x.strip()]
        if len(lines) > MAX_VOCABULARY:
            raise ValueError(f"over {MAX_VOCABULARY} tokens")
        Vocabulary(lines)  # a bad file fails here
        self.lines, self.pattern, self.key = spark.sparkContext.broadcast(lines), pattern, uuid.uuid4().hex

    def _of_worker(self):
        lines, pattern, key = self.lines, self.pattern, self.key

        def get() -> Encoder:
            from pulse.llm.byte_bpe import _encoders as made

            if key not in made:  # one encoder a worker, with what it has learnt
                made.clear()
                made[key] = Encoder(Vocabulary(lines.value), pattern)
            return made[key]

        return get

    def encode(self, text: Column) -> Column:
        """array<int>: the ids of each text."""
        get = self._of_worker()

        @F.arrow_udf("array<int>")
        def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = get()
            for s in texts:
                for ids, bounds in encoder.encode_flat(s.to_pylist()):  # small output batches: little memory
                    yield _lists(ids, bounds)

        return of(text)

    def decode(self, ids: Column) -> Column:
        """binary: the bytes that the ids stand for."""
        get = self._of_worker()

        @F.pandas_udf("binary")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            vocabulary = get().vocabulary
            for s in batches:
                yield pd.Series([vocabulary.decode(() if x is None else x.tolist()) for x in s], dtype=object)

        return of(ids)

    def round_trip(self, text: Column) -> Column:
        """struct<ids: array<int>, decoded: binary>: both of the above in one pass through the workers."""
        get = self._of_worker()

        @F.arrow_udf("ids array<int>, decoded binary")
        def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = get()
            for s in texts:
                for ids, bounds in encoder.encode_flat(s.to_pylist()):
                    decoded, ends = encoder.vocabulary.decode_all(ids)
                    at = np.concatenate([[0], ends])[bounds].astype(np.int32)
                    decoded = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(at), pa.py_buffer(decoded)])
                    yield pa.StructArray.from_arrays([_lists(ids, bounds), decoded], ["ids", "decoded"])

        return of(text)
