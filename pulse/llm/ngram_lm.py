"""Bigram language model in Elias-Fano levels, built and queried by distributed tasks.

Tokens are words (A-Z lower-cased, split at ASCII white space) and one end
token a text.  The model is an n-gram trie of two levels in shared files:

* *Level 1*, the vocabulary: sorted 64-bit word hashes and the running sums of
  their exact counts, both Elias-Fano coded.  A word's number is its position;
  its count is the difference of neighbouring sums.
* *Level 2*, the successors: for each context (a word's number, or that of the
  text's begin) a monotone pointer to its range of successors.  Inside a range
  a successor is coded relative to its context (context's place in the block
  times the vocabulary, plus its number), which makes the whole block one
  monotone Elias-Fano sequence; a query is a successor search in it.  Each
  entry holds its discounted probability, quantised to 16 bits of log10.

p(w | v) = max(c(vw) - D, 0) / c(v) + D T(v) / c(v) * p1(w), with T(v) distinct
successors of v (from the pointers) and p1(w) = (c(w) + 1/2) / (N + (V + 1) / 2).
An unknown context leaves p1.

Levels are cut into shards of bounded size: level 1 by hash ranges, level 2 by
ranges of the keys at which equal numbers of bigrams are expected (a context's
place follows from the running sums of level 1), so that a word as frequent as
a third of all tokens is spread over many shards.  Tasks count in memory and
ship sorted, Elias-Fano coded blocks, not rows; a shard's task merges its
blocks.  Scoring tasks sort the distinct bigrams of many texts, map the shards
they need from the shared folder, and decode only the blocks touched.  The
driver sees one line a shard.

Defined cases: null texts are empty (one end token); rows that repeat a text
are counted each time when learning; without training texts every token has
probability 1 by the base formula (N = V = 0) and the model; null ids are never
held out; a vocabulary of more than 3 billion words is refused (its pairs would not fit 63 bits).
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pulse.llm import elias_fano
from pulse.llm.byte_bpe import segments
from pulse.llm.common import file_system, write_out
from pulse.session import fresh_path

BEGIN, END = b" ", b""  # never words: a word is neither empty nor blank
WORD_END = re.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # words end at ASCII white space alone
DISCOUNT = 0.75
BLOCK = 1 << 16  # entries coded together
GROUP_TOKENS = 4_000_000  # tokens that a task looks up at once: fewer groups decode the model less often
HELD_WORDS = 400_000  # distinct words that a counting task holds before it ships them
SHARD_CHARS = 48 << 20  # characters of training text a level 1 shard
SHARD_BIGRAMS = 2_000_000  # bigram tokens expected a level 2 shard
CODES_PER_UNIT = 4096  # quantisation steps per unit of log10


def word_hash(word: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word)


def hashes(words) -> np.ndarray:
    return np.fromiter(map(word_hash, words), dtype=np.uint64, count=len(words))


# --- counted blocks on their way to a shard --------------------------------------
def pack_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    k = elias_fano.encode(keys)
    return struct.pack("<Q", len(k)) + k + zlib.compress(counts.astype("<u4").tobytes(), 1)


def merge_counts(blobs) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of all blobs and the sums of their counts."""
    keys, counts = [], []
    for b in blobs:
        (n,) = struct.unpack("<Q", b[:8])
        keys.append(elias_fano.decode(b[8 : 8 + n]))
        counts.append(np.frombuffer(zlib.decompress(b[8 + n :]), dtype="<u4").astype(np.int64))
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(c, first)


# --- files ----------------------------------------------------------------------
class Shard:
    """A file of blocks.  Each block is a list of byte strings; a directory of first keys ends the file."""

    def __init__(self, path: str):
        fs, place = file_system(path)
        if fs.type_name == "local":
            self.data = np.memmap(place, dtype=np.uint8, mode="r")
            self.read = lambda a, b: self.data[a:b]
            size = len(self.data)
        else:  # ranges are read where a file can't be mapped
            f = fs.open_input_file(place)
            self.read = lambda a, b: np.frombuffer(f.read_at(b - a, a), dtype=np.uint8)
            size = f.size()
        (n,) = struct.unpack("<Q", self.read(size - 8, size).tobytes())
        table = self.read(size - 8 - 24 * n, size - 8).tobytes()
        #: Of each block: its first key, its place in the file, and the entries (level 1: and counts) before it.
        self.first, self.place, self.before = np.frombuffer(table, dtype="<u8").reshape(3, n)

    def block(self, i: int) -> list[np.ndarray]:
        at = int(self.place[i])
        n, *sizes = struct.unpack("<5I", self.read(at, at + 20).tobytes())
        out, at = [], at + 20
        for s in sizes[:n]:
            out.append(self.read(at, at + s))
            at += s
        return out

    @staticmethod
    def write(path: str, blocks: list[tuple[int, int, list[bytes]]]) -> None:
        fs, place = file_system(path)
        fs.create_dir(place.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(place) as f:
            places, at = [], 0
            for _, _, parts in blocks:
                places.append(at)
                sizes = [len(p) for p in parts] + [0] * (4 - len(parts))
                at += f.write(struct.pack("<5I", len(parts), *sizes) + b"".join(parts))
            table = np.array([[b[0] for b in blocks], places, [b[1] for b in blocks]], dtype="<u8")
            f.write(table.tobytes() + struct.pack("<Q", len(blocks)))


class Vocabulary:
    """Level 1.  shards: (shard, path, n words, n tokens) in order of the hashes."""

    def __init__(self, shards: list[tuple], bits: int):
        self.bits, self.shards, self.open = bits, shards, {}
        self.words = np.concatenate([[0], np.cumsum([s[2] for s in shards], dtype=np.int64)])
        self.tokens = np.concatenate([[0], np.cumsum([s[3] for s in shards], dtype=np.int64)])
        self.at = {s[0]: i for i, s in enumerate(shards)}
        self.V, self.N = int(self.words[-1]), int(self.tokens[-1])

    def _shard(self, i: int) -> Shard:
        if i not in self.open:
            self.open[i] = Shard(self.shards[i][1])
        return self.open[i]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number or -1, tokens before it, count) of sorted distinct hashes."""
        number, sums, count = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        of = (keys >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), dtype=np.int64)
        names, starts = np.unique(of, return_index=True)
        for name, a, b in zip(names.tolist(), starts, [*starts[1:], len(keys)]):
            i = self.at.get(name)
            if i is None:
                continue
            shard = self._shard(i)
            block = np.searchsorted(shard.first, keys[a:b], side="right") - 1
            for j in np.unique(block[block >= 0]).tolist():
                part = a + np.flatnonzero(block == j)
                words, total = map(elias_fano.decode, shard.block(j))
                at = np.searchsorted(words, keys[part])
                at[at == len(words)] = 0
                hit = words[at] == keys[part]
                at, part = at[hit], part[hit]
                total = total.astype(np.int64)
                number[part] = self.words[i] + j * BLOCK + at
                sums[part] = self.tokens[i] + total[at]
                count[part] = total[at + 1] - total[at]
        return number, sums, count

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """Exact counts of sorted word numbers."""
        out = np.zeros(len(numbers), dtype=np.int64)
        of = np.searchsorted(self.words, numbers, side="right") - 1
        block = (numbers - self.words[of]) // BLOCK
        place = of * (1 << 32) + block
        names, starts = np.unique(place, return_index=True)
        for name, a, b in zip(names.tolist(), starts, [*starts[1:], len(numbers)]):
            i, j = name >> 32, name & (1 << 32) - 1
            total = elias_fano.decode(self._shard(i).block(j)[1]).astype(np.int64)
            at = numbers[a:b] - self.words[i] - j * BLOCK
            out[a:b] = total[at + 1] - total[at]
        return out


def write_vocabulary(path: str, keys: np.ndarray, counts: np.ndarray) -> None:
    total = np.concatenate([[0], np.cumsum(counts)])
    blocks = []
    for a in range(0, len(keys), BLOCK):
        b = min(a + BLOCK, len(keys))
        blocks.append((int(keys[a]), a, [elias_fano.encode(keys[a:b]), elias_fano.encode(total[a : b + 1])]))
    Shard.write(path, blocks)


def write_successors(path: str, keys: np.ndarray, counts: np.ndarray, base: int, context_counts) -> None:
    """keys: context * base + word, sorted; context_counts: sorted contexts -> their counts."""
    context = (keys // np.uint64(base)).astype(np.int64)
    word = (keys % np.uint64(base)).astype(np.int64)
    blocks = []
    for a in range(0, len(keys), BLOCK):
        b = min(a + BLOCK, len(keys))
        own, pointer, place = np.unique(context[a:b], return_index=True, return_inverse=True)
        log = np.log10((counts[a:b] - DISCOUNT) / context_counts(own)[place])
        codes = np.clip(np.rint(-log * CODES_PER_UNIT), 0, 0xFFFF).astype("<u2")
        blocks.append(
            (
                int(keys[a]),
                a,
                [
                    elias_fano.encode(own),
                    elias_fano.encode(np.append(pointer, b - a)),
                    elias_fano.encode(place.astype(np.int64) * base + word[a:b]),
                    codes.tobytes(),
                ],
            )
        )
    Shard.write(path, blocks)


class Successors:
    """Level 2.  shards: (shard, path, first key) in order of the keys."""

    def __init__(self, shards: list[tuple], base: int):
        self.shards, self.base, self.open = shards, base, {}
        self.first = np.array([s[2] for s in shards], dtype=np.int64)

    def _shard(self, i: int) -> Shard:
        if i not in self.open:
            self.open[i] = Shard(self.shards[i][1])
        return self.open[i]

    def find(self, keys: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 of the discounted probability or nan of sorted distinct keys, T of sorted distinct contexts).

        Every key's context is among the contexts.
        """
        log, kinds = np.full(len(keys), np.nan), np.zeros(len(contexts), dtype=np.int64)
        low, high = contexts * self.base, contexts * self.base + self.base - 1
        for i in range(len(self.shards)):
            end = self.first[i + 1] if i + 1 < len(self.shards) else np.int64(2**63 - 1)
            # Contexts whose range may reach into the shard.
            a, b = np.searchsorted(high, self.first[i]), np.searchsorted(low, end)
            if a >= b:
                continue
            shard = self._shard(i)
            first = shard.first.astype(np.int64)
            ends = np.append(first[1:], end)
            for j in range(len(first)):
                x, y = a + np.searchsorted(high[a:b], first[j]), a + np.searchsorted(low[a:b], ends[j])
                if x >= y:
                    continue
                parts = shard.block(j)
                own, pointer = (elias_fano.decode(p).astype(np.int64) for p in parts[:2])
                at = np.searchsorted(own, contexts[x:y])
                at[at == len(own)] = 0
                there = own[at] == contexts[x:y]
                kinds[x:y] += np.where(there, pointer[at + 1] - pointer[at], 0)
                p, q = np.searchsorted(keys, first[j]), np.searchsorted(keys, ends[j])
                if p >= q:
                    continue
                context = keys[p:q] // self.base
                place = np.searchsorted(own, context)
                place[place == len(own)] = 0
                relative = place * self.base + (keys[p:q] - context * self.base)
                chain = elias_fano.decode(parts[2]).astype(np.int64)
                found = np.searchsorted(chain, relative)
                found[found == len(chain)] = 0
                hit = (chain[found] == relative) & (own[place] == context)
                codes = parts[3].view("<u2") if parts[3].flags.c_contiguous else np.frombuffer(parts[3].tobytes(), "<u2")
                log[p:q][hit] = codes[found[hit]] / -CODES_PER_UNIT
        return log, kinds


# --- texts as token numbers --------------------------------------------------------
class Group:
    """Tokens of successive texts as local numbers; 0 is the begin, 1 the end."""

    def __init__(self):
        self.index: dict[bytes, int] = {BEGIN: 0, END: 1}
        self.parts: list[np.ndarray] = []
        self.texts: list[tuple[int, int]] = []  # text, symbols
        self.size = 0
        self.carried = False  # the first symbol only is a context

    def add(self, text: int, words: list[bytes]) -> None:
        index = self.index
        ids = [index.setdefault(w, len(index)) for w in words]
        self.parts.append(np.array(ids, dtype=np.int32))
        self.texts.append((text, len(ids)))
        self.size += len(ids)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(local numbers, text of each, whether it is a token)."""
        flat = np.concatenate(self.parts)
        token = flat != 0
        if self.carried:
            token[0] = False
        return flat, np.repeat(np.array([t for t, _ in self.texts], dtype=np.int32), [n for _, n in self.texts]), token


def groups(texts) -> Iterator[Group]:
    """Texts in groups of about GROUP_TOKENS tokens; a longer text goes on in the next group."""
    group = Group()
    for i, text in enumerate(texts):
        group.add(i, [BEGIN])
        for segment in segments(text or "", WORD_END):
            words = segment.encode("utf-8", "surrogatepass").lower().split()
            group.add(i, words)
            if group.size > GROUP_TOKENS and words:
                yield group
                group = Group()
                group.carried = True
                group.add(i, [words[-1]])
        group.add(i, [END])
    if group.size:
        yield group


class Numbers:
    """The vocabulary's view of a group's local numbers."""

    def __init__(self, group: Group, vocabulary: Vocabulary, texts: int):
        h = hashes(list(group.index))
        order = np.argsort(h)
        number, sums, count = vocabulary.find(h[order])
        self.number, self.sums, self.count = (np.empty(len(h), dtype=np.int64) for _ in range(3))
        self.number[order], self.sums[order], self.count[order] = number, sums, count
        # The begin is the last context, and stands as often as there are texts.
        self.number[0], self.sums[0], self.count[0] = vocabulary.V, vocabulary.N, texts


def shard_of(numbers: Numbers, v: np.ndarray, w: np.ndarray, total: int) -> np.ndarray:
    """Level 2 shard of local pairs: non-decreasing in the key."""
    spread = numbers.count[v] * (numbers.sums[w] / max(1, total))
    return (numbers.sums[v] + np.floor(spread).astype(np.int64)) // SHARD_BIGRAMS


# --- Spark -------------------------------------------------------------------------
def _count_words(texts: DataFrame, bits: int) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def ship() -> pd.DataFrame:
            h = hashes(list(held))
            c = np.fromiter(held.values(), dtype=np.int64, count=len(held))
            held.clear()
            order = np.argsort(h)
            h, c = h[order], c[order]
            of = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), dtype=np.int64)
            names, starts = np.unique(of, return_index=True)
            return pd.DataFrame(
                [(n, pack_counts(h[a:b], c[a:b])) for n, a, b in zip(names.tolist(), starts, [*starts[1:], len(h)])], columns=["shard", "blob"]
            )

        for batch in batches:
            for text in batch["text"]:
                for segment in segments(text or "", WORD_END):
                    held.update(segment.encode("utf-8", "surrogatepass").lower().split())
                held[END] += 1
                if len(held) > HELD_WORDS:
                    yield ship()
        if held:
            yield ship()

    return texts.select("text").mapInPandas(count, "shard long, blob binary")


def _count_bigrams(texts: DataFrame, level1, n_texts: int) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(*level1.value)
        for batch in batches:
            for group in groups(batch["text"]):
                numbers = Numbers(group, vocabulary, n_texts)
                flat, _, token = group.arrays()
                at = np.flatnonzero(token[1:]) + 1
                v, w = flat[at - 1], flat[at]
                key = (numbers.number[v] * (vocabulary.V + 1) + numbers.number[w]).astype(np.uint64)
                key, first, c = np.unique(key, return_index=True, return_counts=True)
                of = shard_of(numbers, v[first], w[first], vocabulary.N)
                names, starts = np.unique(of, return_index=True)
                yield pd.DataFrame(
                    [(n, pack_counts(key[a:b], c[a:b])) for n, a, b in zip(names.tolist(), starts, [*starts[1:], len(key)])], columns=["shard", "blob"]
                )

    return texts.select("text").mapInPandas(count, "shard long, blob binary")


def _merge(blobs: DataFrame, name: str, write) -> list[tuple]:
    """One file a shard; (shard, path, n entries, sum of counts, first key), in order."""
    folder = fresh_path(blobs.sparkSession, f"llm-{name}")

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = merge_counts(group["blob"])
        path = f"{folder}/{uuid.uuid4().hex}"  # a retried task leaves a file that nothing refers to
        write(path, keys, counts)
        return pd.DataFrame(
            [(group["shard"].iloc[0], path, len(keys), int(counts.sum()), f"{int(keys[0])}")], columns=["shard", "path", "n", "total", "first"]
        )

    made = blobs.groupBy("shard").applyInPandas(merge, "shard long, path string, n long, total long, first string")
    rows = write_out(made, f"{name}-list").collect()
    return sorted((r["shard"], r["path"], r["n"], r["total"], int(r["first"])) for r in rows)


class BigramModel:
    """A trained model; ``score(text)`` is a column of structs."""

    def __init__(self, spark, level1: tuple, level2: tuple, n_texts: int):
        self.N = sum(s[3] for s in level1[0])
        self.V = sum(s[2] for s in level1[0])
        self.data, self.n_texts = spark.sparkContext.broadcast((level1, level2)), n_texts

    def score(self, text: Column) -> Column:
        """n_tokens, n_known (tokens seen in training), base_score, score (log10 probabilities)."""
        data, n_texts = self.data, self.n_texts

        @F.pandas_udf("n_tokens long, n_known long, base_score double, score double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            vocabulary, successors = Vocabulary(*data.value[0]), Successors(*data.value[1])
            for texts in batches:
                yield score_texts(texts, vocabulary, successors, n_texts)

        return of(text)


def score_texts(texts, vocabulary: Vocabulary, successors: Successors, n_texts: int) -> pd.DataFrame:
    n = len(texts)
    out = {"n_tokens": np.zeros(n, dtype=np.int64), "n_known": np.zeros(n, dtype=np.int64), "base_score": np.zeros(n), "score": np.zeros(n)}
    whole = vocabulary.N + 0.5 * (vocabulary.V + 1)
    for group in groups(texts):
        numbers = Numbers(group, vocabulary, n_texts)
        flat, text, token = group.arrays()
        at = np.flatnonzero(token)
        w, of = flat[at], text[at]
        p1 = (numbers.count + 0.5) / whole
        p1[0] = 1  # the begin is no token
        out["n_tokens"] += np.bincount(of, minlength=n)
        out["n_known"] += np.bincount(of, weights=numbers.count[w] > 0, minlength=n).astype(np.int64)
        out["base_score"] += np.bincount(of, weights=np.log10(p1)[w], minlength=n)
        out["score"] += np.bincount(of, weights=_bigram_logs(flat[at - 1], w, numbers, successors, p1), minlength=n)
    return pd.DataFrame(out)


def _bigram_logs(v: np.ndarray, w: np.ndarray, numbers: Numbers, successors: Successors, p1: np.ndarray) -> np.ndarray:
    """log10 p(w | v) of local pairs, worked out once for each distinct pair."""
    pair, back = np.unique(v.astype(np.int64) * len(p1) + w, return_inverse=True)
    v, w = pair // len(p1), pair % len(p1)
    p = p1[w].copy()
    context = (numbers.number[v] >= 0) & (numbers.count[v] > 0)
    own, place = np.unique(numbers.number[v[context]], return_inverse=True)
    known = context & (numbers.number[w] >= 0)
    key = numbers.number[v] * successors.base + numbers.number[w]
    order = np.flatnonzero(known)[np.argsort(key[known])]
    key = key[order]
    log, kinds = successors.find(key, own)
    p[context] *= DISCOUNT * kinds[place] / numbers.count[v[context]]
    seen = ~np.isnan(log)
    p[order[seen]] += 10 ** log[seen]
    return np.log10(p)[back]


def pair_base(distinct: int) -> int:
    """What a pair's key multiplies its context with; a vocabulary whose keys would not fit 63 bits is refused."""
    base = distinct + 1
    if base * base >= 1 << 63:
        raise ValueError(f"{distinct} distinct words are too many for pairs in 63 bits")
    return base


def train(texts: DataFrame, text_col: str = "text") -> BigramModel:
    """Learns from every row of ``texts``."""
    spark = texts.sparkSession
    texts = texts.select(F.col(text_col).alias("text"))
    chars, n_texts = texts.agg(F.sum(F.length("text")), F.count(F.lit(1))).first()
    bits = max(0, ((chars or 0) // SHARD_CHARS).bit_length())
    words = _merge(_count_words(texts, bits), "vocabulary", write_vocabulary)
    level1 = ([w[:4] for w in words], bits)
    shared = spark.sparkContext.broadcast(level1)
    base = pair_base(sum(w[2] for w in words))

    def write(path: str, keys: np.ndarray, counts: np.ndarray) -> None:
        vocabulary = Vocabulary(*shared.value)

        def context_counts(own: np.ndarray) -> np.ndarray:
            inner = own < vocabulary.V
            out = np.full(len(own), n_texts, dtype=np.int64)
            out[inner] = vocabulary.counts(own[inner])
            return out

        write_successors(path, keys, counts, base, context_counts)

    pairs = _merge(_count_bigrams(texts, shared, n_texts), "successors", write)
    return BigramModel(spark, level1, ([(p[0], p[1], p[4]) for p in pairs], base), n_texts)
