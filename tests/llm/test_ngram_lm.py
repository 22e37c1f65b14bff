"""Elias-Fano coding, and the language model against a plain dictionary model."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulse.llm import elias_fano, ngram_lm, queries

SF = "/root/testdata/sf0.001"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**64 - 1))))
def test_elias_fano_round_trip(values):
    v = np.sort(np.array(values, dtype=np.uint64))
    assert elias_fano.decode(elias_fano.encode(v)).tolist() == v.tolist()


def test_elias_fano_is_compact():
    v = np.sort(np.random.default_rng(1).integers(0, 2**40, 65536, dtype=np.uint64))
    assert 8 * len(elias_fano.encode(v)) / len(v) < 24 + 3  # log2(2^40 / 2^16) + 2 bits and the header


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ)), "\n"]


def plain(train, texts):
    """n_tokens, n_known, base score and bigram score by dictionaries."""
    uni, bi, kinds, ctx = Counter(), Counter(), Counter(), Counter()
    for t in train:
        w = tokens(t)
        uni.update(w)
        bi.update(zip(["\t", *w], w))
    for (v, _), c in bi.items():
        kinds[v] += 1
        ctx[v] += c
    whole = sum(uni.values()) + 0.5 * (len(uni) + 1)
    out = []
    for t in texts:
        w = tokens(t)
        p1 = [(uni[x] + 0.5) / whole for x in w]
        p = [
            q if not ctx[v] else max(bi[v, x] - 0.75, 0) / ctx[v] + 0.75 * kinds[v] / ctx[v] * q
            for v, x, q in zip(["\t", *w], w, p1)
        ]
        out.append((len(w), sum(uni[x] > 0 for x in w), sum(map(math.log10, p1)), sum(map(math.log10, p))))
    return out, sum(uni.values())


def check(model, df, train, rows):
    want, n = plain(train, [t for _, t in rows])
    assert model.N == n
    got = {r.doc_id: r.s for r in df.select("doc_id", model.score(F.col("text")).alias("s")).collect()}
    for (i, _), (a, b, base, score) in zip(rows, want):
        s = got[i]
        assert (s.n_tokens, s.n_known) == (a, b)
        assert s.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert s.score == pytest.approx(score, abs=1e-6 + a / ngram_lm.CODES_PER_UNIT / 2)


def test_query_matches_the_plain_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    want, n = plain([t for i, t in rows if not held[i]], [t for _, t in rows])
    got = {r.doc_id: r for r in queries.QUERIES["op10_lm_score"](spark, SF).collect()}
    for (i, _), (a, b, base, score) in zip(rows, want):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], a, b, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, abs=a / ngram_lm.CODES_PER_UNIT / 2)
    gain = [r.score - r.base_score for r in got.values() if r.held_out]
    assert sum(gain) > 0  # better than the base on texts that it has not seen


@pytest.mark.parametrize("small", [False, True])
def test_shards_blocks_and_groups_change_nothing(spark, monkeypatch, small):
    if small:
        for name, value in {"BLOCK": 7, "GROUP_TOKENS": 13, "SHARD_CHARS": 150, "SHARD_BIGRAMS": 20, "HELD_WORDS": 9}.items():
            monkeypatch.setattr(ngram_lm, name, value)
    texts = ["the cat the dog", "The the the the", "a  cat\tsat\non the mat", "", None, "É é the É", "x" * 500, "the end " * 40, "the cat the dog"]
    rows = list(enumerate([*texts, "unknown words only", "the unknown cat"]))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    if small:  # worker processes keep their own constants, so the same steps run here
        vocabulary, successors, n = build_locally(texts)
        got = ngram_lm.score_texts([t for _, t in rows], vocabulary, successors, n)
        want, _ = plain(texts, [t for _, t in rows])
        for (a, b, base, score), r in zip(want, got.itertuples()):
            assert (r.n_tokens, r.n_known) == (a, b)
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, abs=a / ngram_lm.CODES_PER_UNIT / 2)
    else:
        check(ngram_lm.train(df.where("doc_id < 9")), df, texts, rows)


def build_locally(texts):
    """The two levels from the same steps as the Spark tasks, with this process's constants."""
    import tempfile
    import uuid

    folder = tempfile.mkdtemp(prefix="pulse-test-")
    held = Counter(w.encode() if w != "\n" else ngram_lm.END for t in texts for w in tokens(t))
    words = list(held)
    h = ngram_lm.hashes(words)
    order = np.argsort(h)
    h, c = h[order], np.array([held[words[i]] for i in order])
    bits, shards = 2, []
    for s in range(4):
        own = (h >> np.uint64(62)).astype(int) == s
        if own.any():
            path = f"{folder}/{uuid.uuid4().hex}"
            ngram_lm.write_vocabulary(path, h[own], c[own])
            shards.append((s, path, int(own.sum()), int(c[own].sum())))
    vocabulary = ngram_lm.Vocabulary(shards, bits)
    blobs = {}
    for group in ngram_lm.groups(texts):
        numbers = ngram_lm.Numbers(group, vocabulary, len(texts))
        flat, _, token = group.arrays()
        at = np.flatnonzero(token[1:]) + 1
        v, w = flat[at - 1], flat[at]
        key = (numbers.number[v] * (vocabulary.V + 1) + numbers.number[w]).astype(np.uint64)
        key, first, n = np.unique(key, return_index=True, return_counts=True)
        of = ngram_lm.shard_of(numbers, v[first], w[first], vocabulary.N)
        assert (np.diff(of) >= 0).all()
        for s in np.unique(of):
            blobs.setdefault(int(s), []).append(ngram_lm.pack_counts(key[of == s], n[of == s]))
    if ngram_lm.SHARD_BIGRAMS < 100:
        assert len(blobs) > 3

    def counts(own):
        return np.array([len(texts) if i == vocabulary.V else vocabulary.counts(np.array([i]))[0] for i in own])

    level2 = []
    for s in sorted(blobs):
        keys, n = ngram_lm.merge_counts(blobs[s])
        path = f"{folder}/{uuid.uuid4().hex}"
        ngram_lm.write_successors(path, keys, n, vocabulary.V + 1, counts)
        level2.append((s, path, int(keys[0])))
    return vocabulary, ngram_lm.Successors(level2, vocabulary.V + 1), len(texts)


@pytest.mark.parametrize("space", ["\u3000", "\u00a0", "\u0085", "\x1c", "\x1f"])
def test_long_texts_are_cut_at_ascii_white_space_only(space):
    text = "ab " * 87_381 + f"x{space}y{space}z end"  # the first cut is looked for from the x on
    assert len(text) > 262_144
    found = [w for s in ngram_lm.segments(text, ngram_lm.WORD_END) for w in s.encode().split()]
    assert found == text.encode().split()
    groups = list(ngram_lm.groups([text]))
    assert sum(g.size for g in groups) == len(text.encode().split()) + 2  # and begin and end
    assert f"x{space}y{space}z".encode() in groups[0].index


def test_probabilities_of_a_context_sum_to_one():
    texts = ["a b a c", "a b", "c c c a"] * 3
    vocabulary, successors, n = build_locally(texts)
    for context in ("a", "b", "zz"):
        nexts = [f"{context} {w}" for w in ("a", "b", "c", "zz")]
        got = ngram_lm.score_texts([context, *nexts], vocabulary, successors, n)["score"]
        want, _ = plain(texts, [context, *nexts])
        total = 0.0
        uni = Counter(w for t in texts for w in tokens(t))
        for w in [*uni, "zz"]:
            total += pair_probability(texts, context, w)
        assert total == pytest.approx(1)
        assert got.tolist() == pytest.approx([x[3] for x in want], abs=0.01)


def pair_probability(texts, v, w):
    uni, bi = Counter(), Counter()
    for t in texts:
        x = tokens(t)
        uni.update(x)
        bi.update(zip(x, x[1:]))
    p1 = (uni[w] + 0.5) / (sum(uni.values()) + 0.5 * (len(uni) + 1))
    after = {b: c for (a, b), c in bi.items() if a == v}
    if not after:
        return p1
    return max(after.get(w, 0) - 0.75, 0) / sum(after.values()) + 0.75 * len(after) / sum(after.values()) * p1


def test_edges(spark):
    schema = "doc_id long, text string, s int, n_tokens int"
    empty = spark.createDataFrame([], schema)
    some = spark.createDataFrame([(1, "a b", 0, 0), (None, None, 0, 0), (2, "", 0, 0)], schema)
    model = ngram_lm.train(empty)
    assert model.N == 0
    assert {(r.s.n_tokens, r.s.base_score, r.s.score) for r in some.select(model.score(F.col("text")).alias("s")).collect()} == {(3, 0.0, 0.0), (1, 0.0, 0.0)}
    trained = ngram_lm.train(some)
    assert empty.select(trained.score(F.col("text")).alias("s")).count() == 0


def test_too_many_distinct_words_are_refused():
    assert ngram_lm.pair_base(3_000_000_000) == 3_000_000_001
    with pytest.raises(ValueError):
        ngram_lm.pair_base(3_100_000_000)
