"""Periodic runs against a search over all stretches and periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def brute(words, min_length=6, min_exponent=4):
    """Every (start, length, period) by definition."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, min_exponent * q):
                found.setdefault((i, length), q)  # the smallest period of the stretch
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def dropped(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def found(texts, **kw):
    rows = periodic_runs._batch([t.encode().split() for t in texts], kw.get("min_length", 6), kw.get("min_exponent", 4))
    return [[(r["start"], r["length"], r["period"]) for r in runs] for runs in rows["runs"]], rows["collapsed"].tolist()


@pytest.mark.parametrize("letters,n,least", [(1, 30, 2), (2, 40, 2), (2, 60, 4), (3, 80, 2), (5, 200, 3)])
def test_random_words_against_all_stretches(letters, n, least, monkeypatch):
    monkeypatch.setattr(periodic_runs, "PAIRS", 50)  # several blocks of look-ups
    rng = random.Random(letters * n)
    texts = [" ".join(rng.choice("abcdefgh"[:letters]) for _ in range(rng.randrange(n))) for _ in range(150)]
    runs, collapsed = found(texts, min_length=3, min_exponent=least)
    for text, own, rest in zip(texts, runs, collapsed):
        assert own == brute(text.split(), 3, least), text
        assert rest.split() == dropped(text.split(), own)


def test_planted_periods():
    rng = random.Random(5)
    texts = []
    for q in (1, 2, 3, 7, 40, 250):
        head, root, tail = ([f"{x}{rng.randrange(10**6)}" for _ in range(k)] for x, k in (("h", 30), ("r", q), ("t", 20)))
        texts.append(" ".join(head + (root * 7)[: 5 * q + q // 2 + 2] + tail))
    texts.append(texts[3] + " " + texts[4])  # two runs
    runs, collapsed = found(texts)
    for text, own, rest in zip(texts, runs, collapsed):
        assert own == brute(text.split()) and own
        assert rest.split() == dropped(text.split(), own)
    assert len(runs[-1]) == 2


def test_a_long_periodic_text_is_quick():
    words = [str(i) for i in range(3000)] * 40 + ["x"] * 100_000
    runs, _ = found([" ".join(words)])
    assert runs == [[(0, 120_000, 3000), (120_000, 100_000, 1)]]


EDGE = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n", "a"),
    (4, "a a a a a", "a"),  # five words are no run
    (5, "a a a a a a", "a"),
    (5, "a a a a a a", "a"),
    (6, "a\x0ba\x0ca\ta\na\ra b", "a"),
    (7, "a\x1ca a　a\x85a a", "a"),  # not ASCII white space: two words
    (None, "x y x y x y x y", None),
]


def test_edges(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, runs string")  # a name that the result has too
    got = docs.select("doc_id", periodic_runs.periodic_runs(F.col("text")).alias("r")).select("doc_id", "r.*")
    rows = {}
    for r in got.collect():
        rows.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert rows[1] == rows[2] == rows[3] == [(0, [], "")]
    assert rows[4] == [(5, [], "a a a a a")]
    assert rows[5] == [(6, [(0, 6, 1)], "a")] * 2
    assert rows[6] == [(7, [(0, 6, 1)], "a b")]
    assert rows[7] == [(2, [], "a\x1ca a　a\x85a a")]
    assert rows[None] == [(8, [(0, 8, 2)], "x y")]
    assert docs.limit(0).select(periodic_runs.periodic_runs(F.col("text"))).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(F.col("text"), min_exponent=1)


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()
    rest = b" ".join(dropped(words, runs))
    return (len(runs), *best, milli, hashlib.sha256(listed).hexdigest(), hashlib.sha256(rest).hexdigest())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 6000").collect()
    got = {
        r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
        for r in queries.op12_periodic_runs(spark, SF).collect()
    }
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sum(zlib.crc32(str(d.doc_id).encode()) % 10 == 0 for d in docs) > 5
    for d in docs:
        assert got[d.doc_id] == expected(d.doc_id, d.text), d.doc_id


def test_levels_and_common_prefixes():
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 2, 60), rng.integers(2, 4, 50), np.full(30, 9)])
    array = periodic_runs.SuffixArray(keys, np.array([0, 60, 110]))
    ends = np.repeat([60, 110, 140], [60, 50, 30])
    suffix = lambda i: tuple(keys[i : ends[i]])
    assert [suffix(i) for i in array.order] == sorted(suffix(i) for i in range(140))
    for b in range(1, 140):
        x, y = suffix(array.order[b - 1]), suffix(array.order[b])
        shared = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        assert array.lcp[b] == shared
