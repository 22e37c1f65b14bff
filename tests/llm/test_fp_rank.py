"""Ranked lexical search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pulse.llm import fp_rank

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(AZ))


def brute(docs, items, k=10):
    """[(item, rank, doc, score)] by scoring all documents."""
    words = [(d, Counter(split(t))) for d, t in docs if split(t)]
    n_docs, total = len(words), sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, []).extend(split(t))
    out = []
    for i, terms in asked.items():
        rows = []
        for d, c in words:
            m = 25 + (75 * sum(c.values()) * n_docs) // total
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(rows, key=lambda x: x[:3])[:k])]
    return Counter(out)


def ranked(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return Counter(tuple(r) for r in fp_rank.top_documents(d, i, **kw).select("item_id", "rank", "doc_id", "score").collect())


def corpus(n, seed, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    text = lambda k: " ".join(rng.choices(vocabulary, weights, k=k))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(n)]
    docs += [(n + i, docs[i % 7][1]) for i in range(n // 3)]  # copies: equal scores
    return docs, [(i, text(rng.randrange(1, 25))) for i in range(25)]


def test_against_all_scores(spark):
    docs, items = corpus(900, 1)
    assert ranked(spark, docs, items) == brute(docs, items)


def test_small_trees_blocks_and_passes(spark, monkeypatch):
    # (the workers import the module's own constants, so these hold for the tree in this process too)
    docs, items = corpus(200, 2)
    monkeypatch.setattr(fp_rank, "MAX_QUERY_TERMS", 90)  # several passes
    assert ranked(spark, docs, items, k=3) == brute(docs, items, k=3)
    with pytest.raises(ValueError):
        monkeypatch.setattr(fp_rank, "MAX_QUERY_TERMS", 3)
        ranked(spark, docs, items)


def vectors(docs, vocabulary):
    ids = {t: i for i, t in enumerate(vocabulary)}
    counts = [Counter(ids[t] for t in split(x) if t in ids) for _, x in docs]
    sizes = np.array([len(c) for c in counts], dtype=np.int64)
    flat = [p for c in counts for p in sorted(c.items())]
    term, tf = (np.array([p[x] for p in flat], dtype=np.int32) for x in (0, 1))
    return sizes, term, tf


@pytest.mark.parametrize("leaf,block", [(1, 3), (4, 20), (64, 4096)])
def test_bounds_hold_and_prune(monkeypatch, leaf, block):
    monkeypatch.setattr(fp_rank, "LEAF_DOCS", leaf)
    monkeypatch.setattr(fp_rank, "BLOCK_TERMS", block)
    docs, items = corpus(1500, 3, words=300)
    vocabulary = sorted({t for _, x in items for t in split(x)})
    sizes, term, tf = vectors(docs, vocabulary)
    n = np.array([len(split(x)) for _, x in docs])
    m = 25 + (75 * n * len(docs)) // n.sum()
    df = np.bincount(term, minlength=len(vocabulary))
    rank = np.empty(len(vocabulary), dtype=np.uint32)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(vocabulary))
    place = {t: i for i, t in enumerate(vocabulary)}
    asked = []
    for number, (_, text) in enumerate(items):
        c = Counter(t for t in split(text) if df[place[t]])
        pairs = sorted((place[t], k * fp_rank.weight(len(docs), int(df[place[t]]))) for t, k in c.items())
        asked.append((number, *np.array(pairs, dtype=np.int64).T))
    tree = fp_rank.Tree(sizes, term, tf, m, rank)
    assert sorted(tree.docs) == np.flatnonzero(sizes).tolist()
    searcher = fp_rank.Searcher(asked, rank, 10)
    for b in searcher.blocks:
        tfs = tree.largest_tfs(b)
        for number, local, own in b.items:
            gain = np.zeros(len(vocabulary), dtype=np.int64)
            gain[b.terms[local]] = own
            bounds = fp_rank.impact(tfs[:, local], tree.min_m[:, None]) @ own
            exact = np.add.reduceat(gain[tree.term] * tree.impact, tree.at[:-1])
            for node, limit in enumerate(bounds):
                assert exact[tree.first[node] : tree.last[node]].max() <= limit
    for a in range(0, len(docs), 400):
        part = slice(int(sizes[:a].sum()), int(sizes[: a + 400].sum()))
        searcher.add([d for d, _ in docs[a : a + 400]], sizes[a : a + 400], term[part], tf[part], m[a : a + 400])
    got = Counter((i, r + 1, v, -s) for i, best in searcher.best.items() for r, (s, (_, v)) in enumerate(best.rows))
    assert got == brute(docs, items)
    if leaf < 64:
        assert searcher.scored < 0.8 * len(items) * len(docs)  # the bounds leave documents out


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "Straße ÉCOLE x"), (5, "straße École x"), (6, "b b b" * 30_000), (None, "x b"), (7, "x b"), (7, "x b"), (8, "zz")]
    items = [(1, "x"), (1, "X"), (2, None), (3, "none"), (4, "STRASSE straße"), (None, "b x"), (5, "É é")]
    assert ranked(spark, docs, items) == brute(docs, items)
    assert not ranked(spark, [], items) and not ranked(spark, docs, []) and not ranked(spark, [(1, None)], items)
    d = spark.createDataFrame([("a", "x y", 1), ("b", "x", 2)], "doc_id string, text string, item_id long")
    i = spark.createDataFrame([("q", "x", 7.0, 1)], "item_id string, text string, score double, rank int")
    got = fp_rank.top_documents(d, i)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert [(r.item_id, r["rank"], r.doc_id) for r in got.orderBy("rank").collect()] == [("q", 1, "b"), ("q", 2, "a")]
