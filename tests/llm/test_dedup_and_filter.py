"""Exact dedup, SimHash near-dedup and URL filters against DuckDB or brute force."""

import hashlib
import itertools
from collections import Counter

import numpy as np
import pytest
import xxhash

from compare import compare, duck
from pulse.llm import exact_dedup, golay, queries, simhash, url_filter
from pulse.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, hash string, norm string"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name])
    assert ok, msg


# --- exact dedup -------------------------------------------------------------
EDGE = [
    (1, "Ab É", "x", "x"),
    (2, "aB É", "x", "x"),
    (3, "ab é", None, "x"),  # only A-Z are lower-cased
    (4, None, "x", "x"),
    (5, "", "x", "x"),
    (6, "long " * 50_000, "x", "x"),
    (6, "long " * 50_000, "x", "x"),
    (None, "ab É", "x", "x"),
    (None, "alone", "x", None),
]


def test_exact_dedup_edges(spark):
    docs = spark.createDataFrame(EDGE, DOCS)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.verdicts(docs).collect())
    assert got == Counter(
        [(1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False), (3, 3, 1, True), (None, None, 1, True)]
        + [(4, 5, 2, False), (5, 5, 2, True), (6, 6, 2, True), (6, 6, 2, True)]
    )
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 5, 6]
    assert exact_dedup.verdicts(docs.limit(0)).count() == 0 and exact_dedup.keep_one(docs.limit(0)).count() == 0


def test_hash_collisions_do_not_merge_texts(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("00"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.verdicts(docs).collect()}
    sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in "ab"}
    assert got == {1: (3, 2, sha["a"]), 2: (2, 1, sha["b"]), 3: (3, 2, sha["a"])}


# --- SimHash -----------------------------------------------------------------
def brute_print(text, k=3):
    import re

    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints):
    """{print: set of prints reachable by steps of 2 bits or fewer}"""
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(parent, 2):
        if (a ^ b).bit_count() <= 2:
            parent[find(a)] = find(b)
    return {p: find(p) for p in parent}


def brute_simhash(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    root = brute_components({p for _, p in prints})
    low = {}
    for i, p in prints:
        if i is not None:
            low[root[p]] = min(i, low.get(root[p], i))
    return sorted(((-1 if i is None else i), f"{p:016x}", low.get(root[p])) for i, p in prints)


def found(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, r.component_id) for r in df.collect())


def test_golay_is_perfect_and_balls_meet():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 23, 4000)
    index, first = golay.ball_indices(v, 23)
    assert set(first.sum(axis=1).tolist()) <= {1, 6}
    for n in (1, 2):
        u = v.copy()
        for row in range(len(u)):
            for b in rng.choice(23, n, replace=False):
                u[row] ^= 1 << int(b)
        other, _ = golay.ball_indices(u, 23)
        assert all(set(a) & set(b) for a, b in zip(index.tolist(), other.tolist()))


def test_all_pairs_within_two_bits_share_a_key():
    rng = np.random.default_rng(2)
    base = rng.integers(-(1 << 63), 1 << 63, 1)
    all_flips = [0] + [1 << a for a in range(64)] + [1 << a | 1 << b for a, b in itertools.combinations(range(64), 2)]
    near = base.view(np.uint64) ^ np.array(all_flips, dtype=np.uint64)
    own = set(simhash.golay_keys(base)[0].tolist())
    assert 3 <= len(own) <= 18
    assert all(own & set(k.tolist()) for k in simhash.golay_keys(near.view(np.int64)))


def test_simhash_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(queries.QUERIES["op1_simhash"](spark, SF).select("doc_id", "fingerprint", "component_id")) == brute_simhash(rows)


def test_simhash_edges(spark):
    rows = [(3, "A b"), (7, "a B"), (None, "a b"), (9, ""), (8, None), (4, " \t\n"), (5, "one"), (5, "one"), (None, "solo x y z"), (6, "w " * 70_000)]
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, fp string, low int")
    assert found(simhash.near_duplicates(docs)) == brute_simhash(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3, 4, 5, 5, 6]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("small", [0, 2, 64])
def test_links_keep_components_whatever_the_bucket_size(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    rng = np.random.default_rng(3)
    prints = set()
    for _ in range(6):
        at = int(rng.integers(0, 1 << 63))
        for _ in range(40):
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                at ^= 1 << int(b)
            prints.add(at)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r.node: r.root for r in components(simhash._links(df, 2)).collect()}
    want = brute_components(prints)
    classes = lambda m: {frozenset(p for p in m if m[p] == r) for r in set(m.values())}
    assert classes({p: got.get(s, s) for p, s in zip(prints, signed)}) == classes(want)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}}


# --- URL filters ---------------------------------------------------------------
def test_url_rules(spark):
    urls = {
        1: "http://EXAMPLE.net/en/x", 2: "http://a.example.net/de/", 3: "http://net", 4: "http://net/", 5: "http://xnet/",
        6: "https://x.org/fr/1?q#f", 7: "http://example.com/de/1", 8: "http://notexample.com/de/", 9: None, 10: "", 11: "no scheme",
        12: "http://example.net:80/en/", 13: "http://a.net?x=/y", 14: "x://b.net/ü#://c.org/fr/", 15: "http://" + "a." * 50_000 + "net/" + "p/" * 3000,
    }
    pages = spark.createDataFrame([(k, v, "r") for k, v in urls.items()] + [(1, urls[1], "r")], "page_id long, url string, rule string")
    rules = spark.createDataFrame(queries.URL_RULES, "verdict string, host string, path string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert got == {
        1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: (None, "allow"), 4: ("net/", "block"), 5: (None, "allow"),
        6: ("org/fr/", "allow"), 7: ("example.com/de/", "block"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"),
        12: (None, "allow"), 13: (None, "allow"), 14: ("net/", "block"), 15: ("net/", "block"),
    }
    assert url_filter.judge(pages, rules).count() == len(urls) + 1
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), rules).count() == 0
