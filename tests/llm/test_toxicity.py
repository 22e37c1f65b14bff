"""The toxicity classifier: counts against brute force, held-out accuracy, edges."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import queries, toxicity as tx

SF = "/root/testdata/sf0.01"


def grams_of(word):
    w = f"<{word}>"
    return [w[i : i + n] for n in range(tx.MIN_N, tx.MAX_N + 1) for i in range(len(w) - n + 1)]


def test_counts_match_brute_force(spark):
    rows = [("Bad bad word", 1), ("good word", 0), (None, 0), ("", 1), ("x" * 200 + " word é漢🙂z", 0)]
    labelled = spark.createDataFrame(rows, "text string, toxic int")
    got = {r.gram: (r.n1, r.n0) for r in tx.gram_counts(tx.word_counts(labelled)).collect()}
    want = {0: Counter(), 1: Counter()}
    for text, label in rows:
        for w in tx.words_of(text):
            want[label].update(grams_of(w))
    assert got == {tx.gram_hash(g): (want[1][g], want[0][g]) for g in want[0] | want[1]}
    assert got[tx.gram_hash("<bad>")] == (1, 0) and got[tx.gram_hash("word")] == (1, 2)


def test_features_match_brute_force(monkeypatch):
    texts = ["Bad bad word", None, "", "good bad", "word " * 500, "unknown"]
    grams = np.array(sorted(tx.gram_hash(g) for g in ("<bad", "word>", "good", "nope")), dtype=np.int64)
    want = [sorted(np.searchsorted(grams, tx.gram_hash(g)) for g in {g for w in tx.words_of(t) for g in grams_of(w)} if tx.gram_hash(g) in grams) for t in texts]
    for cached, group in ((100_000, 256), (1, 1)):
        monkeypatch.setattr(tx, "CACHED_WORDS", cached)
        monkeypatch.setattr(tx, "GROUP_TEXTS", group)
        got = [np.flatnonzero(row).tolist() for there in tx.Features(grams).groups(texts) for row in there]
        assert got == want
    assert tx.Features(grams[:0]).present(texts).shape == (6, 0)


def test_long_words_keep_their_ngrams():
    word = "".join(chr(97 + k % 26) + str(k % 10) for k in range(150))
    inner = {word[i : i + n] for n in range(tx.MIN_N, tx.MAX_N + 1) for i in range(len(word) - n + 1)}
    assert inner <= {g for w in tx.words_of(word) for g in grams_of(w)}


def test_fit_separates_and_a_single_label_gives_the_prior():
    rows = [np.array(r, dtype=np.int32) for r in ([0], [0, 2], [1], [1, 2], [])]
    w, b = tx.fit(rows, np.array([1, 1, 0, 0, 0.0]), np.array([2.0, -2.0, 0.0]))
    assert b + w[0] > 0 > b + w[1] and b < 0
    w, b = tx.fit(rows, np.zeros(5), np.array([2.0, -2.0, 0.0]))
    assert not w.any() and b < 0


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op3_toxicity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id")
    rows = [(r.score, r.predicted, r.toxic) for r in got.where("held_out").collect()]
    pos, neg = [s for s, _, t in rows if t], [s for s, _, t in rows if not t]
    auc = np.mean([[(p > n) + (p == n) / 2 for n in neg] for p in pos])
    assert auc > 0.85 and sum(p for _, p, t in rows if not t) <= 0.02 * len(neg)
    assert all(0 <= s <= 1 and p == (s >= 0.5) for s, p, _ in rows)


def test_a_bounded_sample_keeps_the_rate_of_the_labels(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "just the same words") for i in range(420)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(420)], "doc_id long, toxic int")
    for most in (5_000, 10):
        monkeypatch.setattr(tx, "MAX_FIT_ROWS", most)
        (score,) = {r.s for r in docs.select(tx.train(docs, labels).score(F.col("text")).alias("s")).collect()}
        print("score", score, "at", most, "rows of a label")
        assert score == pytest.approx(20 / 420, abs=0.01)


def test_labels_without_a_document_and_repeated_ids_do_not_use_up_the_sample(spark, monkeypatch):
    monkeypatch.setattr(tx, "MAX_FIT_ROWS", 30)
    docs = spark.createDataFrame([(i, f"vile awful words {i % 7}" if i % 4 == 0 else f"kind friendly talk {i % 7}") for i in range(400)], "doc_id long, text string")
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 4 = 0 AS int) AS toxic")
    more = spark.range(1000, 60_000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic")
    again = spark.createDataFrame([(1, "kind friendly talk")] * 5_000, "doc_id long, text string")
    score = lambda model: {r.doc_id: r.s for r in docs.select("doc_id", model.score(F.col("text")).alias("s")).collect()}
    for model in (tx.train(docs, labels.union(more)), tx.train(docs.union(again), labels)):
        got = score(model)
        assert min(s for i, s in got.items() if i % 4 == 0) > 0.5 > max(s for i, s in got.items() if i % 4)


def test_only_the_text_decides(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = queries.toxicity_model(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    other = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text")
    a = {r.doc_id: r.s for r in docs.select("doc_id", model.score(F.col("text")).alias("s")).collect()}
    assert a == {r.doc_id - 7: r.s for r in other.select("doc_id", model.score(F.col("text")).alias("s")).collect()}


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1), (1, 0), (2, 0), (9, 1), (None, 1), (3, None)]])
def test_edges(spark, labels):
    docs = spark.createDataFrame([(1, "vile words", 0), (2, "fine words", 0), (2, "fine words", 0), (3, None, 0), (4, "", 0), (None, "vile", 0)], "doc_id long, text string, toxic int")
    model = tx.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = docs.select("doc_id", model.score(F.col("text")).alias("s")).collect()
    assert len(rows) == 6 and all(0 <= r.s <= 1 for r in rows)
    assert {r.s < 0.5 for r in rows if r.doc_id in (3, 4)} == {True}
    assert docs.limit(0).select(model.score(F.col("text"))).count() == 0
