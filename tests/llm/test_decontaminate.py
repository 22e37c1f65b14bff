"""Winnowing decontamination against brute force over windows."""

import random
import re

from pulse.llm import decontaminate

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(AZ))


def brute(docs, items, span=10):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for name, text in items:
            x = words(text)
            n = min(span, len(x))
            for s in range(len(x) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == x[s : s + n]:
                        hit.update(range(p, p + n))
                        found.add("" if name is None else str(name))
        out.append((-1 if i is None else i, len(w), len(hit), tuple(sorted(found))))
    return sorted(out)


def got(spark, docs, items):
    d = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, words string")
    b = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, hash string")
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.hits(d, b).collect())


def test_random_texts_over_few_words(spark):
    rng = random.Random(5)
    for trial in range(2):
        text = lambda n: " ".join(rng.choice("a b C dé 7".split()) for _ in range(n))  # noqa: E731, B023
        items = [(k, text(rng.choice([1, 2, 3, 9, 10, 11, 14, 30]) if trial else rng.choice([10, 12, 25]))) for k in range(12)]
        docs = [(k, text(rng.choice([0, 1, 5, 9, 10, 40, 90]))) for k in range(60)]
        for k in range(0, 60, 3):  # plant spans of items
            w = items[k % 12][1].split()
            s = rng.randrange(len(w))
            docs.append((100 + k, f"{text(7)}, {'; '.join(w[s : s + 13])}! {text(6)}"))
        assert got(spark, docs, items) == brute(docs, items)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    items = [(1, long[3000:3300]), (1, None), (2, ""), (None, "one two three four five six seven eight nine ten"), (3, "ÉCOLE"), (4, "école"), (5, "... !")]
    docs = [(1, long), (1, long), (2, None), (3, ""), (4, "One-two three FOUR five six seven eight nine ten"), (None, "x É école ÉCOLE"), (6, "!?")]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, docs, []) == brute(docs, []) and got(spark, [], items) == []


def test_keep_clean_returns_the_same_columns(spark):
    d = spark.createDataFrame([(1, "a b", "x"), (2, "c", "x"), (None, "a b c", "y"), (None, None, "y"), (2, "c", "x")], "doc_id long, text string, row string")
    b = spark.createDataFrame([(1, "B")], "item_id long, text string")
    kept = decontaminate.keep_clean(d, b)
    assert kept.columns == d.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) == [(2, "c"), (2, "c")] and kept.count() == 3


def test_no_python_on_the_main_path(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "B")], "item_id long, text string")
    plan = decontaminate.hits(d, b)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
