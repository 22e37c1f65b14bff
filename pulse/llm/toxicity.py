"""Toxicity: a character n-gram linear classifier on naive-Bayes-scaled features.

Features are the character n-grams (``MIN_N`` to ``MAX_N``) of the padded words
``<word>``; a feature is present if any word of the text has it.

1. *Counts.*  Over all labelled training rows: texts of each label per distinct
   word, then per n-gram (a 64-bit hash) the sums over its places in the words.
   Tasks combine before both shuffles.  The log-count ratio
   r = log((p / |p|) / (q / |q|)) of the two labels, add-``ALPHA`` smoothed,
   follows from the sums.
2. *Selection.*  The ``MAX_FEATURES`` n-grams with the strongest evidence
   (surprise of label 1's count, in standard deviations) form the model, so its size is fixed.
3. *Weights.*  L2-regularised logistic regression on x_j = r_j [n-gram j
   present], fitted on at most ``MAX_FIT_ROWS`` labelled rows of either label
   (those with the smallest hash of the id): the only bounded sample here.
   Each row weighs as many as it stands for, so the label's true rate is the
   prior at any size.
4. *Scores.*  Every text, whole, by the broadcast weights.

Only the text is an input of a score.  Defined cases: null and empty texts have
no features and get the bias's score; several labels of an id count by the
largest; labels without a document, null labels and null ids teach nothing;
without labels of both kinds every text scores below one half.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pulse.llm.common import write_out

MIN_N, MAX_N = 3, 6
MULTIPLIER = 0x9E3779B97F4A7C15  # odd
ALPHA = 1.0
MIN_COUNT = 4
MAX_FEATURES = 1 << 13
MAX_FIT_ROWS = 5_000  # of each label
BROADCAST_LABELS = 2_000_000  # rows of (id, label) that may be broadcast: 32 MB
CACHED_WORDS = 200_000
COUNTED_WORDS = 300_000  # distinct words that a task holds before it passes their counts on
GROUP_CHARS, GROUP_TEXTS = 1 << 20, 256  # texts whose features are looked up together
MAX_WORD = 64  # of a longer word every part of so many characters counts as a word

_SPACE = re.compile(r"[\W_]+")


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words (letters and digits) of a text."""
    words = set(_SPACE.split((text or "").lower()))
    words.discard("")
    long = [w for w in words if len(w) > MAX_WORD]
    for w in long:  # overlapping parts, so that every n-gram of the word is in one of them
        words.discard(w)
        words.update(w[i : i + MAX_WORD] for i in range(0, len(w) - MAX_N + 1, MAX_WORD - MAX_N + 1))
    return words


def gram_hash(gram: str) -> int:
    """64-bit hash of an n-gram, as ``hashed_grams`` computes it."""
    h = len(gram)
    for c in gram:
        h = (h * MULTIPLIER + ord(c)) % (1 << 64)
    return h - (1 << 64) if h >> 63 else h


def hashed_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the padded words, and the word that each is from."""
    text = "".join([f"<{w}>" for w in words])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    room = np.cumsum(sizes)[word] - np.arange(len(points))  # characters left in the word
    hashes, of = [], []
    for n in range(MIN_N, MAX_N + 1):
        at = np.flatnonzero(room >= n)
        h = np.full(len(at), n, dtype=np.uint64)
        for j in range(n):
            h = h * np.uint64(MULTIPLIER) + points[at + j]
        hashes.append(h.view(np.int64))
        of.append(word[at])
    return np.concatenate(hashes), np.concatenate(of)


def word_counts(labelled: DataFrame) -> DataFrame:
    """(text, toxic) -> (word, n1, n0): texts of each label that have the word."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = {0: Counter(), 1: Counter()}

        def flush() -> pd.DataFrame:
            words = list(seen[0] | seen[1])
            out = pd.DataFrame({"word": words, "n1": [seen[1][w] for w in words], "n0": [seen[0][w] for w in words]})
            for words in seen.values():
                words.clear()
            return out.astype({"word": object, "n1": np.int64, "n0": np.int64})

        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"]):
                seen[int(label)].update(words_of(text))
                if len(seen[0]) + len(seen[1]) > COUNTED_WORDS:
                    yield flush()
        yield flush()

    partial = labelled.select("text", "toxic").mapInPandas(count, "word string, n1 long, n0 long")
    return partial.groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def gram_counts(words: DataFrame) -> DataFrame:
    """(word, n1, n0) of distinct words -> (gram, n1, n0): the sums over the places of each n-gram, by its hash."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            h, of = hashed_grams(batch["word"].tolist())
            order = np.argsort(h, kind="stable")
            h, of = h[order], of[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            sums = [np.add.reduceat(batch[c].to_numpy(dtype=np.int64)[of], first) for c in ("n1", "n0")]
            yield pd.DataFrame({"gram": h[first], "n1": sums[0], "n0": sums[1]})

    partial = words.mapInPandas(count, "gram long, n1 long, n0 long")
    return partial.groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def select_features(counts: DataFrame, max_features: int = MAX_FEATURES, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the model (sorted hashes) and their log-count ratios."""
    kept = counts.where((F.col("n1") + F.col("n0")) >= min_count)
    total = counts.agg(F.sum("n1").alias("t1"), F.sum("n0").alias("t0"), F.count(F.lit(1)).alias("v")).first()
    if not total["t1"] or not total["t0"]:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    d1, d0 = total["t1"] + ALPHA * total["v"], total["t0"] + ALPHA * total["v"]
    ratio = F.log((F.col("n1") + ALPHA) / d1) - F.log((F.col("n0") + ALPHA) / d0)
    evidence = F.abs(F.col("n1") - (F.col("n1") + F.col("n0")) * F.lit(d1 / (d1 + d0))) / F.sqrt(F.col("n1") + F.col("n0"))
    top = kept.select("gram", ratio.alias("r"), evidence.alias("e")).orderBy(F.desc("e"), "gram").limit(max_features)
    rows = sorted((r["gram"], r["r"]) for r in top.collect())  # max_features at most
    return np.array([g for g, _ in rows], dtype=np.int64), np.array([r for _, r in rows])


class Features:
    """Which of the model's n-grams texts have; remembers those of words."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        # Numbers of the n-grams of word i: flat[starts[i]:starts[i + 1]].
        self.flat, self.starts = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.index]
        if len(self.index) + len(new) > CACHED_WORDS:
            self._forget()
            new = list(words)
        if not new:
            return
        h, of = hashed_grams(new)
        at = np.searchsorted(self.grams, h)
        at[at == len(self.grams)] = 0
        hit = self.grams[at] == h if len(self.grams) else np.zeros(len(h), dtype=bool)
        order = np.argsort(of[hit], kind="stable")
        sizes = np.bincount(of[hit], minlength=len(new))
        self.index.update(zip(new, range(len(self.starts) - 1, len(self.starts) - 1 + len(new))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, at[hit][order].astype(np.int32)])

    def present(self, texts: list[str | None]) -> np.ndarray:
        """(texts, n-grams) booleans."""
        words = [words_of(t) for t in texts]
        self._learn(set().union(*words))
        out = np.zeros((len(texts), len(self.grams)), dtype=bool)
        sizes = [len(own) for own in words]
        word = np.fromiter((self.index[w] for own in words for w in own), dtype=np.int64, count=sum(sizes))
        n = self.starts[word + 1] - self.starts[word]
        ends = np.cumsum(n)
        at = np.repeat(self.starts[word] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        out[np.repeat(np.repeat(np.arange(len(texts)), sizes), n), self.flat[at]] = True
        return out

    def groups(self, texts) -> Iterator[np.ndarray]:
        """``present`` of successive texts, a bounded number of characters or a single text at a time."""
        group, size = [], 0
        for t in texts:
            if group and (size + len(t or "") > GROUP_CHARS or len(group) == GROUP_TEXTS):
                yield self.present(group)
                group, size = [], 0
            group.append(t)
            size += len(t or "")
        if group:
            yield self.present(group)


def fit(
    rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, l2: float = 1e-3, steps: int = 400, stands: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Weights (already times r) and bias, by Adam on the whole sample; ``stands``: for how many rows each row stands."""
    stands = np.ones(len(rows)) if stands is None else stands
    toxic = (stands * labels).sum()
    bias = float(np.log((toxic + 1) / (stands.sum() - toxic + 2)))
    if not len(ratios) or labels.min() == labels.max():
        return np.zeros(len(ratios)), bias
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows).astype(np.int64)
    r = np.clip(ratios, -6, 6)
    value = r[column]
    w, m, v = np.zeros(len(r) + 1), np.zeros(len(r) + 1), np.zeros(len(r) + 1)
    w[-1] = bias
    for t in range(1, steps + 1):
        z = np.bincount(at, weights=w[column] * value, minlength=len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * stands / stands.sum()
        g = np.append(np.bincount(column, weights=error[at] * value, minlength=len(r)) + l2 * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w[:-1] * r, float(w[-1])


_models: dict[str, tuple] = {}


class Toxicity:
    """A fitted model: ``score(text)`` is a column."""

    def __init__(self, spark, grams: np.ndarray, weights: np.ndarray, bias: float):
        self.data, self.key = spark.sparkContext.broadcast((grams, weights, bias)), uuid.uuid4().hex

    def score(self, text: Column) -> Column:
        """Probability of label 1."""
        data, key = self.data, self.key

        @F.pandas_udf("double")
        def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from pulse.llm.toxicity import _models as made

            if key not in made:
                made.clear()
                grams, weights, bias = data.value
                made[key] = (Features(grams), weights, bias)
            features, weights, bias = made[key]
            for s in texts:
                for there in features.groups(s):
                    z = there @ weights + bias
                    yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))

        return of(text)


def _with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Broadcasts the labels when they are few enough, else joins by shuffles."""
    few = labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    return docs.join(F.broadcast(labels) if few else labels, "id")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_features: int = MAX_FEATURES, min_count: int = MIN_COUNT
) -> Toxicity:
    """Fits on the documents (id, text) that have a label.

    The model has the ``max_features`` n-grams of the strongest evidence among
    those that ``min_count`` labelled documents or more have.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).alias("toxic"))
    )
    grams, ratios = select_features(write_out(gram_counts(word_counts(_with_labels(texts, marks))), "gram-counts"), max_features, min_count)

    lookup = spark.sparkContext.broadcast(grams)

    @F.pandas_udf("binary")
    def numbers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(lookup.value)
        for s in batches:
            for there in features.groups(s):
                yield pd.Series([np.flatnonzero(row).astype(np.int32).tobytes() for row in there], dtype=object)

    # Labels of ids that no document has must not use up the sample: only those of documents are drawn from.
    labelled = write_out(_with_labels(texts.select("id"), marks).groupBy("id", "toxic").count(), "labelled")
    first = lambda df, t, *by: df.where(F.col("toxic") == t).orderBy(F.xxhash64("id"), "id", *by).limit(MAX_FIT_ROWS)
    sample = first(labelled, 0).union(first(labelled, 1)).select("id", "toxic")
    drawn_rows = texts.join(F.broadcast(sample), "id").select("id", "toxic", F.xxhash64("text").alias("h"), numbers("text").alias("f"))
    drawn_rows = write_out(drawn_rows, "fit-rows")
    rows = first(drawn_rows, 0, "h").collect() + first(drawn_rows, 1, "h").collect()  # an id may have many rows
    rows.sort(key=lambda r: (r["id"], bytes(r["f"])))
    vectors = [np.frombuffer(bytes(r["f"]), dtype=np.int32) for r in rows]
    toxic = np.array([r["toxic"] for r in rows], dtype=int)
    every = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.sum("count").alias("n")).collect()}
    drawn = np.bincount(toxic, minlength=2)
    stands = np.array([every.get(t, 0) / max(1, drawn[t]) for t in (0, 1)])[toxic]
    weights, bias = fit(vectors, toxic.astype(float), ratios, stands=stands) if rows else (np.zeros(len(ratios)), -1.0)
    return Toxicity(spark, grams, weights, bias)
