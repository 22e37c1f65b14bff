"""Ranked lexical search on document FP-trees with branch and bound.

Every item (a row of a query table) ranks all documents by a length-normalised
sum of its terms' weights (``score`` below).

1. One scan restricts each document to a vector of the query terms that it
   holds, with their frequencies (tf) and its length; the vectors are written.
2. Counts over them give the number of documents, their length and the document
   frequency of each query term, hence the weights.
3. Each task takes the vectors in groups of ``TREE_DOCS``.  A group's vectors,
   their terms from the most to the least frequent, are a trie (FP-tree):
   documents that begin with the same terms share a path.  Sorted vectors make
   every subtree a range of documents, so a node is a range; runs of small
   neighbouring subtrees are one leaf of at most ``LEAF_DOCS`` documents.  A
   node keeps, for each term, the largest tf below it, and the smallest length
   factor m below it.
4. For each item the tree is searched depth first, the child of the highest
   bound first.  A bound scores the node's largest tfs with its smallest m, so
   no document below can score more; a subtree whose bound is under the item's
   k-th score so far is left out.  Scores in a leaf are exact.  The k-th score
   is carried from group to group.
5. A task returns k documents an item at most; the best k of these are the
   result.

What the driver holds is the query set: its terms, at most ``MAX_QUERY_TERMS``
in a pass; a larger set of items is worked off in several passes over the
documents.  A single item with more distinct terms than that is refused.
Nothing that grows with the documents is collected or broadcast, and only the
tasks' best k a item are shuffled.

Defined cases: null texts have no terms, as empty ones; documents without terms
count nowhere.  Documents that repeat an id are documents of their own; equal
scores go by ascending id, null ids last.  Rows that share an item id, null
included, are one item with the terms of all of them.  An item without terms, or
whose terms no document holds, has no rows; empty tables give none.  Other
columns are ignored, whatever their names.  A very long text is split into words
once, and held as its query terms only.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pulse.llm.common import lower_ascii, write_out

MAX_QUERY_TERMS = 200_000  # (item, term) pairs of a pass
TREE_DOCS = 8192
LEAF_DOCS = 64
BLOCK_TERMS = 4096  # distinct terms of the items whose bounds are held at once

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of terms, A-Z in lower case; a space for all others.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

#: The length factor of a document of n terms: 100 - SLOPE + SLOPE * n / average length.
SLOPE = 75


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Rises with tf and falls with m; 0 for tf 0."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# --- the query set ---------------------------------------------------------------------
def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, term, times)"""
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text), F.lit(""))), F.lit(f"({TERM})"), F.lit(1))
    rows = items.select(F.col(item_id).alias("item"), F.explode(words).alias("term"))
    return rows.groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


def passes(terms: DataFrame, at_most: int) -> Iterator[DataFrame]:
    """The terms of whole items, in parts of at most ``at_most`` rows."""
    total, parts = terms.count(), 1
    if total == 0:
        return
    while True:
        part = F.pmod(F.xxhash64("item"), F.lit(parts))
        largest = terms.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if largest <= at_most:
            break
        if parts > 64 * (1 + total // at_most):
            raise ValueError(f"an item has over {at_most} distinct terms")
        parts *= 2
    for i in range(parts):
        yield terms.where(part == i)


class Block:
    """Items whose distinct terms number BLOCK_TERMS at most (or a single item), with bounds on their own terms."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], vocabulary: int):
        self.terms = np.unique(np.concatenate([t for _, t, _ in items]))
        self.local = np.full(vocabulary, -1, dtype=np.int32)
        self.local[self.terms] = np.arange(len(self.terms))
        self.items = [(number, self.local[t], gain) for number, t, gain in items]


def blocks(items: list[tuple[int, np.ndarray, np.ndarray]], vocabulary: int) -> Iterator[Block]:
    held, seen = [], set()
    for item in items:
        more = seen.union(item[1].tolist())
        if held and len(more) > BLOCK_TERMS:
            yield Block(held, vocabulary)
            held, more = [], set(item[1].tolist())
        held.append(item)
        seen = more
    if held:
        yield Block(held, vocabulary)


# --- the tree ----------------------------------------------------------------------------
class Tree:
    """An FP-tree of restricted vectors: sorted documents, nodes as ranges of them, parents before children.

    ``docs`` has the input's row of each sorted document; ``term``, ``tf`` and
    ``impact`` its entries, from ``at[i]`` to ``at[i + 1]``.
    """

    def __init__(self, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, frequency_rank: np.ndarray):
        doc = np.repeat(np.arange(len(sizes)), sizes)
        rank = frequency_rank[term]
        by = np.lexsort((rank, doc))
        ends = np.cumsum(sizes)
        raw = rank[by].astype(">u4").tobytes()
        paths = [raw[4 * a : 4 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        order = [i for i in sorted(range(len(paths)), key=paths.__getitem__) if paths[i]]
        self.docs = np.array(order, dtype=np.int64)
        self.m = m[self.docs]
        n = sizes[self.docs]
        self.at = np.concatenate([[0], np.cumsum(n)])
        entries = by[np.repeat((ends - sizes)[self.docs] - self.at[:-1], n) + np.arange(self.at[-1])]
        self.term, self.tf = term[entries], tf[entries].astype(np.int64)
        self.impact = impact(self.tf, np.repeat(self.m, n))
        self._nodes(_shared_terms([paths[i] for i in order]))

    def _nodes(self, shared: np.ndarray) -> None:
        """``shared[i]``: terms at the head of both document i - 1 and i."""
        self.first, self.last, self.children = [0], [len(self.docs)], [[]]
        parent, todo = [-1], [0]
        while todo:
            node = todo.pop()
            a, b = self.first[node], self.last[node]
            if b - a <= LEAF_DOCS:
                continue
            inner = shared[a + 1 : b]
            cuts = [a, *(np.flatnonzero(inner == inner.min()) + a + 1).tolist(), b]
            for lo, hi in _grouped(cuts):
                child = len(self.first)
                self.first.append(lo)
                self.last.append(hi)
                self.children.append([])
                parent.append(node)
                self.children[node].append(child)
                todo.append(child)
        self.parent = parent
        leaf = sorted((i for i, c in enumerate(self.children) if not c), key=self.first.__getitem__)
        self.leaf_of = np.repeat(np.array(leaf, dtype=np.int64), [self.last[i] - self.first[i] for i in leaf])
        self.min_m = np.array([self.m[a:b].min(initial=np.iinfo(np.int64).max) for a, b in zip(self.first, self.last)])

    def largest_tfs(self, block: Block) -> np.ndarray:
        """Rows: nodes, columns: the block's terms."""
        local = block.local[self.term]
        used = local >= 0
        out = np.zeros((len(self.first), len(block.terms)), dtype=np.int64)
        node = np.repeat(self.leaf_of, np.diff(self.at))[used]
        np.maximum.at(out, (node, local[used]), self.tf[used])
        for i in range(len(self.first) - 1, 0, -1):  # children come after their parents
            np.maximum(out[self.parent[i]], out[i], out=out[self.parent[i]])
        return out

    def scores(self, leaf: int, gain: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's documents; ``gain`` has the item's weight times repeats of each term."""
        a, b = self.first[leaf], self.last[leaf]
        lo, hi = self.at[a], self.at[b]
        return np.add.reduceat(gain[self.term[lo:hi]] * self.impact[lo:hi], self.at[a:b] - lo)

    def search(self, bounds: np.ndarray, gain: np.ndarray, best: Best) -> int:
        """Depth first, the highest bound first; the number of documents that were scored."""
        stack, scored = [0], 0
        limit = bounds.tolist()
        while stack:
            node = stack.pop()
            if limit[node] < best.least:
                continue
            inner = self.children[node]
            if inner:
                stack += sorted(inner, key=limit.__getitem__)
            else:
                a = self.first[node]
                scored += self.last[node] - a
                scores = self.scores(node, gain)
                good = np.flatnonzero(scores >= best.least)
                if len(good):
                    best.add(scores[good].tolist(), self.docs[good + a].tolist())
        return scored


def _shared_terms(paths: list[bytes]) -> np.ndarray:
    out = np.zeros(len(paths), dtype=np.int64)
    for i in range(1, len(paths)):
        n = min(len(paths[i - 1]), len(paths[i]))
        x, y = (np.frombuffer(p, dtype=">u4", count=n // 4) for p in paths[i - 1 : i + 1])
        differ = np.flatnonzero(x != y)
        out[i] = differ[0] if len(differ) else n // 4
    return out


def _grouped(cuts: list[int]) -> Iterator[tuple[int, int]]:
    """Neighbouring ranges joined while they have at most LEAF_DOCS documents."""
    lo = cuts[0]
    for a, b in zip(cuts[1:], [*cuts[2:], None]):
        if b is None or b - lo > LEAF_DOCS:
            yield lo, a
            lo = a


class Best:
    """The k best (score, id) of an item so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.least, self.ids = k, [], 1, None

    def add(self, scores: list[int], rows: list[int]) -> None:
        ids = self.ids  # of the group at hand
        self.rows += [(-s, (ids[r] is None, ids[r])) for s, r in zip(scores, rows)]
        self.rows.sort(key=_by_score)
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


def _by_score(row):
    score, (missing, value) = row
    return (score, missing) if missing else (score, missing, value)


class Searcher:
    """Best k documents of every item over groups of vectors."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], frequency_rank: np.ndarray, k: int):
        self.rank, self.blocks = frequency_rank, list(blocks(items, len(frequency_rank)))
        self.best = {number: Best(k) for number, _, _ in items}
        self.scored = 0

    def add(self, ids: list, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> None:
        tree = Tree(sizes, term, tf, m, self.rank)
        if not len(tree.docs):
            return
        gain = np.zeros(len(self.rank), dtype=np.int64)
        for block in self.blocks:
            tfs = tree.largest_tfs(block)
            for number, local, own in block.items:
                best = self.best[number]
                best.ids = ids
                bounds = impact(tfs[:, local], tree.min_m[:, None]) @ own
                gain[block.terms[local]] = own
                self.scored += tree.search(bounds, gain, best)
                gain[block.terms[local]] = 0


# --- jobs ----------------------------------------------------------------------------------
_vocabularies: dict[str, dict[bytes, int]] = {}


def restricted(docs: DataFrame, doc_id: str, text: str, vocabulary: list[str]) -> DataFrame:
    """(doc, n, terms, tfs) of the documents with at least one term; terms are places in ``vocabulary``."""
    shared, key = docs.sparkSession.sparkContext.broadcast(vocabulary), uuid.uuid4().hex

    @F.pandas_udf("n long, terms array<int>, tfs array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from pulse.llm.fp_rank import _vocabularies as made

        if key not in made:
            made.clear()
            made[key] = {t.encode(): i for i, t in enumerate(shared.value)}
        number = made[key].get
        for s in batches:
            n, terms, tfs = [], [], []
            for t in s:
                words = terms_of(t)
                n.append(len(words))
                ids, counts = np.unique(np.array([x for x in map(number, words) if x is not None], dtype=np.int32), return_counts=True)
                terms.append(ids)
                tfs.append(counts.astype(np.int32))
            yield pd.DataFrame({"n": n, "terms": pd.Series(terms, dtype=object), "tfs": pd.Series(tfs, dtype=object)})

    rows = docs.select(F.col(doc_id).alias("doc"), of(F.col(text)).alias("v"))
    return rows.select("doc", "v.*").where("n > 0")


def _searched(vectors: DataFrame, items: list, frequency_rank: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc, score): the best k of each task."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, frequency_rank))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*shared.value, k)
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc").type
            for a in range(0, batch.num_rows, TREE_DOCS):
                part = batch.slice(a, TREE_DOCS)
                terms, tfs = part.column("terms"), part.column("tfs")
                sizes = np.diff(terms.offsets.to_numpy())
                n = part.column("n").to_numpy().astype(np.int64)
                m = 100 - SLOPE + (SLOPE * n * n_docs) // n_terms
                flat = lambda x: x.flatten().to_numpy(zero_copy_only=False)
                searcher.add(part.column("doc").to_pylist(), sizes.astype(np.int64), flat(terms), flat(tfs), m)
        rows = [(number, value, -s) for number, best in searcher.best.items() for s, (_, value) in best.rows]
        if rows:
            number, value, score = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(value, kind), pa.array(score, pa.int64())], ["item", "doc", "score"])

    kind = vectors.schema["doc"].dataType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc", kind), T.StructField("score", T.LongType())])
    return vectors.select("doc", "n", "terms", "tfs").mapInArrow(search, schema)


def _pass(spark: SparkSession, docs: DataFrame, terms: DataFrame, doc_id: str, text: str, k: int) -> DataFrame | None:
    """(item, doc, score) of the items of ``terms``, at least their best k."""
    rows = terms.collect()  # at most MAX_QUERY_TERMS
    vocabulary = sorted({r.term for r in rows})
    place = {t: i for i, t in enumerate(vocabulary)}
    vectors = write_out(restricted(docs, doc_id, text, vocabulary), "term-vectors")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    counts = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in counts.collect():  # one row a query term at most
        df[r.t] = r.df
    frequency_rank = np.empty(len(vocabulary), dtype=np.uint32)
    frequency_rank[np.argsort(-df, kind="stable")] = np.arange(len(vocabulary))
    of_item: dict = {}
    for r in rows:
        if df[place[r.term]]:
            of_item.setdefault(r["item"], []).append((place[r.term], r.times * weight(n_docs, int(df[place[r.term]]))))
    if not of_item:
        return None
    items = [(number, *np.array(sorted(pairs), dtype=np.int64).T) for number, pairs in enumerate(of_item.values())]
    found = _searched(vectors, items, frequency_rank, n_docs, n_terms, k)
    kind = terms.schema["item"].dataType
    names = spark.createDataFrame(list(enumerate(of_item)), T.StructType([T.StructField("item", T.LongType()), T.StructField("_id", kind)]))
    return found.join(F.broadcast(names), "item").select(F.col("_id").alias("item"), "doc", "score")


def top_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item id, rank, document id, score): each item's ``k`` documents of the highest score above 0.

    Terms are maximal matches of ``TERM``, A-Z in lower case.  A score is the
    sum over the item's terms, repeats included, of ``weight`` times ``impact``.
    """
    spark = docs.sparkSession
    found = None
    for part in passes(write_out(query_terms(items, item_id, item_text), "query-terms"), MAX_QUERY_TERMS):
        rows = _pass(spark, docs, part, doc_id, text, k)
        if rows is not None:
            found = rows if found is None else found.unionByName(rows)
    if found is None:
        empty = T.StructType([T.StructField("item", items.schema[item_id].dataType), T.StructField("doc", docs.schema[doc_id].dataType), T.StructField("score", T.LongType())])
        found = spark.createDataFrame([], empty)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")
