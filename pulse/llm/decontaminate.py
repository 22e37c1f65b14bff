"""Benchmark decontamination by winnowing, with DataFrame operations only.

A *window* is ``span`` consecutive words of a benchmark item; an item of fewer
words is one window.  A document word is hit if it lies inside an occurrence of
a window.

Winnowing: of the ``span - k + 1`` k-gram hashes inside each window, the
smallest (ties: the leftmost) is the window's fingerprint.  The choice depends
on the window's words alone, so wherever a window occurs in a document, the
document's winnowing picks the k-gram at the same offset: every shared span of
``span`` words meets in the join, whatever surrounds it.  Items shorter than
``span`` meet by the hash of their whole word sequence.

1. One pass over the documents makes the word array, winnows it, and keeps the
   picks whose hash falls in a slot that a window's hash falls in (the number of
   slots is fixed; it only spares rows to the join).  Each pick carries its
   neighbouring words.
2. The picks of all documents are joined with the benchmark's windows on the
   hash and extended: the ``span`` words around the pick must equal the window.
3. Occurrences are united per document into hit words and items.

Only picks and counts are shuffled, never texts.

Defined cases: null or empty texts and items have no words; repeated documents
are judged row by row; repeated items (equal item_id) count once; an item with
a null id counts as an item with an empty id; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulse.llm.common import lower_ascii, write_out

SPAN = 10
K = 5
POSITION_BITS = 30  # a string has less than 2^30 words
SLOTS = 1 << 16  # of hashes that the benchmark may mark; a plan holds half of them at most
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_A_WORD), "")


def gram_hash(words: Column, start: Column, n: int) -> Column:
    """Hash of n words from a 0-based start."""
    return F.xxhash64(F.lit(n), *[F.get(words, start + j) for j in range(n)])


def _marked(hash_: Column, start: Column) -> Column:
    """The hash with its low bits replaced by the position: sorts by hash, then leftmost."""
    low = (1 << POSITION_BITS) - 1
    return hash_.bitwiseAND(F.lit(~low)).bitwiseOR(start.cast("long"))


def _hash_of(mark: Column) -> Column:
    return F.shiftright(mark, POSITION_BITS)


def _position_of(mark: Column) -> Column:
    return mark.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")


def _range(n: Column) -> Column:
    """0 .. n-1, empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def winnow(words: Column, marks: Column, span: int, k: int) -> Column:
    """Picked marks: the smallest in each window of span - k + 1 successive marks, each once."""
    w = span - k + 1
    lowest = lambda i: F.least(*[F.get(marks, i + j) for j in range(w)])
    return F.array_distinct(F.transform(_range(F.size(words) - (span - 1)), lowest))


def marks_of(words: Column, k: int) -> Column:
    return F.transform(_range(F.size(words) - (k - 1)), lambda i: _marked(gram_hash(words, i, k), i))


def benchmark_windows(items: DataFrame, span: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct (size, words, hash, offset) of all windows, each with an id, and their items.

    hash: of the window's pick (or of all its words, if short); offset: of the pick in the window.
    """
    of = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(text_col)).alias("w"))
    size = F.least(F.size("w"), F.lit(span))
    windows = (
        of.where(F.size("w") > 0)
        .select("item", size.alias("size"), F.explode(F.transform(_range(F.size("w") - size + 1), lambda i: F.slice(F.col("w"), i + 1, size))).alias("words"))
        .groupBy("size", "words")
        .agg(F.collect_set("item").alias("items"))
    )
    marks = marks_of(F.col("words"), k)
    pick = F.array_min(marks)
    short = F.coalesce(*[F.when(F.col("size") == n, gram_hash(F.col("words"), F.lit(0), n)) for n in range(1, span)])
    return windows.select(
        "size",
        "words",
        "items",
        F.when(F.col("size") == span, _hash_of(pick)).otherwise(_hash_of(short)).alias("hash"),
        F.when(F.col("size") == span, _position_of(pick)).otherwise(0).alias("offset"),
    )


def _slot(hash_: Column) -> Column:
    return hash_.bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def _known(hash_: Column, slots: list[int]) -> Column:
    """False for hashes that no window has; true for the others and some more."""
    return F.lit(True) if len(slots) > SLOTS // 2 else _slot(hash_).isin(slots) if slots else F.lit(False)


def _picks(docs: DataFrame, windows: DataFrame, span: int, k: int) -> DataFrame:
    """docs (id, text) -> row, id, n_words, picks (size, hash, at, start, context), written once."""
    slots = sorted(r[0] for r in windows.select(_slot(F.col("hash"))).distinct().collect())  # SLOTS at most
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # span at most
    words = F.col("words")

    def pick(size: int, hash_: Column, at: Column, before: int) -> Column:
        start = F.greatest(at - before, F.lit(0))
        return F.struct(
            F.lit(size).alias("size"),
            hash_.alias("hash"),
            at.alias("at"),
            start.alias("start"),
            F.slice(words, start + 1, at + size - start).alias("context"),
        )

    rows = docs.select("id", words_of(F.col("text")).alias("words"))

    def short(n: int) -> Column:
        at = F.filter(_range(F.size(words) - (n - 1)), lambda i: _known(_hash_of(gram_hash(words, i, n)), slots))
        return F.transform(at, lambda i: pick(n, _hash_of(gram_hash(words, i, n)), i, 0))

    found = []
    for n in sizes:
        if n < span:
            found.append(short(n))
        else:
            rows = rows.withColumn("marks", marks_of(words, k))
            picked = F.filter(winnow(words, F.col("marks"), span, k), lambda m: _known(_hash_of(m), slots))
            found.append(F.transform(picked, lambda m: pick(span, _hash_of(m), _position_of(m), span - k)))
    none = F.array().cast("array<struct<size:int,hash:bigint,at:int,start:int,context:array<string>>>")
    picks = rows.select(
        F.monotonically_increasing_id().alias("row"), "id", F.size(words).alias("n_words"), F.concat(none, *found).alias("picks")
    )
    return write_out(picks, "winnowed")


def hits(
    docs: DataFrame,
    items: DataFrame,
    span: int = SPAN,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, n_words, n_hit (words inside occurrences), items (sorted ids as text)."""
    windows = write_out(benchmark_windows(items, span, k, item_col, item_text_col), "windows")
    rows = _picks(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), windows, span, k)
    begin = F.col("at") - F.col("offset")
    occurrences = (
        rows.select("row", F.inline("picks"))
        .join(windows, ["size", "hash"])
        .where((begin >= 0) & (F.slice("context", F.greatest(begin - F.col("start"), F.lit(0)) + 1, F.col("size")) == F.col("words")))
    )
    covered = F.transform(F.sequence(begin, begin + F.col("size") - 1), lambda p: F.struct(p.alias("at"), F.lit(None).cast("string").alias("item")))
    by_item = F.transform("items", lambda x: F.struct(F.lit(None).cast("int").alias("at"), x.alias("item")))
    per_row = (
        occurrences.select("row", F.inline(F.concat(covered, by_item)))
        .distinct()
        .groupBy("row")
        .agg(F.count("at").alias("n_hit"), F.array_sort(F.collect_list("item")).alias("items"))
    )
    return rows.join(per_row, "row", "left").select(
        F.col("id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a hit word."""
    key = F.xxhash64(F.col(id_col), F.col(text_col))  # rows with equal ids and texts have equal verdicts
    keyed = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    dirty = hits(keyed, items, id_col="key", **options).where("n_hit > 0").select(F.col("key").alias("dirty")).distinct()
    rows = docs.select(key.alias("key"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    return rows.join(dirty, F.col("key") == F.col("dirty"), "left_anti").select("row.*")
