"""F7 / F8 with thousands of keywords: an inverted index on a 3-gram of each keyword.

A chain of ``contains`` costs a search of the text for every keyword.  Here each
keyword is filed under one of its 3-grams, the one that fewest keywords have.
The 3-gram at each place of a text is looked up in that index, and the keywords
found are compared at that place only.  So the time grows with the text and its
near matches, not with the number of keywords times the length of the text.

The index is broadcast if it fits into ``INDEX_BYTES``; a larger keyword table is
worked off in that many parts, each a scan of the texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulse.functions.sizing import ROW_BYTES
from pulse.session import materialize

GRAM = 3
WINDOW = 32  # characters compared at a place
INDEX_BYTES = 32 << 20


def windows(text: Column, length: int) -> Column:
    """The substring of ``length`` characters (fewer at the end) from each place."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{length}}}))"), F.lit(1))


def keyword_index(keywords: DataFrame, column: str = "keyword") -> DataFrame:
    """(gram, size, at, keyword): each distinct keyword, in lower case, under one gram, which it has ``at`` some place.

    A keyword shorter than a gram is its own.  Null and empty keywords are left out.
    """
    words = keywords.select(F.lower(column).alias("keyword")).where("keyword <> ''").distinct()
    size = F.least(F.length("keyword"), F.lit(GRAM))
    pairs = words.select("keyword", size.alias("size"), F.posexplode(windows(F.col("keyword"), GRAM)).alias("at", "gram"))
    pairs = pairs.where(F.length("gram") == F.col("size"))
    pairs = pairs.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("gram")))
    rarest = Window.partitionBy("keyword").orderBy("n", "gram", "at")
    return pairs.withColumn("k", F.row_number().over(rarest)).where("k = 1").select("gram", "size", "at", "keyword")


def on_tracks(statuses: DataFrame, keywords: DataFrame, column: str = "keyword", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """(kept columns, keyword): each keyword that a status's text holds, ignoring case; distinct rows.

    Null texts hold none.
    """
    index = materialize(keyword_index(keywords, column), "keyword-index")
    sizes = sorted(r["size"] for r in index.select("size").distinct().collect())  # at most GRAM rows
    if not sizes:
        return statuses.limit(0).select(*keep, F.lit("").alias("keyword"))
    n_bytes = index.agg(F.sum(F.octet_length("gram") + F.octet_length("keyword") + ROW_BYTES)).first()[0]
    parts = 1 + 2 * n_bytes // INDEX_BYTES  # half full on average
    part = lambda i: index.where(F.pmod(F.xxhash64("keyword"), F.lit(parts)) == i)
    longest = min(WINDOW, index.agg(F.max(F.length("keyword"))).first()[0])
    low = statuses.select(*keep, F.lower("text").alias("_low"))
    rows = low.withColumn("_from", windows(F.col("_low"), longest))
    rows = rows.select(*keep, "_low", "_from", F.posexplode("_from").alias("_at", "_here"))
    if sizes == [GRAM]:
        rows = rows.withColumn("_gram", F.substring("_here", 1, GRAM))
    else:
        rows = rows.withColumn("_gram", F.explode(F.array_distinct(F.array(*[F.substring("_here", 1, n) for n in sizes]))))
    # Keywords longer than a window, and those with the mark that half a character reads as, are looked for in full.
    doubtful = (F.length("keyword") > longest) | F.contains("keyword", F.lit("?"))
    there = F.startswith(F.get("_from", F.col("_at") - F.col("at")), F.substring("keyword", 1, longest))
    found = []
    for i in range(parts):
        hits = rows.join(F.broadcast(part(i).select(F.col("gram").alias("_gram"), "at", "keyword")), "_gram")
        hits = hits.where(there & (~doubtful | F.contains("_low", F.col("keyword"))))
        found.append(hits.select(*keep, "keyword").distinct())
    return reduce(DataFrame.unionByName, found)
