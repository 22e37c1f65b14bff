"""SimHash near-duplicates: Golay-code fuzzy hashing of 64-bit fingerprints.

1. *Fingerprint.*  Word shingles are hashed with XXH64 (seed 42); a bit of the
   fingerprint is 1 if it is set in over half of the hashes.  Equal
   fingerprints collapse to one row before anything is joined, so groups of
   copies cost one row.
2. *Keys.*  A fingerprint has three segments of 22, 21 and 21 bits.  Of two
   fingerprints at most two bits apart, one segment has no error (pigeonhole),
   and the next segment has two at most, so its one-bit balls decode to a
   common Golay codeword.  The keys are (exact segment, codeword index of the
   next one): 3 to 18 a fingerprint.
3. *Join and verify.*  Fingerprints meet by key.  A bucket of up to
   ``SMALL_BUCKET`` members is verified pair by pair and gives a spanning
   forest, not all its pairs.  Members of larger buckets meet by an exact
   linear way instead: two fingerprints are within two bits if and only if
   they share one of the 65 words at distance 0 or 1, so each emits those words
   and is linked to the smallest fingerprint at the same word.
4. *Components* of the links, see ``components``.

Defined cases: a null text counts as empty; a text without words has
fingerprint zero and links like any other; a text with fewer words than the
shingle has one shingle of all its words.  Null ids take part in links but
never name a component (a component without any id has a null name).  Repeated
rows get equal results.  Columns other than id and text may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pulse.llm.common import write_out
from pulse.llm.components import components
from pulse.llm.golay import ball_indices

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
MAX_BITS = 2  # what the Golay balls and the pigeonhole guarantee
SMALL_BUCKET = 64
CHUNK = 8192  # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one text as an unsigned 64-bit integer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # splits at [\x20\x09-\x0D], lower-cases A-Z
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    counts, total = np.zeros(64, dtype=np.int64), len(starts)
    for i in range(0, total, CHUNK):
        h = np.array(
            [xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts[i : i + CHUNK], ends[i : i + CHUNK])],
            dtype="<u8",
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    """The fingerprint as a (signed) long."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], dtype=np.uint64).view(np.int64))

    return of(text)


def golay_keys(prints: np.ndarray) -> list[np.ndarray]:
    """Join keys of each fingerprint."""
    u = prints.astype(np.int64).view(np.uint64)
    parts = [((u >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    keys, fresh = [], []
    for i in range(3):
        j = (i + 1) % 3
        found, first = ball_indices(parts[j], SEGMENTS[j][1])
        keys.append(np.int64(i) << 40 | parts[i][:, None] << 12 | found)
        fresh.append(first)
    keys, fresh = np.concatenate(keys, axis=1), np.concatenate(fresh, axis=1)
    return [k[f] for k, f in zip(keys, fresh)]


def _key_column(fp: Column) -> Column:
    @F.pandas_udf("array<long>")
    def of(prints: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in prints:
            v = s.to_numpy(dtype=np.int64)
            out: list[np.ndarray] = []
            for i in range(0, len(v), 4096):
                out += golay_keys(v[i : i + 4096])
            yield pd.Series(out, dtype=object)

    return of(fp)


def forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members at most ``max_bits`` apart."""
    u = np.unique(members.astype(np.int64))
    near = np.bitwise_count(u.view(np.uint64)[:, None] ^ u.view(np.uint64)[None, :]) <= max_bits
    links, unseen = [], np.ones(len(u), dtype=bool)
    for root in range(len(u)):
        if not unseen[root]:
            continue
        unseen[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            for x in np.flatnonzero(near[at] & unseen):
                unseen[x] = False
                queue.append(x)
                links.append((int(u[at]), int(u[x])))
    return links


def _links(prints: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links whose components are those of all pairs of prints at most max_bits apart."""
    keyed = write_out(prints.select("fp", F.explode(_key_column(F.col("fp"))).alias("key")), "golay-keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = write_out(keyed.join(sizes, "key"), "golay-shared")

    @F.pandas_udf("array<struct<a:long,b:long>>")
    def verified(buckets: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in buckets:
            yield pd.Series([[{"a": a, "b": b} for a, b in forest(np.asarray(m), max_bits)] for m in s], dtype=object)

    small = (
        shared.where(F.col("n") <= SMALL_BUCKET)
        .groupBy("key")
        .agg(F.collect_list("fp").alias("members"))
        .select(F.inline(verified("members")))
    )
    balls = F.array("fp", *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])
    large = shared.where(F.col("n") > SMALL_BUCKET).select("fp").distinct()
    at = large.select("fp", F.explode(balls).alias("word"))
    lowest = at.groupBy("word").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = at.join(lowest, "word").where("fp <> low").select(F.col("low").alias("a"), F.col("fp").alias("b"))
    return small.union(stars).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (smallest id of the component)."""
    if max_bits != MAX_BITS:
        raise ValueError(f"the segments and codewords are laid out for max_bits = {MAX_BITS}")
    rows = write_out(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")), "fingerprints"
    )
    prints = rows.groupBy("fp").agg(F.min("id").alias("low"))
    roots = components(_links(prints.select("fp"), max_bits))
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(of_print, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their component; rows without an id stay."""
    ids = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    gone = ids.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone")).distinct()
    rows = docs.select(F.col(id_col).alias("k"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    return rows.join(gone, F.col("k") == F.col("gone"), "left_anti").select("row.*")
