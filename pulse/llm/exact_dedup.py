"""Exact deduplication of normalised texts, with DataFrame operations only.

Texts are grouped by their 128-bit MD5 hash *and* the text itself, so that the
aggregation compares the bytes of rows that share a hash: a hash collision
gives two classes, never a false copy.  The grouping aggregates before its
shuffle, so a text that makes up a third of all rows crosses it as one row a
task.

Defined cases: a null text counts as empty, and all empty texts are copies of
each other.  Null ids never win over an id; a class without any id keeps one
row whose id is null.  Rows that repeat an id and a text are marked alike in
``verdicts``; ``keep_one`` returns one of them.  Columns other than the id and
the text may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulse.llm.common import lower_ascii


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id (largest id of the class), group_size, kept, text_sha256."""
    keyed = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm")).withColumn(
        "hash", F.unhex(F.md5("norm"))
    )
    by_text = keyed.groupBy("hash", "norm").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # The class of a row is its hash and, to tell apart texts whose hashes
    # collide, the SHA-256 of the text that the byte-wise grouping separated.
    classes = by_text.select("hash", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size")
    rows = keyed.select("id", "hash", F.unhex(F.sha2("norm", 256)).alias("sha"))
    return rows.join(classes, ["hash", "sha"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with all columns: that of the largest id, ties by the other columns."""
    row = F.struct(F.col(id_col).alias("k"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    norm = normalised(F.col(text_col))
    return (
        docs.select(norm.alias("norm"), row.alias("r"))
        .withColumn("hash", F.unhex(F.md5("norm")))
        .groupBy("hash", "norm")
        .agg(F.max("r").alias("r"))
        .select("r.row.*")
    )
