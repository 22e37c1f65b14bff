"""A training-data pipeline of the operators in ``pulse.llm``: raw documents to token ids.

Every stage reads all that its predecessor kept and takes effect: toxic
documents go, one document of each class of equal texts stays, one of each
SimHash component stays, documents with benchmark passages go, and what is left
becomes token ids.

Defined cases are those of the operators: null texts count as empty, tables may
be empty, and documents may have further columns, which all but the last stage
hand on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulse.llm import decontaminate, exact_dedup, queries, simhash
from pulse.llm.common import table, write_out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; learns from the labelled documents outside the held-out fold."""
    model = queries.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the largest id of each class of equal texts."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each SimHash component (3-word shingles, 2 bits)."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a 10-word window of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (token ids), n_tokens, ids_sha256, decoded_sha256."""
    return queries.token_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", tokenise),
]

#: A trained classifier and a tokenizer are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; what a stage keeps is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
