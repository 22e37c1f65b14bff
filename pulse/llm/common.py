"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulse.session import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.

    ``lower`` does just that for a pure ASCII text, and is far faster than
    ``translate``, which the other texts take.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def crc_bucket(doc_id: Column, of: int = 5) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % of


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def write_out(df: DataFrame, name: str, arrow_rows: int | None = None) -> DataFrame:
    """Compute ``df`` once into a table in the shared work folder, and read that.

    ``arrow_rows`` bounds the rows that a Python worker gets at once, for this
    table only: where rows are large (whole word lists), their number times
    their size is what a worker holds.
    """
    spark = df.sparkSession
    path = fresh_path(spark, f"llm-{name}")
    before = spark.conf.get(ARROW_ROWS)
    if arrow_rows:
        spark.conf.set(ARROW_ROWS, str(min(arrow_rows, int(before)) if int(before) > 0 else arrow_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """(pyarrow file system, path) of a URI or a plain path: shared local folders and object stores alike."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
