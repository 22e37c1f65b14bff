"""Readers for the driver's parquet tables.

Known tables are read with a declared schema: no schema-inference job runs
per read, and a changed file fails loudly instead of shifting types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Projections and filters applied later reach the scan."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(path)
