"""SRC3 + J2 over catalogue tables: bucketed, sorted, joined without a shuffle.

``colocate`` writes a fact and a dimension table into the same number of buckets
of the join key (``bucketBy``, ``sortBy``, ``saveAsTable``), so that every later
join of the two reads bucket by bucket.  The shuffle is paid once, on writing.

A key that a bucket cannot take (more rows than a bucket's share of the table)
is salted: its rows go to several buckets, and its dimension row is written into
each of them.  No more keys than buckets can be that frequent, which bounds the
list that is broadcast while writing.

Tables are external, under the shared work folder; each call makes new ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulse.plans import views
from pulse.session import fresh_path

BUCKETS = 16
SALT = "_salt"


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> str:
    """Writes a table with one file a bucket, sorted by the keys; its name in the catalogue."""
    table = f"{name}_{uuid.uuid4().hex[:8]}"
    writer = df.repartition(buckets, *keys).write.format("parquet").option("path", fresh_path(df.sparkSession, f"table-{name}"))
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return table


def colocate(facts: DataFrame, dimension: DataFrame, key: str, dimension_key: str, name: str, buckets: int = BUCKETS) -> tuple[str, str]:
    """The names of the two tables, both bucketed by (``key``, salt); rows without a key are left out of both.

    ``dimension`` has one row a key.
    """
    facts = facts.where(F.col(key).isNotNull())
    dimension = dimension.where(F.col(dimension_key).isNotNull()).withColumnRenamed(dimension_key, key)
    total = facts.count()
    share = max(1, total // buckets)
    counts = facts.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > share)
    hot = F.broadcast(counts.select("_key", F.least(F.ceil(F.col("_n") / share), F.lit(buckets)).cast("int").alias("_parts")))  # at most ``buckets`` rows
    salted = facts.withColumn("_row", F.xxhash64(*facts.columns)).join(hot, F.col(key) == F.col("_key"), "left")
    salted = salted.withColumn(SALT, F.coalesce(F.pmod("_row", "_parts"), F.lit(0)).cast("int")).drop("_row", "_key", "_parts")
    copies = dimension.join(hot, F.col(key) == F.col("_key"), "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0))))
    )
    keys = [key, SALT]
    return save_bucketed(salted, name, keys, buckets), save_bucketed(copies.drop("_key", "_parts"), f"{name}_{key}", keys, buckets)


def join_colocated(spark: SparkSession, facts: str, dimension: str, key: str) -> DataFrame:
    """Each fact with its dimension row, left outer."""
    return spark.table(facts).join(spark.table(dimension), [key, SALT], "left").drop(SALT)


def bucketed_status_user_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 from tables bucketed by user and by place; narrow rows meet by status id in the end."""
    status, user, place = views.narrow_tables(spark, sf_dir)
    by_user = join_colocated(spark, *colocate(status, user, "user_id", "user_id", "status_of_user"), "user_id")
    placed = status.select("id", "place_id")
    by_place = join_colocated(spark, *colocate(placed, place, "place_id", "place_id", "status_of_place"), "place_id")
    rows = by_user.unionByName(by_place, allowMissingColumns=True)
    rows = rows.unionByName(status.where("user_id is null"), allowMissingColumns=True)
    rest = [c for c in rows.columns if c != "id"]
    return rows.groupBy("id").agg(*[F.max(c).alias(c) for c in rest])
