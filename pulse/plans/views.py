"""SRC3 and J2: the ten result tables registered for Spark SQL.

The reference exposes its keyed tables to SQL clients through
``CREATE TABLE ... USING`` on a SQL service.  Here each table is a
merge-on-read DataFrame registered as a session view; any SQL over them is
planned by Catalyst like any other query (views are inlined, so filters and
projections of the SQL reach the parquet scans of the driver tables).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulse.operators.keyed import RowLog
from pulse.plans import batch
from pulse.session import fresh_path, materialize

# --- fixed values: the reference's result table names ----------------------
TABLES = (
    "tweet",
    "distinct_user",
    "hashtag",
    "toptweeter",
    "location",
    "trump_sentiment",
    "russia_sentiment",
    "status_hifi",
    "user_hifi",
    "place_hifi",
)
# ---------------------------------------------------------------------------


def result_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "tweet": batch.status_ids(spark, sf_dir),
        "distinct_user": batch.counter_user(spark, sf_dir),
        "hashtag": batch.counter_hashtag(spark, sf_dir),
        "toptweeter": batch.counter_retweeter(spark, sf_dir),
        "location": batch.geo_points(spark, sf_dir),
        "trump_sentiment": batch.sentiment_b(spark, sf_dir),
        "russia_sentiment": batch.sentiment_a(spark, sf_dir),
        "status_hifi": batch.upsert_statuses(spark, sf_dir),
        "user_hifi": batch.upsert_users(spark, sf_dir),
        "place_hifi": batch.upsert_places(spark, sf_dir),
    }


def register_tables(spark: SparkSession, sf_dir: str, prefix: str = "") -> list[str]:
    """Register the ten tables as temporary views; returns their names."""
    names = []
    for name, df in result_tables(spark, sf_dir).items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def register_parquet_table(spark: SparkSession, name: str, path: str) -> None:
    """``CREATE TABLE ... USING parquet`` over a written table or snapshot."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING parquet OPTIONS (path '{path}')")


def register_log(
    spark: SparkSession, name: str, path: str, key: Sequence[str] = (), order: Sequence[str] = (), amount: str | None = None
) -> None:
    """A written row log as a view of its current rows: a counter's totals (``amount``) or the latest row of each key.

    The view reads the log's files whenever it is queried; columns of the order
    (all beginning with ``_``) are left out.
    """
    log = RowLog(spark, path)
    rows = log.totals(list(key), amount) if amount else log.current(list(key), order)
    rows.drop(*[c for c in rows.columns if c.startswith("_")]).createOrReplaceTempView(name)


#: What ``sql_view_scan`` sums of each table, besides its rows.
CHECKSUMS = {
    "tweet": "id",
    "distinct_user": "`count`",
    "hashtag": "freq",
    "toptweeter": "retweeted",
    "location": "id",
    "trump_sentiment": "rating",
    "russia_sentiment": "rating",
    "status_hifi": "favorite_count",
    "user_hifi": "followers_count",
    "place_hifi": "length(full_name)",
}


def sql_view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3: every table registered and scanned through SQL (rows and a column's sum), in one statement.

    The views are inlined, so each scan reads the columns that its sum needs.
    """
    prefix = f"v{uuid.uuid4().hex[:8]}_"  # views of their own: a later call may register other tables
    register_tables(spark, sf_dir, prefix)
    parts = [
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(sum({CHECKSUMS[t]}) AS BIGINT) AS checksum FROM {prefix}{t}" for t in TABLES
    ]
    return spark.sql("\nUNION ALL\n".join(parts))


def join_status_user_place(status: DataFrame, user: DataFrame, place: DataFrame) -> DataFrame:
    """Each status with its author's and place's rows."""
    users = user.select(F.col("id").alias("user_id"), "screen_name", "followers_count")
    places = place.select(F.col("id").alias("place_id"), F.col("full_name").alias("place_full_name"))
    return join_narrow(status.select("id", "user_id", "place_id"), users, places)


def join_narrow(status: DataFrame, user: DataFrame, place: DataFrame) -> DataFrame:
    """Statuses (id, user_id, place_id) with the columns of their user and place.

    Statuses without a place (two in three) skip the place join: their null key
    would send them all to one partition.
    """
    s = status.join(user, "user_id", "left")
    placed = s.where("place_id is not null").join(place, "place_id", "left")
    unplaced = s.where("place_id is null").withColumn("place_full_name", F.lit(None).cast("string"))
    return placed.unionByName(unplaced)


def narrow_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The columns that J2 needs of the status, user and place tables, written (status texts are neither read nor written)."""
    t = result_tables(spark, sf_dir)
    status = t["status_hifi"].select("id", "user_id", "place_id")
    user = t["user_hifi"].select(F.col("id").alias("user_id"), "screen_name", "followers_count")
    place = t["place_hifi"].select(F.col("id").alias("place_id"), F.col("full_name").alias("place_full_name"))
    return materialize(status, "status"), materialize(user, "user"), materialize(place, "place")


def status_user_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 over written tables (the statuses are derived once a table, not once a join)."""
    status, user, place = narrow_tables(spark, sf_dir)
    return join_narrow(status, user, place)
