"""Counts, interval counts, running totals and rankings.

Every count is a ``groupBy`` so Spark runs a partial (map-side) aggregate
before the shuffle: a hot hashtag or author is collapsed inside each task and
crosses the network as one row per task, whatever its share of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def count_by(df: DataFrame, key: str | Column, key_name: str, count_name: str = "count") -> DataFrame:
    """A1 / A2 / A3: rows per key (the reference's ``countByValue``)."""
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(k.alias(key_name)).agg(F.count(F.lit(1)).alias(count_name))


def count_by_interval(
    df: DataFrame,
    key: str | Column,
    key_name: str,
    interval: str,
    count_name: str = "count",
    ts: str = "created_at",
) -> DataFrame:
    """Rows per key inside each tumbling event-time interval.

    The event-time form of the reference's per-batch count; it is repeatable,
    and the same expression runs on a stream.
    """
    k = F.col(key) if isinstance(key, str) else key
    w = F.window(F.col(ts), interval)
    return (
        df.groupBy(w.alias("w"), k.alias(key_name))
        .agg(F.count(F.lit(1)).alias(count_name))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            key_name,
            count_name,
        )
    )


def running_totals(
    interval_counts: DataFrame, key_name: str, count_name: str = "count", total_name: str = "running_count"
) -> DataFrame:
    """A5: running total per key across intervals, in interval order.

    The window holds one row per (key, interval) after aggregation, so a hot
    key costs at most one row per interval, not one per status.
    """
    w = (
        Window.partitionBy(key_name)
        .orderBy("window_start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return interval_counts.withColumn(total_name, F.sum(count_name).over(w))


def total(df: DataFrame, name: str = "n_statuses") -> DataFrame:
    """Number of rows."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_total(df: DataFrame, key: str | Column, name: str = "n_users", exact: bool = True) -> DataFrame:
    """Number of distinct keys; ``exact=False`` uses a HyperLogLog sketch."""
    k = F.col(key) if isinstance(key, str) else key
    agg = F.count_distinct(k) if exact else F.approx_count_distinct(k)
    return df.agg(agg.alias(name))


# A rank table (one row per distinct value) above this size is joined by the
# planner instead of broadcast.
RANKS_BROADCAST_MAX_BYTES = 32 << 20


def rank_desc(df: DataFrame, value: str, rank_name: str = "rank") -> DataFrame:
    """SQL ``RANK() OVER (ORDER BY value DESC)`` without a global sort.

    The rank of a value is one plus the number of rows with a larger value,
    taken from the value histogram.  The histogram is range-partitioned by
    value; each partition sums its own rows, and only the totals (one row a
    partition) pass through a single task.  Null values rank last, as in SQL.

    The input is computed once, into the shared work folder.  Joining the
    ranks back on the value is skewed by nature (many tags share a count of
    1), so the rank table is broadcast if its size allows: the ranked rows are
    then not shuffled.  Above the bound the planner joins (AQE splits skewed
    partitions).
    """
    from pulse.functions.sizing import broadcast_if_small
    from pulse.session import materialize

    df = materialize(df, "ranked")
    order = F.desc_nulls_last(value)
    hist = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    hist = materialize(hist.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "histogram")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = hist.groupBy("_part").agg(F.sum("_rows").alias("_rows"))
    parts = parts.select("_part", F.coalesce(F.sum("_rows").over(before(Window.orderBy("_part"))), F.lit(0)).alias("_before"))
    inner = F.coalesce(F.sum("_rows").over(before(Window.partitionBy("_part").orderBy(order))), F.lit(0))
    ranks = hist.withColumn("_inner", inner).join(parts, "_part").select(
        F.col(value).alias("_value"), (F.col("_before") + F.col("_inner") + 1).alias(rank_name)
    )
    ranks = broadcast_if_small(materialize(ranks, "ranks"), RANKS_BROADCAST_MAX_BYTES)
    return df.join(ranks, df[value].eqNullSafe(ranks["_value"]), "inner").drop("_value")


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """First ``k`` rows of an order (``TakeOrderedAndProject``).

    Every order ends with the key, so ties cannot make the result unstable.
    """
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: str, k: int, order: list[Column], rank_name: str = "rank") -> DataFrame:
    """T5: top ``k`` rows inside each group.

    ``row_number() <= k`` lets Spark insert a partial per-group limit before
    the shuffle (``WindowGroupLimit``), so a hot group ships at most ``k``
    rows per task.
    """
    w = Window.partitionBy(group).orderBy(*order)
    ranked = df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)
    return ranked.withColumn(rank_name, F.col(rank_name).cast("long"))


__all__ = [
    "count_by",
    "count_by_interval",
    "running_totals",
    "total",
    "distinct_total",
    "rank_desc",
    "top_k",
    "top_k_per_group",
]
