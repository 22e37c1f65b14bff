"""A7 over any span: one stored HLL sketch an interval, united for the intervals of a span.

A sketch has a fixed size (2**lg_k buckets), whatever the interval's rows; it is
built by partial aggregation, written once, and any later span is answered from
the sketches of its intervals without reading a status again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from pulse.session import materialize

LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """Three standard errors of an estimate."""
    return 3 * 1.04 / math.sqrt(2**lg_k)


def by_day(statuses: DataFrame, key: str, lg_k: int = LG_K) -> DataFrame:
    """(day, sketch): one sketch of the column a day; null keys are left out, and a day without a key has no row."""
    rows = statuses.where(F.col(key).isNotNull()).select(F.to_date("created_at").alias("day"), F.col(key).cast("string").alias("k"))
    return rows.groupBy("day").agg(F.hll_sketch_agg("k", F.lit(lg_k)).alias("sketch"))


def store(sketches: DataFrame) -> DataFrame:
    """Written into the shared work folder, and read from there."""
    return materialize(sketches, "sketches")


def merge(*stored: DataFrame) -> DataFrame:
    """Sketches of several feeds as one a day."""
    rows = stored[0]
    for more in stored[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("day").agg(F.hll_union_agg("sketch").alias("sketch"))


def days_of(spans: DataFrame) -> DataFrame:
    """(span_start, span_end, day): the days from the start up to, not including, the end."""
    days = spans.where("span_start < span_end").select("span_start", "span_end").distinct()
    return days.withColumn("day", F.explode(F.sequence("span_start", F.date_sub("span_end", 1))))


def distinct_over(stored: DataFrame, spans: DataFrame, name: str = "estimate") -> DataFrame:
    """(span_start, span_end, estimate) of each span with any day: distinct keys within ``relative_error`` in all likelihood."""
    united = days_of(spans).join(stored, "day").groupBy("span_start", "span_end").agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select("span_start", "span_end", F.hll_sketch_estimate("sketch").alias(name))


def exact_over(statuses: DataFrame, key: str, spans: DataFrame, name: str) -> DataFrame:
    """The same, counted: a row a day and key crosses the shuffle, then one a span and key."""
    daily = statuses.where(F.col(key).isNotNull()).select(F.to_date("created_at").alias("day"), F.col(key).alias("k")).distinct()
    pairs = days_of(spans).join(daily, "day").select("span_start", "span_end", "k").distinct()
    return pairs.groupBy("span_start", "span_end").agg(F.count(F.lit(1)).alias(name))
