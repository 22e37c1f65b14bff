"""Closed intervals that lose no late row (W3 + A1): what comes late goes to a side table.

A watermarked aggregate drops rows of intervals that have closed.  Here every
batch counts its own rows per interval and tag, and the counts go one of two
ways:

* to ``open``, if their interval was open when the batch began;
* to ``late``, if it had closed.

When a batch moves the feed's latest event time past an interval's end by
``lateness``, the interval closes: its counts of ``open`` are summed and
appended to ``closed`` once, never to change.  Readers take ``closed`` alone, or
add ``late`` to it for the exact counts.  ``seen`` holds the latest event time of
each batch, one row a batch, so what a batch decides depends on the batches
before it only; a batch that is run again decides the same.

No operator state: the logs are the state.  ``open`` is partitioned by day, and a
closing batch reads the days between two watermarks, not the whole log.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulse.operators import counts, filters, shape
from pulse.operators.keyed import BATCH_COL, RowLog
from pulse.session import fresh_path
from pulse.streaming.jobs import AVAILABLE_NOW, TAG_FIELDS, Source, _batches, _drive

KEY = ("window_start", "window_end", "tags")
COUNTS = "window_start timestamp_ntz, window_end timestamp_ntz, tags string, freq long"
SEEN = "seen timestamp_ntz"
_UNITS = ("seconds", "minutes", "hours", "days", "weeks")


def duration(text: str) -> dt.timedelta:
    """``"90 minutes"`` and the like."""
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text.lower())
    if not found or f"{found[2]}s" not in _UNITS:
        raise ValueError(f"no span of time: {text!r}")
    return dt.timedelta(**{f"{found[2]}s": int(found[1])})


class ClosedCounts:
    """The four logs of a job under one folder; ``interval`` is the length of its intervals."""

    def __init__(self, spark: SparkSession, path: str, interval: dt.timedelta, lateness: dt.timedelta):
        self.spark, self.path = spark, path.rstrip("/")
        self.interval, self.lateness = interval, lateness
        self.open = RowLog(spark, f"{self.path}/open", partition_by=("day",))
        self.late = RowLog(spark, f"{self.path}/late")
        self.closed = RowLog(spark, f"{self.path}/closed")
        self.seen = RowLog(spark, f"{self.path}/seen")

    def logs(self) -> Sequence[RowLog]:
        return self.open, self.late, self.closed, self.seen

    def _rows(self, log: RowLog, schema: str) -> DataFrame:
        """A log's rows; a log of empty batches has no file to take a schema from."""
        schema = f"{schema}, {BATCH_COL} int"
        if not log.batches():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(log.path)

    def seen_before(self, batch_id: int) -> dt.datetime | None:
        """The latest event time of the batches before this one; a row a batch is read."""
        return self._rows(self.seen, SEEN).where(F.col(BATCH_COL) < batch_id).agg(F.max("seen")).first()[0]

    def take(self, rows: DataFrame, newest: dt.datetime | None, batch_id: int) -> None:
        """A batch's counts (``KEY`` and freq), and the latest event time of all its rows."""
        before = self.seen_before(batch_id)
        now = max((t for t in (before, newest) if t is not None), default=None)
        mark = lambda t: F.lit(None if t is None else t - self.lateness).cast("timestamp_ntz")
        shut = F.coalesce(F.col("window_end") <= mark(before), F.lit(False))
        self.open.write_batch(rows.where(~shut).withColumn("day", F.to_date("window_start")), batch_id)
        self.late.write_batch(rows.where(shut), batch_id)
        held = self._rows(self.open, f"{COUNTS}, day date").where(F.col(BATCH_COL) <= batch_id)
        closing = held.where((F.col("window_end") <= mark(now)) & ~shut)
        if before is not None:  # what closes now ends after the last mark: earlier days are not read
            closing = closing.where(F.col("day") >= F.to_date(mark(before - self.interval)))
        self.closed.write_batch(closing.groupBy(*KEY).agg(F.sum("freq").alias("freq")), batch_id)
        self.seen.write_batch(self.spark.createDataFrame([(newest,)], SEEN), batch_id)

    def final(self) -> DataFrame:
        """Closed intervals as they closed."""
        return self._rows(self.closed, COUNTS).drop(BATCH_COL)

    def exact(self) -> DataFrame:
        """Closed intervals with the counts that came late; tags may be new."""
        both = self.final().unionByName(self._rows(self.late, COUNTS).drop(BATCH_COL))
        return both.groupBy(*KEY).agg(F.sum("freq").alias("freq"))

    def late_total(self) -> int:
        return self._rows(self.late, COUNTS).agg(F.coalesce(F.sum("freq"), F.lit(0))).first()[0]


def hashtag_counts(
    spark: SparkSession, source: Source, interval: str, lateness: str = "10 minutes", out: str | None = None, trigger: dict = AVAILABLE_NOW, run_seconds: float | None = None
) -> ClosedCounts:
    """Tag counts of closed intervals of US English statuses, and the late ones beside them.

    Statuses without a time are in no interval.  Intervals that are still open
    when the job ends are in ``open``, and close in a later run.
    """
    tables = ClosedCounts(spark, out or fresh_path(spark, "log-closed"), duration(interval), duration(lateness))

    def handle(batch: DataFrame, bid: int) -> None:
        tags = shape.hashtags(filters.us_english(batch), keep=("created_at",)).where("created_at is not null")
        per_batch = counts.count_by_interval(tags, "tag", "tags", interval, "freq").persist()
        try:
            tables.take(per_batch, batch.agg(F.max("created_at")).first()[0], bid)
        finally:
            per_batch.unpersist()

    _drive(spark, "closed_hashtags", source, _batches(handle, fields=TAG_FIELDS), trigger, run_seconds, tables.path, tables.logs())
    return tables
