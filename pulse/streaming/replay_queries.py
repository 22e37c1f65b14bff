"""Registered ``stream_*`` queries: replay the tables as files, run the stream.

Each replays the derived statuses with ``availableNow`` in several micro-batches
and returns the output it wrote, so it shares the oracle of its batch
counterpart.  Keyed tables replay a feed that delivers every third status twice.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from pulse.operators import shape
from pulse.operators.keyed import RowLog
from pulse.plans import batch
from pulse.session import fresh_path
from pulse.streaming import closed, jobs, report, stateful
from pulse.streaming.jobs import StatusSource
from pulse.streaming.replay import all_closed, closed_runs, reversed_runs, slice_runs, stage_closing, stage_events

# --- fixed values: parameters of the registered test queries -----------------
CLOSE_AFTER = "365 days"  # the closing status after the last one
JOIN_WITHIN = "60 days"  # of event time that a status may be from its user's row
REPEATED_WITHIN = "14 days"  # in which a status may be delivered again
# ---------------------------------------------------------------------------


def _events(sf_dir: str, runs: list[str]) -> StatusSource:
    return StatusSource(runs, "events", tables=sf_dir)


def _stream(spark: SparkSession, sf_dir: str) -> StatusSource:
    """Every replay file, a slice a micro-batch."""
    return _events(sf_dir, slice_runs(stage_events(spark, sf_dir)))


def _redelivered(spark: SparkSession, sf_dir: str) -> StatusSource:
    return _events(sf_dir, slice_runs(stage_events(spark, sf_dir, again=True)))


def _closed(spark: SparkSession, sf_dir: str, again: bool = False) -> StatusSource:
    """Every slice in order, then a status that closes the last intervals."""
    base = stage_events(spark, sf_dir, again=again)
    stage_closing(spark, base, CLOSE_AFTER, sf_dir)
    return _events(sf_dir, closed_runs(base))


def stream_top_hashtags_by_interval(spark, sf_dir):
    """Chained aggregates: the first tags of each interval, given out when it closes."""
    return stateful.top_hashtags_by_interval(spark, _closed(spark, sf_dir), batch.TEST_INTERVAL, batch.TOP_TAGS_PER_INTERVAL)


def stream_running_user_counts(spark, sf_dir):
    """A total an author, carried from interval to interval in keyed state."""
    return stateful.running_user_counts(spark, _closed(spark, sf_dir), batch.TEST_INTERVAL)


def stream_unique_user_counts(spark, sf_dir):
    """Counters on a feed that delivers every third status twice."""
    return stateful.unique_user_counts(spark, _redelivered(spark, sf_dir), REPEATED_WITHIN)


def stream_status_user_place(spark, sf_dir):
    """J2 as joins of streams."""
    return stateful.status_user_place(spark, _closed(spark, sf_dir, again=True), JOIN_WITHIN).where("id >= 0")


def stream_hashtag_counts_by_interval(spark, sf_dir):
    """Watermarked: one run (one micro-batch) per event-time slice, on one checkpoint."""
    return jobs.hashtag_counts_by_interval(spark, _stream(spark, sf_dir), batch.TEST_INTERVAL)


def stream_closed_hashtag_counts(spark, sf_dir):
    """Closed intervals and what came late, from a replay that runs backwards in time: most statuses are late."""
    base = stage_events(spark, sf_dir)
    stage_closing(spark, base, CLOSE_AFTER, sf_dir)
    return closed.hashtag_counts(spark, _events(sf_dir, [*reversed_runs(base), all_closed(base)]), batch.TEST_INTERVAL).exact()


def stream_batch_report(spark, sf_dir):
    """What the three filters of the hashtag job took in, kept and dropped, over all batches."""
    return report.totals(report.us_hashtags(spark, _stream(spark, sf_dir))[1])


def stream_hashtag_counts(spark, sf_dir):
    """Counters take every status: the replay runs backwards in time."""
    return jobs.hashtag_counts(spark, _events(sf_dir, reversed_runs(stage_events(spark, sf_dir))), batch.TEST_INTERVAL)


def stream_user_counts(spark, sf_dir):
    return jobs.user_counts(spark, _stream(spark, sf_dir))


def compacted_user_counts(spark, sf_dir):
    """A counter log of which all but the last batch was compacted."""
    return _with_late_batch(spark, sf_dir, lambda log: log.compact_counter("user", "count"))


def _with_late_batch(spark, sf_dir, compact) -> DataFrame:
    feed, out = _stream(spark, sf_dir), fresh_path(spark, "log-compacted")
    log = jobs.user_log(spark, replace(feed, paths=feed.paths[:-1]), out=out)
    compact(log)
    return jobs.user_log(spark, replace(feed, paths=feed.paths[-1:]), out=out).totals("user", "count")


def stream_distinct_user_total(spark, sf_dir):
    return jobs.distinct_user_total(spark, _stream(spark, sf_dir))


def stream_retweeter_counts(spark, sf_dir):
    return jobs.retweeter_counts(spark, _stream(spark, sf_dir))


def stream_status_ids(spark, sf_dir):
    return jobs.status_ids(spark, _redelivered(spark, sf_dir))


def stream_geo_points(spark, sf_dir):
    return jobs.geo_points(spark, _redelivered(spark, sf_dir))


def stream_sentiment(spark, sf_dir):
    return jobs.sentiment_scores(spark, _redelivered(spark, sf_dir), batch.lexicon(spark), batch.TEST_TRACK_A)


def stream_upsert_users(spark, sf_dir):
    return shape.as_text(jobs.upsert_users(spark, _redelivered(spark, sf_dir)))


def compacted_users(spark, sf_dir):
    """A user log of which all but the last batch was compacted."""
    feed, out = _redelivered(spark, sf_dir), fresh_path(spark, "log-compacted")
    jobs.upsert_users(spark, replace(feed, paths=feed.paths[:-1]), out=out)
    RowLog(spark, f"{out}/user_hifi").compact("id", jobs.STATUS_ORDER)
    return shape.as_text(jobs.upsert_users(spark, replace(feed, paths=feed.paths[-1:]), out=out))


def stream_upsert_statuses(spark, sf_dir):
    """K1 on statuses: the second delivery of a status wins, in the same batch or a later one."""
    return shape.as_text(jobs.fanout(spark, _redelivered(spark, sf_dir))["status_hifi"])


def stream_upsert_places(spark, sf_dir):
    return jobs.fanout(spark, _redelivered(spark, sf_dir))["place_hifi"].drop("bounding_box")


def stream_fanout(spark, sf_dir):
    """K5: three tables from one stream, then J2 over them."""
    from pulse.plans.views import join_status_user_place

    t = jobs.fanout(spark, _redelivered(spark, sf_dir))
    return join_status_user_place(t["status_hifi"], t["user_hifi"], t["place_hifi"])


#: Each stream query with the batch query whose oracle it shares.
STREAM_ORACLE = {
    "stream_hashtag_counts_by_interval": "hashtag_counts_by_interval",
    "stream_closed_hashtag_counts": "hashtag_counts_by_interval",
    "stream_batch_report": "filter_report",
    "stream_top_hashtags_by_interval": "top_hashtags_by_interval",
    "stream_running_user_counts": "running_user_counts",
    "stream_unique_user_counts": "user_counts",
    "stream_status_user_place": "status_user_place",
    "stream_hashtag_counts": "hashtag_counts",
    "stream_user_counts": "user_counts",
    "compacted_user_counts": "user_counts",
    "stream_distinct_user_total": "distinct_user_total",
    "stream_retweeter_counts": "retweeter_counts",
    "stream_status_ids": "status_ids",
    "stream_geo_points": "geo_points",
    "stream_sentiment": "sentiment_a",
    "stream_upsert_users": "upsert_users",
    "compacted_users": "upsert_users",
    "stream_upsert_statuses": "upsert_redelivered",
    "stream_upsert_places": "upsert_places",
    "stream_fanout": "status_user_place",
}
STREAM_QUERIES = {name: globals()[name] for name in STREAM_ORACLE}
