"""The reference's seven programs as streaming apps driven by ``JobSettings``.

Each app reads status files from ``source`` (a folder or glob), runs its
stream with a ``processingTime`` trigger of ``settings.interval`` for
``settings.run_seconds`` (or replays what is there with ``available_now``),
writes its tables under ``settings.out_path`` and returns them as current
(merge-on-read) DataFrames.  The master is never set here; ``spark-submit``
decides it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulse.session import fresh_path
from pulse.settings import WIDE_TABLES_INTERVAL, JobSettings
from pulse.sources.lexicon import lexicon_dimension, read_lexicon
from pulse.streaming import jobs


def _trigger(settings: JobSettings, available_now: bool, interval: str | None = None) -> tuple[dict, float | None]:
    if available_now:
        return jobs.AVAILABLE_NOW, None
    # run_seconds <= 0: run until the query is stopped or killed.
    secs = float(settings.run_seconds) if settings.run_seconds > 0 else None
    return {"processingTime": interval or settings.interval}, secs


def _source(source, settings: JobSettings) -> jobs.StatusSource:
    if isinstance(source, jobs.StatusSource):
        return source
    return jobs.StatusSource(
        source, settings.source_format, settings.files_per_trigger, settings.state_partitions, settings.bad_lines
    )


def _out(spark: SparkSession, settings: JobSettings, table: str) -> str:
    base = settings.out_path or fresh_path(spark, "app")
    return f"{base.rstrip('/')}/{table}"


def status_ids(spark, source, settings: JobSettings, available_now=False) -> dict[str, DataFrame]:
    trigger, secs = _trigger(settings, available_now)
    ids = jobs.status_ids(spark, _source(source, settings), settings.lang, _out(spark, settings, "ids"), trigger, secs)
    return {"tweet": ids}


def author_counts(spark, source, settings: JobSettings, available_now=False) -> dict[str, DataFrame]:
    trigger, secs = _trigger(settings, available_now)
    out = _out(spark, settings, "distinct_user")
    return {"distinct_user": jobs.user_counts(spark, _source(source, settings), settings.lang, out, trigger, secs)}


def trending_hashtags(spark, source, settings: JobSettings, available_now=False) -> dict[str, DataFrame]:
    trigger, secs = _trigger(settings, available_now)
    out = _out(spark, settings, "hashtag_by_interval")
    table = jobs.hashtag_log(spark, _source(source, settings), settings.interval, out, trigger, secs)
    per_interval = table.totals(["window_start", "window_end", "tags"], "freq")
    return {"hashtag_by_interval": per_interval, "hashtag": table.totals("tags", "freq")}


def account_retweeters(spark, source, settings: JobSettings, available_now=False) -> dict[str, DataFrame]:
    trigger, secs = _trigger(settings, available_now)
    out = _out(spark, settings, "toptweeter")
    return {"toptweeter": jobs.retweeter_counts(spark, _source(source, settings), settings.account, out, trigger, secs)}


def geo_points(spark, source, settings: JobSettings, available_now=False) -> dict[str, DataFrame]:
    trigger, secs = _trigger(settings, available_now)
    # The table's folder is named after it, inside the job's.
    return {"location": jobs.geo_points(spark, _source(source, settings), _out(spark, settings, "geo"), trigger, secs)}


def keyword_sentiment(spark, source, settings: JobSettings, available_now=False, lexicon: DataFrame | None = None) -> dict[str, DataFrame]:
    """Two keyword tracks, two tables, one streaming query; the lexicon is read
    once and broadcast if its size is proven small."""
    trigger, secs = _trigger(settings, available_now)
    if lexicon is None:
        if not settings.lexicon_path:
            raise ValueError("keyword_sentiment needs a lexicon: set lexicon_path (--lexicon)")
        lexicon = lexicon_dimension(read_lexicon(spark, settings.lexicon_path))
    tracks = {"russia_sentiment": settings.track_a, "trump_sentiment": settings.track_b}
    root = _out(spark, settings, "sentiment")
    return jobs.sentiment_tracks(spark, _source(source, settings), lexicon, tracks, settings.lang, root, trigger, secs)


def wide_tables(spark, source, settings: JobSettings, available_now=False) -> dict[str, DataFrame]:
    """Place, user and status tables from one stream, on a fixed 1 s micro-batch."""
    trigger, secs = _trigger(settings, available_now, WIDE_TABLES_INTERVAL)
    root = _out(spark, settings, "hifi")
    return jobs.fanout(spark, _source(source, settings), settings.lang, root, trigger, secs)


APPS: dict[str, Callable[..., dict[str, DataFrame]]] = {
    "status_ids": status_ids,
    "author_counts": author_counts,
    "trending_hashtags": trending_hashtags,
    "account_retweeters": account_retweeters,
    "geo_points": geo_points,
    "keyword_sentiment": keyword_sentiment,
    "wide_tables": wide_tables,
}
