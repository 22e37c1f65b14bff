
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulse.plans import batch, catalog, views

Query = Callable[[SparkSession, str], DataFrame]

BATCH_QUERIES: dict[str, Query] = {
    name: getattr(batch, name)
    for name in (
        "status_scan",
        "lang_filter",
        "status_ids",
        "status_total",
        "preview_100",
        "user_counts",
        "user_counts_by_interval",
        "running_user_counts",
        "distinct_user_total",
        "top_100_users",
        "counter_user",
        "us_statuses",
        "hashtag_explode",
        "hashtag_counts",
        "hashtag_counts_by_interval",
        "ranked_hashtags",
        "top_hashtag",
        "top_hashtags_by_interval",
        "counter_hashtag",
        "counter_bump",
        "retweets",
        "retweeter_counts",
        "retweeter_counts_by_interval",
        "ranked_retweeters",
        "counter_retweeter",
        "geo_points",
        "track_a",
        "track_b",
        "word_scores",
        "sentiment_a",
        "sentiment_b",
        "ranked_sentiment",
        "place_rows",
        "user_rows",
        "status_rows",
        "created_at_text",
        "upsert_statuses",
        "upsert_users",
        "upsert_places",
        "heavy_hashtags",
        "distinct_users_by_span",
        "tracks_many",
        "filter_report",
        "raw_status_rows",
    )
}

VIEW_QUERIES: dict[str, Query] = {
    "sql_view_scan": views.sql_view_scan,
    "status_user_place": views.status_user_place,
    "bucketed_status_user_place": catalog.bucketed_status_user_place,
}


def all_queries() -> dict[str, Query]:
    from pulse.streaming import replay_queries

    return {**BATCH_QUERIES, **VIEW_QUERIES, **replay_queries.STREAM_QUERIES}
