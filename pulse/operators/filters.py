"""Status filters (language, place, country, geo, retweet, keyword tracks).

All are plain predicates: Catalyst combines them, and the parts that touch
only one input table reach that table's parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from pulse.functions.text import contains_any
from pulse.settings import DEFAULT_ACCOUNT, DEFAULT_COUNTRY_CODE, DEFAULT_LANG


def by_lang(statuses: DataFrame, lang: str = DEFAULT_LANG) -> DataFrame:
    """language equals ``lang`` (null language is dropped)."""
    return statuses.where(F.col("lang") == lang)


def with_place(statuses: DataFrame) -> DataFrame:
    """a place is present."""
    return statuses.where(F.col("place").isNotNull())


def in_country(statuses: DataFrame, country_code: str = DEFAULT_COUNTRY_CODE) -> DataFrame:
    """place country code equals ``country_code`` (null code is dropped)."""
    return statuses.where(F.col("place.country_code") == country_code)


def with_geo(statuses: DataFrame) -> DataFrame:
    """a geo point is present."""
    return statuses.where(F.col("geo").isNotNull())


def retweets(statuses: DataFrame) -> DataFrame:
    """the status is a retweet."""
    return statuses.where(F.col("retweeted_status").isNotNull())


def retweets_of(statuses: DataFrame, account: str = DEFAULT_ACCOUNT) -> DataFrame:
    """F5 + F6: retweets of ``account``, screen name compared ignoring case."""
    return retweets(statuses).where(
        F.lower(F.col("retweeted_status.user.screen_name")) == account.lower()
    )


def on_track(
    statuses: DataFrame,
    keywords: Iterable[str],
    country_code: str | None = None,
) -> DataFrame:
    """Text holds any keyword, ignoring case.

    ``country_code`` is the optional place filter the reference has commented
    out; it is off by default.
    """
    out = statuses.where(contains_any(F.col("text"), keywords))
    if country_code is not None:
        out = in_country(out, country_code)
    return out


def us_english(
    statuses: DataFrame, lang: str = DEFAULT_LANG, country_code: str = DEFAULT_COUNTRY_CODE
) -> DataFrame:
    """F1 + F2 + F3, the hashtag job's input."""
    return in_country(with_place(by_lang(statuses, lang)), country_code)
