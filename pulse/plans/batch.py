"""The reference's jobs as batch plans over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame: the status
records are derived from the tables, then the operators are composed.  No rows
are collected.  Most functions are one lazy plan; the ``ranked_*`` ones write
their counts, histogram and ranks to the shared work folder while the plan is
built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulse.operators import counts, filters, heavy, keyed, report, sentiment, shape, sketches, tracks
from pulse.session import fresh_path
from pulse.sources import variant
from pulse.sources.lexicon import FIXTURE_LEXICON, first_wins, fixture_lexicon
from pulse.sources.statuses import deliveries, flat_statuses, status_records
from pulse.streaming.replay import drifting_lines

# --- fixed values: parameters of the registered test queries (FIXTURES.md) --
TEST_TRACK_A = ("attion", "thble", "eriner")
TEST_TRACK_B = ("eriner", "rely")
TEST_INTERVAL = "1 hour"
TOP_TAGS_PER_INTERVAL = 3
TOP_USERS = 100
HEAVY_FRACTION = 0.05
SPAN_DAYS = 7
MANY_KEYWORDS = 2_000
BUMP_TAG, BUMP_AMOUNT = "ncaa", 2
# ---------------------------------------------------------------------------


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_records(spark, sf_dir)


def english(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.by_lang(statuses(spark, sf_dir))


def lexicon(spark: SparkSession) -> DataFrame:
    # Size proven by the literal: len(FIXTURE_LEXICON) rows, so broadcast is safe.
    assert len(FIXTURE_LEXICON) < 1_000
    return F.broadcast(first_wins(fixture_lexicon(spark)))


# ---- sources ---------------------------------------------------------------

def status_scan(spark, sf_dir):
    """SRC1: the status records, flattened for comparison."""
    return flat_statuses(statuses(spark, sf_dir))


# ---- English statuses: ids, total, preview ----------------------------------

def lang_filter(spark, sf_dir):
    return english(spark, sf_dir).select("id", "lang", "created_at")


def status_ids(spark, sf_dir):
    return shape.status_ids(english(spark, sf_dir))


def status_total(spark, sf_dir):
    return counts.total(english(spark, sf_dir), "n_statuses")


def preview_100(spark, sf_dir):
    """K3: the first 100 English statuses by id."""
    rows = english(spark, sf_dir).select(
        "id", F.col("user.screen_name").alias("screen_name"), "created_at"
    )
    return counts.top_k(rows, 100, [F.asc("id")])


# ---- Statuses per author ----------------------------------------------------

def _user_key():
    return F.col("user.screen_name")


def user_counts(spark, sf_dir):
    return counts.count_by(english(spark, sf_dir), _user_key(), "user", "count")


def user_counts_by_interval(spark, sf_dir):
    return counts.count_by_interval(english(spark, sf_dir), _user_key(), "user", TEST_INTERVAL, "count")


def running_user_counts(spark, sf_dir):
    return counts.running_totals(user_counts_by_interval(spark, sf_dir), "user", "count", "running_count")


def distinct_user_total(spark, sf_dir):
    return counts.distinct_total(english(spark, sf_dir), _user_key(), "n_users")


def top_100_users(spark, sf_dir):
    return counts.top_k(user_counts(spark, sf_dir), TOP_USERS, [F.desc("count"), F.asc("user")])


def counter_user(spark, sf_dir):
    """K2: totals of the per-interval user increments."""
    return keyed.counter_totals(user_counts_by_interval(spark, sf_dir), "user", "count")


# ---- Hashtags of English statuses placed in one country ----------------------

def _us(spark, sf_dir):
    return filters.us_english(statuses(spark, sf_dir))


def us_statuses(spark, sf_dir):
    return _us(spark, sf_dir).select(
        "id",
        F.col("place.id").alias("place_id"),
        F.col("place.country_code").alias("country_code"),
    )


def hashtag_explode(spark, sf_dir):
    return shape.hashtags(_us(spark, sf_dir))


def hashtag_counts(spark, sf_dir):
    return counts.count_by(shape.hashtags(_us(spark, sf_dir)), "tag", "tags", "freq")


def hashtag_counts_by_interval(spark, sf_dir):
    tags = shape.hashtags(_us(spark, sf_dir), keep=("created_at",))
    return counts.count_by_interval(tags, "tag", "tags", TEST_INTERVAL, "freq")


def ranked_hashtags(spark, sf_dir):
    return counts.rank_desc(hashtag_counts(spark, sf_dir), "freq", "rank")


def top_hashtag(spark, sf_dir):
    return counts.top_k(hashtag_counts(spark, sf_dir), 1, [F.desc("freq"), F.asc("tags")])


def top_hashtags_by_interval(spark, sf_dir):
    return counts.top_k_per_group(
        hashtag_counts_by_interval(spark, sf_dir),
        "window_start",
        TOP_TAGS_PER_INTERVAL,
        [F.desc("freq"), F.asc("tags")],
    )


def counter_hashtag(spark, sf_dir):
    return keyed.counter_totals(hashtag_counts_by_interval(spark, sf_dir), "tags", "freq")


def counter_bump(spark, sf_dir):
    """K6: the hashtag counter after ``UPDATE ... SET freq = freq + 2 WHERE tags = 'ncaa'``."""
    increments = hashtag_counts_by_interval(spark, sf_dir).select("tags", "freq")
    bumped = keyed.counter_bump(increments, {"tags": BUMP_TAG}, "freq", BUMP_AMOUNT)
    return keyed.counter_totals(bumped, "tags", "freq")


# ---- Retweeters of one account -----------------------------------------------

def retweets(spark, sf_dir):
    return filters.retweets(statuses(spark, sf_dir)).select(
        "id", F.col("retweeted_status.user.screen_name").alias("rt_screen_name")
    )


def _account_retweets(spark, sf_dir):
    return filters.retweets_of(statuses(spark, sf_dir))


def retweeter_counts(spark, sf_dir):
    return counts.count_by(_account_retweets(spark, sf_dir), _user_key(), "top_user", "retweeted")


def retweeter_counts_by_interval(spark, sf_dir):
    return counts.count_by_interval(
        _account_retweets(spark, sf_dir), _user_key(), "top_user", TEST_INTERVAL, "retweeted"
    )


def ranked_retweeters(spark, sf_dir):
    return counts.rank_desc(retweeter_counts(spark, sf_dir), "retweeted", "rank")


def counter_retweeter(spark, sf_dir):
    return keyed.counter_totals(retweeter_counts_by_interval(spark, sf_dir), "top_user", "retweeted")


# ---- Geo points ---------------------------------------------------------------

def geo_points(spark, sf_dir):
    return shape.geo_points(filters.with_geo(statuses(spark, sf_dir)))


# ---- Keyword tracks and lexicon sentiment -------------------------------------

def track_a(spark, sf_dir):
    return filters.on_track(english(spark, sf_dir), TEST_TRACK_A).select("id")


def track_b(spark, sf_dir):
    return filters.on_track(english(spark, sf_dir), TEST_TRACK_B).select("id")


def word_scores(spark, sf_dir):
    tracked = filters.on_track(english(spark, sf_dir), TEST_TRACK_A)
    return sentiment.word_scores(tracked, lexicon(spark))


def sentiment_a(spark, sf_dir):
    tracked = filters.on_track(english(spark, sf_dir), TEST_TRACK_A)
    return sentiment.sentiment(tracked, lexicon(spark))


def sentiment_b(spark, sf_dir):
    tracked = filters.on_track(english(spark, sf_dir), TEST_TRACK_B)
    return sentiment.sentiment(tracked, lexicon(spark))


def ranked_sentiment(spark, sf_dir):
    return counts.rank_desc(sentiment_a(spark, sf_dir).select("id", "rating"), "rating", "rank")


# ---- Wide status, user and place tables ---------------------------------------

def place_rows(spark, sf_dir):
    return shape.place_rows(english(spark, sf_dir))


def user_rows(spark, sf_dir):
    return shape.user_rows(english(spark, sf_dir))


def status_rows(spark, sf_dir):
    return shape.status_rows(english(spark, sf_dir))


def created_at_text(spark, sf_dir):
    return shape.created_at_texts(statuses(spark, sf_dir))


def upsert_statuses(spark, sf_dir):
    """K1: the status table after all deliveries; a later delivery wins."""
    rows = shape.status_rows(deliveries(english(spark, sf_dir)), carry=(F.col("delivery_no"),))
    return keyed.latest_of_repeats(rows, "id", ["delivery_no"]).drop("delivery_no")


def _order():
    return (F.col("created_at").alias("_ts"), F.col("id").alias("_sid"))


def upsert_users(spark, sf_dir):
    """K1: one row per user, taken from that user's latest status."""
    rows = shape.user_rows(english(spark, sf_dir), carry=_order())
    return keyed.latest_by_key(rows, "id", ["_ts", "_sid"]).drop("_ts", "_sid")


def upsert_places(spark, sf_dir):
    """K1: one row per place id (placeless statuses keyed by their own id, D6)."""
    rows = shape.place_rows(english(spark, sf_dir), carry=_order())
    return keyed.latest_by_key(rows, "id", ["_ts", "_sid"]).drop("_ts", "_sid")


# ---- sketches, large keyword lists ----------------------------------------------------

def heavy_hashtags(spark, sf_dir):
    """The tags that at least one in twenty tags of US statuses is."""
    tags = shape.hashtags(filters.us_english(statuses(spark, sf_dir))).withColumnRenamed("tag", "tags")
    return heavy.heavy_hitters(tags.select("tags"), "tags", HEAVY_FRACTION, "freq")


def distinct_users_by_span(spark, sf_dir):
    """A7 for every week that begins on a day with statuses: counted, and whether the stored sketches agree."""
    rows = english(spark, sf_dir).select("created_at", F.col("user.screen_name").alias("user"))
    stored = sketches.store(sketches.by_day(rows, "user"))
    spans = stored.select(F.col("day").alias("span_start"), F.date_add("day", SPAN_DAYS).alias("span_end"))
    both = sketches.exact_over(rows, "user", spans, "n_users").join(sketches.distinct_over(stored, spans), ["span_start", "span_end"])
    off = F.abs(F.col("estimate") - F.col("n_users"))
    return both.select("span_start", "span_end", "n_users", (off <= 1 + sketches.relative_error() * F.col("n_users")).alias("within_bound"))


def many_keywords(spark, sf_dir):
    """Stand-in for a large keyword list: words of the documents in the order of their hashes."""
    from pulse.sources.tables import read_table

    words = read_table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("keyword"))
    return words.where("length(keyword) >= 4").distinct().orderBy(F.md5("keyword")).limit(MANY_KEYWORDS)


def tracks_many(spark, sf_dir):
    """F7 / F8 with the country filter: English statuses from the US on each of 2,000 keyword tracks."""
    found = tracks.on_tracks(filters.us_english(statuses(spark, sf_dir)), many_keywords(spark, sf_dir))
    return counts.count_by(found, "keyword", "keyword", "n_statuses")


# ---- filters' report, raw lines --------------------------------------------------------

def filter_report(spark, sf_dir):
    """What the three filters of the hashtag job take in, keep and drop."""
    return report.filter_report(statuses(spark, sf_dir), report.us_english_steps())


def _raw_lines(spark, sf_dir):
    """Stand-in for a raw feed: the statuses as written JSON lines, read back as text."""
    path = fresh_path(spark, "raw-lines")
    drifting_lines(statuses(spark, sf_dir)).write.text(path, compression="gzip")
    return spark.read.text(path)


def raw_status_rows(spark, sf_dir):
    """SRC1 + P8: status rows from raw lines with unknown, missing and retyped fields."""
    return shape.status_rows(filters.by_lang(variant.from_variant(_raw_lines(spark, sf_dir))))
