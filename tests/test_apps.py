"""The seven streaming apps replayed on the smallest tables equal the batch plans."""

import pytest

from pulse.operators import shape
from pulse.plans import batch
from pulse.session import fresh_path
from pulse.settings import JobSettings
from pulse.streaming import apps
from pulse.streaming.replay import all_slices, slice_runs, stage_replay


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def replay(spark, sf_small):
    return stage_replay(spark, sf_small)


@pytest.fixture(scope="module")
def settings(spark):
    return JobSettings(
        interval=batch.TEST_INTERVAL,
        out_path=fresh_path(spark, "t-apps"),
        track_a=batch.TEST_TRACK_A,
        track_b=batch.TEST_TRACK_B,
    )


def test_tweet_count(spark, sf_small, replay, settings):
    got = apps.status_ids(spark, all_slices(replay), settings, available_now=True)["tweet"]
    assert rows(got) == rows(batch.status_ids(spark, sf_small))


def test_distinct_users(spark, sf_small, replay, settings):
    got = apps.author_counts(spark, all_slices(replay), settings, available_now=True)["distinct_user"]
    assert rows(got) == rows(batch.user_counts(spark, sf_small))


def test_top_trending(spark, sf_small, replay, settings):
    out = apps.trending_hashtags(spark, slice_runs(replay)[::-1], settings, available_now=True)
    assert rows(out["hashtag_by_interval"]) == rows(batch.hashtag_counts_by_interval(spark, sf_small))
    assert rows(out["hashtag"]) == rows(batch.hashtag_counts(spark, sf_small))


def test_top_retweeter(spark, sf_small, replay, settings):
    got = apps.account_retweeters(spark, all_slices(replay), settings, available_now=True)["toptweeter"]
    assert rows(got) == rows(batch.retweeter_counts(spark, sf_small))


def test_tweet_location(spark, sf_small, replay, settings):
    got = apps.geo_points(spark, all_slices(replay), settings, available_now=True)["location"]
    assert rows(got) == rows(batch.geo_points(spark, sf_small))


def test_sentiment(spark, sf_small, replay, settings):
    with pytest.raises(ValueError, match="lexicon"):
        apps.keyword_sentiment(spark, all_slices(replay), settings, available_now=True)
    out = apps.keyword_sentiment(spark, all_slices(replay), settings, available_now=True, lexicon=batch.lexicon(spark))
    assert rows(out["russia_sentiment"]) == rows(batch.sentiment_a(spark, sf_small))
    assert rows(out["trump_sentiment"]) == rows(batch.sentiment_b(spark, sf_small))


def test_hifi_tables(spark, sf_small, replay, settings):
    out = apps.wide_tables(spark, all_slices(replay), settings, available_now=True)
    assert dict(out["status_hifi"].dtypes)["entities"] == "array<string>"
    assert rows(shape.as_text(out["status_hifi"])) == rows(batch.status_rows(spark, sf_small))
    assert rows(shape.as_text(out["user_hifi"])) == rows(batch.upsert_users(spark, sf_small))
    assert dict(out["place_hifi"].dtypes)["bounding_box"].startswith("struct")
    assert rows(out["place_hifi"].drop("bounding_box")) == rows(batch.upsert_places(spark, sf_small))


def test_cli_runs_an_app(spark, replay, capsys):
    from pulse.run import main

    out = fresh_path(spark, "t-cli")
    main(["geo_points", "--source", all_slices(replay), "--out", out, "--available-now", "--preview", "3"])
    assert "longitude" in capsys.readouterr().out
    assert spark.table("location").count() == 250


def test_live_trigger_runs_for_the_configured_time(spark, sf_small, replay):
    import time

    live = JobSettings(interval="1 second", run_seconds=8, out_path=fresh_path(spark, "t-live"))
    t0 = time.time()
    got = apps.geo_points(spark, all_slices(replay), live)["location"]
    assert time.time() - t0 >= 8
    assert rows(got) == rows(batch.geo_points(spark, sf_small))


def test_written_table_registered_for_sql(spark, replay):
    """SRC3: a table written by an app is registered by its current rows."""
    from pulse.plans.views import register_log

    live = JobSettings(out_path=fresh_path(spark, "t-sql"))
    apps.geo_points(spark, all_slices(replay), live, available_now=True)
    register_log(spark, "demo_location", f"{live.out_path}/geo/location", ["id"])
    n = spark.sql("SELECT count(*) AS n FROM demo_location WHERE latitude IS NOT NULL").first()["n"]
    assert n == 250


def test_cli_reads_json_status_files(spark, sf_small):
    from pulse.run import main
    from pulse.sources.statuses import status_records

    src = fresh_path(spark, "t-cli-json")
    status_records(spark, sf_small).write.json(src)
    out = fresh_path(spark, "t-cli-json-out")
    main(["author_counts", "--source", src, "--out", out, "--format", "json", "--available-now", "--preview", "0"])
    assert rows(spark.table("distinct_user")) == rows(batch.user_counts(spark, sf_small))
