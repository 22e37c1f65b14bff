"""Stateful streams: restarts, bounded state, repeats, and outer joins against the batch plans."""

import datetime as dt

import pytest

from edge_rows import STATUS, T0, place, status, user
from pulse.plans import batch, views
from pulse.session import fresh_path
from pulse.streaming import replay_queries, stateful
from pulse.streaming.replay import closed_runs, slice_runs, stage_closing, stage_deliveries, stage_replay


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


@pytest.fixture
def progress(monkeypatch):
    """Progress reports of the last job."""
    seen = []
    real = stateful._late
    monkeypatch.setattr(stateful, "_late", lambda p, lateness: seen.extend(p) or real(p, lateness))
    return seen


def closed(spark, base):
    stage_closing(spark, base, "365 days")
    return closed_runs(base)


def files(spark, batches):
    """One source glob a batch of hand-made statuses, each with the files of those before."""
    base = fresh_path(spark, "t-stateful")
    for i, b in enumerate(batches):
        spark.createDataFrame(b, STATUS).coalesce(1).write.parquet(f"{base}/b={i}")
    return [f"{base}/b={{{','.join(map(str, range(n + 1)))}}}/*.parquet" for n in range(len(batches))]


def test_top_hashtags_close_once_and_leave_no_state(spark, sf_small, progress):
    runs = closed(spark, stage_replay(spark, sf_small))
    got = stateful.top_hashtags_by_interval(spark, runs, "1 hour", 3)
    assert rows(got) == rows(batch.top_hashtags_by_interval(spark, sf_small))
    held = [[s["numRowsTotal"] for s in p["stateOperators"]] for p in progress if p["stateOperators"]]
    n_tags = len(rows(batch.hashtag_counts_by_interval(spark, sf_small)))
    assert all(len(h) == 3 for h in held)
    # Only what came last (a quarter of the feed a batch) is held; a closed interval is not.
    assert max(max(h) for h in held) < n_tags / 2 and sum(held[-1]) == 0
    assert sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]) == 0


def test_top_hashtags_ties_and_open_intervals(spark):
    tagged = lambda i, minute, *tags: status(i, created_at=T0 + dt.timedelta(minutes=minute), place=place(), hashtags=list(tags))
    runs = files(spark, [[tagged(1, 1, "b", "a"), tagged(2, 2, "c", "a", "b")], [tagged(3, 61, "z")], [tagged(4, 200)]])
    out = fresh_path(spark, "t-top")
    got = stateful.top_hashtags_by_interval(spark, runs, "1 hour", 2, out=out)
    assert sorted((r.window_start, r["rank"], r.tags, r.freq) for r in got.collect()) == [(T0, 1, "a", 2), (T0, 2, "b", 2), (T0 + dt.timedelta(hours=1), 1, "z", 1)]


def test_running_counts_go_on_after_a_restart_with_other_partitions(spark, sf_small, progress):
    runs, out = closed(spark, stage_replay(spark, sf_small)), fresh_path(spark, "t-running")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        stateful.running_user_counts(spark, runs[:2], "1 hour", out=out)
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        got = stateful.running_user_counts(spark, runs[2:], "1 hour", out=out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows(got) == rows(batch.running_user_counts(spark, sf_small))
    users = batch.distinct_user_total(spark, sf_small).first()[0]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == users  # one total an author


def test_running_counts_leave_out_statuses_without_an_author(spark):
    runs = files(spark, [[status(1, user=user(1)), status(2, user=user(1)), status(3, user=None)], [status(900, user=user(2))]])
    got = stateful.running_user_counts(spark, runs, "1 hour")
    assert [(r.user, r["count"], r.running_count) for r in got.collect()] == [("User_1", 2, 2)]


def test_repeats_count_once_and_late_ones_are_reported(spark, sf_small):
    runs, want = slice_runs(stage_deliveries(spark, sf_small)), rows(batch.user_counts(spark, sf_small))
    report = {}
    assert rows(stateful.unique_user_counts(spark, runs, "14 days", report=report)) == want
    n_english = batch.status_total(spark, sf_small).first()[0]
    repeated = batch.english(spark, sf_small).where("id % 3 = 0").count()
    assert report == {"late": 0, "repeats": repeated} and 0 < repeated < n_english
    # Ids are forgotten after an hour, but repeats that come later are not counted either.
    assert rows(stateful.unique_user_counts(spark, runs, "1 hour", report=report)) == want
    assert report["late"] > 0 and report["late"] + report["repeats"] == repeated


def test_join_goes_on_after_a_restart(spark, sf_small):
    runs, out = closed(spark, stage_deliveries(spark, sf_small)), fresh_path(spark, "t-join")
    part = stateful.status_user_place(spark, runs[:2], replay_queries.JOIN_WITHIN, out=out)
    n_part = part.count()
    got = stateful.status_user_place(spark, runs[2:], replay_queries.JOIN_WITHIN, out=out).where("id >= 0")
    want = rows(views.status_user_place(spark, sf_small))
    assert rows(got) == want and 0 < n_part < len(want)


def test_join_gives_nulls_when_the_watermark_has_passed(spark):
    at = lambda i, hours, **kw: status(i, **{"created_at": T0 + dt.timedelta(hours=hours), "place": None, **kw})
    runs = files(
        spark,
        [
            [at(1, 0, user=user(1, followers=1), place=place("p1")), at(2, 1, user=None), at(3, 1, user=user(2))],
            [at(4, 2, user=user(1, followers=4))],  # within three hours of status 1
            [at(5, 20, user=user(1, followers=5))],  # too far away
            [at(6, 100, user=user(9))],
        ],
    )
    out = fresh_path(spark, "t-join-nulls")
    first = {r.id: r for r in stateful.status_user_place(spark, runs[:2], "3 hours", out=out).collect()}
    assert set(first) == {1, 3, 4}  # 2 waits for a user; statuses without a place wait for none
    got = {r.id: r for r in stateful.status_user_place(spark, runs[2:], "3 hours", out=out).collect()}
    assert (got[1].followers_count, got[1].place_full_name) == (4, "Somewhere, AMERICA")
    assert (got[2].screen_name, got[2].followers_count, got[2].place_full_name) == (None, None, None)
    assert (got[3].screen_name, got[3].place_full_name) == ("User_2", None)
    assert got[4].followers_count == 4 and got[5].followers_count == 5 and got[6].screen_name == "User_9"


def test_jobs_leave_session_settings_untouched(spark, sf_small):
    keys = list(stateful.CONF)
    before = {k: spark.conf.get(k, None) for k in keys}
    replay_queries.stream_unique_user_counts(spark, sf_small)
    assert {k: spark.conf.get(k, None) for k in keys} == before
