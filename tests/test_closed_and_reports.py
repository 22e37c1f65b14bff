"""Closed intervals with late rows, filter reports, and raw lines whose fields drift."""

import datetime as dt
import json
import random
from collections import Counter

import pytest

from edge_rows import STATUS, T0, place, status
from pulse.operators import report as steps_of
from pulse.plans import batch
from pulse.session import fresh_path
from pulse.sources import variant
from pulse.streaming import closed, jobs, report
from pulse.streaming.replay import drifting_lines


def files(spark, batches):
    """One source glob a batch of hand-made statuses, each with the files of those before."""
    base = fresh_path(spark, "t-closed")
    for i, b in enumerate(batches):
        spark.createDataFrame(b, STATUS).coalesce(1).write.parquet(f"{base}/b={i}")
    return [f"{base}/b={{{','.join(map(str, range(n + 1)))}}}/*.parquet" for n in range(len(batches))]


def tagged(i, minute, *tags, **kw):
    at = None if minute is None else T0 + dt.timedelta(minutes=minute)
    return status(i, **{"created_at": at, "place": place(), "hashtags": list(tags), **kw})


def counted(df):
    return {(r.window_start, r.tags): r.freq for r in df.collect()}


# ---- closed intervals -----------------------------------------------------------------

def brute(batches, lateness):
    """Counts of the closed intervals as they closed, late counts, counts still open."""
    final, late, held, seen = Counter(), Counter(), Counter(), None
    for rows in batches:
        mark = None if seen is None else seen - lateness
        for r in rows:
            if r["created_at"] is None:
                continue
            start = r["created_at"].replace(minute=0)
            for t in r["hashtags"]:
                gone = mark is not None and start + dt.timedelta(hours=1) <= mark
                (late if gone else held)[start, t] += 1
        seen = max([r["created_at"] for r in rows if r["created_at"]] + ([seen] if seen else []), default=None)
        for key in [k for k in held if seen and k[0] + dt.timedelta(hours=1) <= seen - lateness]:
            final[key] = held.pop(key)
    return final, late, held


@pytest.mark.parametrize("seed", [1, 2])
def test_closed_intervals_match_brute_force_across_a_restart(spark, seed):
    rng = random.Random(seed)
    feed = [[tagged(100 * b + i, rng.randrange(0, 60 * 50) if rng.random() < 0.3 else 600 * b + rng.randrange(600), *rng.choices("abc", k=2)) for i in range(25)] for b in range(5)]
    feed[2].append(tagged(999, None, "a"))  # without a time: in no interval
    runs, out = files(spark, feed), fresh_path(spark, "t-closed-out")
    closed.hashtag_counts(spark, runs[:2], "1 hour", "30 minutes", out=out)
    got = closed.hashtag_counts(spark, runs[2:], "1 hour", "30 minutes", out=out)
    final, late, held = brute(feed, dt.timedelta(minutes=30))
    assert late and held and final
    assert counted(got.final()) == final and got.late_total() == sum(late.values())
    assert counted(got.exact()) == final + late
    keys = [tuple(r) for r in got.final().select("window_start", "tags").collect()]
    assert len(keys) == len(set(keys))  # an interval closes once


def test_a_batch_that_runs_again_changes_nothing(spark):
    runs, out = files(spark, [[tagged(1, 1, "a")], [tagged(2, 200, "b")], [tagged(3, 5, "a"), tagged(4, 900, "c")]]), fresh_path(spark, "t-again")
    got = closed.hashtag_counts(spark, runs, "1 hour", out=out)
    before = counted(got.exact())
    assert before == {(T0, "a"): 2, (T0 + dt.timedelta(hours=3), "b"): 1}
    rows = spark.createDataFrame([(T0, T0 + dt.timedelta(hours=1), "a", 1)], closed.COUNTS)
    for bid in got.open.batches():
        got.take(rows, T0, bid)
    assert counted(got.exact()) == before


def test_feeds_without_tags_close_nothing(spark):
    got = closed.hashtag_counts(spark, files(spark, [[tagged(1, 1)], [tagged(2, 500, "x", place=None)]]), "1 hour")
    assert got.exact().count() == got.final().count() == got.late_total() == 0


def test_spans_of_time():
    assert closed.duration("1 hour") == dt.timedelta(hours=1) and closed.duration("90 Minutes") == dt.timedelta(minutes=90)
    with pytest.raises(ValueError):
        closed.duration("a while")


# ---- reports --------------------------------------------------------------------------

def test_report_by_batch_and_after_a_lost_report(spark, tmp_path):
    feed = [
        [tagged(1, 1, "a"), status(2, lang="de"), status(3, lang=None), status(4, place=None)],
        [status(5, place=place(country_code="CA")), status(6, place=place(country_code=None)), tagged(7, 2, "b", "c")],
    ]
    out, runs = fresh_path(spark, "t-report"), files(spark, feed)
    rows, told = report.us_hashtags(spark, runs, out=out)
    by_batch = {(r.batch_id, r.step): (r.rows_in, r.kept, r.dropped) for r in told.read().collect()}
    assert by_batch == {
        (0, "lang"): (4, 2, 2), (0, "place"): (2, 1, 1), (0, "country"): (1, 1, 0),
        (1, "lang"): (3, 3, 0), (1, "place"): (3, 3, 0), (1, "country"): (3, 1, 2),
    }
    assert sorted((r.id, r.tag) for r in rows.read().collect()) == [(1, "a"), (7, "b"), (7, "c")]
    # The rows were published, the report and the commit were not: the batch runs again.
    import shutil

    shutil.copytree(f"{rows.path}/batch_id=0".removeprefix("file:"), f"{tmp_path}/out/rows/batch_id=0")
    (tmp_path / "out/_checkpoint").mkdir()
    (tmp_path / "out/_checkpoint/metadata").write_text('{"id":"6f2f2a0e-5e0a-4b7e-9b2f-2f0a5a3c1d11"}')
    again, told = report.us_hashtags(spark, runs, out=str(tmp_path / "out"))
    assert {(r.batch_id, r.step): (r.rows_in, r.kept, r.dropped) for r in told.read().collect()} == by_batch
    assert again.read().count() == 3


def test_null_conditions_drop_and_no_rows_are_zeros(spark, sf_small):
    df = spark.createDataFrame([status(1, lang=None), status(2)], STATUS)
    steps = steps_of.us_english_steps()
    assert [tuple(r) for r in steps_of.filter_report(df, steps).collect()] == [("lang", 2, 1, 1), ("place", 1, 0, 1), ("country", 0, 0, 0)]
    assert [tuple(r)[1:] for r in steps_of.filter_report(df.limit(0), steps).collect()] == [(0, 0, 0)] * 3
    assert steps_of.kept(batch.statuses(spark, sf_small), steps).count() == batch.us_statuses(spark, sf_small).count()


# ---- raw lines that drift ----------------------------------------------------------------

LINES = [
    {"id": "1", "lang": "en", "favorite_count": "7", "retweet_count": 3.0, "favorited": "true", "new": {"deep": [1]},
     "user": {"id": "9", "screen_name": "x", "followers_count": "many", "verified": True}, "geo": {"coordinates": ["1.5", 2]}},
    {"id": 2, "lang": "en", "favorite_count": [1], "user": "x", "entities": {"hashtags": [{"text": "A"}, {"text": 5}, {"other": 1}]}},
    {"id": 3},
]


def test_fields_are_cast_one_by_one(spark):
    text = [*map(json.dumps, LINES), "  ", "[1]", "null"]
    got = variant.from_variant(spark.createDataFrame([(t,) for t in text], "value string")).collect()
    one, two, three = (next(r for r in got if r.id == i) for i in (1, 2, 3))
    assert (one.favorite_count, one.retweet_count, one.favorited, one.user.id, one.user.screen_name) == (7, 3, True, 9, "x")
    assert one.user.followers_count is None and one.user.verified and (one.geo.latitude, one.geo.longitude) == (1.5, 2.0)
    assert two.favorite_count is None and two.user is None and two.hashtags == ["A", "5", None]
    assert three.lang is None and three.in_reply_to_status_id == -1 and three.hashtags == []
    assert len(got) == 5 and sum(r.id is None for r in got) == 2  # JSON that is no object: without values


def test_bad_lines_fail_or_are_listed(spark):
    lines = spark.createDataFrame([("{oops",), ('{"id": 1}',), ("",)], "value string")
    with pytest.raises(Exception, match="MALFORMED"):
        variant.from_variant(lines).collect()
    assert sorted((r.id for r in variant.from_variant(lines, "PERMISSIVE").collect()), key=str) == [1, None]
    assert [r.value for r in variant.variant_bad_lines(lines).collect()] == ["{oops"]


def test_kinds_of_fields(spark):
    lines = spark.createDataFrame([(json.dumps(x),) for x in LINES] + [("[1]",)], "value string")
    got = {(r.field, r.kind): r.n for r in variant.field_kinds(lines).collect()}
    assert got["id", "STRING"] == 1 and got["id", "BIGINT"] == 2 and got["user", "OBJECT"] == 1 and got["user", "STRING"] == 1
    assert got["favorite_count", "ARRAY"] == 1 and got["new", "OBJECT"] == 1


def test_lines_are_parsed_once_and_other_fields_are_not_taken(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    plan = variant.from_variant(lines).select("id", "lang", "user.id", "geo")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1 and "$.text" not in plan and "$.entities" not in plan


def test_drifting_lines_as_a_stream(spark, sf_small, tmp_path):
    path = str(tmp_path / "lines")
    drifting_lines(batch.statuses(spark, sf_small)).write.text(path)
    source = jobs.StatusSource(path, "variant")
    got, want = jobs.hashtag_counts(spark, source).collect(), batch.hashtag_counts(spark, sf_small).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
