"""Streams: replay equals batch, and a restart from the checkpoint adds nothing."""

from pyspark.sql import functions as F

from pulse.operators import counts, filters, keyed
from pulse.plans import batch
from pulse.session import fresh_path
from pulse.streaming.replay import stage_replay, status_stream


def _totals(df):
    return {r["user"]: r["count"] for r in df.collect()}


def test_restart_from_checkpoint_gives_same_totals(spark, sf_small):
    path = stage_replay(spark, sf_small)
    log = keyed.RowLog(spark, fresh_path(spark, "t-restart-log"))
    ckpt = fresh_path(spark, "t-restart-ckpt")

    def handle(df, bid):
        log.write_batch(counts.count_by(filters.by_lang(df), F.col("user.screen_name"), "user", "count"), bid)

    def run(max_batches):
        q = (
            status_stream(spark, path)
            .writeStream.option("checkpointLocation", ckpt)
            .foreachBatch(handle)
            .trigger(availableNow=True)
            .start()
        )
        if max_batches is None:
            q.awaitTermination()
        else:
            # stop part-way: wait for the first batch to commit
            while q.lastProgress is None or q.lastProgress.get("batchId", -1) < max_batches - 1:
                if not q.isActive:
                    break
                q.awaitTermination(0.2)
            q.stop()

    run(1)
    run(None)  # restart from the checkpoint
    run(None)  # nothing new: no batch may be added again
    want = _totals(batch.user_counts(spark, sf_small))
    assert _totals(log.totals("user", "count")) == want


def test_json_status_files_stream_like_parquet(spark, sf_small):
    """SRC1 over JSON lines: the same records, the same author counts."""
    from pulse.sources.statuses import status_records

    src = fresh_path(spark, "t-json-src")
    # Spark writes TIMESTAMP_NTZ to JSON with milliseconds unless told otherwise.
    status_records(spark, sf_small).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(src)
    log = keyed.RowLog(spark, fresh_path(spark, "t-json-log"))

    def handle(df, bid):
        log.write_batch(counts.count_by(filters.by_lang(df), F.col("user.screen_name"), "user", "count"), bid)

    q = (
        status_stream(spark, src, fmt="json")
        .writeStream.option("checkpointLocation", fresh_path(spark, "t-json-ckpt"))
        .foreachBatch(handle)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    assert _totals(log.totals("user", "count")) == _totals(batch.user_counts(spark, sf_small))

    from pulse.schema import STATUS
    from pulse.sources.statuses import flat_statuses

    original = flat_statuses(status_records(spark, sf_small))
    from_json = flat_statuses(spark.read.schema(STATUS).json(src))
    assert original.exceptAll(from_json).count() == 0 and from_json.exceptAll(original).count() == 0


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_every_stream_query_runs_several_batches(spark, sf_small):
    from pulse.streaming import jobs, replay_queries

    jobs.BATCH_SECONDS.clear()
    for name in ("stream_user_counts", "stream_hashtag_counts", "stream_fanout"):
        replay_queries.STREAM_QUERIES[name](spark, sf_small).count()
    assert {n: len(s) >= 4 for n, s in jobs.BATCH_SECONDS.items()} == {"user_counts": True, "hashtag_counts": True, "fanout": True}


def test_late_rows_count_in_totals_and_are_reported_by_closed_intervals(spark, sf_small, caplog):
    from pulse.streaming import jobs
    from pulse.streaming.replay import reversed_runs

    runs = reversed_runs(stage_replay(spark, sf_small))
    want = rows(batch.hashtag_counts(spark, sf_small))
    assert rows(jobs.hashtag_counts(spark, runs, batch.TEST_INTERVAL)) == want
    by_interval = jobs.hashtag_log(spark, runs, batch.TEST_INTERVAL).totals(["window_start", "window_end", "tags"], "freq")
    assert rows(by_interval) == rows(batch.hashtag_counts_by_interval(spark, sf_small))
    with caplog.at_level("WARNING"):
        closed = jobs.hashtag_counts_by_interval(spark, runs, batch.TEST_INTERVAL, lateness="1 second")
    assert closed.count() < by_interval.count() and "late and were dropped" in caplog.text


def test_windows_do_not_depend_on_the_session_zone(spark, sf_small):
    from pulse.streaming import jobs
    from pulse.streaming.replay import slice_runs

    want = rows(batch.hashtag_counts_by_interval(spark, sf_small))
    runs = slice_runs(stage_replay(spark, sf_small))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert rows(jobs.hashtag_counts_by_interval(spark, runs, batch.TEST_INTERVAL)) == want
        log = jobs.hashtag_log(spark, runs, batch.TEST_INTERVAL)
        assert rows(log.totals(["window_start", "window_end", "tags"], "freq")) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_lost_checkpoint_is_refused(spark, sf_small):
    import pytest

    from pulse.operators.keyed import RowLog
    from pulse.streaming import jobs
    from pulse.streaming.replay import all_slices

    log = RowLog(spark, fresh_path(spark, "t-lost"))
    log.write_batch(spark.createDataFrame([("a", 1)], "user string, count long"), 0)
    with pytest.raises(RuntimeError, match="checkpoint is gone"):
        jobs.user_counts(spark, all_slices(stage_replay(spark, sf_small)), out=log.path)


def test_the_last_of_many_versions_in_one_batch_wins(spark, sf_small):
    from pulse.sources.statuses import status_records
    from pulse.streaming import jobs

    one = status_records(spark, sf_small).where("lang = 'en'").limit(1)
    src = fresh_path(spark, "t-versions")
    versions = one.withColumn("retweet_count", F.explode(F.sequence(F.lit(0), F.lit(7)))).coalesce(1)
    versions.sortWithinPartitions("retweet_count").write.parquet(src)
    got = jobs.fanout(spark, src)["status_hifi"].collect()
    assert [r["retweet_count"] for r in got] == [7]


def test_bad_json_lines_fail_or_are_listed(spark, sf_small, tmp_path):
    import pytest

    from pulse.streaming import jobs
    from pulse.streaming.replay import bad_lines

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"id": 1, "lang": "en", "user": {"screen_name": "x"}}\n{"id": 2, "lang": \n\n{"id": 3, "lang": "en", "user": {"screen_name": "x"}}\n')
    with pytest.raises(Exception):
        jobs.user_counts(spark, jobs.StatusSource(str(src), "json"))
    got = jobs.user_counts(spark, jobs.StatusSource(str(src), "json", bad_lines="PERMISSIVE"))
    assert [tuple(r) for r in got.collect()] == [("x", 2)]
    assert [r["line"] for r in bad_lines(spark, str(src)).collect()] == ['{"id": 2, "lang": ']


def test_stream_jobs_leave_session_settings_untouched(spark, sf_small):
    from pulse.streaming import jobs
    from pulse.streaming.replay import all_slices

    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")}
    base = stage_replay(spark, sf_small)
    jobs.geo_points(spark, all_slices(base)).count()
    jobs.hashtag_counts_by_interval(spark, jobs.StatusSource(all_slices(base), state_partitions=3), batch.TEST_INTERVAL).count()
    after = {k: spark.conf.get(k, None) for k in before}
    assert after == before


def test_raw_statuses(spark, tmp_path):
    import datetime as dt
    import json

    from pulse.streaming import jobs

    src = tmp_path / "raw"
    src.mkdir()
    user = {"id": 7, "screen_name": "x", "created_at": "Wed Jan 01 00:00:00 +0000 2020", "profile_image_url_https": "https://i"}
    first = {
        "id": 1, "created_at": "Mon Jan 01 10:20:30 +0000 2024", "lang": "en", "text": "short", "full_text": "the whole text",
        "entities": {"hashtags": [{"text": "NCAA"}, {"text": "b"}]}, "extended_entities": {"media": [{"expanded_url": "https://m"}]},
        "geo": {"coordinates": [1.5, 2.5]}, "place": {"id": "p", "country_code": "US"}, "user": user,
        "retweeted_status": {"text": "old", "user": {"screen_name": "BTS_twt"}}, "unknown": [1],
    }
    second = {"id": 2, "lang": "en", "text": "t", "coordinates": {"coordinates": [3.5, 4.5]}, "user": user}
    (src / "a.json").write_text(json.dumps(first) + "\n" + json.dumps(second) + "\n" + json.dumps({"id": 3, "lang": "en"}) + "\n")
    source = jobs.StatusSource(str(src), "raw")
    points = {r["id"]: (r["longitude"], r["latitude"]) for r in jobs.geo_points(spark, source).collect()}
    assert points == {1: (2.5, 1.5), 2: (3.5, 4.5)}
    status = {r["id"]: r for r in jobs.fanout(spark, source)["status_hifi"].collect()}
    one = status[1]
    assert (one["text"], one["entities"], one["extended_entities"], one["retweeted_status"]) == ("the whole text", ["NCAA", "b"], ["https://m"], "old")
    assert one["created_at"] == dt.datetime(2024, 1, 1, 10, 20, 30) and one["in_reply_to_user_id"] == -1 and status[3]["user_id"] is None
    assert {r["tags"]: r["freq"] for r in jobs.hashtag_counts(spark, source).collect()} == {"ncaa": 1, "b": 1}
    assert [tuple(r) for r in jobs.retweeter_counts(spark, source).collect()] == [("x", 1)]


def test_staged_events_are_the_statuses_without_their_texts(spark, sf_small):
    """What a replay stages does not grow with the texts; the stream gives whole statuses, in order of delivery."""
    from pulse.sources.statuses import flat_statuses, status_records
    from pulse.streaming import jobs
    from pulse.streaming.replay import SLICE_COL, all_slices, slice_runs, stage_deliveries, stage_events

    base = stage_events(spark, sf_small)
    assert set(spark.read.parquet(base).columns) == {"event_id", "ts", "user_id", "event_type", "value", SLICE_COL}

    def streamed(runs, fmt):
        log = keyed.RowLog(spark, fresh_path(spark, "t-events"))
        source = jobs.StatusSource(runs, fmt, tables=sf_small)
        jobs._drive(spark, "t", source, jobs._batches(lambda b, i: log.write_batch(flat_statuses(b), i)), jobs.AVAILABLE_NOW, None, log.path, [log])
        return log.read()

    assert rows(streamed(all_slices(base), "events").drop("batch_id")) == rows(flat_statuses(status_records(spark, sf_small)))
    again = slice_runs(stage_events(spark, sf_small, again=True))
    assert rows(streamed(again, "events")) == rows(streamed(slice_runs(stage_deliveries(spark, sf_small)), "parquet"))


def test_a_batch_is_computed_with_the_fields_that_its_job_uses(spark, sf_small):
    from pulse.streaming import jobs
    from pulse.streaming.replay import slice_runs, stage_events

    seen = []
    source = jobs.StatusSource(slice_runs(stage_events(spark, sf_small))[:1], "events", tables=sf_small)
    make = lambda rows: seen.append(rows.columns) or rows.select("id", *jobs.ORDER)
    jobs._upserts(spark, source, "t-fields", {"t": make}, "en", None, jobs.AVAILABLE_NOW, None, fields=("id", "lang"))
    assert seen == [["id", "lang", "_file_time", "_file", "_block", "_line"]]


def test_fanout_holds_no_texts(spark, sf_small, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from pulse.streaming import jobs
    from pulse.streaming.replay import slice_runs

    held, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: held.append(df.columns) or persist(df, *a))
    tables = jobs.fanout(spark, slice_runs(stage_replay(spark, sf_small))[0])
    assert held and not any("text" in columns or "retweeted_status" in columns for columns in held)
    assert tables["status_hifi"].where("text is not null").count() > 0
