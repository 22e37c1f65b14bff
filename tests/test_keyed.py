"""Row logs: idempotent batches, merge-on-read, counters, compaction; lexicon reader."""

import pytest

from pulse.operators import keyed
from pulse.session import fresh_path
from pulse.sources.lexicon import first_wins, read_lexicon


def test_rewritten_batch_is_not_counted_twice(spark):
    log = keyed.RowLog(spark, fresh_path(spark, "t-counter"))
    inc = spark.createDataFrame([("a", 2), ("b", 1)], "k string, n long")
    log.write_batch(inc, 0)
    log.write_batch(inc, 0)  # a replayed batch
    log.write_batch(spark.createDataFrame([("a", 5)], "k string, n long"), 1)
    got = {r["k"]: r["n"] for r in log.totals("k", "n").collect()}
    assert got == {"a": 7, "b": 1}


def test_upsert_later_batch_wins_and_compaction_keeps_it(spark):
    log = keyed.RowLog(spark, fresh_path(spark, "t-upsert"))
    log.write_batch(spark.createDataFrame([(1, "old"), (2, "x")], "id long, v string"), 0)
    log.write_batch(spark.createDataFrame([(1, "new")], "id long, v string"), 1)
    got = {r["id"]: r["v"] for r in log.current("id").collect()}
    assert got == {1: "new", 2: "x"}
    log.compact("id")
    assert log.read().count() == 2 and log.folders() == 1
    log.write_batch(spark.createDataFrame([(2, "y")], "id long, v string"), 2)
    got = {r["id"]: r["v"] for r in log.current("id").collect()}
    assert got == {1: "new", 2: "y"} and log.folders() == 2


def test_counter_compaction_keeps_sums(spark):
    log = keyed.RowLog(spark, fresh_path(spark, "t-counter-c"))
    for b, n in enumerate((3, 4, 5)):
        log.write_batch(spark.createDataFrame([("a", n), ("b", 1)], "k string, n long"), b)
    totals = lambda: {r["k"]: r["n"] for r in log.totals("k", "n").collect()}
    log.compact_counter("k", "n")
    assert totals() == {"a": 12, "b": 3} and log.folders() == 1
    log.compact_counter("k", "n")  # nothing new: nothing to do
    log.append(spark.createDataFrame([("a", 2)], "k string, n long"))  # K6
    assert totals() == {"a": 14, "b": 3}
    log.compact_counter("k", "n")
    assert totals() == {"a": 14, "b": 3} and log.folders() == 1


def test_a_failed_write_leaves_no_batch(spark):
    import pytest
    from pyspark.sql import functions as F

    log = keyed.RowLog(spark, fresh_path(spark, "t-failed"))
    good = spark.createDataFrame([("a", 1)], "k string, n long")
    log.write_batch(good, 0)
    with pytest.raises(Exception, match="boom"):
        log.write_batch(good.withColumn("n", F.raise_error(F.lit("boom")).cast("long")), 1)
    assert log.batches() == [0] and log.read().count() == 1


def test_logs_as_sql_views(spark):
    from pulse.plans.views import register_log

    log = keyed.RowLog(spark, fresh_path(spark, "t-view"))
    log.write_batch(spark.createDataFrame([(1, "old", 1), (2, "x", 1)], "id long, v string, _ts int"), 0)
    log.write_batch(spark.createDataFrame([(1, "new", 2)], "id long, v string, _ts int"), 1)
    register_log(spark, "t_view", log.path, ["id"])
    assert [tuple(r) for r in spark.sql("SELECT * FROM t_view ORDER BY id").collect()] == [(1, "new"), (2, "x")]


def test_counter_bump(spark):
    inc = spark.createDataFrame([("ncaa", 3), ("x", 1)], "tags string, freq long")
    bumped = keyed.counter_totals(keyed.counter_bump(inc, {"tags": "ncaa"}, "freq", 2), "tags", "freq")
    assert {r["tags"]: r["freq"] for r in bumped.collect()} == {"ncaa": 5, "x": 1}


def test_lexicon_file_first_entry_wins_and_bad_lines_fail(spark, tmp_path):
    import pytest

    p = tmp_path / "lexicon.tsv"
    p.write_text("good\t3\nbad\t-2\ngood\t-1\nodd\tnotanumber\n")
    lex = {r["word"]: r["score"] for r in first_wins(read_lexicon(spark, str(p), mode="DROPMALFORMED")).collect()}
    assert lex == {"good": 3, "bad": -2}
    with pytest.raises(Exception, match="(?i)malformed"):
        first_wins(read_lexicon(spark, str(p))).collect()


def test_first_entry_wins_over_files_in_name_order(spark, tmp_path):
    d = tmp_path / "lex"
    d.mkdir()
    (d / "a.tsv").write_text("word\t3\n")
    (d / "b.tsv").write_text("word\t-1\n" + "".join(f"w{i}\t1\n" for i in range(5000)))  # larger: read first
    lex = {r["word"]: r["score"] for r in first_wins(read_lexicon(spark, str(d))).collect()}
    assert lex["word"] == 3 and len(lex) == 5001


def test_day_partitioned_log_prunes_on_read(spark):
    import contextlib
    import io

    from pyspark.sql import functions as F

    log = keyed.RowLog(spark, fresh_path(spark, "t-day"), partition_by=("day",))
    rows = spark.createDataFrame(
        [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")], "k string, n long, day string"
    ).withColumn("day", F.to_date("day"))
    log.write_batch(rows, 0)
    one_day = log.read().where(F.col("day") == F.lit("2024-01-02").cast("date"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one_day.explain("formatted")
    assert "PartitionFilters: [isnotnull(day" in buf.getvalue()
    assert [r["k"] for r in one_day.collect()] == ["b"]

    log.compact("k")
    pruned = log.read().where(F.col("day") == F.lit("2024-01-02").cast("date"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        pruned.explain("formatted")
    assert "PartitionFilters: [isnotnull(day" in buf.getvalue()
    assert [r["k"] for r in pruned.collect()] == ["b"]


@pytest.mark.parametrize("bits", [27, 15, 3])
def test_latest_of_repeats_is_latest_by_key_and_shuffles_no_single_rows(spark, monkeypatch, bits):
    from pulse.operators import keyed

    monkeypatch.setattr(keyed, "REPEATED_BITS", bits)
    data = [(i % 700, i, f"text {i}") for i in range(1000)] + [(None, 1, "a"), (None, 2, "b"), (-(2**60), 5, None)]
    df = spark.createDataFrame(data, "id long, n long, text string").repartition(5)
    got = keyed.latest_of_repeats(df, "id", ["n"])
    key = lambda r: repr(tuple(r))
    assert got.columns == df.columns
    assert sorted(got.collect(), key=key) == sorted(keyed.latest_by_key(df, "id", ["n"]).collect(), key=key)
    once = keyed.latest_of_repeats(df.where("id >= 0 and n < 700"), "id", ["n"])
    assert once.count() == 700


@pytest.mark.parametrize("limit", [keyed.PLACE_BYTES, 0])
def test_latest_of_a_log_is_latest_by_key_and_shuffles_no_texts(spark, monkeypatch, limit):
    from pyspark.sql import functions as F

    monkeypatch.setattr(keyed, "PLACE_BYTES", limit)  # 0: the log is too large for marks
    log = keyed.RowLog(spark, fresh_path(spark, "t-latest"), wide=True)
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 50 > 0, F.col("id") % 30_000).alias("id"), F.col("id").alias("n"), F.concat(F.lit("text "), "id").alias("text")
    )  # ids that come once, twice and 800 times (null)
    order = (keyed.BATCH_COL, "n")
    for b, part in enumerate((rows.where("n < 30000"), rows.where("n >= 20000"), rows.where("n % 7 = 0").withColumn("n", F.lit(-1)))):
        log.write_batch(part.repartition(3), b)  # repeats inside and across batches
        if b == 1:
            log.compact("id", order)
    got, want = log.latest("id", order), keyed.latest_by_key(log.read(), "id", order)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    if limit:
        plan = got._jdf.queryExecution().sparkPlan().toString()
        shuffled = [line for line in plan.splitlines() if "Window" in line or "SortMergeJoin" in line]
        assert shuffled and not any("text" in line for line in shuffled)


def test_texts_that_come_again_are_stored_once_a_file(spark):
    from pyspark.sql import functions as F

    log = keyed.RowLog(spark, fresh_path(spark, "t-wide"), wide=True)
    text = F.concat(*(F.sha2(F.concat(F.floor(F.col("id") / 2) % 100, F.lit(f" {i}")).cast("string"), 512) for i in range(200)))
    log.write_batch(spark.range(0, 1000, 1, 1).select("id", text.alias("text")), 0)  # 25 MB of texts, 2.5 MB of different ones
    path = spark._jvm.org.apache.hadoop.fs.Path(log.path)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    assert size < 3_000_000 and log.read().agg(F.min(F.length("text"))).first()[0] == 200 * 128
