"""Operators on hand-made edge rows."""

import pytest
from pyspark.sql import functions as F

from edge_rows import edge_df, status
from pulse.operators import counts, filters, keyed, sentiment, shape
from pulse.schema import STATUS
from pulse.sources.lexicon import first_wins, fixture_lexicon


@pytest.fixture(scope="module")
def edges(spark):
    return edge_df(spark)


@pytest.fixture(scope="module")
def lex(spark):
    return first_wins(fixture_lexicon(spark))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_lang_filter_drops_null_language(edges):
    assert 5 not in ids(filters.by_lang(edges))


def test_us_filter_needs_place_and_code(edges):
    assert ids(filters.us_english(edges)) == [3, 4]


def test_hashtags_lower_cased_and_repeats_kept(edges):
    rows = shape.hashtags(filters.us_english(edges)).collect()
    assert sorted((r["id"], r["pos"], r["tag"]) for r in rows) == [
        (3, 0, "alpha"),
        (3, 1, "alpha"),
        (3, 2, "beta"),
    ]
    got = {r["tags"]: r["freq"] for r in counts.count_by(shape.hashtags(filters.us_english(edges)), "tag", "tags", "freq").collect()}
    assert got == {"alpha": 2, "beta": 1}


def test_geo_points_only_with_geo(edges):
    rows = shape.geo_points(filters.with_geo(edges)).collect()
    assert [(r["id"], r["longitude"], r["latitude"]) for r in rows] == [(6, -20.25, 10.5)]


def test_retweets_of_account_ignores_case(edges):
    assert ids(filters.retweets(edges)) == [8, 9]
    assert ids(filters.retweets_of(edges, "bts_twt")) == [8]


def test_keyword_tracks_overlap(edges):
    a = ids(filters.on_track(edges, ["eriner"]))
    b = ids(filters.on_track(edges, ["eriner", "rely"]))
    assert a == [14] and b == [14]


def test_keyword_is_literal_not_pattern(spark):
    df = spark.createDataFrame([status(1, text="100% sure"), status(2, text="100 percent")], STATUS)
    assert ids(filters.on_track(df, ["0%"])) == [1]
    assert ids(filters.on_track(df, ["_"])) == []


def test_sentiment_edges(edges, lex):
    got = {r["id"]: r["rating"] for r in sentiment.sentiment(filters.by_lang(edges), lex).collect()}
    assert got["10"] == 0  # empty text
    assert got["11"] == 4  # "that," and "commas," keep their commas: "with" (+1), "this" (+3)
    assert got["12"] == 0  # "that\nwith" is one word
    assert got["13"] == 3  # "that!" does not match, "this" does
    assert got["14"] == 4 - 4 + 2  # eriner + rely + that
    assert got["15"] == 6  # first "that" (+2) wins, three times


def test_word_scores_positions(edges, lex):
    rows = sentiment.word_scores(edges.where("id = 14"), lex).collect()
    assert sorted((r["pos"], r["word"], r["score"]) for r in rows) == [
        (0, "eriner", 4),
        (1, "rely", -4),
        (2, "that", 2),
    ]
    rows = sentiment.word_scores(edges.where("id = 13"), lex).collect()
    assert {r["word"]: r["score"] for r in rows}["that!"] == 0  # listed, with 0


@pytest.mark.parametrize("words", [0, 20_000])
def test_rating_of_repeated_ids_with_and_without_a_join(spark, edges, lex, monkeypatch, words):
    monkeypatch.setattr(sentiment, "LITERAL_MAX_WORDS", words)
    rows = edges.where("id in (13, 14, 15)")
    twice = rows.union(rows).union(rows.where("id = 14").withColumn("text", F.lit("eriner")))
    got = sorted((r["id"], r["rating"]) for r in sentiment.sentiment(twice, lex).collect())
    assert got == [("13", 3), ("13", 3), ("14", 2), ("14", 2), ("14", 4), ("15", 6), ("15", 6)]


def test_rank_keeps_null_values_and_reads_its_input_once(spark):
    from pulse.operators import counts

    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for x in it:
            seen.add(1)
            yield x

    df = spark.createDataFrame(spark.sparkContext.parallelize([("a", 3), ("b", None), ("c", 5), ("d", 3), ("e", None)]).mapPartitions(count), "k string, v long")
    got = {r["k"]: r["rank"] for r in counts.rank_desc(df, "v").collect()}
    assert got == {"c": 1, "a": 2, "d": 2, "b": 4, "e": 4} and seen.value == 5


def test_size_check_counts_bytes_anew(spark):
    from pulse.functions.sizing import fits

    small, large = (spark.createDataFrame([("x" * n,)], "w string") for n in (10, 5000))
    assert fits(small, 1000) and not fits(large, 1000) and fits(spark.range(60), 2000) and not fits(spark.range(1000), 2000)


def test_place_rows_fall_back_to_status_id(edges):
    rows = {r["id"] for r in shape.place_rows(edges.where("id in (1, 3)")).collect()}
    assert rows == {"1", "p1"}
    assert shape.place_rows(edges.where("id = 1"), keep_placeless=False).count() == 0


def test_status_rows_sentinels(edges):
    r = shape.status_rows(edges.where("id = 7")).first()
    assert (r["longitude"], r["latitude"]) == (181.0, 91.0)
    assert r["created_at"] == "Mon Jan 01 00:07:00 UTC 2024"


def test_user_rows_text_form(edges):
    r = shape.user_rows(edges.where("id = 1")).first()
    assert r["created_at"] == "Wed Jan 01 00:00:00 UTC 2020"
    assert r["withheld_in_countries"] == ""


def test_latest_by_key_redelivery(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id long, v string, delivery_no int"
    )
    got = {r["id"]: r["v"] for r in keyed.latest_by_key(df, "id", ["delivery_no"]).collect()}
    assert got == {1: "b", 2: "c"}


def test_rank_desc_matches_sql_rank(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 5), ("d", 1)], "k string, n long")
    got = {r["k"]: r["rank"] for r in counts.rank_desc(df, "n").collect()}
    assert got == {"a": 1, "c": 1, "b": 3, "d": 4}


def test_top_k_per_group_breaks_ties_by_key(spark):
    df = spark.createDataFrame(
        [("w", "x", 2), ("w", "y", 2), ("w", "z", 1), ("v", "x", 1)], "g string, k string, n long"
    )
    out = counts.top_k_per_group(df, "g", 1, [F.desc("n"), F.asc("k")]).collect()
    assert sorted((r["g"], r["k"]) for r in out) == [("v", "x"), ("w", "x")]


def test_running_totals(spark):
    df = spark.createDataFrame(
        [("u", 2, 1), ("u", 1, 3), ("v", 1, 5)], "user string, window_start int, count long"
    )
    got = {(r["user"], r["window_start"]): r["running_count"] for r in counts.running_totals(df, "user").collect()}
    assert got == {("u", 1): 3, ("u", 2): 4, ("v", 1): 5}


def test_hot_key_with_a_third_of_rows(spark):
    """One author writes a third of all statuses: counts and upserts stay exact."""
    from edge_rows import user

    rows = [status(i, user=user(7 if i % 3 == 0 else 100 + i, followers=i)) for i in range(900)]
    df = spark.createDataFrame(rows, STATUS).repartition(8)
    got = {r["user"]: r["count"] for r in counts.count_by(df, F.col("user.screen_name"), "user").collect()}
    assert got["User_7"] == 300 and len(got) == 601
    latest = keyed.latest_by_key(shape.user_rows(df, carry=(F.col("id").alias("_sid"),)), "id", ["_sid"])
    hot = latest.where("id = 7").collect()
    assert len(hot) == 1 and hot[0]["followers_count"] == 897


def test_approx_distinct_is_close(spark):
    from edge_rows import user

    df = spark.createDataFrame([status(i, user=user(i % 400)) for i in range(2000)], STATUS)
    exact = counts.distinct_total(df, F.col("user.screen_name")).first()[0]
    approx = counts.distinct_total(df, F.col("user.screen_name"), exact=False).first()[0]
    assert exact == 400 and abs(approx - 400) <= 0.05 * 400
