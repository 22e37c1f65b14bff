"""Heavy hitters, stored sketches, large keyword lists and bucketed tables: results and plans on made-up skew."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from pulse.operators import heavy, sketches, tracks
from pulse.plans import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- heavy hitters ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows: one key with a third of them, two with a fifth, null keys, and 8,000 keys of one row each."""
    hot = [("hot", 6700), ("a", 2000), ("b", 2000)]
    parts = [spark.range(n).select(F.lit(k).alias("k")) for k, n in hot]
    parts += [spark.range(1300).select(F.lit(None).cast("string").alias("k")), spark.range(8000).select(F.concat(F.lit("rare"), "id").alias("k"))]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


def test_heavy_hitters_are_exact(skewed):
    count = lambda f: {r.k: r["count"] for r in heavy.heavy_hitters(skewed, "k", f).collect()}
    assert count(0.1) == {"hot": 6700, "a": 2000, "b": 2000}
    assert count(6700 / 18700) == {"hot": 6700} and count(0.5) == {}
    assert len(count(1e-4)) == 3  # at least two rows
    assert heavy.heavy_hitters(skewed.limit(0), "k", 0.1).count() == 0
    with pytest.raises(ValueError):
        heavy.heavy_hitters(skewed, "k", 0.0)


def test_rare_keys_are_not_shuffled(spark, skewed):
    cells = heavy.sketch(skewed, "k")
    assert cells.count() <= heavy.DEPTH * heavy.WIDTH
    assert cells.where("row = 2").agg(F.sum("n")).first()[0] == 18700
    left = heavy.candidates(skewed, "k", cells.where("n >= 1870"))
    assert left.select("k").distinct().count() <= 3 + 8  # rare keys that share all their cells with heavy ones
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(heavy.heavy_hitters(skewed, "k", 0.1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "LeftSemi" in below and "LeftSemi" not in above and text.count("BroadcastHashJoin") == heavy.DEPTH


# --- sketches ----------------------------------------------------------------------------
def test_spans_of_stored_sketches(spark):
    day = dt.date(2024, 1, 1)
    rows = spark.range(60_000).select(
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.expr("make_dt_interval(id % 20)")).alias("created_at"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise((F.col("id") % 9000).cast("string")).alias("user"),
    )
    stored = sketches.store(sketches.by_day(rows, "user"))
    assert stored.count() == 20
    pairs = [(0, 1), (0, 20), (3, 9), (15, 40), (-9, 2), (5, 5), (30, 40), (0, 20)]
    spans = spark.createDataFrame([(day + dt.timedelta(a), day + dt.timedelta(b)) for a, b in pairs], "span_start date, span_end date")
    exact = {(r[0], r[1]): r.n for r in sketches.exact_over(rows, "user", spans, "n").collect()}
    estimated = {(r[0], r[1]): r.estimate for r in sketches.distinct_over(stored, spans).collect()}
    assert set(exact) == set(estimated) and len(exact) == 5  # empty spans have no row
    for span, n in exact.items():
        assert abs(estimated[span] - n) <= sketches.relative_error() * n
    halves = [sketches.store(sketches.by_day(rows.where(f"id % 2 = {i}"), "user")) for i in (0, 1)]
    merged = {(r[0], r[1]): r.estimate for r in sketches.distinct_over(sketches.merge(*halves), spans).collect()}
    assert all(abs(merged[span] - n) <= sketches.relative_error() * n for span, n in exact.items())
    assert "Scan parquet" in plan(sketches.distinct_over(stored, spans)) or "FileScan parquet" in plan(sketches.distinct_over(stored, spans))


# --- keyword lists -------------------------------------------------------------------------
TEXTS = [(1, "The Quick brown fox"), (2, None), (3, ""), (4, "100% sure_thing\nfoxtrot"), (5, "ÉCOLE école Straße"), (6, "aaaa"), (6, "aaaa"), (None, "quick"), (7, "x😀y? " + "long" * 20), (8, "😀y")]
KEYWORDS = ["quick", "QUICK", "fox", "foxtrot", "0%", "e_t", "a", "aa", "aaaaa", "école", "stra", "g\nf", "", None, "x", "brown fox", "😀y", "?y", "y?", "long" * 12, "long" * 21]


def test_tracks_against_plain_search(spark):
    docs = spark.createDataFrame([(i, t, "k") for i, t in TEXTS], "id long, text string, keywords string")
    words = spark.createDataFrame([(k,) for k in KEYWORDS], "keyword string")
    got = sorted(map(tuple, tracks.on_tracks(docs, words).collect()), key=repr)
    distinct = {k.lower() for k in KEYWORDS if k}
    want = sorted({(i, k) for i, t in TEXTS for k in distinct if k in (t or "").lower()}, key=repr)
    assert got == want
    assert tracks.on_tracks(docs, words.limit(0)).count() == 0 and tracks.on_tracks(docs.limit(0), words).count() == 0


def test_tracks_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame(TEXTS, "id long, text string")
    words = spark.createDataFrame([(k,) for k in KEYWORDS], "keyword string")
    want = sorted(map(tuple, tracks.on_tracks(docs, words).collect()), key=repr)
    monkeypatch.setattr(tracks, "INDEX_BYTES", 400)
    parts = tracks.on_tracks(docs, words)
    assert plan(parts).count("Union") >= 1
    assert sorted(map(tuple, parts.collect()), key=repr) == want


def test_every_keyword_has_one_gram_and_rare_ones_are_chosen(spark):
    words = spark.createDataFrame([(f"the{w}",) for w in ("qzx", "vkj", "wpy")], "keyword string")
    index = tracks.keyword_index(words).collect()
    assert len(index) == 3 and all(r.gram != "the" and r.keyword[r["at"] :].startswith(r.gram) for r in index)


def test_time_is_flat_in_the_number_of_keywords(spark, sf_small):
    from pulse.plans import batch

    docs = batch.english(spark, sf_small).select("id", "text").repartition(8)
    docs = docs.sparkSession.createDataFrame(docs.collect(), "id long, text string").repartition(8)
    words = lambda n: spark.range(n).select(F.concat(F.substring(F.md5(F.col("id").cast("string")), 1, 7), F.lit("q")).alias("keyword"))

    def seconds(n):
        df = tracks.on_tracks(docs, words(n))
        at = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - at

    seconds(10)
    few, many = min(seconds(100) for _ in range(3)), min(seconds(10_000) for _ in range(3))
    assert many < 3 * few + 1  # a hundred times the keywords


# --- bucketed tables -------------------------------------------------------------------------
def test_joins_of_bucketed_tables_have_no_exchange(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500 + 10).alias("user_id"))
    facts = facts.unionByName(spark.range(3000, 3010).select("id", F.lit(None).cast("long").alias("user_id")))
    users = spark.range(400).select(F.col("id").alias("user_id"), F.concat(F.lit("u"), "id").alias("name"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = catalog.colocate(facts, users, "user_id", "user_id", "t", buckets=8)
        joined = catalog.join_colocated(spark, *tables, "user_id")
        text = plan(joined)
        assert "Exchange" not in text and "SortMergeJoin" in text
        got = sorted(map(tuple, joined.select("id", "user_id", "name").collect()))
        want = facts.where("user_id is not null").join(users, "user_id", "left").select("id", "user_id", "name")
        assert got == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The key with a third of the rows is dealt to several buckets; a bucket is a file.
    rows = spark.table(tables[0]).groupBy(F.input_file_name()).count()
    assert rows.agg(F.max("count")).first()[0] < 3000 / 3
    assert spark.table(tables[1]).where("user_id = 7").count() > 1
