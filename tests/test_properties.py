"""Property tests: distributed operators against plain Python on random inputs."""

from hypothesis import HealthCheck, given, settings, strategies as st

from pulse.operators import counts, keyed

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

pairs = st.lists(st.tuples(st.sampled_from("abcdefgh"), st.integers(0, 6)), min_size=1, max_size=40)


@SETTINGS
@given(rows=pairs)
def test_rank_desc_equals_sql_rank(spark, rows):
    df = spark.createDataFrame([(f"{k}{i}", n) for i, (k, n) in enumerate(rows)], "k string, n long")
    got = {r["k"]: r["rank"] for r in counts.rank_desc(df, "n").collect()}
    values = [n for _, n in rows]
    want = {f"{k}{i}": 1 + sum(v > n for v in values) for i, (k, n) in enumerate(rows)}
    assert got == want


@SETTINGS
@given(rows=pairs)
def test_latest_by_key_equals_python(spark, rows):
    data = [(k, n, i) for i, (k, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, n long, seq long").repartition(3)
    got = {r["k"]: (r["n"], r["seq"]) for r in keyed.latest_by_key(df, "k", ["n", "seq"]).collect()}
    want = {}
    for k, n, i in data:
        if k not in want or (n, i) > want[k]:
            want[k] = (n, i)
    assert got == want


@SETTINGS
@given(rows=pairs, k=st.integers(1, 3))
def test_top_k_per_group_equals_python(spark, rows, k):
    from pyspark.sql import functions as F

    data = [(g, f"t{i}", n) for i, (g, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, tag string, n long")
    out = counts.top_k_per_group(df, "g", k, [F.desc("n"), F.asc("tag")]).collect()
    got = sorted((r["g"], r["tag"]) for r in out)
    want = []
    for g in {g for g, _, _ in data}:
        members = sorted((-n, t) for gg, t, n in data if gg == g)[:k]
        want += [(g, t) for _, t in members]
    assert got == sorted(want)


VOCAB = ["that", "That", "THIS", "with", "with,", "eriner", "rely", "of", "and!", "x", "", "\n", "that\nwith"]


@SETTINGS
@given(texts=st.lists(st.lists(st.sampled_from(VOCAB), max_size=12), min_size=1, max_size=8))
def test_sentiment_equals_brute_force(spark, texts):
    """Ratings against plain Python: split on single spaces, lower-case, first entry wins."""
    from edge_rows import status
    from pulse.operators import sentiment
    from pulse.schema import STATUS
    from pulse.sources.lexicon import FIXTURE_LEXICON, first_wins, fixture_lexicon

    rows = [status(i, text=" ".join(words)) for i, words in enumerate(texts)]
    df = spark.createDataFrame(rows, STATUS)
    got = {r["id"]: r["rating"] for r in sentiment.sentiment(df, first_wins(fixture_lexicon(spark))).collect()}
    scores = {}
    for _, word, score in sorted(FIXTURE_LEXICON):
        scores.setdefault(word, score)
    want = {str(r["id"]): sum(scores.get(w.lower(), 0) for w in r["text"].split(" ")) for r in rows}
    assert got == want
