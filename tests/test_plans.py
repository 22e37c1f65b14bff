"""Physical-plan properties that matter at scale."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from pulse.plans import batch
from pulse.plans.registry import BATCH_QUERIES

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
CROSS_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_python_and_no_cross_join_in_batch_plans(spark, sf_small, name):
    text = plan_text(BATCH_QUERIES[name](spark, sf_small))
    assert not any(n in text for n in PYTHON_NODES + CROSS_NODES)


def test_language_filter_reaches_documents_scan_and_text_is_pruned(spark, sf_small):
    text = plan_text(batch.user_counts(spark, sf_small))
    docs_scan = [b for b in text.split("\n\n") if "documents.parquet" in b and "ReadSchema" in b]
    assert docs_scan, text
    assert any("EqualTo(lang,en)" in b for b in docs_scan)
    assert all("text:string" not in b for b in docs_scan)


def test_keyword_filter_runs_on_documents_side(spark, sf_small):
    text = plan_text(batch.track_a(spark, sf_small))
    docs_filters = [
        b for b in text.split("\n\n") if b.startswith("(") and "Filter" in b.split("\n")[0] and "attion" in b
    ]
    assert docs_filters
    assert all("event_id" not in b for b in docs_filters)


@pytest.mark.parametrize("name", ["top_hashtags_by_interval", "upsert_users", "upsert_statuses"])
def test_partial_group_limit_before_shuffle(spark, sf_small, name):
    text = plan_text(BATCH_QUERIES[name](spark, sf_small), "simple")
    lines = text.splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(limits) >= 2 and exchanges
    assert max(limits) > min(exchanges)  # one limit below the first exchange


def test_wide_columns_pruned_through_upsert(spark, sf_small):
    from pulse.plans import views

    parts = views.narrow_tables(spark, sf_small)
    assert [sorted(spark.read.parquet(df.inputFiles()[0]).columns) for df in parts] == [
        ["id", "place_id", "user_id"],
        ["followers_count", "screen_name", "user_id"],
        ["place_full_name", "place_id"],
    ]
    text = plan_text(views.result_tables(spark, sf_small)["status_hifi"].select("id", "user_id", "place_id"))
    assert "text:string" not in text


def test_entry_schema_is_stable(spark):
    assert [f.simpleString() for f in entry.entry(spark).schema] == ["user:string", "count:bigint"]


def test_rank_join_back_is_broadcast_without_auto_broadcast(spark, sf_small):
    """The skewed join on a count never shuffles the ranked rows."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(batch.ranked_hashtags(spark, sf_small), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    top = [line for line in text.splitlines() if "Join" in line][0]
    assert "BroadcastHashJoin" in top and "freq" in top


def test_sentiment_of_stored_statuses_is_one_scan_without_a_shuffle(spark, sf_small):
    from pulse.operators import filters, sentiment
    from pulse.schema import STATUS
    from pulse.session import fresh_path
    from pulse.sources.statuses import status_records

    path = fresh_path(spark, "t-plan-statuses")
    status_records(spark, sf_small).write.parquet(path)
    stored = spark.read.schema(STATUS).parquet(path)
    df = sentiment.sentiment(filters.on_track(filters.by_lang(stored), batch.TEST_TRACK_A), batch.lexicon(spark))
    assert df.count() > 0
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()  # as it ran
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan


def test_raw_lines_are_written_compressed(spark, sf_small):
    lines = batch._raw_lines(spark, sf_small)
    assert lines.count() == batch.statuses(spark, sf_small).count()
    assert all(f.endswith(".gz") for f in lines.inputFiles())
