"""Every registered query against its DuckDB oracle on the smallest tables."""

import sys

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from pulse.plans.oracle import oracle_sql
from pulse.plans.registry import all_queries

QUERIES = all_queries()  # the library's own; those of pulse.llm have their tests in tests/llm
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["user", "count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    ok, msg = compare(QUERIES[name](spark, sf_small), con, SQL[name])
    assert ok, msg


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stream_", "compacted_"))))
def test_column_types_match_oracle(spark, con, sf_small, name):
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in QUERIES[name](spark, sf_small).schema}
    rel = con.sql(SQL[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert spark_types == duck_types


def test_queries_run_in_a_second_session(spark, sf_small, con):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    for name in ("sql_view_scan", "status_user_place"):
        ok, msg = compare(QUERIES[name](other, sf_small), con, SQL[name])
        assert ok, msg


@pytest.mark.parametrize("missing", ["pulse.llm", "pulse.llm.queries", "public_tokenizers"])
def test_entry_works_without_the_llm_subpackage_or_what_it_needs(monkeypatch, missing):
    for name in [m for m in sys.modules if m.startswith("pulse.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(SQL)
