"""The pipeline against a brute-force version, and every stage on odd tables."""

import base64
import hashlib
import os
import sys

import public_tokenizers as P
import pytest
import tiktoken

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from pulse.llm import queries  # noqa: E402
from test_decontaminate import brute as brute_hits  # noqa: E402
from test_dedup_and_filter import brute_simhash  # noqa: E402

SF = "/root/testdata/sf0.001"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_run_matches_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    toxic = {r.doc_id for r in queries.QUERIES["op3_toxicity"](spark, SF).where("predicted = 1").collect()}
    left = {i: t for i, t in docs.items() if i not in toxic}
    last = {}
    for i, t in left.items():
        last[t.translate(AZ)] = max(i, last.get(t.translate(AZ), i))
    left = {i: left[i] for i in last.values()}
    left = {i: left[i] for i, _, low in brute_simhash(list(left.items())) if i == low}
    left = {i: left[i] for i, _, n_hit, _ in brute_hits(list(left.items()), items) if not n_hit}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, t in left.items():
        ids = library.encode_ordinary(t)
        want[i] = (ids, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (list(r.ids), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(want) < len(docs)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_tables(spark, name, stage):
    rows = [(1, "Some text here", "en", "s", 14, 0.5), (1, "Some text here", "en", "s", 14, 0.5), (2, "some TEXT here", None, None, None, None)]
    rows += [(3, None, "en", "s", 0, None), (4, "", "en", "s", 0, None), (None, "no id", "en", "s", 5, None), (5, "w " * 60_000, "en", "s", 1, 1.0)]
    # Columns named as the operators' own.
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp double").selectExpr(
        "*", "1 as key", "'r' as row", "2 as hash", "3 as id", "4 as ids"
    )
    out = stage(spark, docs, SF)
    assert out.count() >= 3
    if name != "byte_bpe":
        assert out.columns == docs.columns and {r.key for r in out.collect()} == {1}
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_every_operator_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
