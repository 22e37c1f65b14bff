"""Registered queries of the operators, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulse.llm import byte_bpe, decontaminate, exact_dedup, fp_rank, html_text, ngram_lm, periodic_runs, simhash, substring_dedup, suffix_dedup, toxicity, url_filter, warc_zip
from pulse.llm.common import crc_bucket, table

Query = Callable[[SparkSession, str], DataFrame]

#: (verdict, host, path)
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.verdicts(table(spark, sf_dir, "documents"))


def held_out(doc_id, remainder: int):
    """True where crc32 of the id as text leaves ``remainder`` modulo 5; false for a null id."""
    return F.coalesce(crc_bucket(doc_id) == remainder, F.lit(False))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Toxicity:
    """Learns from the labels of the rows that are not held out."""
    return toxicity.train(docs, labels.where(~held_out(F.col("doc_id"), 0)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id"), 0).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc_zip.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
    return back.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def tokenised(docs: DataFrame) -> DataFrame:
    """doc_id, the ids of the text, and the bytes that they decode to."""
    bpe = byte_bpe.ByteBPE(docs.sparkSession, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return docs.select("doc_id", bpe.round_trip(F.col("text")).alias("t")).select("doc_id", "t.ids", "t.decoded")


def token_digests(docs: DataFrame) -> DataFrame:
    return tokenised(docs).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents")).drop("ids")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(table(spark, sf_dir, "documents"), min_words=50, similarity=0.8)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = held_out(F.col("doc_id"), 1)
    model = ngram_lm.train(docs.where(~held))
    scored = docs.select("doc_id", held.alias("held_out"), model.score(F.col("text")).alias("s"))
    return scored.select("doc_id", "held_out", "s.n_tokens", "s.n_known", F.lit(model.N).cast("long").alias("train_tokens"), "s.base_score", "s.score")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text: of every tenth document by crc32 of the id, the words from some place on repeat the first few of them."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.expr("crc32(cast(doc_id AS string)) div 10").alias("g"))
    picked = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    picked = picked.withColumn("a", F.expr("cast(g % n AS int)"))
    picked = picked.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) AS int)"))
    tail = "slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) AS int))), 1, n - a)"
    text = F.expr(f"CASE WHEN n > 0 THEN array_join(concat(slice(words, 1, a), {tail}), ' ') ELSE text END")
    return picked.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_periodic_tails(table(spark, sf_dir, "documents"))
    found = docs.select("doc_id", periodic_runs.periodic_runs(F.col("text"), min_length=6, min_exponent=4).alias("r"))
    # Runs come by start and period, so the first of equal exponents wins.
    stronger = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    found = found.select("doc_id", "r.runs", "r.collapsed", F.aggregate("r.runs", none, stronger).alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_rank.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc": op5_warc,
    "op6_url_filter": op6_url_filter,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_html_text": op8_html_text,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_lm_score": op10_lm_score,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ranked_search": op13_ranked_search,
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES: dict[str, str] = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)
    """,
    "op4_decontaminate": f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), i AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), s AS (
            SELECT item_id, w, least(len(w), 10) AS m, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS pos FROM i WHERE len(w) > 0
        ), win AS (
            SELECT DISTINCT item_id, m, array_to_string(w[pos:pos + m - 1], ' ') AS g FROM s
        ), ds AS (
            SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS pos FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m
        ), dw AS (
            SELECT doc_id, m, pos, array_to_string(w[pos:pos + m - 1], ' ') AS g FROM ds
        ), hit AS (
            SELECT doc_id, m, pos, item_id FROM dw JOIN win USING (m, g)
        ), words AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(pos, pos + m - 1)) AS p FROM hit) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages
        ), b AS (
            SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(CAST('0x' || substr(sha1(body), i, 1) AS INTEGER)), 4, '0')), '') AS bits,
                   max(page_id) OVER (PARTITION BY body) AS newest
            FROM p
        )
        SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST('0b' || substr(bits, 5 * i + 1, 5) AS INTEGER), 1)), '') AS payload_digest,
               CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < newest THEN newest END AS refers_to
        FROM b
    """,
    "op6_url_filter": f"""
        WITH u AS (
            SELECT page_id, strpos(url, '://') AS p, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), h AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_AZ}) AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u
        ), r(verdict, rhost, rpath) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), m AS (
            SELECT h.page_id, h.host, h.path, r.rhost || r.rpath AS rule, r.verdict,
                   row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST, length(r.rhost) DESC) AS k
            FROM h LEFT JOIN r ON (h.host = r.rhost OR h.host LIKE '%.' || r.rhost) AND starts_with(h.path, r.rpath)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
    """,
    # Holds for pages whose mark-up is that of the given tables: one article of plain h1, p, b and br.
    "op8_html_text": """
        WITH a AS (
            SELECT page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS body FROM pages
        ), t AS (
            SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(p|br|h1)>', ' ', 'g'), '</?b>', '', 'g') AS body FROM a
        ), d AS (
            SELECT page_id, url, replace(replace(replace(replace(body, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)) AS body FROM t
        ), w AS (
            SELECT page_id, url, trim(regexp_replace(regexp_replace(body, '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) AS text FROM d
        )
        SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM w
    """,
    "op13_ranked_search": f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), i AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), q AS (
            SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM i) GROUP BY ALL
        ), c AS (
            SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0
        ), m AS (
            SELECT doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms AS m FROM d, c WHERE len(w) > 0
        ), t AS (
            SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL
        ), wt AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c
        ), s AS (
            SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM q JOIN wt USING (term) JOIN t USING (term) JOIN m USING (doc_id) GROUP BY ALL
        ), r AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
        )
        SELECT * FROM r WHERE rank <= 10
    """,
}
