"""Lexicon sentiment: per-word lookup (J1), per-status rating (A4).

The reference collects statuses to the driver and runs one or two Spark jobs
per word.  Here a status's rating is a column over its own row: the words are
filtered by a hash set of the lexicon's words, and each score counts the hits
in its own set.  Nothing is shuffled, a repeated status is scored row by row,
and the same column serves batches and streams.

The sets are part of the plan, so this holds for lexicons up to
``LITERAL_MAX_WORDS`` words with ``LITERAL_MAX_SCORES`` different scores (both
checked).  A larger lexicon is joined: exploded words meet it by an equi-join,
and sums return to the rows by id and text digest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulse.functions.text import words

LITERAL_MAX_WORDS = 20_000
LITERAL_MAX_SCORES = 64


def status_words(statuses: DataFrame) -> DataFrame:
    """(id, pos, word): the lower-cased words of each status, split on spaces."""
    return statuses.select("id", F.posexplode(words(F.col("text"))).alias("pos", "word"))


def word_scores(statuses: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(id, pos, word, score) for every word; 0 when the lexicon lacks it.

    ``lexicon`` must hold one score per word (see ``first_wins``).  It is a
    dimension: the caller broadcasts it behind a size check, or the planner
    sort-merges.
    """
    scored = status_words(statuses).join(lexicon.select("word", "score"), "word", "left")
    return scored.select("id", "pos", "word", F.coalesce("score", F.lit(0)).alias("score"))


def literal_lexicon(lexicon: DataFrame) -> dict[str, int] | None:
    """The lexicon as a dictionary if it is small enough to be part of a plan, else None."""
    rows = lexicon.select("word", "score").where("word is not null and score is not null").limit(LITERAL_MAX_WORDS + 1).collect()
    found = {r["word"]: r["score"] for r in rows}
    if len(rows) > LITERAL_MAX_WORDS or len(set(found.values())) > LITERAL_MAX_SCORES:
        return None
    return found


def rating(text: Column, lexicon: Mapping[str, int]) -> Column:
    """The sum of the scores of a text's words; a null text has 0."""
    by_score: dict[int, list[str]] = {}
    for word, score in lexicon.items():
        if score:
            by_score.setdefault(score, []).append(word)
    if not by_score:
        return F.lit(0)
    known = [w for ws in by_score.values() for w in ws]
    hits = F.filter(words(text), lambda w: w.isin(known))
    # One pass finds the few hits; the sets of the scores see only those.
    total = F.aggregate(hits, F.lit(0), lambda acc, w: acc + _score(w, by_score))
    return F.coalesce(total, F.lit(0))


def _score(word: Column, by_score: Mapping[int, list[str]]) -> Column:
    out = None
    for score, ws in by_score.items():
        out = F.when(word.isin(ws), score) if out is None else out.when(word.isin(ws), score)
    return out.otherwise(0)


def _joined(statuses: DataFrame, lexicon: DataFrame, carry: Sequence[str]) -> DataFrame:
    """(id, text, rating) by a join, for a lexicon too large for a plan."""
    base = statuses.select("id", "text", *carry, F.struct(F.col("id"), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("_row"))
    once = base.dropDuplicates(["_row"])
    hits = once.select("_row", F.explode(words(F.col("text"))).alias("word")).join(lexicon.select("word", "score"), "word")
    sums = hits.groupBy("_row").agg(F.sum("score").cast("int").alias("rating"))
    joined = base.join(sums, base["_row"].eqNullSafe(sums["_row"]), "left")
    return joined.select("id", "text", F.coalesce("rating", F.lit(0)).alias("rating"), *carry)


def sentiment(statuses: DataFrame, lexicon: DataFrame, id_as_text: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """A4: (id, rating, text) for every status row, and the columns ``carry``; no lexicon word gives 0.

    The result table keys rows by the id as text; id and text stay whole,
    typed columns (D2 is not reproduced).
    """
    literal = literal_lexicon(lexicon)
    if literal is None:
        scored = _joined(statuses, lexicon, carry)
    else:
        scored = statuses.select("id", "text", rating(F.col("text"), literal).alias("rating"), *carry)
    sid = F.col("id").cast("string") if id_as_text else F.col("id")
    return scored.select(sid.alias("id"), "rating", "text", *carry)
