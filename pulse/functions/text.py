"""Text predicates and word splitting."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F


def contains_any(text: Column, keywords: Iterable[str]) -> Column:
    """Case-insensitive substring test against any keyword.

    ``lower(text)`` is written once; Catalyst's common-subexpression
    elimination evaluates it once per row.  ``contains`` (not ``like``) keeps
    ``%`` and ``_`` in a keyword literal.
    """
    low = F.lower(text)
    tests = [low.contains(k.lower()) for k in keywords]
    if not tests:
        return F.lit(False)
    return reduce(lambda a, b: a | b, tests)


def words(text: Column) -> Column:
    """Split on single spaces; punctuation and newlines stay inside a word."""
    return F.split(F.lower(text), " ")
