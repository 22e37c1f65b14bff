"""Size-checked broadcast.

A side is broadcast only after its size in bytes is proven to be under a
bound; above the bound the join is left to the planner (sort-merge, or AQE's
runtime broadcast when the shuffled side turns out small).  Nothing is
remembered between calls: an input that has grown is checked anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

ROW_BYTES = 16  # of a row besides its values


def fits(df: DataFrame, max_bytes: int) -> bool:
    """True when the rows of ``df`` take at most ``max_bytes`` (values as text, and ROW_BYTES each).

    The check stops after ``max_bytes / ROW_BYTES`` rows, so it is cheap even
    when the answer is no.
    """
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    size = reduce(lambda a, b: a + b, sizes, F.lit(ROW_BYTES))
    total = df.limit(max_bytes // ROW_BYTES + 1).agg(F.sum(size.cast("long"))).first()[0]
    return (total or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int) -> DataFrame:
    """``broadcast(df)`` when it takes at most ``max_bytes``, else ``df``."""
    return F.broadcast(df) if fits(df, max_bytes) else df
