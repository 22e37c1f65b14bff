"""Heavy hitters by a count-min sketch that prunes, and exact counts of what is left.

A plain count shuffles a row for each distinct key and task, though all but a
few keys are rare.  Here a first pass counts hash cells: ``DEPTH`` rows of
``WIDTH`` cells, so a task hands on at most ``DEPTH * WIDTH`` counters however
many keys it has, and the sums of all tasks are the sketch.  A cell holds at
least the count of each of its keys, so a key with a light cell cannot be heavy.
A second pass keeps the rows whose cells are all heavy and counts those exactly.
At most ``1 / fraction`` cells of a row can be heavy, which bounds what is
broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

DEPTH, WIDTH = 4, 1 << 14


def _cell(key: Column, row: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), key), F.lit(WIDTH)).cast("int")


def sketch(rows: DataFrame, key: str) -> DataFrame:
    """(row, cell, n): the count-min sketch of a column; null keys are left out."""
    cells = F.array(*[F.struct(F.lit(i).alias("row"), _cell(F.col(key), i).alias("cell")) for i in range(DEPTH)])
    exploded = rows.where(F.col(key).isNotNull()).select(F.inline(cells))
    return exploded.groupBy("row", "cell").agg(F.count(F.lit(1)).alias("n"))


def candidates(rows: DataFrame, key: str, heavy_cells: DataFrame) -> DataFrame:
    """The rows whose key has a heavy cell (row, cell) in every row of the sketch."""
    for i in range(DEPTH):
        cells = heavy_cells.where(F.col("row") == i).select(F.col("cell").alias("_cell"))
        rows = rows.join(F.broadcast(cells), _cell(F.col(key), i) == F.col("_cell"), "left_semi")
    return rows


def heavy_hitters(rows: DataFrame, key: str, fraction: float, count_name: str = "count") -> DataFrame:
    """(key, count) of the keys that at least ``fraction`` of the rows with a key have; exact.

    ``fraction`` is 0.0001 or more.  Null keys are left out; an empty input
    gives no rows.  The input is read twice.
    """
    from pulse.session import materialize

    if not 1e-4 <= fraction <= 1:
        raise ValueError("fraction is between 0.0001 and 1")
    counters = materialize(sketch(rows, key), "sketch")  # at most DEPTH * WIDTH rows
    total = counters.where("row = 0").agg(F.sum("n")).first()[0] or 0
    least = max(1, math.ceil(round(fraction * total, 6)))
    found = candidates(rows.where(F.col(key).isNotNull()), key, counters.where(F.col("n") >= least))
    return found.groupBy(key).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) >= least)
