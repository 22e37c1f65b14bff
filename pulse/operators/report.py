"""What filters in a row take in, keep and drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulse.settings import DEFAULT_COUNTRY_CODE, DEFAULT_LANG

#: A filter: its name and condition.  A null condition drops the row, as in ``where``.
Step = tuple[str, Column]


def us_english_steps(lang: str = DEFAULT_LANG, country_code: str = DEFAULT_COUNTRY_CODE) -> list[Step]:
    """F1, F2 and F3, as ``filters.us_english`` has them."""
    return [
        ("lang", F.col("lang") == lang),
        ("place", F.col("place").isNotNull()),
        ("country", F.col("place.country_code") == country_code),
    ]


def kept(rows: DataFrame, steps: Sequence[Step]) -> DataFrame:
    for _, condition in steps:
        rows = rows.where(condition)
    return rows


def metrics(steps: Sequence[Step]) -> list[Column]:
    """Aggregates over the unfiltered rows: ``n0`` counts them, ``n1`` those that pass the first step, and so on."""
    out, passed = [F.count(F.lit(1)).alias("n0")], F.lit(True)
    for i, (_, condition) in enumerate(steps, 1):
        passed = passed & F.coalesce(condition, F.lit(False))
        out.append(F.count_if(passed).alias(f"n{i}"))
    return out


def lines(counted: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """(step, rows_in, kept, dropped) of a row of ``metrics``; other columns stay in front."""
    rest = [c for c in counted.columns if c not in {f"n{i}" for i in range(len(steps) + 1)}]
    each = [
        F.struct(F.lit(name).alias("step"), F.col(f"n{i}").alias("rows_in"), F.col(f"n{i + 1}").alias("kept"), (F.col(f"n{i}") - F.col(f"n{i + 1}")).alias("dropped"))
        for i, (name, _) in enumerate(steps)
    ]
    return counted.select(*rest, F.inline(F.array(*each)))


def filter_report(rows: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """One pass over the rows, whatever the number of steps."""
    return lines(rows.agg(*metrics(steps)), steps)
