"""A job's table and, for each batch, what its filters took in, kept and dropped.

The counts are observed metrics (``Dataset.observe``) of the write of the batch
itself: no second pass, and no row passes the driver but one of counts a batch.
The write has no shuffle, so the metrics are those of its result tasks, which
Spark counts once however often a task is tried or an executor is lost.  The
report is a row log beside the table, by batch id: a restarted job goes on with
it, and a batch that is run again is not reported twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from pulse.operators import report, shape
from pulse.operators.keyed import RowLog
from pulse.operators.report import Step
from pulse.session import fresh_path
from pulse.streaming.jobs import AVAILABLE_NOW, TAG_FIELDS, Source, _batches, _drive


def filtered(
    spark: SparkSession,
    source: Source,
    steps: Sequence[Step],
    make: Callable[[DataFrame], DataFrame],
    out: str | None = None,
    trigger: dict = AVAILABLE_NOW,
    run_seconds: float | None = None,
    fields: Sequence[str] | None = None,
) -> tuple[RowLog, RowLog]:
    """The rows that ``make`` (no shuffle) derives from the statuses that pass all steps, and the report by batch and step.

    A report: batch_id, step, rows_in, kept, dropped.
    """
    root = out or fresh_path(spark, "log-report")
    rows, told = RowLog(spark, f"{root}/rows"), RowLog(spark, f"{root}/report")

    def handle(batch: DataFrame, bid: int) -> None:
        session, counts = batch.sparkSession, report.metrics(steps)
        if bid in rows.batches():  # written by a run that was lost before its report
            counted = batch.agg(*counts).first().asDict()
        else:
            seen = Observation()
            rows.write_batch(make(report.kept(batch.observe(seen, *counts), steps)), bid)
            counted = seen.get
        schema = ", ".join(f"n{i} long" for i in range(len(steps) + 1))
        values = tuple(int(counted[f"n{i}"]) for i in range(len(steps) + 1))
        told.write_batch(report.lines(session.createDataFrame([values], schema), steps), bid)

    _drive(spark, "filter_report", source, _batches(handle, fields=fields), trigger, run_seconds, root, [rows, told])
    return rows, told


def us_hashtags(spark: SparkSession, source: Source, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> tuple[RowLog, RowLog]:
    """The hashtags of US English statuses, with the report of the three filters."""
    make = lambda rows: shape.hashtags(rows, keep=("id", "created_at"))
    return filtered(spark, source, report.us_english_steps(), make, out, trigger, run_seconds, TAG_FIELDS)


def totals(told: RowLog) -> DataFrame:
    """(step, rows_in, kept, dropped) over all batches."""
    return told.read().groupBy("step").agg(*[F.sum(c).alias(c) for c in ("rows_in", "kept", "dropped")])
