"""The jobs as Structured Streaming queries.

Every job writes, per micro-batch, into ``RowLog`` tables with ``foreachBatch``:
counters append their batch's own counts (totals are sums on read), keyed
tables append rows with their order of arrival (the current row of a key is the
latest, on read).  No state grows with keys or time, no row can be late, and a
batch that is run again is not written again.  One query may feed several
tables from one read of each batch.

``hashtag_counts_by_interval`` is the stateful exception for callers who want
closed intervals: it needs a lateness, and reports the rows it drops.

Every query checkpoints next to its output, so a restart (or a lost executor)
resumes from the last committed batch.  ``trigger`` defaults to
``availableNow`` (replay everything, then stop); a live job passes
``{"processingTime": "10 seconds"}`` (the reference's interval) and runs until
``run_seconds`` elapse.
"""

from __future__ import annotations

import contextlib
import logging
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pulse.operators import counts, filters, keyed, sentiment, shape
from pulse.operators.keyed import RowLog
from pulse.session import exists, fresh_path
from pulse.settings import DEFAULT_ACCOUNT, DEFAULT_LANG
from pulse.streaming.replay import ARRIVAL, arrival, status_stream, with_event_time

AVAILABLE_NOW = {"availableNow": True}
TAG_FIELDS = ("id", "created_at", "lang", "place", "hashtags")
RETWEET_FIELDS = ("user", "retweeted_status")
COMPACT_AFTER = 100  # folders of a log beyond which a job compacts it when it ends
ORDER = (*ARRIVAL, "_line")  # of arrival, inside a batch

log = logging.getLogger(__name__)
#: Seconds of each micro-batch with rows, of the last run of each job (see bench.py).
BATCH_SECONDS: dict[str, list[float]] = {}


@dataclass(frozen=True)
class StatusSource:
    """Status files to stream: one glob or folder per run, their format, and how a run takes them."""

    paths: str | Sequence[str]
    fmt: str = "parquet"
    files_per_trigger: int | None = None  # None: all new files in one micro-batch
    state_partitions: int | None = None  # None: the session's shuffle partitions
    bad_lines: str = "FAILFAST"  # or PERMISSIVE (JSON only)
    tables: str | None = None  # the folder of the tables whose staged events these are (format ``events``)


Source = str | Sequence[str] | StatusSource


def _run(query: StreamingQuery, run_seconds: float | None) -> StreamingQuery:
    """Wait for the query: to completion for ``availableNow``, else ``run_seconds``."""
    if run_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(run_seconds):
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return query


def _drive(
    spark: SparkSession,
    name: str,
    source: Source,
    build: Callable[[DataFrame], DataStreamWriter],
    trigger: dict,
    run_seconds: float | None,
    root: str,
    logs: Iterable[RowLog],
    conf: dict[str, str] | None = None,
) -> list[dict]:
    """Run the query once per source path, all runs on one checkpoint; the progress reports.

    A later run resumes from the committed offsets and state of the earlier
    ones, exactly as a restart after a failure does.  The checkpoint sits in
    the output folder (``_checkpoint``, skipped by readers).  Without it, batch
    ids would start anew and meet the batches that are there: that is refused.
    """
    checkpoint = f"{root.rstrip('/')}/_checkpoint"
    if not exists(spark, f"{checkpoint}/metadata") and any(t.batches() for t in logs):
        raise RuntimeError(f"{root} holds batches, but its checkpoint is gone: write to a new folder")
    src = source if isinstance(source, StatusSource) else StatusSource(source)
    conf = dict(conf or {})
    if src.state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(src.state_partitions)
    progress: list[dict] = []
    for path in [src.paths] if isinstance(src.paths, str) else list(src.paths):
        writer = lambda p=path: build(status_stream(spark, p, src.files_per_trigger, src.fmt, src.bad_lines, src.tables))
        q = _run(start(spark, name, writer, checkpoint, trigger, conf), run_seconds)
        progress += [dict(p) for p in q.recentProgress]
    BATCH_SECONDS[name] = [p["durationMs"]["triggerExecution"] / 1000 for p in progress if p["numInputRows"]]
    return progress


def start(spark: SparkSession, name: str, writer: Callable[[], DataStreamWriter], checkpoint: str, trigger: dict, conf: dict[str, str]) -> StreamingQuery:
    """Starts a query under ``conf``: plans take the zone and the state store from the session when they are built."""
    with _query_conf(spark, conf):
        query = writer().queryName(f"{name}_{uuid.uuid4().hex[:8]}").option("checkpointLocation", checkpoint)
        return query.trigger(**trigger).start()


@contextlib.contextmanager
def _query_conf(spark: SparkSession, conf: dict[str, str]):
    """Apply ``conf`` while a query starts (the query copies the session then)."""
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _batches(handler: Callable[[DataFrame, int], None], output_mode: str = "append", fields: Sequence[str] | None = None):
    """``fields``: of a status, that the handler uses.  A batch is computed with all its columns, so the stream picks them."""

    def build(stream: DataFrame) -> DataStreamWriter:
        rows = stream if fields is None else stream.select(*fields, *ARRIVAL)
        return rows.writeStream.outputMode(output_mode).foreachBatch(handler)

    return build


# ---- counters (K2) ------------------------------------------------------------------

def increments(
    spark: SparkSession,
    source: Source,
    name: str,
    per_batch: Callable[[DataFrame], DataFrame],
    key: str | Sequence[str],
    amount: str,
    out: str | None = None,
    trigger: dict = AVAILABLE_NOW,
    run_seconds: float | None = None,
    fields: Sequence[str] | None = None,
) -> RowLog:
    """K2 on a stream: each batch appends its own counts; totals are sums on read.

    Every row counts once, whatever its event time or order of arrival, and a
    replayed batch is not added again (D8).
    """
    table = RowLog(spark, out or fresh_path(spark, f"log-{name}"))
    handle = lambda batch, bid: table.write_batch(per_batch(batch), bid)
    _drive(spark, name, source, _batches(handle, fields=fields), trigger, run_seconds, table.path, [table])
    if table.folders() > COMPACT_AFTER:
        table.compact_counter(key, amount)
    return table


def user_log(spark, source: Source, lang=DEFAULT_LANG, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> RowLog:
    def per_batch(batch: DataFrame) -> DataFrame:
        return counts.count_by(filters.by_lang(batch, lang), F.col("user.screen_name"), "user", "count")

    return increments(spark, source, "user_counts", per_batch, "user", "count", out, trigger, run_seconds, ("lang", "user"))


def user_counts(spark, source: Source, lang=DEFAULT_LANG, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> DataFrame:
    """W7 + A2 + K2: running count per author across batches."""
    return user_log(spark, source, lang, out, trigger, run_seconds).totals("user", "count")


def distinct_user_total(spark, source: Source, lang=DEFAULT_LANG, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> DataFrame:
    """A7 on a stream, exact: the number of authors with a count in any batch."""
    totals = user_counts(spark, source, lang, out, trigger, run_seconds)
    return totals.where(F.col("user").isNotNull()).agg(F.count(F.lit(1)).alias("n_users"))


def retweeter_counts(spark, source: Source, account=DEFAULT_ACCOUNT, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> DataFrame:
    """F5 + F6 + A3 + K2: who retweets ``account``, running counts."""

    def per_batch(batch: DataFrame) -> DataFrame:
        rts = filters.retweets_of(batch, account)
        return counts.count_by(rts, F.col("user.screen_name"), "top_user", "retweeted")

    table = increments(spark, source, "retweeter_counts", per_batch, "top_user", "retweeted", out, trigger, run_seconds, RETWEET_FIELDS)
    return table.totals("top_user", "retweeted")


def hashtag_log(spark, source: Source, interval: str, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> RowLog:
    """A1 + K2: increments per event-time interval and tag; both hashtag tables are sums of them."""

    def per_batch(batch: DataFrame) -> DataFrame:
        tags = shape.hashtags(filters.us_english(batch), keep=("created_at",))
        return counts.count_by_interval(tags, "tag", "tags", interval, "freq")

    key = ("window_start", "window_end", "tags")
    return increments(spark, source, "hashtag_counts", per_batch, key, "freq", out, trigger, run_seconds, TAG_FIELDS)


def hashtag_counts(spark, source: Source, interval="1 hour", out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> DataFrame:
    """Every status counts, however late it comes."""
    return hashtag_log(spark, source, interval, out, trigger, run_seconds).totals("tags", "freq")


def hashtag_counts_by_interval(
    spark: SparkSession,
    source: Source,
    interval: str,
    lateness: str = "10 minutes",
    out: str | None = None,
    trigger: dict = AVAILABLE_NOW,
    run_seconds: float | None = None,
) -> DataFrame:
    """W3 + A1: tag counts per event-time interval, stateful with a watermark.

    Update mode emits each changed (interval, tag) count; the latest per key is
    the current count.  Intervals close ``lateness`` after their end, so the
    state store stays bounded on an endless stream; rows that come later still
    are dropped and reported.  ``hashtag_log`` drops none.
    """
    # Partitioned by day inside each batch: a reader bounded in time prunes.
    table = RowLog(spark, out or fresh_path(spark, "log-hashtag-interval"), partition_by=("day",))

    def write(df: DataFrame, bid: int) -> None:
        # Back to wall clocks inside the query's own session, which is in UTC.
        wall = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
        table.write_batch(wall.withColumn("day", F.to_date("window_start")), bid)

    def build(stream: DataFrame) -> DataStreamWriter:
        us = filters.us_english(with_event_time(stream, lateness))
        tags = shape.hashtags(us, keep=("created_at",))
        return _batches(write, "update")(counts.count_by_interval(tags, "tag", "tags", interval, "freq"))

    # The wall clocks of the records are UTC, whatever the session's zone.
    conf = {"spark.sql.session.timeZone": "UTC"}
    progress = _drive(spark, "hashtag_iv", source, build, trigger, run_seconds, table.path, [table], conf)
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in progress for s in p["stateOperators"])
    if dropped:
        log.warning("%d counts came over %s late and were dropped", dropped, lateness)
    return table.current(["window_start", "window_end", "tags"]).drop("day")


# ---- keyed tables (K1) ----------------------------------------------------------------

def _upserts(
    spark: SparkSession,
    source: Source,
    name: str,
    tables: dict[str, Callable[[DataFrame], DataFrame]],
    lang: str | None,
    out: str | None,
    trigger: dict,
    run_seconds: float | None,
    orders: dict[str, Sequence[str]] = {},  # noqa: B006  never changed
    fields: Sequence[str] | None = None,
    wide: Iterable[str] = (),
    shared: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """K1: each table's rows, appended with their order; the latest row of each id on read.

    The latest is that of the latest batch, then by arrival, unless ``orders``
    says otherwise.  Rows that several tables share are read and filtered once
    a batch.  ``wide``: tables with texts, most of whose ids come once; they are
    written from the batch itself if ``shared`` names the fields that the other
    tables use, so that texts are not held.
    """
    key = "id"
    root = out or fresh_path(spark, f"log-{name}")
    logs = {t: RowLog(spark, f"{root}/{t}", wide=t in wide) for t in tables}
    alone = set(wide) if shared is not None else set()  # written from the batch

    def handle(batch: DataFrame, bid: int) -> None:
        rows = arrival(batch if lang is None else filters.by_lang(batch, lang))
        held = rows if shared is None else rows.select(*shared, *ORDER)
        several = len(tables.keys() - alone) > 1
        if several:
            held = held.persist()
        try:
            for t, make in tables.items():
                logs[t].write_batch(make(rows if t in alone else held), bid)
        finally:
            if several:
                held.unpersist()

    _drive(spark, name, source, _batches(handle, fields=fields), trigger, run_seconds, root, logs.values())
    for t, table in logs.items():
        if table.folders() > COMPACT_AFTER:
            table.compact(key, orders.get(t, (keyed.BATCH_COL, *ORDER)))
    return {t: latest(table, orders.get(t, (keyed.BATCH_COL, *ORDER)), t in wide) for t, table in logs.items()}


def latest(table: RowLog, order: Sequence[str], wide: bool = False) -> DataFrame:
    rows = table.latest("id", order) if wide else keyed.latest_by_key(table.read(), "id", order)
    return rows.drop(*order, keyed.BATCH_COL)


def _ordered() -> tuple:
    return tuple(F.col(c) for c in ORDER)


def status_ids(spark, source: Source, lang=DEFAULT_LANG, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> DataFrame:
    """F1 + P1: ids are the table's keys."""
    make = lambda rows: rows.select("id", *ORDER)
    return _upserts(spark, source, "status_ids", {"tweet": make}, lang, out, trigger, run_seconds, fields=("id", "lang"))["tweet"]


def geo_points(spark, source: Source, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> DataFrame:
    """F4 + P3, one point a status id."""

    def make(rows: DataFrame) -> DataFrame:
        return shape.geo_points(filters.with_geo(rows), carry=_ordered())

    return _upserts(spark, source, "geo_points", {"location": make}, None, out, trigger, run_seconds, fields=("id", "geo"))["location"]


def sentiment_tracks(
    spark: SparkSession,
    source: Source,
    lexicon: DataFrame,
    tracks: dict[str, Iterable[str]],
    lang: str = DEFAULT_LANG,
    out: str | None = None,
    trigger: dict = AVAILABLE_NOW,
    run_seconds: float | None = None,
) -> dict[str, DataFrame]:
    """F7/F8 + J1 + A4: several keyword tracks scored from one read of each batch.

    A status is scored by its own row; a status may be on several tracks.
    """

    def track(words: tuple[str, ...]) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: sentiment.sentiment(filters.on_track(rows, words), lexicon, carry=ORDER)

    tables = {name: track(tuple(words)) for name, words in tracks.items()}
    return _upserts(spark, source, "sentiment", tables, lang, out, trigger, run_seconds, fields=("id", "lang", "text"), wide=tables)


def sentiment_scores(
    spark, source: Source, lexicon: DataFrame, keywords: Iterable[str], lang=DEFAULT_LANG, out=None, trigger=AVAILABLE_NOW, run_seconds=None
) -> DataFrame:
    """One keyword track (see ``sentiment_tracks``)."""
    return sentiment_tracks(spark, source, lexicon, {"track": keywords}, lang, out, trigger, run_seconds)["track"]


#: A user's or place's row comes from its latest status: by event time, status id, then arrival.
STATUS_ORDER = ("_ts", "_sid", keyed.BATCH_COL, *ORDER)


def _by_status() -> tuple:
    return (F.col("created_at").alias("_ts"), F.col("id").alias("_sid"), *_ordered())


def fanout(spark, source: Source, lang=DEFAULT_LANG, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> dict[str, DataFrame]:
    """K5: place, user and status tables from one read of each batch (the reference reads twice per output, D9).

    Stored status and user rows keep typed dates and arrays; ``shape.as_text``
    gives their text form.
    """
    tables = {
        "place_hifi": lambda rows: shape.place_rows(rows, carry=(shape.no_bounding_box(), *_by_status())),
        "user_hifi": lambda rows: shape.user_rows(rows, text_form=False, carry=_by_status()),
        "status_hifi": lambda rows: shape.status_rows(rows, text_form=False, carry=_ordered()),
    }
    orders = {"place_hifi": STATUS_ORDER, "user_hifi": STATUS_ORDER}
    shared = ("id", "created_at", "place", "user")
    return _upserts(spark, source, "fanout", tables, lang, out, trigger, run_seconds, orders, wide=("status_hifi",), shared=shared)


def upsert_users(spark, source: Source, lang=DEFAULT_LANG, out=None, trigger=AVAILABLE_NOW, run_seconds=None) -> DataFrame:
    """W8 + K1: user rows, latest status per user on read."""
    make = lambda rows: shape.user_rows(rows, text_form=False, carry=_by_status())
    orders = {"user_hifi": STATUS_ORDER}
    fields = ("id", "created_at", "lang", "user")
    return _upserts(spark, source, "upsert_users", {"user_hifi": make}, lang, out, trigger, run_seconds, orders, fields)["user_hifi"]
