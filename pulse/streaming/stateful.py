"""Stateful streaming jobs: chained aggregates, carried totals, de-duplication and stream-stream joins.

All keep their state in RocksDB, off the JVM's heap, with a change log in the
checkpoint: a restart, also on other machines, loads the last snapshot and the
changes after it.  State partitions are fixed by the first start of a
checkpoint, so later runs may have any number of cores.

Every state is bounded by a watermark, except one total an author
(``running_user_counts``).  Results are appended once, when they can no longer
change: an interval closes when a status comes that is later than its end by
``lateness``.  Statuses later than that are dropped by Spark, and reported.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from pulse.operators import counts, filters, keyed, shape
from pulse.operators.keyed import RowLog
from pulse.session import exists, fresh_path
from pulse.settings import DEFAULT_LANG
from pulse.streaming.jobs import AVAILABLE_NOW, BATCH_SECONDS, STATUS_ORDER, Source, StatusSource, _batches, _by_status, _drive, _ordered, _run, start
from pulse.streaming.replay import ARRIVAL, arrival, with_event_time

log = logging.getLogger(__name__)

CONF = {
    "spark.sql.session.timeZone": "UTC",  # the wall clocks of the records
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
TAG_BUCKETS = 64


def _late(progress: list[dict], lateness: str) -> int:
    """Rows that came too late, over all batches; a warning if there are any."""
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in progress for s in p["stateOperators"])
    if dropped:
        log.warning("%d rows came over %s late and were dropped", dropped, lateness)
    return dropped


def _writer(table: RowLog):
    """Appends a batch, its time stamps as wall clocks (cast inside the query's session, which is in UTC)."""

    def write(df: DataFrame, bid: int) -> None:
        times = [n for n, t in df.dtypes if t == "timestamp"]
        table.write_batch(df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}), bid)

    return write


def _interval_counts(stream: DataFrame, key: str, interval: str, amount: str) -> DataFrame:
    """(w, key, amount): rows per interval and key."""
    return stream.groupBy(F.window("created_at", interval).alias("w"), key).agg(F.count(F.lit(1)).alias(amount))


# ---- W3 + A1 + T5 ---------------------------------------------------------------------
def top_hashtags_by_interval(
    spark: SparkSession, source: Source, interval: str, k: int, lateness: str = "10 minutes", out: str | None = None, trigger: dict = AVAILABLE_NOW, run_seconds: float | None = None
) -> DataFrame:
    """The ``k`` most frequent tags of each closed interval (ties by tag): three aggregates in one query.

    Counts per interval and tag; when an interval closes, the best ``k`` of each
    of ``TAG_BUCKETS`` buckets of its tags, so that no single task takes all
    tags; then the best ``k`` of those.  The second and third state hold an
    interval only while it closes.
    """
    table = RowLog(spark, out or fresh_path(spark, "log-top-hashtags"))

    def build(stream: DataFrame) -> DataStreamWriter:
        best = lambda c: F.slice(F.sort_array(c), 1, k)
        tags = shape.hashtags(filters.us_english(with_event_time(stream, lateness)), keep=("created_at",))
        freq = _interval_counts(tags.withColumnRenamed("tag", "tags"), "tags", interval, "freq")
        bucket = F.pmod(F.xxhash64("tags"), F.lit(TAG_BUCKETS)).alias("bucket")
        entry = F.struct((-F.col("freq")).alias("minus"), "tags")
        parts = freq.groupBy(F.window("w", interval).alias("w"), bucket).agg(best(F.collect_list(entry)).alias("best"))
        whole = parts.groupBy(F.window("w", interval).alias("w")).agg(best(F.flatten(F.collect_list("best"))).alias("best"))
        rows = whole.select("w", F.posexplode("best").alias("pos", "e"))
        columns = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "e.tags", (-F.col("e.minus")).alias("freq")]
        return _batches(_writer(table))(rows.select(*columns, (F.col("pos") + 1).cast("long").alias("rank")))

    _late(_drive(spark, "top_hashtags", source, build, trigger, run_seconds, table.path, [table], CONF), lateness)
    return table.read().drop(keyed.BATCH_COL)


# ---- W7 + A5 ----------------------------------------------------------------------------
def _running_total() -> StatefulProcessor:
    import pandas as pd

    class RunningTotal(StatefulProcessor):  # local, so that executors need no import of this package
        """The total of a key so far; rows are its counts per interval, which close in order."""

        def init(self, handle) -> None:
            self.total = handle.getValueState("total", "total long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            if key[0] is None:
                return
            before = self.total.get()
            closed = pd.concat(list(rows)).sort_values("start")
            closed["total"] = closed["n"].cumsum() + (before[0] if before else 0)
            self.total.update((int(closed["total"].iloc[-1]),))
            yield closed[["key", "start", "stop", "n", "total"]]

        def close(self) -> None:
            pass

    return RunningTotal()


def running_user_counts(
    spark: SparkSession, source: Source, interval: str, lateness: str = "10 minutes", lang: str = DEFAULT_LANG, out: str | None = None, trigger: dict = AVAILABLE_NOW, run_seconds: float | None = None
) -> DataFrame:
    """Statuses per author and closed interval, and the author's total up to it.

    The counts of an interval are an aggregate, so an author of very many
    statuses is one row an interval; a total an author is carried from interval
    to interval in keyed state.  Statuses without an author are left out.
    """
    table = RowLog(spark, out or fresh_path(spark, "log-running-users"))

    def build(stream: DataFrame) -> DataStreamWriter:
        rows = filters.by_lang(with_event_time(stream, lateness), lang).select("created_at", F.col("user.screen_name").alias("key"))
        closed = _interval_counts(rows, "key", interval, "n")
        edges = [F.unix_micros(f"w.{x}").alias(y) for x, y in (("start", "start"), ("end", "stop"))]
        totals = closed.select("key", *edges, "n").groupBy("key")
        totals = totals.transformWithStateInPandas(_running_total(), "key string, start long, stop long, n long, total long", "append", "none")
        ends = [F.timestamp_micros(x).alias(y) for x, y in (("start", "window_start"), ("stop", "window_end"))]
        return _batches(_writer(table))(totals.select(*ends, F.col("key").alias("user"), F.col("n").alias("count"), F.col("total").alias("running_count")))

    _late(_drive(spark, "running_users", source, build, trigger, run_seconds, table.path, [table], CONF), lateness)
    return table.read().drop(keyed.BATCH_COL)


# ---- K2 under redelivery (D8) --------------------------------------------------------------
def unique_user_counts(
    spark: SparkSession,
    source: Source,
    lateness: str,
    lang: str = DEFAULT_LANG,
    out: str | None = None,
    trigger: dict = AVAILABLE_NOW,
    run_seconds: float | None = None,
    report: dict[str, int] | None = None,
) -> DataFrame:
    """Statuses per author, a status that is delivered again counted once.

    An id is remembered until the watermark (``lateness`` behind the latest
    status) has passed it.  A status that comes later than that, be it a repeat
    or not, is not counted.  ``report`` is given the number of ``repeats`` and of
    such ``late`` rows.
    """
    table = RowLog(spark, out or fresh_path(spark, "log-unique-users"))

    def write(batch: DataFrame, bid: int) -> None:
        table.write_batch(counts.count_by(batch, "user", "user", "count"), bid)

    def build(stream: DataFrame) -> DataStreamWriter:
        rows = filters.by_lang(with_event_time(stream, lateness), lang).select("id", "created_at", F.col("user.screen_name").alias("user"))
        return _batches(write)(rows.dropDuplicatesWithinWatermark(["id"]))

    progress = _drive(spark, "unique_users", source, build, trigger, run_seconds, table.path, [table], CONF)
    late = _late(progress, lateness)
    if report is not None:
        report["late"] = late
        report["repeats"] = sum(s["customMetrics"].get("numDroppedDuplicateRows", 0) for p in progress for s in p["stateOperators"])
    return table.totals("user", "count")


# ---- J2 -------------------------------------------------------------------------------------
_FEED = {"status": ("id", "user_id", "place_id"), "user": ("id", "screen_name", "followers_count"), "place": ("id", "full_name")}


def _feed(spark: SparkSession, source: Source, lang: str, root: str, trigger: dict) -> tuple[dict[str, RowLog], dict]:
    """The three tables that the join reads, a row a key and batch, and the query's arguments that writes them."""
    logs = {t: RowLog(spark, f"{root}/{t}") for t in _FEED}

    def build(stream: DataFrame) -> DataStreamWriter:
        # A batch is computed with all its columns: the stream picks those of status rows that the join takes.
        rows = shape.status_rows(filters.by_lang(stream, lang), text_form=False, carry=("user", "place", *ARRIVAL))
        return _batches(handle)(rows.select("created_at", *_FEED["status"], "user", "place", *ARRIVAL))

    def handle(batch: DataFrame, bid: int) -> None:
        rows = arrival(batch).persist()
        try:
            made = {
                "status": rows.select(*_FEED["status"], *_by_status()),
                "user": shape.user_rows(rows, text_form=False, carry=_by_status()),
                "place": shape.place_rows(rows, carry=_by_status()),
            }
            for t, df in made.items():
                order = [c for c in STATUS_ORDER if c != keyed.BATCH_COL]
                latest = keyed.latest_by_key(df.where("id is not null"), "id", order)
                # The rows of the batch as one file a task: a batch is taken as a whole by the join.
                logs[t].write_batch(latest.select(*_FEED[t], F.col("_ts").cast("timestamp").alias("ts"), F.col("_sid").alias("sid")), bid)
        finally:
            rows.unpersist()

    return logs, {"name": "join_feed", "build": build, "root": f"{root}/feed", "logs": logs.values()}


def _joined(spark: SparkSession, root: str, within: str) -> DataFrame:
    """Status rows with the user and place rows whose status is at most ``within`` away, both joins left outer."""

    def table(name: str, prefix: str) -> DataFrame:
        columns = ", ".join(f"{c} {'long' if c in ('id', 'user_id') and name != 'place' else 'int' if c == 'followers_count' else 'string'}" for c in _FEED[name])
        rows = spark.readStream.schema(f"{columns}, ts timestamp, sid long").parquet(f"{root}/{name}/{keyed.BATCH_COL}=*/")
        return rows.select(*[F.col(c).alias(prefix + c) for c in rows.columns]).withWatermark(prefix + "ts", within)

    near = lambda other: F.expr(f"{other} BETWEEN s_ts - INTERVAL {within} AND s_ts + INTERVAL {within}")
    s, u, p = table("status", "s_"), table("user", "u_"), table("place", "p_")
    # A status without a place meets none: it passes the second join at once, by a key of its own instead of one that all share.
    s = s.withColumn("place_key", F.coalesce("s_place_id", F.concat(F.lit("no place "), F.col("s_id").cast("string"))))
    with_user = s.join(u, (F.col("s_user_id") == F.col("u_id")) & near("u_ts"), "left_outer")
    # A join's input may have one event time: from here on that of the status.
    with_user = with_user.withColumn("u_at", F.unix_micros("u_ts")).drop("u_ts")
    return with_user.join(p, (F.col("place_key") == F.col("p_id")) & F.col("s_place_id").isNotNull() & near("p_ts"), "left_outer")


def status_user_place(
    spark: SparkSession, source: Source, within: str, lang: str = DEFAULT_LANG, out: str | None = None, trigger: dict = AVAILABLE_NOW, run_seconds: float | None = None
) -> DataFrame:
    """J2 on streams: each status with its author's and its place's row.

    One query writes, a batch at a time, the status rows and the latest row of
    each user and place; another reads the three tables as streams and joins
    them, left outer.  A status meets the rows of its user and place that come
    from statuses at most ``within`` (event time) before or after it; rows are
    kept as long, so the state is bounded, and a status that has met none by
    then gets nulls.  Of several rows the latest holds, on read; with ``within``
    over the whole feed that is the row that the user or place table ends with.

    A repeated run with the same ``out`` goes on where the last one ended.  With
    another trigger than ``availableNow`` both queries run side by side.
    """
    root = out or fresh_path(spark, "log-join")
    logs, feed = _feed(spark, source, lang, root, trigger)
    table = RowLog(spark, f"{root}/joined")
    src = source if isinstance(source, StatusSource) else StatusSource(source)
    conf = CONF | ({"spark.sql.shuffle.partitions": str(src.state_partitions)} if src.state_partitions else {})
    checkpoint = f"{table.path}/_checkpoint"
    if table.batches() and not exists(spark, f"{checkpoint}/metadata"):
        raise RuntimeError(f"{table.path} holds batches, but its checkpoint is gone: write to a new folder")
    join = lambda how: start(spark, "join", lambda: _batches(_writer(table))(_joined(spark, root, within)), checkpoint, how, conf)
    seconds: list[float] = []
    if trigger == AVAILABLE_NOW:
        for path in [src.paths] if isinstance(src.paths, str) else src.paths:
            part = replace(src, paths=path)
            _drive(spark, source=part, trigger=trigger, run_seconds=None, **feed)
            seconds += BATCH_SECONDS["join_feed"]
            query = _run(join(trigger), None)
            seconds += [p["durationMs"]["triggerExecution"] / 1000 for p in query.recentProgress if p["numInputRows"]]
    else:
        query = join(trigger)
        try:
            _drive(spark, source=source, trigger=trigger, run_seconds=run_seconds, **feed)
        finally:
            query.stop()
    BATCH_SECONDS["join"] = seconds
    order = [F.col(c) for c in ("u_at", "u_sid", "p_ts", "p_sid", "s_ts")]
    rows = keyed.latest_by_key(table.read(), "s_id", order)
    return rows.select(
        F.col("s_id").alias("id"),
        F.col("s_user_id").alias("user_id"),
        F.col("u_screen_name").alias("screen_name"),
        F.col("u_followers_count").alias("followers_count"),
        F.col("s_place_id").alias("place_id"),
        F.col("p_full_name").alias("place_full_name"),
    )
