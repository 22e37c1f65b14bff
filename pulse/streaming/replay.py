"""File replay: the status records as a stream of parquet files.

The reference reads a live network stream; here a stream is a folder of
parquet files read with ``readStream`` (SRC1).  To replay the driver's tables
as a stream, the derived statuses are written once, in one parallel job, into
the shared work folder, split by event time into ``slices`` sub-folders.  The
registered queries replay the ``events`` rows instead (``stage_events``), without
texts; their stream makes statuses of them as the batch plans do, by a join with
the documents inside each micro-batch.

Streams whose result does not depend on arrival order read every slice in
one run.  A watermarked stream runs once per slice on one checkpoint, each
run reading slices ``0..i`` (already-seen files are skipped by the source's
file log) in one micro-batch, so event time only moves forward between
batches and no row is late.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pulse.schema import STATUS
from pulse.session import app_id, exists, fresh_path
from pulse.settings import DEFAULT_COUNTRY_CODE, DEFAULT_LANG
from pulse.sources.raw import RAW_DATE, RAW_NAMES, from_raw, raw_schema
from pulse.sources.statuses import status_records, statuses_of
from pulse.sources.tables import SCHEMAS, read_table
from pulse.sources.variant import LINE, from_variant

DEFAULT_SLICES = 4
SLICE_COL = "_slice"

#: Staged events: a repeated delivery adds ``_again`` to the counters, ``_status`` is a status as it stands.
STAGED = f"{SCHEMAS['events']}, _again int, _status {STATUS.simpleString()}"

_staged: dict[tuple, str] = {}


def stage_replay(spark: SparkSession, sf_dir: str, slices: int = DEFAULT_SLICES) -> str:
    """Write the statuses of ``sf_dir`` split into ``slices`` event-time folders.

    Staged once per session and input; later calls reuse the folder.
    """
    key = (app_id(spark), sf_dir, slices)
    if key in _staged:
        return _staged[key]
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:8]
    target = fresh_path(spark, f"replay-{tag}")

    _sliced(status_records(spark, sf_dir), slices).write.partitionBy(SLICE_COL).parquet(target)
    _staged[key] = target
    return target


def _sliced(statuses: DataFrame, slices: int, rows: DataFrame | None = None) -> DataFrame:
    """Adds the slice index of the event-time range, whose bounds are scalar subqueries over the statuses (to ``rows``: events)."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    times = statuses.select(micros("created_at").alias("t"))
    lo, hi = times.select(F.min("t")).scalar(), times.select(F.max("t")).scalar()
    t = micros("created_at" if rows is None else "ts")
    return (statuses if rows is None else rows).withColumn(SLICE_COL, F.least(F.floor((t - lo) * slices / (hi - lo + 1)), F.lit(slices - 1)).cast("int"))


def stage_events(spark: SparkSession, sf_dir: str, slices: int = DEFAULT_SLICES, again: bool = False) -> str:
    """The ``events`` rows in the slices of their statuses; ``again``: with the deliveries of ``stage_deliveries``.

    Staged once per session and input; ``status_stream`` reads them with the format ``events``.
    """
    key = (app_id(spark), sf_dir, slices, again)
    if key in _staged:
        return _staged[key]
    target = fresh_path(spark, f"events-{hashlib.sha1(sf_dir.encode()).hexdigest()[:8]}")
    rows = _sliced(status_records(spark, sf_dir), slices, read_table(spark, sf_dir, "events").drop("props"))
    if again:
        rows = _delivered(rows, "event_id", slices)
    rows.write.partitionBy(SLICE_COL).parquet(target)
    _staged[key] = target
    return target


def all_slices(base: str) -> str:
    """Glob over every replay file."""
    return f"{base}/{SLICE_COL}=*/*.parquet"


def slices_upto(base: str, last: int) -> str:
    """Glob over the files of slices ``0..last``."""
    ids = ",".join(str(i) for i in range(last + 1))
    return f"{base}/{SLICE_COL}={{{ids}}}/*.parquet"


def reversed_runs(base: str, slices: int = DEFAULT_SLICES) -> list[str]:
    """One source glob per run, each adding the next older slice: the latest statuses come first."""
    ids = [str(i) for i in range(slices)]
    return [f"{base}/{SLICE_COL}={{{','.join(ids[-n:])}}}/*.parquet" for n in range(1, slices + 1)]


def slice_runs(base: str, slices: int = DEFAULT_SLICES) -> list[str]:
    """One source glob per run, each adding the next slice.

    A watermarked query must take each run's new slice in a single
    micro-batch (``files_per_trigger=None``): files inside a slice are in no
    time order, so a second batch of the same slice could hold rows older
    than the watermark the first one set.  More slices keep batches small.
    """
    return [slices_upto(base, i) for i in range(slices)]


CLOSING = "_closing"


def stage_closing(spark: SparkSession, base: str, after: str, sf_dir: str | None = None) -> None:
    """Adds a status without an author or hashtags, in English from the US, ``after`` the last one of a staged replay.

    A stream closes an interval when a later status comes, as on a live feed;
    at the end of a replay this one closes the last intervals.  ``sf_dir``: the
    replay holds the events of these tables.
    """
    target = f"{base}/{SLICE_COL}{CLOSING}"
    if exists(spark, target):
        return
    statuses = spark.read.schema(STATUS).parquet(all_slices(base)) if sf_dir is None else status_records(spark, sf_dir)
    last = statuses.agg(F.max("created_at").alias("t"))
    values = {
        "id": F.lit(-1),
        "created_at": F.col("t") + F.expr(f"INTERVAL {after}"),
        "lang": F.lit(DEFAULT_LANG),
        "place": F.from_json(F.lit(f'{{"country_code": "{DEFAULT_COUNTRY_CODE}"}}'), STATUS["place"].dataType.simpleString()),
        "hashtags": F.array(),
    }
    columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATUS.fields]
    row = last.select(*columns)
    if sf_dir is not None:
        row = row.select(F.struct(*STATUS.names).alias("_status"))
    row.coalesce(1).write.parquet(target)


def closed_runs(base: str, slices: int = DEFAULT_SLICES) -> list[str]:
    """As ``slice_runs``, and a last run with the closing status."""
    names = ",".join([*(f"={i}" for i in range(slices)), CLOSING])
    return [*slice_runs(base, slices), f"{base}/{SLICE_COL}{{{names}}}/*.parquet"]


def all_closed(base: str) -> str:
    """Glob over every replay file and the closing status."""
    return f"{base}/{SLICE_COL}*/*.parquet"


#: Where a row came from: rows of a batch sort by it in order of arrival (``_block``: the row of a Parquet file).
ARRIVAL = ("_file_time", "_file", "_block")


def status_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, fmt: str = "parquet", mode: str = "FAILFAST", tables: str | None = None
) -> DataFrame:
    """SRC1: a streaming DataFrame of status records from a folder of files.

    ``fmt`` is ``parquet`` (columnar, pushdown), ``json`` (one status record per
    line), ``raw`` (one raw status per line, see ``sources.raw``), ``variant``
    (the same, with fields that drift, see ``sources.variant``) or ``events``
    (events of the folder ``tables``, see ``stage_events``); the
    declared schema means no inference pass.
    A line that is no status fails the stream; ``mode="PERMISSIVE"`` reads it
    as a status without values (see ``bad_lines``).
    ``files_per_trigger=None`` takes every new file in one micro-batch.
    """
    columnar = fmt in ("parquet", "events")
    schema = {"raw": raw_schema(), "variant": f"{LINE} string", "events": STAGED}.get(fmt, STATUS)
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if not columnar:
        reader = reader.option("mode", mode)
    rows = reader.format({"raw": "json", "variant": "text", "events": "parquet"}.get(fmt, fmt)).load(path)
    rows = rows.select(
        "*",
        F.col("_metadata.file_modification_time").alias("_file_time"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index" if columnar else "_metadata.file_block_start").alias("_block"),
    )
    if fmt == "variant":
        return from_variant(rows, mode)
    if fmt == "events":
        return _from_events(spark, rows, tables)
    return from_raw(rows) if fmt == "raw" else rows


def _from_events(spark: SparkSession, rows: DataFrame, tables: str) -> DataFrame:
    """Staged events as statuses: those with a document, and the ones that are statuses as they stand."""
    made = statuses_of(spark, tables, rows, how="left", carry=("_again", "_status", *ARRIVAL))
    ready, again = F.col("_status").isNotNull(), F.coalesce("_again", F.lit(0))

    def field(name: str) -> Column:
        own = F.col(name) + again if name in COUNTERS else F.col(name)
        return F.when(ready, F.col(f"_status.{name}")).otherwise(own).alias(name)

    return made.where(ready | F.col("_found").isNotNull()).select(*map(field, STATUS.names), *ARRIVAL)


def arrival(batch: DataFrame) -> DataFrame:
    """A micro-batch with ``_line``: its rows' order inside a block."""
    return batch.withColumn("_line", F.monotonically_increasing_id())


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line): the lines of JSON status files that are no status record."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    schema = T.StructType([*STATUS.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json("line", schema, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    return lines.where(F.trim("line") != "").where(parsed["_bad"].isNotNull())


RAW_DATE_OUT = "EEE " + RAW_DATE.replace("Z", "'+0000'")  # records hold UTC wall clocks


def drifting_lines(statuses: DataFrame) -> DataFrame:
    """Status records as raw lines of a feed whose fields drift, for replays.

    By id, numbers come as numbers, as text or as decimals, truth values as
    text, an unknown field comes and goes, and null fields are left out.
    """
    third = F.col("id") % 3
    raw_date = lambda c: F.date_format(c, RAW_DATE_OUT)
    user = [raw_date("user.created_at").alias(n) if n == "created_at" else F.col(f"user.{n}").alias(RAW_NAMES.get(n, n)) for n in STATUS["user"].dataType.names]
    made = {
        "created_at": raw_date("created_at"),
        "entities": F.struct(F.transform("hashtags", lambda t: F.struct(t.alias("text"))).alias("hashtags")),
        "extended_entities": F.struct(F.transform("media", lambda m: F.struct(m.alias("expanded_url"))).alias("media")),
        "geo": F.when(F.col("geo").isNotNull(), F.struct(F.array("geo.latitude", "geo.longitude").alias("coordinates"))),
        "user": F.struct(*user),
    }
    same = [f.name for f in STATUS.fields if f.name not in (*made, "hashtags", "media")]

    def form(retyped: dict[str, str], *extra) -> Column:
        columns = {c: F.col(c) for c in same} | made
        return F.to_json(F.struct(*[(x.cast(retyped[c]) if c in retyped else x).alias(c) for c, x in columns.items()], *extra))

    numbers = ("id", "favorite_count", "retweet_count", "in_reply_to_user_id")
    as_text = form({c: "string" for c in (*numbers, "truncated", "favorited")})
    as_decimal = form({c: "decimal(22,1)" for c in numbers[1:]}, F.struct("lang").alias("an_unknown_field"))
    return statuses.select(F.when(third == 0, form({})).when(third == 1, as_text).otherwise(as_decimal).alias(LINE))


def with_event_time(statuses: DataFrame, delay: str | None = None) -> DataFrame:
    """``created_at`` as TIMESTAMP (watermarks reject TIMESTAMP_NTZ), plus a watermark."""
    out = statuses.withColumn("created_at", F.col("created_at").cast("timestamp"))
    return out.withWatermark("created_at", delay) if delay else out


COUNTERS = ("favorite_count", "retweet_count")


def stage_deliveries(spark: SparkSession, sf_dir: str, slices: int = DEFAULT_SLICES) -> str:
    """As ``stage_replay``, with every third status delivered twice.

    The second delivery has its favourite and retweet counters bumped.  It
    comes after the first in the same slice (even ids) or in the next one (odd
    ids), so both repeats inside a batch and across batches occur.
    """
    key = (app_id(spark), sf_dir, -slices)
    if key in _staged:
        return _staged[key]
    target = fresh_path(spark, f"deliveries-{hashlib.sha1(sf_dir.encode()).hexdigest()[:8]}")
    rows = _delivered(_sliced(status_records(spark, sf_dir), slices), "id", slices)
    rows.withColumns({c: F.col(c) + F.col("_again") for c in COUNTERS}).drop("_again").write.partitionBy(SLICE_COL).parquet(target)
    _staged[key] = target
    return target


def _delivered(rows: DataFrame, key: str, slices: int) -> DataFrame:
    """Sliced rows as they are delivered; ``_again`` is 1 in a second delivery."""
    sends = F.when(F.col(key) % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    again = rows.withColumn("_again", F.explode(sends))
    later = F.when(F.col(key) % 2 == 1, F.col("_again")).otherwise(0)
    return (
        again.withColumn(SLICE_COL, F.least(F.col(SLICE_COL) + later, F.lit(slices - 1)))
        # One file a slice and task, deliveries of an id in order inside it.
        .repartition(key)
        .sortWithinPartitions(SLICE_COL, key, "_again")
    )
