"""Keyed tables on Parquet: append-only row logs read by key.

The reference appends to a key-value store where a repeated key overwrites
(K1) or a counter column adds up (K2).  Parquet cannot update in place, so a
table here is an append-only row log; the current value of a key is decided
on read:

* upsert (K1): the latest row per key, ``row_number() == 1`` in key order;
* counter (K2): the sum of all increments per key.

Both reduce inside each task before the shuffle (a partial per-key limit,
resp. partial aggregation): a key holding a third of all rows crosses the
network as one row per task.
Writes are idempotent per batch id, which makes replays exactly-once (the
reference's counters double-count a replayed batch, D8).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window, functions as F

from pulse.session import exists, names, publish

BATCH_COL = "batch_id"


def latest_by_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """K1 merge-on-read: per key, the row with the greatest ``order``.

    ``order`` should end with a column unique within a key so ties cannot
    occur.  Written as ``row_number() == 1`` so that Spark (a) inserts a
    partial per-key limit before the shuffle (``WindowGroupLimit``): each
    task ships at most one row per key, however hot the key; and (b) prunes
    every column the reader does not use below the window, so a query that
    needs three columns of a wide table never shuffles the others.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


REPEATED_BITS = 27  # of the bitmap of repeated keys, 16 MB at most
PLACE = ("_log_file", "_log_row")  # of a row in a log
PLACE_BYTES = 64 << 20  # of the marks of the latest rows of a log, one bit a row, that are broadcast
#: Texts that come again (a status and its second delivery, a retweet) are stored once a row group, while these fit.
WIDE_OPTIONS = {"compression": "zstd", "parquet.dictionary.page.size": str(64 << 20)}


def latest_of_repeats(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``latest_by_key`` of wide rows most of whose keys come once: those rows are not shuffled.

    Keys with several rows are found by a narrow count and marked, by hash, in
    a bitmap of a fixed size that is broadcast.  Rows whose key is not marked
    are the only ones of their key; the others, and the few whose key shares a
    mark, are compared.  ``df`` is computed for each of the three steps.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = _marked(df, keys)
    single, several = (rows.where(c).select(*df.columns) for c in (~F.col("_marked"), F.col("_marked")))
    return single.unionByName(latest_by_key(several, keys, order))


def _marked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``_marked``: false for a key that comes once, but for the few that share a mark with others."""
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << REPEATED_BITS))
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(place.alias("_place"))
    return _in_bitmaps(df, place, _bitmaps(repeated), "_marked")


def _bitmaps(places: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The numbers ``_place`` (of each ``by``) as bitmaps of 4 KB, one a ``_bucket`` of them."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits")
    return places.groupBy(*by, F.bitmap_bucket_number("_place").alias("_bucket")).agg(bits)


def _in_bitmaps(df: DataFrame, place: Column, bitmaps: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``name``: whether the bitmaps, which are broadcast, have ``place`` (a null ``by`` has none)."""
    at = {"_bucket": F.bitmap_bucket_number(place), "_at": F.bitmap_bit_position(place).cast("int")}
    byte = "cast(conv(hex(substring(_bits, _at div 8 + 1, 1)), 16, 10) as int)"
    found = F.expr(f"coalesce(shiftright({byte}, _at % 8) & 1, 0) = 1")
    joined = df.withColumns(at).join(F.broadcast(bitmaps), [*by, "_bucket"], "left").withColumn(name, found)
    return joined.select(*df.columns, name)


def counter_totals(increments: DataFrame, key: str | Sequence[str], amount: str, total_name: str | None = None) -> DataFrame:
    """K2 read: the sum of all increments per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return increments.groupBy(*keys).agg(F.sum(amount).alias(total_name or amount))


def counter_bump(increments: DataFrame, key_values: dict, amount_col: str, amount: int) -> DataFrame:
    """K6: ``UPDATE t SET c = c + n WHERE key = v`` as one appended increment row."""
    row = {**key_values, amount_col: amount}
    types = dict(increments.dtypes)
    bump = increments.sparkSession.range(1).select(
        *[F.lit(v).cast(types[c]).alias(c) for c, v in row.items()]
    )
    return increments.unionByName(bump, allowMissingColumns=True)


class RowLog:
    """An append-only Parquet row log in a shared folder.

    Each batch lands in its own ``batch_id=N`` folder.  It is written aside and
    published by a rename, so readers see all of a batch or nothing.  A batch
    that was published before (a batch run again after a failure holds the same
    rows) is left as it is, so its rows are never added again.

    Compaction writes the log's current rows into one folder (``_compacted``,
    hidden from plain readers) and marks the last batch it holds; readers take
    that folder and the later batches.  A writer may go on meanwhile, and
    nothing is deleted.  ``wide``: of rows with texts.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = (), wide: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)
        self.wide = wide

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Write one batch; ``partition_by`` columns (e.g. a day) become folders
        inside the batch folder, so readers filtering on them prune files."""
        target = f"{self.path}/{BATCH_COL}={int(batch_id)}"
        if not exists(self.spark, target):
            staged = f"{self.path}/_staged/{uuid.uuid4().hex}"
            self._writer(df).parquet(staged)
            publish(self.spark, staged, target)

    def _writer(self, df: DataFrame) -> DataFrameWriter:
        writer = df.write.options(**WIDE_OPTIONS) if self.wide else df.write
        return writer.partitionBy(*self.partition_by) if self.partition_by else writer

    def batches(self) -> list[int]:
        """Ids of the published batches."""
        return sorted(int(n.split("=")[1]) for n in names(self.spark, self.path) if n.startswith(f"{BATCH_COL}="))

    def compacted(self) -> int | None:
        """The last batch that the newest compaction holds."""
        done = [int(n.split("=")[1]) for n in names(self.spark, f"{self.path}/_compacted") if n.startswith("upto=")]
        return max(done, default=None)

    def folders(self) -> int:
        """Folders that a read takes: later batches, and the compaction if there is one."""
        upto = self.compacted()
        return len([b for b in self.batches() if upto is None or b > upto]) + (upto is not None)

    def read(self, places: bool = False) -> DataFrame:
        """``places``: with the file and row of each row, ``PLACE``."""

        def folder(path: str) -> DataFrame:
            rows = self.spark.read.parquet(path)
            place = F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1])
            return rows.select("*", *place) if places else rows

        rows = folder(self.path)
        upto = self.compacted()
        if upto is None:
            return rows
        return rows.where(F.col(BATCH_COL) > upto).unionByName(folder(f"{self.path}/_compacted/upto={upto}"))

    def latest(self, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
        """``latest_by_key`` of wide rows: no row is shuffled with its texts.

        The latest rows of keys that may come again are found by key and order alone and
        marked by file and row; the scan leaves out the rows that they replace.  The marks
        are broadcast, which holds for logs whose marks take ``PLACE_BYTES`` (500 million
        rows); of a larger log the rows with such a key are shuffled.
        """
        keys = [key] if isinstance(key, str) else list(key)
        plain = self.read()
        if plain.count() // 8 + len(plain.inputFiles()) * 4096 > PLACE_BYTES:
            return latest_of_repeats(plain, keys, order)
        rows = self.read(places=True)
        narrow = rows.select(*dict.fromkeys([*keys, *order, *PLACE]))
        several = _marked(narrow, keys).where("_marked").drop("_marked")
        kept = latest_by_key(several, keys, order).select(PLACE[0], F.col(PLACE[1]).alias("_place"))
        marked = _in_bitmaps(_marked(rows, keys), F.col(PLACE[1]), _bitmaps(kept, PLACE[:1]), "_kept", PLACE[:1])
        return marked.where("not _marked or _kept").select(*plain.columns)

    def current(self, key: str | Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
        """Latest row per key: of the latest batch, then by ``order``."""
        return latest_by_key(self.read(), key, [BATCH_COL, *order]).drop(BATCH_COL)

    def totals(self, key: str | Sequence[str], amount: str) -> DataFrame:
        return counter_totals(self.read(), key, amount)

    def append(self, df: DataFrame) -> int:
        """Adds rows as the next batch (single writer): e.g. a counter's bump (K6)."""
        batch_id = max(self.batches(), default=-1) + 1
        self.write_batch(df, batch_id)
        return batch_id

    def compact(self, key: str | Sequence[str], order: Sequence[str | Column] = (BATCH_COL,)) -> None:
        """Upsert log: keep the latest row of each key by ``order``, with its batch id."""
        self._compact(lambda rows: latest_by_key(rows, key, order))

    def compact_counter(self, key: str | Sequence[str], amount: str) -> None:
        """Counter log: keep the sum of each key's increments."""
        keys = [key] if isinstance(key, str) else list(key)
        by = [*keys, *[c for c in self.partition_by if c not in keys]]
        self._compact(lambda rows: counter_totals(rows, by, amount))

    def _compact(self, reduce) -> None:
        done = self.batches()
        if not done or done[-1] == self.compacted():
            return
        rows = reduce(self.read().where(F.col(BATCH_COL) <= done[-1]))
        if BATCH_COL not in rows.columns:
            rows = rows.withColumn(BATCH_COL, F.lit(done[-1]))
        staged = f"{self.path}/_staged/{uuid.uuid4().hex}"
        self._writer(rows.withColumn(BATCH_COL, F.col(BATCH_COL).cast("int"))).parquet(staged)
        publish(self.spark, staged, f"{self.path}/_compacted/upto={done[-1]}")
