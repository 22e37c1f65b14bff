"""Removal of repeated byte strings by a logarithmic family of suffix arrays.

A byte goes when a string of ``length`` bytes that covers it also starts
earlier: in a document of a smaller id, or further ahead in the same one.

1. ``write_batches``: documents are written in batches of some megabytes, sorted
   by id, one file a batch; all later steps read these files, so no text is
   shuffled.
2. Every window of ``length`` bytes is assigned to a seed, the substring of
   ``seed_bytes`` with the smallest hash inside it.  Equal windows have equal
   seeds at equal places, so only windows of equal seeds have to meet.  Windows
   of one occurrence of a seed are neighbours: together they are one passage.
   ``shared_seeds`` counts the batches of each seed and tells every batch which
   of its seeds other batches have.
3. ``passages``: each batch sends the passages of such seeds (and of those that
   it has several passages of itself).  Of equal passages it sends the earliest;
   the others are repeats already.
4. ``repeats``: a seed's passages meet in one shard, in order of document and
   place.  There the shard keeps an index family (``Family``): the next
   passages are a new batch, their windows are sorted into a suffix array
   (suffixes are compared up to ``length`` bytes), which is merge-scanned against
   every level of the family; windows that a level holds are repeats, the others
   become a new level, and levels of about equal size are merged.  So each
   window is merged at most a logarithmic number of times.
5. ``kept``: each batch cuts the repeats out of its documents.

Hot seeds: a seed with over ``hot`` different passages (a line that very many
documents have) is dealt window by window, each going to the shard of its own
bytes, where only equal windows meet; of those each batch sends one.

All comparisons that remove a byte are comparisons of bytes; hashes only bring
passages together.  Batches, shards and files are bounded in bytes (a very long
text is a batch of its own); nothing is collected but a sum of bytes.

Defined cases: a null text counts as empty; texts of fewer than ``length`` bytes
lose nothing.  Null ids come first.  An occurrence is earlier if (id, start) is
smaller, so rows that repeat an id do not remove each other's equal places:
repeated rows keep the same bytes.  An empty table gives no rows.  The columns
that are not named as arguments are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pulse.llm.common import file_system, write_out
from pulse.session import fresh_path

LENGTH = 100  # bytes
BATCH_BYTES = 8 << 20  # text of a batch
SHARD_BYTES = 4 << 20  # text for which there is one shard
SLICE_BYTES = 1 << 20  # passages of a new level
HOT = 512  # different passages of a seed
TILE = 1 << 16  # windows hashed at once
SENT_ROWS = 8192  # passages put into one Arrow table

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_HIGH = np.uint64(0xFFFFFFFF00000000)


def seed_bytes(length: int) -> int:
    """8, 16, 24 or 32: at most half a window."""
    return 8 * max(1, min(4, length // 16))


# --- windows and their seeds ----------------------------------------------------------
def _hashes(tile: np.ndarray, n: int, words: int) -> np.ndarray:
    """Hashes of the ``8 * words`` bytes from each of the first n places."""
    x = np.empty(n + 8 * words, dtype=np.uint64)
    for o in range(8):
        m = len(range(o, len(x), 8))
        x[o::8] = tile[o : o + 8 * m].view("<u8")
    h = x[:n] * _MIX[0]
    for j in range(1, words):
        h ^= h >> np.uint64(29)
        h *= _MIX[j]
        h += x[8 * j : 8 * j + n]
    h ^= h >> np.uint64(32)
    h *= _MIX[1]
    return h ^ (h >> np.uint64(29))


def passages_of(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed hash, first window, number of windows) of the passages of texts that follow one another in ``text``.

    ``starts``: where the texts begin, and the end.  A passage is a stretch of
    windows with the same occurrence of a seed.
    """
    none = np.zeros(0, dtype=np.int64)
    n, k = len(text), seed_bytes(length)
    if n < length:
        return none.astype(np.uint64), none, none
    span = length - k + 1  # seeds of a window
    padded = np.concatenate([text, np.zeros(length + 2 * k + 16, dtype=np.uint8)])
    at, seed, held = [], [], np.uint64(0)
    for a in range(0, n, TILE):
        m = min(TILE, n - a)
        wide = m + span
        h = _hashes(padded[a : a + wide + 2 * k + 8], wide, k // 8)
        # The smallest hash, of equal ones the leftmost: 32 bits of hash, then the place.
        low = (h & _HIGH) | np.arange(wide, dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            low = np.minimum(low[: len(low) - width], low[width:])
            width *= 2
        low = np.minimum(low[:m], low[span - width : span - width + m])
        place = (low & ~_HIGH).astype(np.int64)
        change = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        at.append(change + a)
        seed.append(np.stack([h[place[change]], (place[change] + a).astype(np.uint64)]))
    at, (seed, place) = np.concatenate(at), np.concatenate(seed, axis=1)
    last = starts[1:] - length + 1  # end of the windows of each text
    full = last > starts[:-1]
    cuts = np.unique(np.concatenate([at, starts[:-1][full], last[full], [n]]))
    run = np.searchsorted(at, cuts[:-1], side="right") - 1
    text_of = np.searchsorted(starts, cuts[:-1], side="right") - 1
    good = cuts[:-1] < last[np.minimum(text_of, len(last) - 1)]
    first, size, run = cuts[:-1][good], np.diff(cuts)[good], run[good]
    # Cuts at tile borders inside a passage are closed again.
    same = np.append(False, (place[run][1:] == place[run][:-1]) & (first[1:] == first[:-1] + size[:-1]) & (text_of[good][1:] == text_of[good][:-1]))
    group = np.flatnonzero(~same)
    return seed[run][group], first[group], np.add.reduceat(size, group) if len(group) else none


class Batch:
    """A batch's file: ids and texts in order of id, and the passages of the texts."""

    def __init__(self, folder: str, batch: int, length: int):
        fs, base = file_system(folder)
        self.rows = pq.read_table(f"{base}/{batch}.parquet", filesystem=fs, use_threads=False)
        texts = self.rows.column("text").combine_chunks() if self.rows.num_rows else pa.array([], pa.large_binary())
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks)
        self.starts = np.frombuffer(texts.buffers()[1], dtype=np.int64)[: len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
        self.data = texts.buffers()[2].to_pybytes() if len(texts) and texts.buffers()[2] else b""
        self.data = self.data[: int(self.starts[-1])]
        docs = self.rows.column("doc").to_pylist()
        self.ordinal = np.cumsum([0, *(a != b for a, b in zip(docs[1:], docs))])[: len(docs)]  # equal for equal ids
        self.length = length

    def find_passages(self) -> None:
        self.seed, self.first, self.size = passages_of(np.frombuffer(self.data, dtype=np.uint8), self.starts, self.length)
        self.row = np.searchsorted(self.starts, self.first, side="right") - 1

    def body(self, i: int) -> bytes:
        return self.data[self.first[i] : self.first[i] + self.size[i] + self.length - 1]


# --- 1. batches --------------------------------------------------------------------------
def write_batches(docs: DataFrame, doc_id: str, text: str, batch_bytes: int) -> tuple[DataFrame, str]:
    """(batch, n_bytes) of the files written into a new folder of the shared work folder, and the folder."""
    folder = fresh_path(docs.sparkSession, "llm-suffix-batches")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        held, size, done = [], 0, []

        def close() -> None:
            rows = pa.Table.from_batches(held)
            rows = rows.take(pc.sort_indices(rows, sort_keys=[("doc", "ascending")], null_placement="at_start"))
            batch = uuid.uuid4().int >> 65
            pq.write_table(rows, f"{base}/{batch}.parquet", filesystem=fs, compression="zstd", use_dictionary=False)
            done.append((batch, size))

        for part in parts:
            part = part.set_column(1, "text", part.column(1).cast(pa.large_binary()))
            ends = np.cumsum(pc.binary_length(part.column("text")).to_numpy())
            a = 0
            while a < part.num_rows:
                before = int(ends[a - 1]) if a else 0
                b = int(np.searchsorted(ends, before + batch_bytes - size, side="left")) + 1
                held.append(part.slice(a, b - a))
                b = min(b, part.num_rows)
                size += int(ends[b - 1]) - before
                a = b
                if size >= batch_bytes:
                    close()
                    held, size = [], 0
        if held:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*done)], ["batch", "n_bytes"])

    rows = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return write_out(rows.mapInArrow(write, "batch long, n_bytes long"), "suffix-batches"), folder


# --- 2. seeds that several batches have ----------------------------------------------------
def shared_seeds(batches: DataFrame, folder: str, length: int, hot: int) -> DataFrame:
    """(batch, seed, hot) of the seeds that two batches or more have."""

    def seeds(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for number in part.column("batch").to_pylist():
                batch = Batch(folder, number, length)
                batch.find_passages()
                by = np.argsort(batch.seed, kind="stable")
                seed = batch.seed[by]
                first = np.flatnonzero(np.append(True, seed[1:] != seed[:-1])) if len(seed) else np.zeros(0, dtype=np.int64)
                n = np.diff(np.append(first, len(seed)))
                different = n.copy()
                for g in np.flatnonzero(n > 1).tolist():
                    different[g] = len({batch.body(i) for i in by[first[g] : first[g] + n[g]].tolist()})
                out = [seed[first].view(np.int64), np.full(len(first), number), different]
                for a in range(0, len(first), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(x[a : a + (1 << 16)], pa.int64()) for x in out], ["seed", "batch", "n"])

    of = Window.partitionBy("seed")
    rows = _spread(batches).mapInArrow(seeds, "seed long, batch long, n long")
    rows = rows.withColumns({"batches": F.count(F.lit(1)).over(of), "different": F.sum("n").over(of)})
    return rows.where("batches > 1").select("batch", "seed", (F.col("different") > hot).alias("hot"))


MAX_TASKS = 100_000


def _spread(batches: DataFrame) -> DataFrame:
    """One batch a task, or few."""
    return batches.select("batch").repartitionByRange(max(1, min(batches.count(), MAX_TASKS)), "batch")


# --- 3. passages to compare ------------------------------------------------------------------
def _passage_schema(kind: T.DataType) -> T.StructType:
    """``shard``: what brings rows together; a row without a body is a repeat that its batch has found."""
    long, binary = T.LongType(), T.BinaryType()
    names = [("shard", long), ("seed", long), ("doc", kind), ("batch", long), ("row", long), ("start", long), ("stop", long), ("body", binary)]
    return T.StructType([T.StructField(n, t) for n, t in names])


def select_passages(batch: Batch, shared: set[int], hot_seeds: set[int], hot: int) -> Iterator[tuple]:
    """(seed, row, start, stop, body) to compare (seed None: a window by itself), and repeats (body None), joined where they overlap."""
    batch.find_passages()
    seeds, counts = np.unique(batch.seed, return_counts=True)
    several = set(seeds[counts > 1].view(np.int64).tolist())
    at = np.flatnonzero(np.isin(batch.seed.view(np.int64), np.array(sorted(shared | several), dtype=np.int64)))
    seed = batch.seed[at].view(np.int64).tolist()
    first, size, row = batch.first[at].tolist(), batch.size[at].tolist(), batch.row[at].tolist()
    different: dict[int, set[bytes]] = {}  # passages of the seeds that no other batch has
    for i, s in enumerate(seed):
        if s not in shared:
            different.setdefault(s, set()).add(batch.data[first[i] : first[i] + size[i] + batch.length - 1])
    by_window = hot_seeds | {s for s, x in different.items() if len(x) > hot}
    earliest: dict[bytes, tuple[int, int]] = {}
    open_row, open_start, open_stop = -1, 0, 0
    for i, s in enumerate(seed):
        base, ordinal = int(batch.starts[row[i]]), int(batch.ordinal[row[i]])
        whole = s not in by_window
        meets = s in shared or len(different[s]) > 1
        for a, k in [(first[i], size[i])] if whole else [(first[i] + j, 1) for j in range(size[i])]:
            body = batch.data[a : a + k + batch.length - 1]
            start, stop = a - base, a - base + len(body)
            found = earliest.setdefault(body, (ordinal, start))
            if found == (ordinal, start):
                if meets:
                    yield s if whole else None, row[i], start, stop, body
            elif row[i] == open_row and start <= open_stop:
                open_stop = stop
            else:
                if open_row >= 0:
                    yield None, open_row, open_start, open_stop, None
                open_row, open_start, open_stop = row[i], start, stop
    if open_row >= 0:
        yield None, open_row, open_start, open_stop, None


def passages(batches: DataFrame, shared: DataFrame, folder: str, length: int, hot: int, shards: int, kind: T.DataType) -> DataFrame:
    """The passages to compare and the repeats inside batches (see _passage_schema)."""
    schema = _passage_schema(kind)
    names, none = schema.names, to_arrow_schema(schema).empty_table()

    def send(table: pa.Table) -> pa.Table:
        number = table.column("batch")[0].as_py()
        seeds = table.column("seed").combine_chunks()
        known = pc.is_valid(seeds)
        hot_flags = pc.filter(table.column("hot"), known).to_pylist()
        of_others = pc.filter(seeds, known).to_pylist()
        batch = Batch(folder, number, length)
        docs, parts = batch.rows.column("doc"), []
        found = select_passages(batch, set(of_others), {s for s, h in zip(of_others, hot_flags) if h}, hot)
        while rows := list(itertools.islice(found, SENT_ROWS)):
            seed, row, start, stop, body = map(list, zip(*rows))
            # A single window of a hot seed goes by its own bytes.
            meet = [number if b is None else s if s is not None else hash_bytes(b) for s, b in zip(seed, body)]
            doc = docs.take(pa.array(row, pa.int64())).combine_chunks()
            columns = [[m % shards for m in meet], meet, doc, [number] * len(row), row, start, stop, pa.array(body, pa.binary())]
            parts.append(pa.table([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, pa.int64()) for c in columns], names=names))
        return pa.concat_tables(parts) if parts else none

    all_batches = batches.select("batch", F.lit(None).cast("long").alias("seed"), F.lit(None).cast("boolean").alias("hot"))
    return shared.unionByName(all_batches).groupBy("batch").applyInArrow(send, _passage_schema(kind))


def hash_bytes(body: bytes) -> int:
    """63 bits; where it goes, not whether it is equal."""
    import xxhash

    return xxhash.xxh64_intdigest(body) >> 1


# --- 4. the index family ---------------------------------------------------------------------
class Family:
    """Levels of sorted windows, each with the earliest place of every window; none holds a window twice.

    A place is a number that grows with document and start.
    """

    def __init__(self, length: int):
        self.length, self.levels = length, []

    def add(self, bodies: list[bytes], places: np.ndarray) -> np.ndarray:
        """True for each window of the new passages, one after the other, that starts earlier elsewhere.

        ``places``: of each window.  They are not before those of former calls.
        """
        windows = _windows(bodies, self.length)
        order = np.argsort(windows, kind="stable")  # the suffix array of the batch; places ascend among equals
        sorted_ = windows[order]
        fresh = np.append(True, sorted_[1:] != sorted_[:-1]) if len(order) else np.zeros(0, dtype=bool)
        group = np.cumsum(fresh) - 1
        text, place = sorted_[fresh], places[order]
        earliest = np.minimum.reduceat(place, np.flatnonzero(fresh)) if len(place) else place
        new = np.ones(len(text), dtype=bool)
        for level_text, level_place in self.levels:
            at = np.minimum(np.searchsorted(level_text, text), len(level_text) - 1)
            found = level_text[at] == text
            earliest[found] = np.minimum(earliest[found], level_place[at[found]])
            new &= ~found
        repeat = np.empty(len(order), dtype=bool)
        repeat[order] = earliest[group] < place
        self._push(text[new], earliest[new])
        return repeat

    def _push(self, text: np.ndarray, place: np.ndarray) -> None:
        if len(text):
            self.levels.append((text, place))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            text, place = np.concatenate([b, a]), np.concatenate([y, x])
            order = np.argsort(text, kind="stable")  # two sorted runs: one merge
            self.levels.append((text[order], place[order]))


def _windows(bodies: list[bytes], length: int) -> np.ndarray:
    """All windows of the passages, as fixed-length byte strings (compared like memory; zero bytes count)."""
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    n = sizes - length + 1
    text = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    at = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(n) - n), n) + np.arange(n.sum())
    if not len(at):
        return np.zeros(0, dtype=f"S{length}")
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, length)[at]).view(f"S{length}").ravel()


def shard_repeats(rows: list[tuple[int, int, int, bytes]], length: int, slice_bytes: int) -> Iterator[tuple[int, int, int]]:
    """(row, start, stop) repeated; ``rows``: (seed, ordinal of the document, start, body) in order of document and start."""
    earliest: dict[bytes, tuple[int, int]] = {}
    of_seed: dict[int, int] = {}
    fresh = []
    for i, (seed, ordinal, start, body) in enumerate(rows):
        found = earliest.setdefault(body, (ordinal, start))
        if found < (ordinal, start):
            yield i, start, start + len(body)
        elif found == (ordinal, start):
            fresh.append(i)
            of_seed[seed] = of_seed.get(seed, 0) + 1
    # Passages whose seed has no other have nothing to meet.
    fresh = [i for i in fresh if of_seed[rows[i][0]] > 1]
    family, a = Family(length), 0
    while a < len(fresh):
        b, size = a, 0
        while b < len(fresh) and (size < slice_bytes or b == a):
            size += len(rows[fresh[b]][3])
            b += 1
        part = fresh[a:b]
        bodies = [rows[i][3] for i in part]
        n = np.array([len(x) - length + 1 for x in bodies], dtype=np.int64)
        begin = np.array([(rows[i][1] << 34) + rows[i][2] for i in part], dtype=np.int64)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        repeat = np.flatnonzero(family.add(bodies, np.repeat(begin, n) + inner))
        if len(repeat):
            of = np.repeat(np.arange(len(part)), n)[repeat]
            at = inner[repeat]
            cut = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (at[1:] > at[:-1] + length)))
            ends = np.append(cut[1:], len(at)) - 1
            for x, y in zip(cut.tolist(), ends.tolist()):
                i = part[of[x]]
                start = rows[i][2]
                yield i, start + int(at[x]), start + int(at[y]) + length
        a = b


def repeats(sent: DataFrame, length: int, slice_bytes: int) -> DataFrame:
    """(batch, row, start, stop): stretches of repeated bytes."""

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["batch", "row", "start", "stop"]
        shard, rows, where = None, [], []
        ordinal, last = 0, None

        def found():
            out = [(*where[i], a, b) for i, a, b in shard_repeats(rows, length, slice_bytes)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names) if out else None

        for part in parts:
            known = pc.is_null(part.column("body"))
            yield pa.RecordBatch.from_arrays([pc.filter(part.column(n), known) for n in names], names)
            part = part.filter(pc.invert(known))
            values = [part.column(n).to_pylist() for n in ("shard", "seed", "doc", "batch", "row", "start", "body")]
            for s, seed, doc, batch, row, start, body in zip(*values):
                if s != shard:
                    if rows and (out := found()):
                        yield out
                    shard, rows, where, ordinal, last = s, [], [], 0, doc
                if doc != last:
                    ordinal, last = ordinal + 1, doc
                rows.append((seed, ordinal, start, body))
                where.append((batch, row))
        if rows and (out := found()):
            yield out

    dealt = sent.repartition("shard").sortWithinPartitions("shard", F.asc_nulls_first("doc"), "start")
    return dealt.mapInArrow(of, "batch long, row long, start long, stop long")


# --- 5. what stays -----------------------------------------------------------------------------
def kept(batches: DataFrame, cuts: DataFrame, folder: str, kind: T.DataType, doc_id: str) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every document."""
    long = T.LongType()
    schema = T.StructType([T.StructField("doc", kind), *(T.StructField(n, long) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])

    def cut(table: pa.Table) -> pa.Table:
        batch = Batch(folder, table.column("batch")[0].as_py(), 0)
        row, start, stop = (table.column(n).combine_chunks().drop_null().to_numpy() for n in ("row", "start", "stop"))
        base = batch.starts
        removed = np.zeros(len(batch.data) + 1, dtype=np.int32)
        np.add.at(removed, base[row] + start, 1)
        np.add.at(removed, base[row] + stop, -1)
        gone = np.cumsum(removed[:-1]) > 0
        text = np.frombuffer(batch.data, dtype=np.uint8)
        before = np.concatenate([[0], np.cumsum(gone)])
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = base[:-1][base[:-1] < len(gone)]
        begins[inner] = gone[inner]  # a run ends with its text
        runs = np.concatenate([[0], np.cumsum(begins)])
        n_bytes = np.diff(base)
        n_removed = before[base[1:]] - before[base[:-1]]
        left = text[~gone].tobytes()
        ends = np.cumsum(n_bytes - n_removed)
        bodies = [left[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]
        spans = runs[base[1:]] - runs[base[:-1]]
        columns = [batch.rows.column("doc").combine_chunks(), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, spans)), pa.array(bodies, pa.binary())]
        return pa.table(columns, names=schema.names)

    none = [F.lit(None).cast("long").alias(n) for n in ("row", "start", "stop")]
    return cuts.unionByName(batches.select("batch", *none)).groupBy("batch").applyInArrow(cut, schema).withColumnRenamed("doc", doc_id)


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    doc_id: str = "doc_id",
    text: str = "text",
    batch_bytes: int = BATCH_BYTES,
    shard_bytes: int = SHARD_BYTES,
    slice_bytes: int = SLICE_BYTES,
    hot: int = HOT,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept: the bytes that stay) of every document; the last four arguments change no result."""
    if length < 16:
        raise ValueError("strings have 16 bytes at least")
    kind = docs.schema[doc_id].dataType
    batches, folder = write_batches(docs, doc_id, text, batch_bytes)
    shards = 1 + (batches.agg(F.sum("n_bytes")).first()[0] or 0) // shard_bytes
    sent = passages(batches, shared_seeds(batches, folder, length, hot), folder, length, hot, shards, kind)
    return kept(batches, repeats(sent, length, slice_bytes), folder, kind, doc_id)
