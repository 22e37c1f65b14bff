"""WARC records in ZIP-packaged archives, read by range without extraction.

Writing: each task packs its records into archives of its own.  An archive is a
ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``, WARC
records gzipped one by one, and ``indexes/index.cdxj``, one JSON line a record
with its offset and length inside that member.  Sizes and offsets are written
as ZIP64 throughout, so an archive may exceed 4 GB.  A task names its archives
afresh and reports them only when it succeeds; a retried task leaves files that
nothing refers to, never half an archive in use.

Reading: the end record, its ZIP64 locator and the central directory are parsed
from the file's tail; members and the index are located from there, and every
record is read by its own byte range.

Files are reached through ``pyarrow.fs``, so the folder may be local (shared)
or an object store; it lies under the shared work folder.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pulse.llm.common import file_system, write_out
from pulse.session import fresh_path

ARCHIVE_BYTES = 64 << 20  # an archive is closed beyond this size
DATE = "1970-01-01T00:00:00Z"  # pages carry no crawl time
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
U32 = 0xFFFFFFFF


# --- ZIP ---------------------------------------------------------------------
class ZipWriter:
    """Stored members, with ZIP64 sizes and offsets."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        """A member whose size and checksum follow it (data descriptor)."""
        raw = name.encode()
        self.members.append([raw, self.at, 0, 0])
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x0808, 0, 0, 0x21, 0, U32, U32, len(raw), len(extra)) + raw + extra)

    def add(self, data: bytes) -> int:
        """Appends to the open member; the offset inside it."""
        m = self.members[-1]
        offset, m[2], m[3] = m[2], m[2] + len(data), zlib.crc32(data, m[3])
        self._write(data)
        return offset

    def end(self) -> None:
        _, _, size, crc = self.members[-1]
        self._write(struct.pack("<IIQQ", 0x08074B50, crc, size, size))

    def close(self) -> None:
        start = self.at
        for raw, offset, size, crc in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset)
            self._write(
                struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x0808, 0, 0, 0x21, crc, U32, U32, len(raw), len(extra), 0, 0, 0, 0, U32)
                + raw
                + extra
            )
        size, n, end64 = self.at - start, len(self.members), self.at
        self._write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, start))
        self._write(struct.pack("<IIQI", 0x07064B50, 0, end64, 1))
        self._write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), min(size, U32), U32, 0))


def _read(f, at: int, size: int) -> bytes:
    f.seek(at)
    data = f.read(size)
    if len(data) != size:
        raise ValueError("the archive ends early")
    return data


def members(f, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (offset of the data, size) of the stored members, from the central directory."""
    tail_at = max(0, size - 65_557)  # end record and the longest comment
    tail = _read(f, tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    _, _, _, _, count, length, start, _ = struct.unpack("<IHHHHIIH", tail[at : at + 22])
    if count == 0xFFFF or U32 in (length, start):
        sig, _, at64, _ = struct.unpack("<IIQI", _read(f, tail_at + at - 20, 20))
        if sig != 0x07064B50:
            raise ValueError("no ZIP64 locator")
        sig, _, _, _, _, _, _, count, length, start = struct.unpack("<IQHHIIQQQQ", _read(f, at64, 56))
        if sig != 0x06064B50:
            raise ValueError("no ZIP64 end record")
    directory, at, found = _read(f, start, length), 0, {}
    for _ in range(count):
        head = struct.unpack("<IHHHHHHIIIHHHHHII", directory[at : at + 46])
        if head[0] != 0x02014B50:
            raise ValueError("bad central directory")
        method, packed, plain, n_name, n_extra, n_comment, offset = head[4], head[8], head[9], head[10], head[11], head[12], head[16]
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        at += 46 + n_name + n_extra + n_comment
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = next(wide) if plain == U32 else plain
                packed = next(wide) if packed == U32 else packed
                offset = next(wide) if offset == U32 else offset
            extra = extra[4 + n :]
        if method == 0:  # only stored members can be read by range
            n_name, n_extra = struct.unpack("<HH", _read(f, offset + 26, 4))
            found[name] = (offset + 30 + n_name + n_extra, packed)
    return found


# --- WARC --------------------------------------------------------------------
def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page: str | None) -> str:
    """Any id, percent-encoded; a null id has no part after the name."""
    return "<urn:page>" if page is None else f"<urn:page:{quote(page, safe='', errors='surrogatepass')}>"


def _page(urn: str) -> str | None:
    if urn == "<urn:page>":
        return None
    return unquote(urn.removeprefix("<urn:page:").removesuffix(">"), errors="surrogatepass")


def _clean(value: str) -> str:
    """A header value may not hold control characters: they are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page: str | None, url: str | None, payload: bytes, original: str | None = None) -> bytes:
    """A response record, or a revisit of the page ``original``; the HTTP header states the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if original is not None:
        head += [f"WARC-Refers-To: {_urn(original)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of one record; for a response the payload, whose digest is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (digest(payload) != sha or len(payload) != stated):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    original = fields.get("WARC-Refers-To")
    return {
        "page": _page(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "record_type": kind,
        "payload_bytes": stated,
        "payload_digest": sha,
        "refers_to": None if original is None else _page(original),
        "payload": payload if kind == "response" else None,
    }


# --- Spark -------------------------------------------------------------------
def plan_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """page, url, payload, original: the page (largest id with an equal payload) that a revisit refers to."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn(
        "sha", F.unhex(F.sha2("payload", 256))
    )
    # Of payloads of the same SHA-256; the counting aggregates before its shuffle.
    newest = rows.groupBy("sha").agg(F.max("page").alias("newest"))
    revisit = (F.octet_length("payload") >= min_bytes) & (F.col("page") < F.col("newest"))
    return rows.join(newest, "sha", "left").select(
        F.col("page").cast("string").alias("page"),
        "url",
        "payload",
        F.when(revisit, F.col("newest").cast("string")).alias("original"),
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Packs (page, url, payload, original) rows; one row per archive: path, n_records, n_bytes."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        done, zf, out, path, index = [], None, None, "", []

        def close():
            zf.end()
            zf.begin(INDEX)
            for line in index:
                zf.add(line)
            zf.end()
            zf.close()
            out.close()
            done.append((path, len(index), zf.at))

        for batch in batches:
            for page, url, payload, original in zip(batch["page"], batch["url"], batch["payload"], batch["original"]):
                if zf is None:
                    path, index = f"{base}/{uuid.uuid4().hex}.wacz", []
                    out = fs.open_output_stream(path)
                    zf = ZipWriter(out)
                    zf.begin(DATA)
                raw = gzip.compress(record(page, url, bytes(payload), original), 3, mtime=0)
                entry = {"page": page, "offset": zf.add(raw), "length": len(raw)}
                index.append(f"{_urn(page)} {DATE} {json.dumps(entry)}\n".encode())
                if zf.at > ARCHIVE_BYTES:
                    close()
                    zf = None
        if zf is not None:
            close()
        yield pd.DataFrame(done, columns=["path", "n_records", "n_bytes"])

    return records.mapInPandas(pack, "path string, n_records long, n_bytes long")


RECORD = "page string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def read_archives(archives: DataFrame, folder: str, batch_bytes: int = 8 << 20) -> DataFrame:
    """Every record of the archives (path): one row each, see RECORD; revisits have no payload."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = file_system(folder)
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for path in batch["path"]:
                with fs.open_input_file(path) as f:
                    where = members(f, f.size())
                    data, (index_at, index_size) = where[DATA][0], where[INDEX]
                    rows, held = [], 0
                    for line in io.BytesIO(_read(f, index_at, index_size)):
                        entry = json.loads(line.split(b" ", 2)[2])
                        raw = gzip.decompress(_read(f, data + entry["offset"], entry["length"]))
                        rows.append(parse(raw))
                        held += len(raw)
                        if held > batch_bytes:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=names)

    return archives.select("path").mapInPandas(read, RECORD)


def round_trip(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes all pages into archives and reads every record back (columns of RECORD, page as the id's type).

    Of pages with equal payloads of at least ``min_bytes`` bytes, that with the
    largest id is a response and the others are revisits of it.

    Defined cases: a null html is an empty payload (which counts as equal to
    other empty ones); a null url leaves out the target URI, and control
    characters in an url are percent-encoded; rows that repeat the largest id
    and its payload are all responses; null ids are responses and read back as
    null, and text ids may hold any characters or be empty.  Other columns are not archived.
    """
    folder = fresh_path(pages.sparkSession, "llm-archives")
    kind = dict(pages.dtypes)[id_col]
    archives = write_out(write_archives(plan_records(pages, id_col, url_col, html_col, min_bytes), folder), "archive-list")
    id_of = lambda c: F.col(c).cast(kind)
    back = read_archives(archives.repartition(max(1, archives.count())), folder)
    return back.withColumns({"page": id_of("page"), "refers_to": id_of("refers_to")})
