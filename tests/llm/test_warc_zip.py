"""Archives: exact round trip, standard ZIP readers, damaged files, edges."""

import base64
import gzip
import hashlib
import io
import zipfile

import pytest

from pulse.llm import queries, warc_zip

SF = "/root/testdata/sf0.001"


def expected(rows):
    newest = {}
    for i, _, h in rows:
        if i is not None:
            newest[h or ""] = max(i, newest.get(h or "", i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        old = i is not None and i < newest[h or ""]
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), sha, "revisit" if old else "response", newest[h or ""] if old else None))
    return sorted(out, key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, queries.QUERIES["op5_warc"](spark, SF).collect()), key=str) == expected(rows)


EDGE = [
    (1, "http://a/", "<p>é\r\n\r\nx</p>"), (2, "http://b/\r\nX: 1", "<p>é\r\n\r\nx</p>"), (3, None, None), (4, "", ""), (5, "u", "WARC/1.1\r\n\r\n"),
    (5, "u", "WARC/1.1\r\n\r\n"), (None, "n", "<p>é\r\n\r\nx</p>"), (6, "big", "zü" * 400_000),
]


@pytest.mark.parametrize("limit", [1, 64 << 20])
def test_edges_and_payloads(spark, monkeypatch, limit):
    monkeypatch.setattr(warc_zip, "ARCHIVE_BYTES", limit)
    pages = spark.createDataFrame([(*r, "x") for r in EDGE], "page_id long, url string, html string, payload string")
    got = warc_zip.round_trip(pages).collect()
    assert sorted(((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(EDGE)
    html = {(r[0], r[2] or "") for r in EDGE}
    assert all((r.page, bytes(r.payload).decode()) in html for r in got if r.record_type == "response")
    assert {r.url for r in got if r.page == 2} == {"http://b/%0D%0AX: 1"} and {r.url for r in got if r.page == 3} == {None}
    assert warc_zip.round_trip(pages.limit(0)).count() == 0


def test_min_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    assert {r.page: r.refers_to for r in warc_zip.round_trip(pages, min_bytes=3).collect()} == {1: None, 2: None, 3: 4, 4: None}


def packed(payloads):
    out = io.BytesIO()
    z = warc_zip.ZipWriter(out)
    z.begin(warc_zip.DATA)
    spans = []
    for k, p in enumerate(payloads):
        raw = gzip.compress(warc_zip.record(str(k), "u", p))
        spans.append((z.add(raw), len(raw)))
    z.end()
    z.begin(warc_zip.INDEX)
    z.add(b"index")
    z.end()
    z.close()
    return out.getvalue(), spans


def test_the_standard_library_reads_our_archives_and_we_read_its():
    data, spans = packed([b"one", b"", b"three" * 1000])
    z = zipfile.ZipFile(io.BytesIO(data))
    assert z.testzip() is None and z.namelist() == [warc_zip.DATA, warc_zip.INDEX]
    where = warc_zip.members(io.BytesIO(data), len(data))
    at, size = where[warc_zip.DATA]
    assert data[at : at + size] == z.read(warc_zip.DATA)
    o, n = spans[2]
    assert warc_zip.parse(gzip.decompress(data[at + o : at + o + n]))["payload"] == b"three" * 1000
    for allow64 in (False, True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as w:
            with w.open("a.txt", "w", force_zip64=allow64) as f:
                f.write(b"stored")
            w.writestr("b.txt", b"packed" * 99, zipfile.ZIP_DEFLATED)
            w.comment = b"PK comment " * 50
        raw = out.getvalue()
        found = warc_zip.members(io.BytesIO(raw), len(raw))
        assert list(found) == ["a.txt"] and raw[found["a.txt"][0] :][:6] == b"stored"


def test_damage_is_noticed():
    data, spans = packed([b"payload"])
    at = warc_zip.members(io.BytesIO(data), len(data))[warc_zip.DATA][0]
    raw = gzip.decompress(data[at : at + spans[0][1]])
    with pytest.raises(ValueError, match="damaged"):
        warc_zip.parse(raw.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.members(io.BytesIO(b"nothing here"), 12)
    with pytest.raises(ValueError):
        cut = data[:40] + data[60:]
        warc_zip.members(io.BytesIO(cut), len(cut))


def test_text_ids_of_any_characters(spark):
    ids = ["a b", "a\nb", "a\r\nWARC-Type: x", "", None, "é%20 {", "x"]
    pages = spark.createDataFrame([(i, "http://x", f"<p>{n % 4}</p>") for n, i in enumerate(ids)], "page_id string, url string, html string")
    got = {r.page: (r.record_type, r.refers_to, r.payload_bytes) for r in warc_zip.round_trip(pages).collect()}
    assert set(got) == set(ids) and got[None] == ("response", None, 8)
    assert got["a b"] == ("response", None, 8)  # the same payload as the null id, which is no larger
    assert got["a\nb"] == ("revisit", "é%20 {", 8) and got["a\r\nWARC-Type: x"] == ("revisit", "x", 8) and got[""] == ("response", None, 8)
