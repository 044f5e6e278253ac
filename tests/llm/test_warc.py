import base64
import hashlib
import io
import json
import zipfile

import pyarrow.fs as pafs
import pytest
from shopfloor.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, path int"


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    last = {}
    for page_id, html in rows:
        key = html or ""
        if key not in last or last[key] is None or (page_id is not None and page_id > last[key]):
            last[key] = page_id
    out = []
    for page_id, html in rows:
        newest = last[html or ""]
        revisit = newest != page_id
        size = len((html or "").encode())
        out.append(
            (page_id, size, sha1(html), "revisit" if revisit else "response", newest if revisit else None)
        )
    return sorted(out, key=repr)


def read_back(df, folder):
    archives = warc.write_archives(df, folder)
    records = warc.read_records(archives, folder)
    narrow = records.selectExpr(
        "page_id", "record_type", "refers_to", "declared", "found",
        "cast(octet_length(payload) AS long) AS payload_bytes",
    )
    return archives, sorted(map(tuple, warc.resolved(narrow).collect()), key=repr)


ROWS = [
    (1, "http://a.example/x y?é=\r\nX: 1", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (3, "http://a.example/", None),
    (4, "", ""),
    (5, "http://b.example/", "WARC/1.1\r\n\r\nPK\x05\x06 é\U0001f600\r\n\r\n"),
    (6, "http://b.example/long", "text " * 200_000),
    (7, "http://b.example/long", "text " * 200_000),
    (7, "http://b.example/long", "text " * 200_000),
    (None, "http://c.example/", "<p>one</p>"),
    (None, "http://c.example/", "alone"),
]


def test_round_trip_of_odd_rows(spark, tmp_path):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], SCHEMA)
    archives, found = read_back(df, f"file://{tmp_path}/w")
    assert found == expected([(i, html) for i, _, html in ROWS])
    assert archives.agg({"records": "sum"}).first()[0] == len(ROWS)


def test_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()
    found = sorted(map(tuple, warc.op5_zip_warc_round_trip(spark, sf_dir).collect()), key=repr)
    assert found == expected([tuple(r) for r in pages])


def test_many_archives_and_empty_table(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://a.example/{i}", f"page {i % 30}", "x", 1) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    archives, found = read_back(df.repartition(5), str(tmp_path / "w"))
    assert found == expected([(r[0], r[2]) for r in rows])
    empty, nothing = read_back(df.where("false"), str(tmp_path / "e"))
    assert (empty.count(), nothing) == (0, [])
    # An archive is an ordinary ZIP file whose records are ordinary gzip members.
    path = archives.first()["path"]
    with zipfile.ZipFile(path) as archive:
        assert archive.testzip() is None
        lines = archive.read(warc.INDEX).decode().splitlines()
        entry = json.loads(lines[0].split(" ", 2)[2])
        data = archive.read(warc.DATA)
    assert data[entry["offset"] : entry["offset"] + 2] == b"\x1f\x8b"


class _Bytes:
    def __init__(self, raw):
        self.raw = raw

    def read_at(self, n, at):
        return self.raw[at : at + n]


@pytest.mark.parametrize("limit", [None, 100])
def test_directories_with_and_without_zip64(monkeypatch, limit):
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    stream = io.BytesIO()
    parts = {f"m{i}": bytes([i]) * (i * 90) for i in range(6)}
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED) as archive:
        for name, data in parts.items():
            archive.writestr(name, data)
        archive.writestr("packed", b"x" * 900, compress_type=zipfile.ZIP_DEFLATED)
        archive.comment = b"PK a comment"
    raw = stream.getvalue()
    assert (b"PK\x06\x06" in raw) == bool(limit)
    members = warc.zip_members(_Bytes(raw), len(raw))
    assert {n: raw[a : a + k] for n, (a, k) in members.items()} == parts


def test_broken_file(tmp_path):
    path = tmp_path / "x"
    path.write_bytes(b"no archive")
    with pafs.LocalFileSystem().open_input_file(str(path)) as file, pytest.raises(ValueError, match="central"):
        warc.zip_members(file, 10)
