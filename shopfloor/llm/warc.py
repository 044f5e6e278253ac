"""WARC records in ZIP-packaged archives: written by tasks, read back by byte ranges.

An archive is a ZIP file with stored members: ``archive/data.warc.gz`` (one gzip member per
record), ``indexes/index.cdxj`` (a line per record: offset, length, digest) and
``datapackage.json``. Of pages with equal payloads the one with the largest id is a response;
the others are revisits that carry its id and no payload.

The reader never unpacks an archive. One task per archive reads its end, parses the central
directory (ZIP64 or not), finds the stored members behind their local headers and reads the
index in blocks; the index rows are dealt out anew, and each task range-reads and parses
its own records. Payload digests are worked out from the bytes read, and revisits are joined
to the response that they refer to.

Files go to a folder all executors share, by ``pyarrow.fs`` (local paths, HDFS, S3, ...). A
task writes under a name of its own, and only archives named in the committed table of
archives are read, so a lost or repeated task leaves no half archive in the result.

Edge cases: a null html is an empty payload; a null url leaves out the target line, and
line breaks in urls are escaped; a null id is written as "null"; repeated rows with the
largest id are responses alike, and earlier ones revisits; an empty table writes no archive.
Only named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.layout import table
from shopfloor.scratch import materialize, scratch_path

DATA = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
# A new archive begins beyond so many bytes or records.
ARCHIVE_BYTES = 512 << 20
ARCHIVE_RECORDS = 200_000
# Records were fetched at no known time; the format wants one.
WARC_DATE = "1970-01-01T00:00:00Z"
READ_BLOCK = 1 << 20
# A reading task takes about so many packed bytes.
TASK_BYTES = 8 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing -------------------------------------------------------------------------


def warc_record(page_id, url: str | None, payload: bytes, payload_digest: str, refers_to) -> bytes:
    """One record; with ``refers_to`` a revisit that repeats the HTTP head alone."""
    revisit = refers_to is not None
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{_name(page_id)}>",
        "WARC-Date": WARC_DATE,
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        fields["WARC-Target-URI"] = quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")
    if revisit:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To"] = f"<urn:page:{_name(refers_to)}>"
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _name(page_id) -> str:
    return "null" if page_id is None else str(page_id)


class _Sink:
    """What a ZIP writer needs of a stream that cannot seek."""

    def __init__(self, stream):
        self.write, self.tell, self.flush = stream.write, stream.tell, stream.flush


class ArchiveWriter:
    def __init__(self, filesystem: pafs.FileSystem, path: str):
        self.stream = filesystem.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Sink(self.stream), "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines: list[str] = []
        self.size = 0

    def add(self, page_id, url, payload: bytes, payload_digest: str, refers_to) -> None:
        record = warc_record(page_id, url, payload, payload_digest, refers_to)
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self.data.write(packed)
        entry = {
            "page": page_id,
            "digest": f"sha1:{payload_digest}",
            "offset": self.size,
            "length": len(packed),
            "filename": DATA.rpartition("/")[2],
        }
        key = quote(url or "-", safe=":/?=&.-_~")
        self.lines.append(f"{key} {WARC_DATE} {json.dumps(entry)}\n")
        self.size += len(packed)

    def close(self) -> None:
        self.data.close()
        info = zipfile.ZipInfo(INDEX)
        with self.zip.open(info, "w", force_zip64=True) as index:
            for line in sorted(self.lines):
                index.write(line.encode())
        about = {"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}]}
        self.zip.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps(about))
        self.zip.close()
        self.stream.close()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns (path, size, records)."""
    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"),
    ).withColumn("sha1", F.unhex(F.sha1("payload")))
    several = (
        given.groupBy("sha1")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("sha1").alias("same"), "last")
    )
    older = (F.col("page_id") < F.col("last")) | (F.col("page_id").isNull() & F.col("last").isNotNull())
    rows = given.join(several, F.col("sha1") == F.col("same"), "left").select(
        "page_id", "url", "payload", "sha1", F.when(older, F.col("last")).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(folder)
        writer, path, done = None, "", []

        def finish() -> None:
            writer.close()
            done.append((path, filesystem.get_file_info(path).size, len(writer.lines)))

        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    filesystem.create_dir(root, recursive=True)
                    path = f"{root}/{uuid.uuid4().hex}.wacz"
                    writer = ArchiveWriter(filesystem, path)
                writer.add(
                    row["page_id"],
                    row["url"],
                    row["payload"],
                    base64.b32encode(row["sha1"]).decode(),
                    row["refers_to"],
                )
                if writer.size >= ARCHIVE_BYTES or len(writer.lines) >= ARCHIVE_RECORDS:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        columns = zip(*done, strict=True) if done else ([], [], [])
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.record_batch(
            [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
            ["path", "size", "records"],
        )

    return materialize(rows.mapInArrow(run, "path string, size long, records long"), "archives")


# --- reading -------------------------------------------------------------------------


def zip_members(file, size: int) -> dict[str, tuple[int, int]]:
    """Offset and length of the data of each stored member, from the directory at the end."""
    start = max(0, size - (22 + 0xFFFF))
    tail = file.read_at(size - start, start)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, entries, length, offset, _ = struct.unpack("<4s4H2IH", tail[at : at + 22])
    if start + at >= 20:
        locator = file.read_at(20, start + at - 20)
        if locator[:4] == b"PK\x06\x07":
            (where,) = struct.unpack("<Q", locator[8:16])
            entries, length, offset = struct.unpack("<3Q", file.read_at(56, where)[32:56])
    directory = file.read_at(length, offset)
    found: dict[str, tuple[int, int]] = {}
    at = 0
    for _ in range(entries):
        part = struct.unpack("<4s6H3I5H2I", directory[at : at + 46])
        if part[0] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain, local = part[4], part[8], part[9], part[16]
        names, extras, comments = part[10:13]
        name = directory[at + 46 : at + 46 + names].decode()
        extra = directory[at + 46 + names : at + 46 + names + extras]
        at += 46 + names + extras + comments
        plain, packed, local = _wide(extra, plain, packed, local)
        if method != 0:
            continue
        head = file.read_at(30, local)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header for {name}")
        begin = local + 30 + sum(struct.unpack("<2H", head[26:30]))
        found[name] = (begin, packed)
    return found


def _wide(extra: bytes, *values: int) -> list[int]:
    """The values, those that do not fit 32 bits taken from the ZIP64 field."""
    out, at = list(values), 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack("<2H", extra[at : at + 4])
        if kind == 1:
            field, place = extra[at + 4 : at + 4 + length], 0
            for i, value in enumerate(values):
                if value == 0xFFFFFFFF:
                    (out[i],) = struct.unpack("<Q", field[place : place + 8])
                    place += 8
        at += 4 + length
    return out


def _open(path: str, folder: str):
    filesystem, _ = pafs.FileSystem.from_uri(folder)
    return filesystem.open_input_file(path)


def _index_lines(file, begin: int, length: int) -> Iterator[bytes]:
    held, done = b"", 0
    while done < length:
        block = file.read_at(min(READ_BLOCK, length - done), begin + done)
        done += len(block)
        *whole, held = (held + block).split(b"\n")
        yield from whole
    if held:
        yield held


def list_records(archives: DataFrame, folder: str) -> DataFrame:
    """(path, begin, length) of every record, from the archives' indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _open(path, folder) as file:
                    members = zip_members(file, file.size())
                    data, _ = members[DATA]
                    begins, lengths = [], []
                    for line in _index_lines(file, *members[INDEX]):
                        entry = json.loads(line.split(b" ", 2)[2])
                        begins.append(data + int(entry["offset"]))
                        lengths.append(int(entry["length"]))
                    yield pa.record_batch(
                        [pa.array([path] * len(begins)), pa.array(begins), pa.array(lengths)],
                        ["path", "begin", "length"],
                    )

    return archives.select("path").mapInArrow(run, "path string, begin long, length long")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The WARC fields (names in lower case) and the payload after the HTTP head."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode().lower()] = value.decode().strip()
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def read_records(archives: DataFrame, folder: str) -> DataFrame:
    """Range-read every record: ids, type, reference, digests and payload.

    The number of tasks follows from the bytes to read, which the index rows do not show.
    """
    packed = archives.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-int(packed) // TASK_BYTES))
    records = list_records(archives, folder)

    def page(name: str | None) -> int | None:
        value = name.strip("<>").rpartition(":")[2] if name else "null"
        return None if value == "null" else int(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            for at in range(0, len(batch), 256):
                out = []
                for row in batch.slice(at, 256).to_pylist():
                    if row["path"] != path:
                        if file is not None:
                            file.close()
                        path, file = row["path"], _open(row["path"], folder)
                    raw = zlib.decompress(file.read_at(row["length"], row["begin"]), 31)
                    fields, payload = parse_record(raw)
                    out.append(
                        {
                            "page_id": page(fields["warc-record-id"]),
                            "record_type": fields["warc-type"],
                            "refers_to": page(fields.get("warc-refers-to")),
                            "declared": fields["warc-payload-digest"].removeprefix("sha1:"),
                            "found": digest(payload),
                            "payload": payload,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=_RECORD)
        if file is not None:
            file.close()

    # In the order of the files, many pieces of an archive to as many tasks.
    dealt = records.repartitionByRange(parts, "path", "begin").sortWithinPartitions("path", "begin")
    return dealt.mapInArrow(
        run,
        "page_id long, record_type string, refers_to long, declared string, found string, payload binary",
    )


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("declared", pa.string()),
        ("found", pa.string()),
        ("payload", pa.binary()),
    ]
)


def resolved(records: DataFrame) -> DataFrame:
    """Narrow record rows with the length and digest of the full payload.

    A revisit takes both from the response it refers to, whose digest has to be the declared one.
    """
    responses = records.where("record_type = 'response'").groupBy("page_id", "found").agg(
        F.max("payload_bytes").alias("bytes")
    )
    target = responses.select(
        F.col("page_id").alias("target"), F.col("found").alias("target_digest"), "bytes"
    )
    revisits = records.where("record_type = 'revisit'").join(
        target,
        (F.col("refers_to") == F.col("target")) & (F.col("declared") == F.col("target_digest")),
        "left",
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        records.where("record_type = 'response'")
        .withColumn("payload_digest", F.col("found"))
        .select(*columns)
        .unionByName(
            revisits.select(
                "page_id",
                F.col("bytes").alias("payload_bytes"),
                F.col("target_digest").alias("payload_digest"),
                "record_type",
                "refers_to",
            )
        )
    )


def op5_zip_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back by ranges."""
    folder = scratch_path(spark, "wacz")
    archives = write_archives(table(spark, sf_dir, "pages"), folder)
    records = read_records(archives, folder)
    narrow = records.select(
        "page_id",
        "record_type",
        "refers_to",
        "declared",
        "found",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    return resolved(materialize(narrow, "records"))
