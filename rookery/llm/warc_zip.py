"""WARC records in ZIP-packaged web archives: writing, and reading by ranges."""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm.rows import arrow_schema, materialise
from rookery.llm.zip_archive import ZipRanges, filesystem, qualified
from rookery.session import scratch_dir

# Bytes of records after which a task begins another archive, and bytes that one range read asks for.
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
# Ranges that one reading task takes on average, once there are more than cores.
TASK_RANGES = 16
DATE = "1970-01-01T00:00:00Z"
_RECORD_ID = "urn:x-page:"
_RECORDS = "archive/data.warc.gz"
_INDEX = "indexes/index.cdxj"
_READ = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the header lines and leaves the payload to the record it refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_RECORD_ID}{'' if page_id is None else page_id}>"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{_RECORD_ID}{refers_to}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(record: bytes) -> tuple:
    """Cells of ``_READ`` for one record; the payload of a response is checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")

    def page(value: str | None) -> int | None:
        number = (value or "").strip("<>").removeprefix(_RECORD_ID)
        return int(number) if number else None

    url = fields.get("warc-target-uri")
    if url is not None:
        url = re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url)
    return (
        page(fields["warc-record-id"]), url, kind, size, digest, page(fields.get("warc-refers-to")),
        payload if kind == "response" else None,
    )


class _Archive:
    """One ZIP file under a temporary name, which gets its own name when it is whole."""

    def __init__(self, folder: str, name: str) -> None:
        self.store, inner = filesystem(folder)
        self.path, self.temporary = f"{folder}/{name}", f"{inner}/.{name}-{uuid.uuid4().hex}"
        self.final = f"{inner}/{name}"
        self.store.create_dir(inner, recursive=True)
        self.out = self.store.open_output_stream(self.temporary)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(_RECORDS), "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, page_id, url, record: bytes) -> None:
        packed = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packed.compress(record) + packed.flush()
        self.data.write(member)
        entry = {"offset": self.size, "length": len(member), "page": page_id}
        self.index.append(f"{page_id} {DATE} {json.dumps(entry)}\n")
        self.size += len(member)

    def close(self) -> tuple[str, int]:
        self.data.close()
        for name, text in ((_INDEX, "".join(self.index)), ("datapackage.json", json.dumps({"profile": "data-package"}))):
            self.zip.writestr(zipfile.ZipInfo(name), text)
        self.zip.close()
        self.out.close()
        self.store.move(self.temporary, self.final)
        return self.path, len(self.index)


def record_kinds(
    pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(page_id, url, html, kind, refers_to)``: which records hold their payload.

    Of equal payloads of at least ``least`` bytes the rows of the smallest id are responses and the
    others revisit it; smaller payloads are responses. A null id is never the smallest. Digests are
    counted before they are shuffled and the pages are joined to those that occur twice, so a payload
    that a third of the pages share is split by AQE like any skewed join.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
        F.sha1(html).alias("digest"),
    )
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1 and first is not null").select("digest", "first")
    first = materialise(first, "digests")
    again = F.col("first").isNotNull() & (F.octet_length("html") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "html",
        F.when(again, "revisit").otherwise("response").alias("kind"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``record_kinds`` and return ``(path, records)`` of each archive.

    A task streams its rows into archives named after the task. Each appears under its name only when
    it is whole, so a task that runs again replaces its own archives. ``folder`` is shared; its paths
    name the file system that Spark takes it from, and tasks open them there.
    """
    folder = qualified(records.sparkSession, folder)
    schema = "path string, records long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, archive, count, done = TaskContext.get().partitionId(), None, 0, []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "kind", "refers_to"))):
                page_id, url, html, kind, refers_to = (x.as_py() for x in row)
                if archive is None:
                    archive = _Archive(folder, f"part-{task:06d}-{count:04d}.wacz")
                    count += 1
                archive.add(page_id, url, warc_record(kind, page_id, url, html, refers_to))
                if archive.size >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        cells = [pa.array([x[i] for x in done], t) for i, t in ((0, pa.string()), (1, pa.int64()))]
        yield pa.RecordBatch.from_arrays(cells, schema=arrow)

    return materialise(records.mapInArrow(run, schema), "archives")


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of the archives named in ``path``: id, url, type, size, digest, reference, payload.

    Each archive's directory and index are parsed where its path lies and give ranges of whole records.
    The ranges are counted and dealt out evenly to at least as many tasks as there are cores, then read
    one by one, so neither a large archive nor a member is ever held whole.
    """
    schema = "path string, begin long, length long"
    arrow = arrow_schema(schema)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = archive_ranges(path, range_bytes)
                cells = [pa.array([path] * len(found)), *(pa.array([x[i] for x in found], pa.int64()) for i in (0, 1))]
                yield pa.RecordBatch.from_arrays([cells[0].cast(pa.string()), *cells[1:]], schema=arrow)

    out = arrow_schema(_READ)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin, length in zip(*(batch.column(c).to_pylist() for c in ("path", "begin", "length"))):
                rows = [parsed(x) for x in read_range(path, begin, length)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out
                )

    found = materialise(archives.select("path").mapInArrow(ranges, schema), "ranges")
    # A number keeps AQE from merging rows of forty bytes that stand for megabytes.
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism, -(-found.count() // TASK_RANGES))
    return found.repartition(tasks).mapInArrow(records, _READ)


def archive_ranges(path: str, range_bytes: int) -> list[tuple[int, int]]:
    """Absolute ranges of whole records, as the archive's own index has them."""
    archive = ZipRanges(path)
    try:
        data, index = archive.members[_RECORDS], archive.members[_INDEX]
        first = archive.data_offset(data)
        lines = archive.read(archive.data_offset(index), index.size).decode().splitlines()
        found: list[tuple[int, int]] = []
        for line in lines:
            entry = json.loads(line.split(" ", 2)[2])
            begin, length = first + entry["offset"], entry["length"]
            if found and found[-1][0] + found[-1][1] == begin and found[-1][1] + length <= range_bytes:
                found[-1] = (found[-1][0], found[-1][1] + length)
            else:
                found.append((begin, length))
        return found
    finally:
        archive.close()


def read_range(path: str, begin: int, length: int) -> Iterator[bytes]:
    """The records of one range; each is a gzip member of its own."""
    store, inner = filesystem(path)
    with store.open_input_file(inner) as file:
        data = file.read_at(length, begin)
    while data:
        member = zlib.decompressobj(31)
        record = member.decompress(data) + member.flush()
        if not member.eof:
            raise ValueError("a record ends outside its range")
        yield record
        data = member.unused_data


def archive_round_trip(
    pages: DataFrame, folder: str | None = None, least: int = 0, archive_bytes: int = ARCHIVE_BYTES, **columns
) -> DataFrame:
    """Write a record per row of ``pages`` to ZIP-packaged archives and read all of them back.

    Null payloads are empty, null urls are left out, null ids stay null. Rows that repeat the smallest
    id of a payload are responses too. No rows write no archive and give no rows; other columns do
    not matter.
    """
    spark: SparkSession = pages.sparkSession
    folder = folder or os.path.join(scratch_dir(spark, "wacz"))
    written = write_archives(record_kinds(pages, least, **columns), folder, archive_bytes)
    return read_archives(written)
