"""ZIP containers read by ranges: end record, ZIP64 records, central directory, stored members."""

from __future__ import annotations

import struct
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession

_END, _END64, _LOCATOR, _ENTRY, _LOCAL = (
    b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
)
_MOST_COMMENT = 65535


# Names that Hadoop and Arrow give the same stores.
_SAME = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme under which Spark itself reaches it; asked on the driver.

    A path without one belongs to the cluster's default file system, not to the machine of a task.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path in it: a file:, hdfs:, viewfs:, s3a:, s3: or gs: URI, or a local path."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(arrow_uri(path))


def arrow_uri(path: str) -> str:
    scheme, _, rest = path.partition("://")
    return f"{_SAME.get(scheme, scheme)}://{rest}"


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    packed: int
    size: int
    header: int  # offset of the local header


class ZipRanges:
    """Members of a ZIP file of any size, found without reading their data."""

    def __init__(self, path: str) -> None:
        store, inner = filesystem(path)
        self.file = store.open_input_file(inner)
        self.size = self.file.size()
        self.members = {m.name: m for m in self._directory()}

    def close(self) -> None:
        self.file.close()

    def read(self, offset: int, length: int) -> bytes:
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise ValueError("the file ends before the range does")
        return data

    def _end(self) -> tuple[int, int, int]:
        """Entries, bytes and offset of the central directory."""
        tail_at = max(0, self.size - 22 - _MOST_COMMENT)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(_END)
        while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP file")
        count, size, offset = struct.unpack_from("<HII", tail, at + 10)
        if count == 0xFFFF or size == 0xFFFFFFFF or offset == 0xFFFFFFFF:
            locator_at = tail_at + at - 20
            locator = self.read(locator_at, 20) if locator_at >= 0 else b""
            if locator[:4] == _LOCATOR:
                record = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
                if record[:4] != _END64:
                    raise ValueError("broken ZIP64 end record")
                count, size, offset = struct.unpack_from("<QQQ", record, 32)
        return count, size, offset

    def _directory(self) -> list[Member]:
        count, size, offset = self._end()
        data, at, found = self.read(offset, size), 0, []
        for _ in range(count):
            if data[at : at + 4] != _ENTRY:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed, whole = struct.unpack_from("<II", data, at + 20)
            name_n, extra_n, comment_n = struct.unpack_from("<HHH", data, at + 28)
            header = struct.unpack_from("<I", data, at + 42)[0]
            name = data[at + 46 : at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + 46 + name_n : at + 46 + name_n + extra_n]
            # ZIP64 numbers stand in this order, each only where the short field is full.
            wide, place = _extra(extra, 1), 0
            values = []
            for short in (whole, packed, header):
                if short == 0xFFFFFFFF and len(wide) >= place + 8:
                    short = struct.unpack_from("<Q", wide, place)[0]
                    place += 8
                values.append(short)
            whole, packed, header = values
            found.append(Member(name, method, packed, whole, header))
            at += 46 + name_n + extra_n + comment_n
        return found

    def data_offset(self, member: Member) -> int:
        """Where a stored member's bytes begin."""
        if member.method != 0:
            raise ValueError(f"{member.name} is compressed; ranges need a stored member")
        local = self.read(member.header, 30)
        if local[:4] != _LOCAL:
            raise ValueError(f"no local header for {member.name}")
        name_n, extra_n = struct.unpack_from("<HH", local, 26)
        return member.header + 30 + name_n + extra_n


def _extra(data: bytes, wanted: int) -> bytes:
    at = 0
    while at + 4 <= len(data):
        kind, size = struct.unpack_from("<HH", data, at)
        if kind == wanted:
            return data[at + 4 : at + 4 + size]
        at += 4 + size
    return b""
