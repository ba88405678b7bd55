"""Reading and writing ZIP packages of stored members by byte ranges.

Only what a packaged web archive needs: members are stored (method 0), so each is a byte range
of the package. The reader finds the end-of-central-directory record, follows the ZIP64
locator where one is present, parses the central directory with its ZIP64 extra fields, and
turns a member into a byte range by its local header. The member data is never unpacked.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

# Fixed values of the ZIP format (APPNOTE 4.3): signatures, record layouts, ZIP64 extra id
LOCAL_SIG, CENTRAL_SIG, END_SIG = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64_SIG, LOCATOR64_SIG = b"PK\x06\x06", b"PK\x06\x07"
LOCAL = struct.Struct("<4sHHHHHIIIHH")
CENTRAL = struct.Struct("<4sHHHHHHIIIHHHHHII")
END = struct.Struct("<4sHHHHIIH")
END64 = struct.Struct("<4sQHHIIQQQQ")
LOCATOR64 = struct.Struct("<4sIQI")
ZIP64_EXTRA = 0x0001
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
UTF8_FLAG = 0x800
DOS_DATE = 0x21  # 1980-01-01, so that equal content gives equal bytes


class BadPackage(ValueError):
    """The bytes are not a package that this reader understands."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc: int
    size: int
    header_at: int


class Packager:
    """Appends stored members to a file object; ``close`` writes the directories.

    ``zip64`` forces the ZIP64 records also where sizes do not call for them.
    """

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.members = out, zip64, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, chunks: list[bytes]) -> None:
        size, crc, at = sum(map(len, chunks)), 0, self.at
        for c in chunks:
            crc = zlib.crc32(c, crc)
        wide = self.zip64 or size >= MAX32
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, size, size) if wide else b""
        n = MAX32 if wide else size
        label = name.encode()
        self._write(LOCAL.pack(LOCAL_SIG, 45 if wide else 20, UTF8_FLAG, 0, 0, DOS_DATE, crc, n, n, len(label),
                               len(extra)) + label + extra)
        for c in chunks:
            self._write(c)
        self.members.append(Member(name, 0, crc, size, at))

    def close(self) -> None:
        start = self.at
        for m in self.members:
            wide = self.zip64 or m.size >= MAX32 or m.header_at >= MAX32
            extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, m.size, m.size, m.header_at) if wide else b""
            n, at = (MAX32, MAX32) if wide else (m.size, m.header_at)
            label, version = m.name.encode(), 45 if wide else 20
            self._write(CENTRAL.pack(CENTRAL_SIG, version, version, UTF8_FLAG, 0, 0, DOS_DATE, m.crc, n, n,
                                     len(label), len(extra), 0, 0, 0, 0, at) + label + extra)
        size, count = self.at - start, len(self.members)
        if self.zip64 or count >= MAX16 or start >= MAX32 or size >= MAX32:
            at = self.at
            self._write(END64.pack(END64_SIG, END64.size - 12, 45, 45, 0, 0, count, count, size, start))
            self._write(LOCATOR64.pack(LOCATOR64_SIG, 0, at, 1))
        short = [MAX16 if self.zip64 else min(count, MAX16)] * 2
        wide = [MAX32 if self.zip64 else min(x, MAX32) for x in (size, start)]
        self._write(END.pack(END_SIG, 0, 0, *short, *wide, 0))


def read_at(f, at: int, size: int) -> bytes:
    f.seek(at)
    data = f.read(size)
    if len(data) < size:
        raise BadPackage(f"package ends before byte {at + size}")
    return data


def directory_range(f, length: int) -> tuple[int, int, int]:
    """(offset, size, members) of the central directory."""
    tail_at = max(0, length - END.size - MAX16)
    tail = read_at(f, tail_at, length - tail_at)
    found = len(tail)
    while True:
        found = tail.rfind(END_SIG, 0, found)
        if found < 0:
            raise BadPackage("no end-of-central-directory record")
        if found + END.size <= len(tail):
            end = END.unpack_from(tail, found)
            if found + END.size + end[7] == len(tail):  # the comment reaches the end of the file
                break
    count, size, start = end[4], end[5], end[6]
    locator_at = tail_at + found - LOCATOR64.size
    if locator_at >= 0:
        locator = LOCATOR64.unpack(read_at(f, locator_at, LOCATOR64.size))
        if locator[0] == LOCATOR64_SIG:
            end64 = END64.unpack(read_at(f, locator[2], END64.size))
            if end64[0] != END64_SIG:
                raise BadPackage("the ZIP64 locator points at no ZIP64 record")
            count, size, start = end64[7], end64[8], end64[9]
    return start, size, count


def members(f, length: int) -> list[Member]:
    """The members that the central directory lists."""
    start, size, count = directory_range(f, length)
    data, at, out = read_at(f, start, size), 0, []
    for _ in range(count):
        e = CENTRAL.unpack_from(data, at)
        if e[0] != CENTRAL_SIG:
            raise BadPackage("bad central directory entry")
        at += CENTRAL.size
        name = data[at:at + e[10]].decode()
        extra = data[at + e[10]:at + e[10] + e[11]]
        packed, plain, header_at = e[8], e[9], e[16]
        x = 0
        while x + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, x)
            if kind == ZIP64_EXTRA:  # holds, in this order, only the fields that are at their maximum
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, x + 4))
                plain = next(wide) if plain == MAX32 else plain
                packed = next(wide) if packed == MAX32 else packed
                header_at = next(wide) if header_at == MAX32 else header_at
            x += 4 + n
        if e[4] == 0 and packed != plain:
            raise BadPackage(f"stored member {name} has two sizes")
        out.append(Member(name, e[4], e[7], plain, header_at))
        at += e[10] + e[11] + e[12]
    return out


def data_range(f, member: Member) -> tuple[int, int]:
    """(offset, size) of a stored member's bytes in the package."""
    if member.method:
        raise BadPackage(f"{member.name} is compressed (method {member.method}); only stored members can be range-read")
    head = LOCAL.unpack(read_at(f, member.header_at, LOCAL.size))
    if head[0] != LOCAL_SIG:
        raise BadPackage(f"no local header for {member.name}")
    return member.header_at + LOCAL.size + head[9] + head[10], member.size
