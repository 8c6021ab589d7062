"""Block-compressed files (BGZF: BAM, and text packed by bgzip), read and written in ranges.

Such a file is a row of gzip members of up to 64 KB, each of which says in its header how long it is. A range of bytes takes the members that
start in it. Places within are virtual offsets: the member's place in the file in the upper bits, the byte within it in the lower 16.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

#: How a member starts, and the empty one at the end of a file.
MAGIC = b"\x1f\x8b\x08\x04"
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Bytes that a member holds when written, and bytes read at once to find one.
FULL, WINDOW = 65_280, 1 << 17


def member_size(head: bytes) -> int | None:
    """Bytes of the member that starts with these, if they are a member's start."""
    if len(head) < 18 or head[:4] != MAGIC:
        return None
    extra = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]]
    while len(extra) >= 4:
        name, n = extra[:2], struct.unpack_from("<H", extra, 2)[0]
        if name == b"BC" and n == 2 and len(extra) >= 6:
            return struct.unpack_from("<H", extra, 4)[0] + 1
        extra = extra[4 + n :]
    return None


class Bgzf:
    """A file of members, f being seekable. read() goes on over members; tell() is the virtual offset of the next byte."""

    def __init__(self, f, size: int):
        self.f, self.size = f, size
        self.member, self.next, self.data, self.at = 0, 0, b"", 0

    def raw(self, place: int, n: int) -> bytes:
        self.f.seek(place)
        return self.f.read(n)

    def load(self, place: int) -> bool:
        """Make the member at a place the current one; False at the end of the file."""
        head = self.raw(place, WINDOW) if place < self.size else b""
        if not head:
            self.member, self.next, self.data, self.at = self.size, self.size, b"", 0
            return False
        if (n := member_size(head)) is None or len(head) < n:
            raise ValueError(f"byte {place}: not a whole member")
        start = 12 + struct.unpack_from("<H", head, 10)[0]
        self.member, self.next, self.at = place, place + n, 0
        self.data = zlib.decompress(head[start : n - 8], -15)
        if zlib.crc32(self.data) != struct.unpack_from("<I", head, n - 8)[0]:
            raise ValueError(f"byte {place}: a member's checksum is wrong")
        return True

    def find(self, place: int) -> int | None:
        """The first member at or after a place: what looks like one, holds what its checksum says, and ends the file or before another."""
        while place < self.size:
            some = self.raw(place, WINDOW)
            k = some.find(MAGIC)
            while k >= 0:
                head = some[k : k + 64]
                if (n := member_size(head)) is not None and (place + k + n == self.size or member_size(self.raw(place + k + n, 64)) is not None):
                    try:
                        self.load(place + k)
                        return place + k
                    except (ValueError, zlib.error):
                        pass
                k = some.find(MAGIC, k + 1)
            place += max(1, len(some) - 63)
        return None

    def filled(self) -> bool:
        """Go to the next member that holds anything, if all of this one is read."""
        while self.at >= len(self.data):
            if not self.load(self.next):
                return False
        return True

    def tell(self) -> int:
        return (self.member << 16) + self.at if self.filled() else self.size << 16

    def seek(self, virtual: int) -> None:
        self.load(virtual >> 16)
        self.at = virtual & 0xFFFF

    def read(self, n: int) -> bytes:
        if self.at + n <= len(self.data):
            self.at += n
            return self.data[self.at - n : self.at]
        out = []
        while n and self.filled():
            some = self.data[self.at : self.at + n]
            self.at += len(some)
            n -= len(some)
            out.append(some)
        return b"".join(out)

    def lines(self, start: int, end: int) -> Iterator[tuple[int, str]]:
        """(place, line) of the lines whose line feed before them is in a member that starts in [start, end); of the first range, the first
        line too. A place is the virtual offset behind that line feed."""
        if start and ((first := self.find(start)) is None or first >= end):
            return
        if not start:
            self.load(0)
        place, parts = None if start else 0, []
        while self.filled():
            k = self.data.find(b"\n", self.at)
            part = self.data[self.at : k + 1 if k >= 0 else len(self.data)]
            if place is not None:
                parts.append(part)
            elif k < 0 and self.next >= end:
                return
            self.at += len(part)
            if k >= 0:
                if place is not None:
                    yield place, b"".join(parts).decode("utf-8", "replace").rstrip("\r\n")
                    parts = []
                if self.member >= end:
                    return
                place = (self.member << 16) + self.at
        if parts:
            yield place, b"".join(parts).decode("utf-8", "replace").rstrip("\r\n")

    def records(self, start: int, end: int, starts) -> bool:
        """Go to the first record that starts in a member of [start, end). starts(data, k, all): whether one starts at k of the data, which
        is all that there is up to the end of the file, or else a window."""
        place = self.find(start)
        while place is not None and place < end:
            self.load(place)
            after, size = self.next, len(self.data)
            some, whole = [self.data], False
            while sum(map(len, some)) < 1 << 18 and not whole:
                whole = not self.load(self.next)
                some.append(self.data)
            data = b"".join(some)
            for k in range(size):
                if starts(data, k, whole):
                    self.load(place)
                    self.at = k
                    return True
            place = after if after < self.size else None
        return False


def packed(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Members of the bytes given, and the empty one at the end."""
    held = bytearray()

    def member(x: bytes) -> bytes:
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(x) + c.flush()
        return MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(x), len(x))

    for part in parts:
        held += part
        while len(held) >= FULL:
            yield member(bytes(held[:FULL]))
            del held[:FULL]
    if held:
        yield member(bytes(held))
    yield END
