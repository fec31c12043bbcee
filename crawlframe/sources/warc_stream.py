"""Read one stored archive piece by piece, and records of it by byte range (runs inside Python tasks).

Memory is bounded by a record's header and one piece of its body, whatever
the size of the archive and of its records.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from crawlframe.sources.shipping import ship

PIECE, LARGEST_HEAD = 1 << 18, 1 << 20
GZIP = b"\x1f\x8b"


@dataclass
class Place:
    """Where a record is: ``position`` in the unpacked archive; in the stored one ``offset`` and, from there, ``stored_length``.

    ``skip`` unpacked bytes lie between ``offset``, the begin of a gzip
    member, and the record; it is 0 where each record has a member of its own.
    """

    position: int
    length: int
    offset: int
    skip: int
    stored_length: int = 0


class StoredArchive:
    """Records of an archive that ``read(n)`` yields, plain or as gzip members."""

    def __init__(self, read: Callable[[int], bytes], digest=None):
        self._read, self._digest = read, digest
        self._data, self._at = bytearray(), 0
        self._members: deque[tuple[int, int]] = deque([(0, 0)])
        self._marks: deque[tuple[int, int]] = deque()
        self._packed, self._left = False, 0
        self._pieces = self._unpacked()

    def _stored(self) -> bytes:
        piece = self._read(PIECE)
        if self._digest is not None:
            self._digest.update(piece)
        return piece

    def _unpacked(self) -> Iterator[tuple[bytes, int]]:
        """Pieces with the number of stored bytes that they and all before them took."""
        piece, taken, made = self._stored(), 0, 0
        if piece[:2] != GZIP:
            while piece:
                taken += len(piece)
                yield piece, taken
                piece = self._stored()
            return
        self._packed = True
        while piece:
            self._members.append((made, taken))
            member = zlib.decompressobj(zlib.MAX_WBITS | 16)
            while not member.eof:
                piece = piece or self._stored()
                if not piece:
                    out = member.flush()
                    if not out and not member.eof:
                        raise EOFError("gzip member cut off")
                else:
                    out = member.decompress(piece, PIECE)
                    rest = member.unused_data if member.eof else member.unconsumed_tail
                    taken += len(piece) - len(rest)
                    piece = rest
                if out:
                    made += len(out)
                    yield out, taken
            piece = piece or self._stored()

    def _fill(self, size: int) -> bool:
        """Hold ``size`` bytes; false where the archive ends before."""
        while len(self._data) < size:
            piece, taken = next(self._pieces, (b"", 0))
            if not piece:
                return False
            self._data += piece
            self._marks.append((self._at + len(self._data), taken))
        return True

    def _drop(self, size: int) -> None:
        del self._data[:size]
        self._at += size

    def records(self) -> Iterator[tuple[Place, dict[str, str]]]:
        """Place and headers (names in lower case) of each record, in file order.

        Between two steps :meth:`body` gives the body; what is left of it is
        passed over.  ``stored_length`` is known once the body is at its end.
        """
        while True:
            while self._fill(2) and self._data[:2] == b"\r\n":
                self._drop(2)
            if not self._fill(1):
                return
            at = self._at
            while len(self._members) > 1 and self._members[1][0] <= at:
                self._members.popleft()
            while self._marks and self._marks[0][0] <= at:
                self._marks.popleft()
            begin, offset = self._members[0] if self._packed else (at, at)
            head = self._head(at)
            headers: dict[str, str] = {}
            for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
                name, colon, value = line.partition(":")
                if colon:
                    headers[name.strip().lower()] = value.strip()
            if not headers.get("content-length", "").isdigit():
                raise ValueError(f"no content length at byte {at}")
            self._drop(len(head) + 4)
            self._left = int(headers["content-length"])
            self._place = Place(at, len(head) + 4 + self._left, offset, at - begin)
            yield self._place, headers
            for _ in self.body():
                pass

    def _head(self, at: int) -> bytes:
        size, found = 256, -1
        while found < 0:
            more = self._fill(size)
            found = self._data.find(b"\r\n\r\n", 0, LARGEST_HEAD)
            if found < 0 and (not more or size >= LARGEST_HEAD):
                break
            size *= 2
        if found < 0 or not self._data.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        return bytes(self._data[:found])

    def body(self, most: int = PIECE) -> Iterator[bytes]:
        """What is left of the body, in pieces of ``most`` bytes."""
        while self._left:
            size = min(most, self._left)
            if not self._fill(size):
                raise ValueError(f"record cut off at byte {self._place.position}")
            piece = bytes(self._data[:size])
            self._drop(size)
            self._left -= size
            yield piece
        end = self._place.position + self._place.length
        if self._packed:
            stop = next((taken for made, taken in self._marks if made >= end), self._place.offset)
            self._place.stored_length = stop - self._place.offset
        else:
            self._place.stored_length = self._place.length


def record_at(source, offset: int, skip: int, stored_length: int) -> bytes:
    """The body of the record in a range of an opened file, the only bytes read."""
    source.seek(offset)
    left = stored_length

    def read(size: int) -> bytes:
        nonlocal left
        piece = source.read(min(size, left))
        left -= len(piece)
        return piece

    archive = StoredArchive(read)
    if skip and not archive._fill(skip):
        raise ValueError(f"no record at stored byte {offset}")
    archive._drop(skip)
    for _ in archive.records():
        return b"".join(archive.body())
    raise ValueError(f"no record at stored byte {offset}")


ship(__name__)
