"""Cut one archive's bytes into WARC records (runs inside Python tasks)."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

from crawlframe.sources.shipping import ship

# What damaged bytes can raise here.
DAMAGE = (ValueError, OSError, EOFError, zlib.error)


def plain_bytes(content: bytes) -> bytes:
    """The archive itself; gzip members are unpacked and joined."""
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def iter_records(content: bytes) -> Iterator[tuple[int, dict[str, str], int, int]]:
    """Yield ``(position, headers, body start, body length)`` per record.

    Header names come in lower case.  Raises ``ValueError`` where the bytes
    stop being WARC, after the records before that point.
    """
    at, end = 0, len(content)
    while True:
        while content[at : at + 2] == b"\r\n":
            at += 2
        if at >= end:
            return
        head_end = content.find(b"\r\n\r\n", at)
        if not content.startswith(b"WARC/", at) or head_end < 0:
            raise ValueError(f"no record at byte {at}")
        headers: dict[str, str] = {}
        for line in content[at:head_end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, colon, value = line.partition(":")
            if colon:
                headers[name.strip().lower()] = value.strip()
        if not headers.get("content-length", "").isdigit():
            raise ValueError(f"no content length at byte {at}")
        start, length = head_end + 4, int(headers["content-length"])
        if start + length > end:
            raise ValueError(f"record cut off at byte {at}")
        yield at, headers, start, length
        at = start + length


def response_payload(block: bytes) -> bytes:
    """Payload of an HTTP response block, de-chunked and decompressed."""
    head, _, body = block.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode("latin-1").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip().lower()
    if headers.get("transfer-encoding") == "chunked":
        body = _join_chunks(body)
    coding = headers.get("content-encoding")
    if coding in ("gzip", "x-gzip"):
        return gzip.decompress(body)
    if coding == "deflate":
        try:
            return zlib.decompress(body)
        except zlib.error:
            return zlib.decompress(body, -zlib.MAX_WBITS)
    return body


def payload_or_none(block: bytes) -> bytes | None:
    try:
        return response_payload(block)
    except DAMAGE:
        return None


def _join_chunks(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        line_end = body.index(b"\r\n", at)
        size = int(body[at:line_end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        parts.append(body[line_end + 2 : line_end + 2 + size])
        at = line_end + 2 + size + 2


ship(__name__)
