"""Codec calls on one blob (run inside Python tasks)."""

from __future__ import annotations

import io
import lzma
import tarfile
import zlib

from crawlframe.profile import ARCHIVED_PAGE_NAME
from crawlframe.sources.shipping import ship

# The window of xz's preset 6, and the shortest one worth setting up.
_XZ_WINDOW, _XZ_LEAST = 1 << 23, 1 << 16


def load_zstandard():
    """The optional ``zstandard`` package, or None."""
    try:
        import zstandard
    except ImportError:
        return None
    return zstandard


def to_xz(body: bytes) -> bytes:
    """The bytes under xz's preset 6, with a window no longer than they need.

    The preset's own window of 8 MB has tables of 80 MB set up for every call,
    which costs a short page far more than its compression.  A match never
    reaches back before the first byte, so the result is as long either way.
    """
    window = min(_XZ_WINDOW, max(_XZ_LEAST, 1 << max(len(body) - 1, 1).bit_length()))
    lzma2 = {"id": lzma.FILTER_LZMA2, "preset": 6, "dict_size": window}
    return lzma.compress(body, filters=[lzma2])


def to_tar_xz(body: bytes) -> bytes:
    out = io.BytesIO()
    with tarfile.open(mode="w", fileobj=out) as tar:
        member = tarfile.TarInfo(ARCHIVED_PAGE_NAME)
        member.size = len(body)
        tar.addfile(member, io.BytesIO(body))
    return to_xz(out.getvalue())


def from_tar_xz(archive: bytes) -> bytes:
    with tarfile.open(mode="r:xz", fileobj=io.BytesIO(archive)) as tar:
        return tar.extractfile(ARCHIVED_PAGE_NAME).read()


def stored_sizes(body: bytes, level: int, zstd) -> list[int | None]:
    """Size as it is, under zlib, xz and (with a compressor) zstandard."""
    return [
        len(body),
        len(zlib.compress(body, level)),
        len(to_xz(body)),
        len(zstd.compress(body)) if zstd else None,
    ]


def train_dictionary(samples: list[bytes], dict_bytes: int, k: int, d: int, level: int):
    """Bytes of a dictionary, or None without ``zstandard`` or enough samples."""
    zstandard = load_zstandard()
    if zstandard is None:
        return None
    try:
        return zstandard.train_dictionary(dict_bytes, samples, k=k, d=d, level=level).as_bytes()
    except zstandard.ZstdError:
        return None


ship(__name__)
