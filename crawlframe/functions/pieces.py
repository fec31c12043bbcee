"""Arrow batches cut by bytes, for tasks whose Python objects are many times the input."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

from crawlframe.sources.shipping import ship

#: Bytes of text or blobs whose objects a task holds at a time.
PIECE_BYTES = 1 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a column of text or bytes takes ``most`` bytes in each, or is one row."""
    for batch in batches:
        begin = total = 0
        for at, size in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if at > begin and total + size > most:
                yield batch.slice(begin, at - begin)
                begin, total = at, 0
            total += size
        yield batch.slice(begin)


ship(__name__)
