"""Tasks that hold many objects per byte hand back their rows in pieces."""

from __future__ import annotations

import pyarrow as pa
import pytest

from crawlframe.functions.pieces import pieces
from crawlframe.operators.pages import with_elements
from crawlframe.sources.archives import with_records

PAGE = b"<html><body>" + b"<p><a href='/user/a'>A</a></p>" * 400 + b"</body></html>"


class Held:
    """Stands for a DataFrame: what ``mapInArrow`` would run is run on one batch."""

    def __init__(self, batch):
        self.batch = batch
        self.schema = {"page_id": type("Field", (), {"dataType": type("Kind", (), {"simpleString": lambda self: "bigint"})()})}

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        return list(function(iter([self.batch])))


def test_pieces_lose_no_row():
    blobs = [b"a" * 5, None, b"", b"b" * 12, b"c" * 3, b"d" * 4, None]
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "blob": pa.array(blobs, pa.binary())})
    cut = list(pieces(iter([batch, batch.slice(0, 0)]), 1, 8))
    assert [one.column(0).to_pylist() for one in cut] == [[0, 1, 2], [3], [4, 5, 6], []]
    assert [blob for one in cut for blob in one.column(1).to_pylist()] == blobs


def test_elements_go_back_in_pieces():
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(500)), "html": [PAGE.decode()] * 499 + [None]})
    found = with_elements(Held(batch), {"user": "a"})
    assert len(found) > 4 and max(one.num_rows for one in found) < 200
    rows = [row for one in found for row in one.to_pylist()]
    assert [row["page_id"] for row in rows] == list(range(500))
    assert [len(row["elements"] or ()) for row in rows] == [400] * 499 + [0]


@pytest.mark.parametrize("n", [1, 300])
def test_parsed_archives_go_back_in_pieces(n):
    record = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(PAGE), PAGE)
    batch = pa.RecordBatch.from_pydict({"path": [f"/{k}" for k in range(n)], "content": [record] * n})
    found = with_records(Held(batch), ("warcinfo",))
    assert max(one.nbytes for one in found) < 3 << 20
    rows = [row for one in found for row in one.to_pylist()]
    assert [(row["path"], row["records"][0]["block"]) for row in rows] == [(f"/{k}", PAGE) for k in range(n)]
