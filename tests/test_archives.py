from __future__ import annotations

import base64
import gzip
import json
import zlib

from pyspark.sql import functions as F

from crawlframe.operators import records as R
from crawlframe.plans.audit import audit_archives, audit_pending
from crawlframe.profile import DELETED_TEXT
from crawlframe.sources import archives as A
from workload import record_queries

VIEW = "https://www.gallery.example/view/12/"


def record(kind, block, uri=None):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{kind}>\r\nContent-Type: text/{kind}\r\n"
    head += f"WARC-Target-URI: {uri}\r\n" if uri else ""
    return f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def response(html, extra=b""):
    return b"HTTP/1.1 200 OK\r\n" + extra + b"\r\n" + html


INFO = record("warcinfo", b"gallery_scrape_attempt_id: 5\r\nx: WARC/1.0\r\n\r\n")
IMAGE = record("response", response(b"WARC/1.0\r\n\r\n"), "https://d.gallery.example/a.gif")


def archive(html, extra=b"", uri=VIEW):
    return INFO + IMAGE + record("response", response(html, extra), uri)


def files(spark, **contents):
    return spark.createDataFrame(
        [(name, bytearray(data)) for name, data in contents.items()], "path string, content binary"
    )


def test_plain_and_gzip_archives_read_alike(spark):
    plain = archive(b"<p>hi")
    members = gzip.compress(INFO) + gzip.compress(IMAGE) + gzip.compress(plain[len(INFO + IMAGE):])
    parsed = A.with_records(files(spark, plain=plain, packed=members), ("response",), VIEW[:30])
    rows = {r.path: r for r in parsed.collect()}
    assert rows["plain"].records == rows["packed"].records
    assert [r.position for r in rows["plain"].records] == [0, len(INFO), len(INFO + IMAGE)]
    assert [r.warc_type for r in rows["plain"].records] == ["warcinfo", "response", "response"]
    blocks = [r.block for r in rows["plain"].records]
    assert blocks[:2] == [None, None] and bytes(blocks[2]) == response(b"<p>hi")
    assert rows["plain"].sha512 != rows["packed"].sha512


def test_damaged_archives_keep_what_can_be_read(spark):
    plain = archive(b"<p>hi")
    packed = gzip.compress(plain)
    flipped = packed[:12] + bytes(255 - b for b in packed[12:40]) + packed[40:]
    parsed = A.with_records(
        files(spark, cut=plain[:-20], junk=b"not a warc", empty=b"", tail=INFO + b"junk",
              badgzip=b"\x1f\x8bxx", flipped=flipped)
    )
    rows = {r.path: (len(r.records), r.error) for r in parsed.collect()}
    assert rows["cut"][0] == 2 and "cut off" in rows["cut"][1]
    assert rows["junk"][0] == 0 and "byte 0" in rows["junk"][1]
    assert rows["empty"] == (0, None)
    assert rows["tail"][0] == 1 and rows["tail"][1] is not None
    assert rows["flipped"][0] == 0 and rows["flipped"][1] is not None
    assert rows["badgzip"][0] == 0 and rows["badgzip"][1] is not None
    assert A.warc_records(parsed).count() == 3


def test_verdicts(spark):
    deleted = f'<div class="section-body"> {DELETED_TEXT} </div>'.encode()
    chunked = b"3\r\n<p>\r\nA;x=1\r\n0123456789\r\n0\r\n\r\n"
    table = files(
        spark,
        present=archive(b"<p>item"),
        deleted=archive(deleted),
        zipped=archive(gzip.compress(deleted), b"Content-Encoding: gzip\r\n"),
        deflated=archive(zlib.compress(deleted), b"content-encoding: deflate\r\n"),
        chunked=archive(chunked, b"Transfer-Encoding: chunked\r\n"),
        broken=archive(b"zz", b"Content-Encoding: gzip\r\n"),
        other=archive(b"<p>item", uri="http://www.gallery.example/view/12/"),
        nothing=b"",
        wall=archive(b"<title>Just a moment</title>"),
        away=archive(b"We are down for maintenance"),
        latin=archive(b"<p>\xff"),
    )
    rows = R.hole_verdict(table, cloudflare="Just a moment", maintenance="down for").collect()
    assert {r.path: r.submission_status for r in rows} == {
        "present": "present", "deleted": "deleted", "zipped": "deleted", "deflated": "deleted",
        "chunked": "present", "broken": "unknown", "other": "unknown", "nothing": "unknown",
        "wall": "cloudflare", "away": "maintenance", "latin": "present",
    }
    default = {r.path: r.submission_status for r in R.hole_verdict(table).collect()}
    assert default["wall"] == default["away"] == "present"


def test_http_body(spark):
    blocks = [response(b"<p>"), response(gzip.compress(b"z"), b"Content-Encoding: gzip\r\n"),
              response(b"zz", b"Content-Encoding: gzip\r\n"), None]
    table = spark.createDataFrame([(b and bytearray(b),) for b in blocks], "block binary")
    bodies = [r[0] and bytes(r[0]) for r in table.select(A.http_body(F.col("block"))).collect()]
    assert bodies == [b"<p>", b"z", None, None]


def test_audit_from_a_folder(spark, tmp_path):
    (tmp_path / "abc").mkdir()
    (tmp_path / "abc" / "one.warc").write_bytes(archive(b"<p>"))
    (tmp_path / "_two.warc").write_bytes(b"")
    root = spark.createDataFrame([(str(tmp_path),)], "root string")
    listed = A.list_files(root)
    names = {str(tmp_path / "abc" / "one.warc"), str(tmp_path / "_two.warc")}
    assert {r.file_path for r in A.dir_manifest(listed, 9).collect()} == names
    rows = audit_archives(A.read_listed_files(listed, 2), 9).collect()
    assert {(r.file_path, r.submission_status) for r in rows} == {
        (str(tmp_path / "abc" / "one.warc"), "present"), (str(tmp_path / "_two.warc"), "unknown")
    }
    assert all(len(r.warc_sha512) == 128 and r.run_id == 9 for r in rows)
    # A run that was stopped goes on with what its manifest still has to do.
    one_done = F.when(F.col("file_path").endswith("one.warc"), "finished").otherwise("todo")
    manifest = A.dir_manifest(listed, 9).withColumn("processed_status", one_done)
    left = audit_pending(manifest.unionByName(A.dir_manifest(listed, 8)), 9, 2).collect()
    assert left == [r for r in rows if r.file_path.endswith("_two.warc")]


def test_folders_and_uris(spark, tmp_path):
    for name in ("abc/x", "00f/y", "zzz/no"):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text(name)
    folders = [(f"file://{tmp_path}/{name}",) for name in ("abc", "00f", "none")]
    listed = A.list_files(spark.createDataFrame(folders, "root string"))
    rows = A.dir_manifest(listed, 1).collect()
    assert {r.file_path for r in rows} == {str(tmp_path / "abc/x"), str(tmp_path / "00f/y")}
    assert {bytes(r.content) for r in A.read_listed_files(listed, 2).collect()} == {b"abc/x", b"00f/y"}


def test_walk_finds_every_file(spark, tmp_path):
    names = ["flat.warc", "abc/x", "zzz/yes", "a/b/c/d/deep", "_odd/.name", "abc/empty"]
    for name in names:
        (tmp_path / "tree" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "tree" / name).write_text("" if "empty" in name else name)
    (tmp_path / "tree" / "bare" / "folder").mkdir(parents=True)
    for root in (f"{tmp_path}/tree", f"file://{tmp_path}/tree"):
        rows = A.dir_manifest(A.walk_tree(spark, root), 1).collect()
        assert {r.file_path for r in rows} == {f"{tmp_path}/tree/{name}" for name in names}
        assert len(rows) == len(names)


def test_first_record(spark):
    rows = spark.createDataFrame(
        [("f", 30, "b"), ("f", 10, "a"), ("f", 20, "b"), ("g", 5, "a"), ("h", 1, None)],
        "path string, position long, warc_type string",
    )
    first = R.first_record_where(rows, F.col("warc_type") == "b")
    assert {r.path: r.position for r in first.collect()} == {"f": 20, "g": None, "h": None}


def test_record_index(spark):
    lines = ['[12,"<i>","response",null,"http://x"]', "[0,\"<j>\",\"warcinfo\"]", "junk", '["x"]']
    table = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = [tuple(r) for r in A.record_index_jsonl(table).collect()]
    assert rows == [
        (12, "<i>", "response", None, "http://x"), (0, "<j>", "warcinfo", None, None),
        (None,) * 5, (None,) * 5,
    ]


def test_record_block_is_one_row_in_line_order(spark):
    chunks = [bytes([65 + i]) * 3 for i in range(10)]
    lines = [(1, 0, json.dumps({"ExtractMetadata": {"x": 1}}))] + [
        (1, i + 1, json.dumps({"BlockChunk": {"data": base64.b64encode(c).decode()}}))
        for i, c in enumerate(chunks)
    ]
    table = spark.createDataFrame(lines[::-1], "rec long, line_no long, value string").repartition(3)
    whole = A.record_block(table, "rec", "line_no").collect()
    assert len(whole) == 1 and bytes(whole[0].block) == b"".join(chunks)
    assert A.record_block(table, "rec", "line_no", lines_per_segment=4).collect() == whole


def test_blocks_of_empty_and_long_texts(spark, tmp_path):
    """An empty text is an empty block, and a long one is cut in memory that grows with its length alone."""
    texts = {1: "", 2: "\u00e9" * 1000, 3: "0123456789" * 300_000, 4: "a" * 1000}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    blocks = record_queries.block(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.block for r in blocks} == texts


def test_long_record_is_one_row(spark):
    line = F.to_json(F.struct(F.struct(F.base64(F.lit(b"ab")).alias("data")).alias("BlockChunk")))
    lines = spark.range(20_000).select(F.lit(1).alias("rec"), F.col("id").alias("line_no"), line.alias("value"))
    rows = A.record_block(lines, "rec", "line_no").select(F.octet_length("block")).collect()
    assert [r[0] for r in rows] == [40_000]
