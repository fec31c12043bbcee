"""Archives as a data source, their index, and records by byte range."""

from __future__ import annotations

import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from crawlframe.operators import records as R
from crawlframe.plans.audit import audit_pending
from crawlframe.profile import DELETED_TEXT, SiteProfile
from crawlframe.sources import archives as A
from crawlframe.sources import warc_source as W
from crawlframe.sources.warc_format import iter_records, plain_bytes
from crawlframe.sources.warc_stream import PIECE, StoredArchive, record_at
from tests.conftest import explained

PROFILE = SiteProfile()
ITEM = f"https://www.{PROFILE.domain}/view/7/"


def record(kind: str, body: bytes, uri: str | None = None) -> bytes:
    target = f"WARC-Target-URI: {uri}\r\n" if uri else ""
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{target}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def page(html: bytes, uri: str = ITEM) -> bytes:
    return record("response", b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + html, uri)


def forms(parts: list[bytes]) -> dict[str, bytes]:
    """An archive as it is, with a gzip member per record, in one member, in two."""
    return {
        "plain": b"".join(parts),
        "members": b"".join(map(gzip.compress, parts)),
        "one": gzip.compress(b"".join(parts)),
        "two": gzip.compress(b"".join(parts[:2])) + gzip.compress(b"".join(parts[2:])),
    }


def test_stream_equals_the_whole_read():
    rng = random.Random(4)
    for _ in range(12):
        parts = [record(rng.choice(["warcinfo", "request", "response"]), rng.randbytes(rng.choice([0, 1, 300, PIECE - 1, PIECE + 5, 700_000]))) for _ in range(rng.randint(2, 6))]
        for stored in forms(parts).values():
            data = plain_bytes(stored)
            wanted = [(at, headers, data[start : start + length]) for at, headers, start, length in iter_records(data)]
            archive, found = StoredArchive(io.BytesIO(stored).read), []
            for place, headers in archive.records():
                body = b"".join(archive.body(rng.choice([1000, PIECE])))
                found.append((place.position, headers, body))
                assert record_at(io.BytesIO(stored), place.offset, place.skip, place.stored_length) == body
            assert found == wanted


def test_places_without_reading_bodies():
    parts = [record("warcinfo", b"x" * 900_000), record("response", b"y" * 10)]
    for form, stored in forms(parts).items():
        places = [place for place, _ in StoredArchive(io.BytesIO(stored).read).records()]
        assert [place.position for place in places] == [0, len(parts[0])]
        assert record_at(io.BytesIO(stored), places[1].offset, places[1].skip, places[1].stored_length) == b"y" * 10
        if form in ("plain", "members"):
            assert all(place.skip == 0 for place in places)


@pytest.mark.parametrize(
    "stored, n, message",
    [
        (record("warcinfo", b"ok") + b"junk here", 1, "no record at byte"),
        (record("warcinfo", b"ok") + record("response", b"x" * 50)[:-30], 1, "record cut off at byte"),
        (record("warcinfo", b"ok") + b"WARC/1.1\r\nWARC-Type: x\r\n\r\n", 1, "no content length"),
        (gzip.compress(record("warcinfo", b"ok")) + gzip.compress(record("response", os.urandom(5000)))[:-900], 1, ""),
        (b"", 0, None),
        (b"\x1f\x8b", 0, "gzip"),
        (b"x" * (3 << 20), 0, "no record at byte 0"),
    ],
)
def test_damage(spark, tmp_path, stored, n, message):
    (tmp_path / "a.warc").write_bytes(stored)
    rows = W.read_archives(spark, str(tmp_path)).collect()
    assert len([row for row in rows if row.error is None]) == n
    errors = [row.error for row in rows if row.error is not None]
    assert len(errors) == (message is not None) and all(message in error for error in errors)
    index = W.archive_index(spark.createDataFrame([(str(tmp_path / "a.warc"),)], "path string"), 1).first()
    assert (len(index.records), index.n_bytes) == (n, len(stored)) and (index.error is None) == (message is None)


@pytest.fixture
def folder(tmp_path):
    shown = b'<html><body id="pageid-item"><div class="section-body">x</div></body></html>'
    deleted = f'<html><body><div class="section-body"> {DELETED_TEXT} </div></body></html>'.encode()
    noise = [record("metadata", os.urandom(200_000)) for _ in range(4)]
    for name, html in (("shown", shown), ("gone", deleted)):
        for form, stored in forms([record("warcinfo", b"a: b"), *noise, page(html), page(b"later")]).items():
            (tmp_path / name).mkdir(exist_ok=True)
            (tmp_path / name / f"{form}.warc").write_bytes(stored)
    (tmp_path / "none.warc").write_bytes(record("warcinfo", b"a: b"))
    (tmp_path / "_empty.warc").write_bytes(b"")
    return tmp_path


def files(spark, folder):
    return A.read_listed_files(A.walk_tree(spark, str(folder)), 2)


def test_source_equals_the_whole_read(spark, folder):
    rows = W.read_archives(spark, str(folder)).select("path", "position", "warc_type", "warc_target_uri", "block").collect()
    parsed = A.with_records(files(spark, folder), ("warcinfo", "response", "metadata"))
    wanted = A.warc_records(parsed).select("path", "position", "warc_type", "warc_target_uri", "block").collect()
    assert sorted(rows) == sorted(wanted) and len(rows) == 8 * 7 + 1
    for depth in ("0", "1"):
        assert sorted(W.read_archives(spark, str(folder), depth=depth).select("path", "position").collect()) == sorted((r.path, r.position) for r in wanted)


def test_filters_reach_the_reader(spark, folder):
    rows = W.read_archives(spark, str(folder), "path string, warc_type string, warc_target_uri string, block binary")
    main = rows.filter((F.col("warc_type") == "response") & F.col("warc_target_uri").startswith(ITEM))
    assert main.count() == 16
    plan = explained(main)
    assert "PushedFilters" in plan and "warc_type" in plan.split("PushedFilters")[1] and "response" in plan.split("PushedFilters")[1].split("]")[0]
    assert rows.filter(F.col("warc_type").isin("warcinfo", "request")).count() == 9
    assert rows.filter(F.col("warc_target_uri").isNull()).count() == 8 * 5 + 1


def test_long_records_come_in_chunks(spark, tmp_path):
    body = os.urandom(1_000_000)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record("response", body)) + gzip.compress(record("request", b"")))
    rows = W.read_archives(spark, str(tmp_path), chunkBytes="300000").orderBy("position", "chunk").collect()
    assert [(row.warc_type, row.chunk, len(row.block)) for row in rows] == [("response", 0, 300_000), ("response", 1, 300_000), ("response", 2, 300_000), ("response", 3, 100_000), ("request", 0, 0)]
    assert b"".join(bytes(row.block) for row in rows) == body
    narrow = W.read_archives(spark, str(tmp_path), "warc_type string, stored_length long").collect()
    assert len(narrow) == 2 and narrow[0].stored_length > 1_000_000


def test_verdicts_by_ranges_read_little(spark, folder):
    index = W.archive_index(A.walk_tree(spark, str(folder)), 2).cache()
    rows = {row.path: row for row in R.indexed_verdict(index, PROFILE).collect()}
    whole = {row.path: row for row in R.hole_verdict(files(spark, folder), PROFILE).collect()}
    assert {path: (row.sha512, row.submission_status) for path, row in rows.items()} == {path: (row.sha512, row.submission_status) for path, row in whole.items()}
    assert {row.submission_status for row in rows.values()} == {"present", "deleted", "unknown"}
    for path, row in rows.items():
        size, name = os.path.getsize(path), os.path.basename(path)
        if name in ("plain.warc", "members.warc"):
            assert 0 < row.n_read < 1000 < 700_000 < size
        if name in ("none.warc", "_empty.warc"):
            assert row.n_read == 0
    pattern = R.indexed_verdict(index, PROFILE, cloudflare="(?s)pageid-item").groupBy("submission_status").count().collect()
    assert dict(pattern) == {"cloudflare": 4, "deleted": 4, "unknown": 2}
    index.unpersist()


def test_verdicts_cross_to_python_once(spark, folder):
    for rows in (R.hole_verdict(files(spark, folder), PROFILE),):
        plan = explained(rows)
        assert "ArrowEvalPython" not in plan
    index = spark.createDataFrame([], f"path string, records array<struct<{W.ENTRY}>>, error string, sha512 string, n_bytes long")
    plan = explained(R.indexed_verdict(index, PROFILE, maintenance="x"))
    assert plan.split("(1)")[0].count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_pending_archives_only(spark, folder):
    manifest = A.dir_manifest(A.walk_tree(spark, str(folder)), 3)
    done = F.when(F.col("file_path").contains("/gone/"), "finished").otherwise("todo")
    rows = audit_pending(manifest.withColumn("processed_status", done), 3, 2, PROFILE).collect()
    assert sorted(row.submission_status for row in rows) == ["present"] * 4 + ["unknown"] * 2
    assert all(len(row.warc_sha512) == 128 for row in rows)


def test_bodies_of_chosen_records(spark, folder):
    index = W.archive_index(A.walk_tree(spark, str(folder)), 2)
    chosen = index.select("path", F.explode("records").alias("record")).filter("record.warc_type = 'warcinfo'")
    rows = W.record_bodies(chosen).collect()
    assert len(rows) == 9 and {bytes(row.block) for row in rows} == {b"a: b"}
    missing = spark.createDataFrame([(str(folder / "none.warc"), None)], f"path string, record struct<{W.ENTRY}>")
    assert [(row.block, row.n_read) for row in W.record_bodies(missing).collect()] == [(None, 0)]
