from __future__ import annotations

import hashlib
import lzma
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crawlframe.functions.codecs import from_tar_xz, stored_sizes, to_tar_xz
from crawlframe.operators import content as C
from crawlframe.plans.discovery import webpage_rows
from crawlframe.plans.storage import content_rows
from crawlframe.session import spread_scan
from crawlframe.sources import blobs
from tests.conftest import explained
from workload import content_queries

START = datetime(2024, 1, 1)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("slot_seconds", [1, 60, 1000, 10**6])
def test_page_changes_against_brute_force(spark, seed, slot_seconds):
    rng = random.Random(seed)
    rows = [
        (i, 0 if rng.random() < 0.4 else rng.randrange(1, 9),
         START + timedelta(seconds=rng.randrange(3000)), rng.choice("ab"))
        for i in range(300)
    ]
    visits = spark.createDataFrame(
        rows,
        "submission_webpage_id long, submission_id long, date_visited timestamp,"
        " original_data_sha512 string",
    )
    expected, last = {}, {}
    for key, page, moment, sha in sorted(rows, key=lambda r: (r[2], r[0])):
        before = last.get(page)
        expected[key] = "first" if before is None else "unchanged" if before == sha else "changed"
        last[page] = sha
    found = C.page_changes(visits, slot_seconds=slot_seconds)
    assert {r.submission_webpage_id: r.change for r in found.collect()} == expected
    assert found.count() == len(rows)


def test_pages_pack_and_unpack(spark):
    pages = spark.createDataFrame(
        [(1, bytearray(b"abc")), (2, bytearray(b"")), (3, bytearray(b"abc")), (4, None)],
        "id long, content binary",
    )
    packed = C.compress_and_digest(pages)
    rows = packed.withColumn("back", C.decompress_page(F.col("compressed_data"))).orderBy("id").collect()
    assert [r.back and bytes(r.back) for r in rows] == [b"abc", b"", b"abc", None]
    assert rows[0].original_data_sha512 == hashlib.sha512(b"abc").hexdigest()
    assert rows[0].compressed_data_sha512 == hashlib.sha512(rows[0].compressed_data).hexdigest()
    assert rows[0].compressed_data == rows[2].compressed_data


def test_webpage_rows_are_repeatable(spark):
    pages = spark.createDataFrame([(1, bytearray(b"a\xff")), (2, bytearray(b"b"))],
                                  "submission_id long, content binary")
    now = F.lit("2025-01-01").cast("timestamp")
    first = webpage_rows(pages, now).orderBy("submission_id").collect()
    assert [r.encoding_status for r in first] == ["unicode_decode_error", "decoded_ok"]
    assert first == webpage_rows(pages.repartition(3), now).orderBy("submission_id").collect()


def test_content_rows_from_file_names(spark):
    files = spark.createDataFrame(
        [("/a/abc/crawl_content_cid-1_aid-11.tar.xz", bytearray(b"xy")),
         ("file:/a/crawl_content_sid-5_aid-12.warc", bytearray(b"")),
         ("/a/readme.txt", bytearray(b"z"))],
        "path string, content binary",
    )
    rows = {r.attempt_id: r for r in content_rows(files).collect()}
    assert set(rows) == {11, 12} and rows[11].content_id == 1
    assert rows[11].content_sha512 == hashlib.sha512(b"xy").hexdigest()
    assert rows[12].content_length == 0 and rows[12].content_binary is None


def blob_table(spark):
    return spark.createDataFrame(
        [(1, 11, "abc1", bytearray(b"xx")), (2, 22, "abc2", bytearray(b"")), (3, 33, "def3", None),
         (4, 44, "def4", bytearray(b"yyy"))],
        "content_id long, attempt_id long, content_sha512 string, content_binary binary",
    )


def test_payload_states(spark):
    rows = C.with_payload_state(blob_table(spark)).collect()
    assert [r.payload_state for r in rows] == ["present", "emptied", "extracted", "present"]
    assert C.payload_count(blob_table(spark)).first().n_payloads == 3
    assert C.payload_batch(blob_table(spark)).count() == 3


def test_export_writes_files_and_repeats_harmlessly(spark, tmp_path):
    for _ in range(2):
        receipts = blobs.export_blobs(blob_table(spark), f"file://{tmp_path}").collect()
        assert {(r.content_id, r.n_bytes) for r in receipts} == {(1, 2), (4, 3)}
    files = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.tar.xz"))
    assert files == ["abc/crawl_content_cid-1_aid-11.tar.xz",
                     "def/crawl_content_cid-4_aid-44.tar.xz"]
    assert (tmp_path / files[1]).read_bytes() == b"yyy"


def test_null_out_follows_the_receipts(spark):
    written = spark.createDataFrame([(1,)], "content_id long")
    rows = blobs.null_out_payload(blob_table(spark), written).orderBy("content_id").collect()
    assert [r.content_binary and bytes(r.content_binary) for r in rows] == [None, None, None, b"yyy"]
    assert all(r.content_binary is None for r in blobs.null_out_payload(blob_table(spark)).collect())


def test_blob_table(spark, tmp_path):
    blobs.write_blob_table(blob_table(spark), str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t")).orderBy("content_id").collect()
    assert [(r.content_id, r.sha_folder, bytes(r.content_binary)) for r in rows] == [
        (1, "ab", b"xx"), (4, "de", b"yyy")
    ]


def test_duplicates_and_sizes(spark):
    rows = spark.createDataFrame([(1, "s", 2048, 1024), (2, "s", 0, 0), (3, "t", None, None)],
                                 "id long, sha string, a long, b long")
    assert [tuple(r) for r in C.duplicate_content(rows, "sha", "id").collect()] == [("s", 2, 1)]
    summed = C.size_summary(rows, "sha", F.col("a"), F.col("b")).filter("sha = 's'").first()
    assert (summed.ratio, summed.summary) == (0.5, "2.000 KiB -> 1.000 KiB")


def sample_table(spark, n=600):
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "omega", "<div class=x>", "</div>"]
    rows = [
        (i, "big" if i % 3 else "small", bytearray(" ".join(rng.choices(words, k=80)).encode()))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id long, source string, data binary")


def test_dictionaries_use_every_sample_in_bounded_shards(spark):
    samples = sample_table(spark)
    shards = C.codec_dictionary(samples, "source", "id", "data", 2048, k=200, shard_bytes=40_000)
    rows = shards.collect()
    total = {}
    for r in rows:
        total[r.source] = total.get(r.source, 0) + r.n
    assert total == {"big": 400, "small": 200}
    assert len([r for r in rows if r.source == "big"]) > len([r for r in rows if r.source == "small"]) > 1
    pytest.importorskip("zstandard")
    assert all(r.dictionary for r in rows)
    gain = C.dictionary_profile(samples, shards, "source", "id", "data", shard_bytes=40_000)
    plain = C.compression_profile(samples, "source", "data")
    size = {(r.source, r.codec): r for r in plain.unionByName(gain).collect()}
    assert {codec for _, codec in size} == {"none", "zlib", "lzma", "zstd", "zstd_dict"}
    assert size[("big", "zstd_dict")].n == size[("big", "none")].n == 400
    assert size[("big", "zstd_dict")].stored_bytes < size[("big", "zstd")].stored_bytes
    assert size[("big", "none")].avg_ratio == 1.0


def test_dictionaries_of_the_query_are_whole(spark):
    """They hold up to a megabyte, not the first few segments that fit a small one."""
    pytest.importorskip("zstandard")
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(20_000)]
    rows = [(k, "s" if k % 4 else "t", bytearray(" ".join(rng.choices(words, k=8_000)).encode())) for k in range(80)]
    samples = spark.createDataFrame(rows, "doc_id long, source string, data binary")
    sizes = {r.source: len(r.dictionary) for r in content_queries._dictionaries(samples).collect()}
    assert sizes["s"] == 1024**2 and 500_000 < sizes["t"] <= 1024**2


def test_blobs_without_a_dictionary_count_too(spark):
    few = sample_table(spark, 3)
    trained = C.codec_dictionary(few, "source", "id", "data")
    rows = C.dictionary_profile(few, trained, "source", "id", "data").collect()
    assert {r.source: r.n for r in rows} == {"small": 1, "big": 2}


def test_too_little_data_gives_no_dictionary(spark):
    few = sample_table(spark, 2)
    assert [r.dictionary for r in C.codec_dictionary(few, "source", "id", "data").collect()] == [None, None]


def test_xz_windows_are_no_longer_than_a_page():
    """A decoder with little memory reads them, and they are as short as under the preset's own window."""
    rng = random.Random(1)
    for size in (0, 1, 700, 70_000, 300_000):
        body = b"".join(rng.choice([b"page ", b"of the gallery ", rng.randbytes(3)]) for _ in range(size // 5))
        archive = to_tar_xz(body)
        assert from_tar_xz(archive) == body
        lzma.LZMADecompressor(memlimit=len(body) * 2 + 300_000).decompress(archive)
        assert stored_sizes(body, 9, None)[2] == len(lzma.compress(body))


def test_one_row_group_is_spread_over_the_cores(spark, tmp_path):
    """The scan has a partition per core already, but all rows in one of them."""
    spark.range(4000).selectExpr("id AS doc_id", "repeat(sha2(string(id), 512), 20) AS text").coalesce(1).write.option(
        "compression", "none"
    ).option("parquet.enable.dictionary", "false").parquet(f"{tmp_path}/one")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        scan = spark.read.parquet(f"{tmp_path}/one")
        assert scan.rdd.getNumPartitions() >= 4
        sizes = [r["count"] for r in spread_scan(scan, "doc_id").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) <= 2000
        even = scan.repartition(8, "doc_id")
        even.write.parquet(f"{tmp_path}/even")
        assert "Exchange" not in explained(spread_scan(spark.read.parquet(f"{tmp_path}/even"), "doc_id"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
