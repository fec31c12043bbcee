"""Stored blobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlframe.functions.content import (
    decode_page,
    digest,
    encoding_status,
    human_size,
    size_in_bytes,
)
from crawlframe.functions.urls import blob_path, parse_archive_path
from crawlframe.operators import content as C
from crawlframe.plans.discovery import webpage_rows
from crawlframe.plans.storage import content_rows
from crawlframe.session import scratch_path
from crawlframe.operators.id_sets import SHIFT
from crawlframe.sources import archives, blobs, buckets
from workload import frames
from workload.frames import with_tables
from workload.registry import query, sql_time, time_text

BLOB_FILE = (
    "substr(content_sha512, 1, 3) || '/crawl_content_cid-' || content_id"
    " || '_aid-' || attempt_id || '.tar.xz'"
)


def sql_size(size: str) -> str:
    """Human-readable size in SQL."""
    ladder = f"CASE WHEN {size} = 0 THEN '0.000 Bit'"
    for power, unit in enumerate(("Byte", "KiB", "MiB", "GiB", "TiB", "PiB")):
        ladder += (
            f" WHEN {size} < {1024 ** (power + 1)} THEN"
            f" printf('%.3f {unit}', CAST({size} AS DOUBLE) / {1024**power}.0)"
        )
    return ladder + " END"


@query(
    "dir_manifest",
    with_tables(
        f"""
        SELECT CAST(7 AS BIGINT) AS run_id, 'todo' AS processed_status, {BLOB_FILE} AS file,
               CAST(NULL AS VARCHAR) AS warc_sha512, 'unknown' AS submission_status
        FROM content WHERE payload <> ''""",
        "content",
    ),
)
def manifest(spark, d):
    """Export every blob to its own file, then walk the folders."""
    root = scratch_path(spark, "archive")
    blobs.export_blobs(frames.contents(spark, d), _as_uri(root)).write.parquet(f"{root}-receipts")
    rows = archives.dir_manifest(archives.walk_tree(spark, root), run_id=7)
    relative = F.regexp_extract("file_path", "([^/]+/[^/]+)$", 1)
    return rows.select(
        "run_id", "processed_status", relative.alias("file"), "warc_sha512", "submission_status"
    )


def _as_uri(path: str) -> str:
    return path if ":" in path else f"file://{path}"


@query(
    "export_blobs",
    with_tables(
        f"""
        SELECT content_id, {BLOB_FILE} AS file, strlen(payload) AS n_bytes
        FROM content WHERE payload <> ''""",
        "content",
    ),
)
def export(spark, d):
    root = scratch_path(spark, "export")
    receipts = blobs.export_blobs(frames.contents(spark, d), _as_uri(root))
    receipts.write.parquet(f"{root}-receipts")
    return spark.read.parquet(f"{root}-receipts")


@query(
    "null_out_payload",
    with_tables(
        """
        SELECT content_id, attempt_id, content_length, CAST(NULL AS VARCHAR) AS payload
        FROM content""",
        "content",
    ),
)
def null_out(spark, d):
    rows = frames.contents(spark, d)
    after = blobs.null_out_payload(rows, blobs.export_plan(rows))
    return after.select(
        "content_id",
        "attempt_id",
        "content_length",
        F.col("content_binary").cast("string").alias("payload"),
    )


@query(
    "bucket_clear",
    with_tables(
        """
        SELECT content_id, attempt_id, CASE WHEN content_id % 3 = 0 THEN NULL ELSE payload END AS payload
        FROM content""",
        "content",
    ),
)
def clear_buckets(spark, d):
    """The same on a table in buckets, for the blobs whose export has receipts: no blob is shuffled."""
    rows = frames.contents(spark, d).drop("source")
    table = buckets.BucketTable(spark, scratch_path(spark, "content"), rows.schema, buckets.by_range("content_id"))
    table.replace(rows)
    table.clear(buckets.exported_ids(rows.filter("content_id % 3 = 0")), "content_id", "content_binary")
    return table.read().select("content_id", "attempt_id", F.col("content_binary").cast("string").alias("payload"))


@query(
    "bucket_merge",
    with_tables(
        f"""
        SELECT site_submission_id, CASE WHEN site_submission_id >= edge THEN 'finished' ELSE processed_status END AS processed_status,
               (site_submission_id >> {SHIFT}) >= (edge >> {SHIFT}) AS rewritten
        FROM submission, (SELECT max(o_orderkey) * 99 // 100 AS edge FROM orders)""",
        "every_submission",
    ),
)
def merge_buckets(spark, d):
    """The newest hundredth of the ids is finished: only their buckets are written again."""
    rows = frames.all_submissions(spark, d)
    rows = rows.withColumn("date_visited", F.col("date_visited").cast("timestamp"))
    table = buckets.BucketTable(spark, scratch_path(spark, "submission"), rows.schema, buckets.by_range("site_submission_id"))
    table.replace(rows)
    edge = rows.agg(F.max("site_submission_id")).first()[0] * 99 // 100
    changes = rows.filter(F.col("site_submission_id") >= edge).withColumn("processed_status", F.lit("finished"))
    number = table.merge(changes, buckets.upsert("site_submission_id", F.col("date_visited")))
    held, _ = table.manifest()
    new = [one for one, commit in held.items() if commit == number]
    return table.read().select(
        "site_submission_id", "processed_status", F.shiftright("site_submission_id", SHIFT).isin(new).alias("rewritten")
    )


@query(
    "payload_batch",
    with_tables(
        """
        SELECT content_id, attempt_id, strlen(payload) AS n_bytes FROM content
        WHERE payload IS NOT NULL""",
        "content",
    ),
)
def batch(spark, d):
    return C.payload_batch(frames.contents(spark, d)).select(
        "content_id", "attempt_id", size_in_bytes(F.col("content_binary")).alias("n_bytes")
    )


@query(
    "payload_state",
    with_tables(
        """
        SELECT content_id, CASE WHEN payload IS NULL THEN 'extracted' WHEN payload = ''
                 THEN 'emptied' ELSE 'present' END AS payload_state
        FROM content""",
        "content",
    ),
)
def state(spark, d):
    return C.with_payload_state(frames.contents(spark, d)).select("content_id", "payload_state")


@query(
    "payload_count",
    with_tables("SELECT count(payload) AS n_payloads FROM content", "content"),
)
def count(spark, d):
    return C.payload_count(frames.contents(spark, d))


@query(
    "size_summary",
    with_tables(
        f"""
        , summed AS (SELECT source, count(*) AS n,
                            CAST(sum(strlen(text)) AS BIGINT) AS original_bytes,
                            CAST(sum(length(text)) AS BIGINT) AS compressed_bytes
                     FROM documents GROUP BY source)
        SELECT source, n, original_bytes, compressed_bytes,
               round(compressed_bytes / original_bytes, 6) AS ratio,
               {sql_size("original_bytes")} || ' -> ' || {sql_size("compressed_bytes")} AS summary
        FROM summed""",
        "content",
    ),
)
def sizes(spark, d):
    """Bytes against characters per source: two sizes that SQL can name too."""
    rows = C.size_summary(
        frames.table(spark, d, "documents"),
        "source",
        F.octet_length("text").cast("long"),
        F.char_length("text").cast("long"),
    )
    return rows.withColumn("ratio", F.round("ratio", 6))


@query(
    "decode_page",
    """
    SELECT doc_id, CASE WHEN doc_id % 50 = 2 THEN text || '\\xff' ELSE text END AS text,
           CASE WHEN doc_id % 50 = 2 THEN 'unicode_decode_error' ELSE 'decoded_ok' END
             AS encoding_status
    FROM documents""",
)
def decode(spark, d):
    data = F.col("content")
    return frames.page_bytes(spark, d).select(
        "doc_id", decode_page(data).alias("text"), encoding_status(data).alias("encoding_status")
    )


@query(
    "digest_content",
    """
    SELECT doc_id, sha256(text) AS content_sha256, strlen(text) AS content_length
    FROM documents""",
)
def digests(spark, d):
    rows = frames.table(spark, d, "documents").select("doc_id", "text")
    return C.with_digest(rows, F.col("text").cast("binary"), 256).drop("text")


@query(
    "compress_and_digest",
    "SELECT doc_id, sha256(text) AS original, sha256(text) AS restored FROM documents",
)
def compress(spark, d):
    """The digest of each page before packing and after unpacking."""
    pages = frames.wide_table(spark, d, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("content")
    )
    packed = C.compress_and_digest(pages, bits=256)
    restored = digest(C.decompress_page(F.col("compressed_data")), 256)
    return packed.select(
        "doc_id", F.col("original_data_sha256").alias("original"), restored.alias("restored")
    )


@query(
    "archive_path",
    with_tables(
        f"""
        SELECT '/archive/' || {BLOB_FILE} AS path, substr(content_sha512, 1, 3) AS sha_prefix,
               content_id, attempt_id
        FROM content""",
        "content",
    ),
)
def paths(spark, d):
    """Paths built and taken apart again."""
    path = blob_path(F.col("content_sha512"), F.col("content_id"), F.col("attempt_id"), "/archive/")
    return (
        frames.contents(spark, d)
        .select(path.alias("path"))
        .select("path", F.inline(F.array(parse_archive_path(F.col("path")))))
        .drop("site_id")
    )


@query(
    "human_size",
    f"""
    WITH s AS (SELECT o_orderkey, o_orderkey * o_orderkey * o_orderkey AS size FROM orders)
    SELECT o_orderkey, size, {sql_size("size")} AS text FROM s""",
)
def human(spark, d):
    """Cubes of the keys as sizes: ``text`` of every one, ``size`` where a long holds it, else null."""
    key = F.col("o_orderkey").cast("decimal(20,0)")
    cube = key * key * key  # beyond a long from 2,097,152 on
    return frames.table(spark, d, "orders").select(
        "o_orderkey", cube.try_cast("long").alias("size"), human_size(cube).alias("text")
    )


@query(
    "duplicate_content",
    with_tables(
        """
        SELECT content_sha512, count(*) AS n_copies, min(content_id) AS first_content_id
        FROM content GROUP BY 1 HAVING count(*) > 1""",
        "content",
    ),
)
def duplicates(spark, d):
    return C.duplicate_content(frames.contents(spark, d), "content_sha512", "content_id")


@query(
    "page_changes",
    f"""
    WITH v AS (SELECT doc_id AS submission_webpage_id, doc_id % 100 AS submission_id,
                      make_timestamp(doc_id * 1000000) AS date_visited,
                      sha256(lang) AS original_data_sha512
               FROM documents),
         w AS (SELECT *, lag(original_data_sha512) OVER (
                           PARTITION BY submission_id ORDER BY date_visited, submission_webpage_id)
                           AS before
               FROM v)
    SELECT submission_id, submission_webpage_id, {sql_time("date_visited")} AS date_visited,
           CASE WHEN before IS NULL THEN 'first' WHEN before = original_data_sha512
                THEN 'unchanged' ELSE 'changed' END AS change
    FROM w""",
)
def changes(spark, d):
    rows = C.page_changes(frames.visits(spark, d))
    return rows.select(
        "submission_id",
        "submission_webpage_id",
        time_text(F.col("date_visited")).alias("date_visited"),
        "change",
    )


@query(
    "content_rows",
    with_tables(
        """
        SELECT content_id, attempt_id, content_length, content_sha512 FROM content""",
        "content",
    ),
)
def stored_files(spark, d):
    """Content rows made from the stored files alone."""
    text, doc = F.col("text"), F.col("doc_id")
    files = frames.table(spark, d, "documents").select(
        blob_path(F.sha2(text, 256), doc, doc * 11, "/archive/").alias("path"),
        text.cast("binary").alias("content"),
    )
    return content_rows(files, bits=256).drop("content_binary")


@query(
    "webpage_rows",
    """
    SELECT doc_id AS submission_id,
           CASE WHEN doc_id % 50 = 2 THEN 'unicode_decode_error' ELSE 'decoded_ok' END
             AS encoding_status,
           CASE WHEN doc_id % 50 = 2 THEN sha256(encode(text) || '\\xFF'::BLOB)
                ELSE sha256(text) END AS restored
    FROM documents""",
)
def webpages(spark, d):
    """Page rows as they are stored, and the digest of what their archives give back."""
    pages = frames.page_bytes(spark, d).withColumnRenamed("doc_id", "submission_id")
    rows = webpage_rows(pages, F.lit("2025-01-01").cast("timestamp_ntz"))
    restored = digest(C.decompress_page(F.col("raw_compressed_webpage_data")), 256)
    return rows.select("submission_id", "encoding_status", restored.alias("restored"))


CODEC_SUMS = "SELECT source, count(*) AS n FROM documents GROUP BY source"


@query(
    "compression_profile",
    f"""
    SELECT source, codec, n, codec <> 'none' AS smaller
    FROM ({CODEC_SUMS}), (SELECT unnest(['none', 'zlib', 'lzma', 'zstd']) AS codec)""",
)
def profile(spark, d):
    """Which codecs make each source smaller; the sizes themselves are the codecs' own."""
    rows = _samples(spark, d)
    raw = rows.groupBy("source").agg(F.sum(F.octet_length("data")).alias("raw_bytes"))
    stored = C.compression_profile(rows, "source", "data").join(raw, "source")
    return stored.select(
        "source", "codec", "n", (F.col("stored_bytes") < F.col("raw_bytes")).alias("smaller")
    )


def _samples(spark, d):
    return frames.wide_table(spark, d, "documents").select(
        "doc_id", "source", F.col("text").cast("binary").alias("data")
    )


DICT_BYTES = 1024**2


def _dictionaries(rows):
    return C.codec_dictionary(rows, "source", "doc_id", "data", dict_bytes=DICT_BYTES)


@query(
    "codec_dictionary",
    f"SELECT source, CAST(0 AS BIGINT) AS shard, n, true AS trained FROM ({CODEC_SUMS})",
)
def dictionary(spark, d):
    trained = F.octet_length("dictionary").between(1, DICT_BYTES)
    return _dictionaries(_samples(spark, d)).select(
        "source", "shard", "n", trained.alias("trained")
    )


@query(
    "dictionary_profile",
    f"SELECT source, 'zstd_dict' AS codec, n, true AS smaller FROM ({CODEC_SUMS})",
)
def dictionary_profile(spark, d):
    """Each source stored with its own dictionary, against storing it as it is."""
    rows = _samples(spark, d)
    raw = rows.groupBy("source").agg(F.sum(F.octet_length("data")).alias("raw_bytes"))
    stored = C.dictionary_profile(rows, _dictionaries(rows), "source", "doc_id", "data")
    return stored.join(raw, "source").select(
        "source", "codec", "n", (F.col("stored_bytes") < F.col("raw_bytes")).alias("smaller")
    )
