"""Fetched archive files to content rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.content import digest, size_in_bytes
from crawlframe.functions.urls import parse_archive_path


def content_rows(files: DataFrame, bits: int = 512) -> DataFrame:
    """``scrape_content`` rows for stored files: ids from the name, size, digest, no blob.

    Files are digested where they are read.  Files whose name holds no attempt
    give no row; the content id is a hash of attempt and digest unless the
    name holds one.
    """
    named = files.select(
        parse_archive_path(F.col("path")).alias("_name"),
        size_in_bytes(F.col("content")).alias("content_length"),
        digest(F.col("content"), bits).alias("content_sha512"),
    ).filter(F.col("_name.attempt_id").isNotNull())
    made_up = F.xxhash64("_name.attempt_id", "content_sha512")
    return named.select(
        F.coalesce("_name.content_id", made_up).alias("content_id"),
        F.col("_name.attempt_id").alias("attempt_id"),
        "content_length",
        "content_sha512",
        F.lit(None).cast("binary").alias("content_binary"),
    )
