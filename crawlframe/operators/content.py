"""Stored blobs: states, sizes, duplicates, versions, codecs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.codecs import (
    from_tar_xz,
    load_zstandard,
    stored_sizes,
    to_tar_xz,
    train_dictionary,
)
from crawlframe.functions.content import digest, human_size, payload_state, size_in_bytes
from crawlframe.operators.ordered import SLOT, previous_row, slot_of


def payload_batch(content: DataFrame) -> DataFrame:
    """Rows that still have a blob, empty or not; partitions are the batches."""
    return content.filter(F.col("content_binary").isNotNull())


def payload_count(content: DataFrame) -> DataFrame:
    """``n_payloads``: rows whose blob is not null.  The bytes are not read
    beyond what the null test needs."""
    return content.agg(F.count("content_binary").alias("n_payloads"))


def with_payload_state(content: DataFrame) -> DataFrame:
    return content.withColumn("payload_state", payload_state(F.col("content_binary")))


def with_digest(df: DataFrame, data: Column, bits: int = 512, prefix: str = "content") -> DataFrame:
    """Add ``<prefix>_sha<bits>`` and ``<prefix>_length``."""
    return df.withColumn(f"{prefix}_sha{bits}", digest(data, bits)).withColumn(
        f"{prefix}_length", size_in_bytes(data)
    )


def compress_page(data: Column) -> Column:
    """The bytes as ``tar.xz`` holding one file; equal bytes give equal archives."""

    @F.pandas_udf("binary")
    def pack(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda blob: None if blob is None else to_tar_xz(bytes(blob)))

    return pack(data)


def decompress_page(data: Column) -> Column:
    """Inverse of :func:`compress_page`."""

    @F.pandas_udf("binary")
    def unpack(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda blob: None if blob is None else from_tar_xz(bytes(blob)))

    return unpack(data)


def compress_and_digest(pages: DataFrame, data: str = "content", bits: int = 512) -> DataFrame:
    """Add the compressed bytes and the digests of both forms."""
    packed = pages.withColumn("compressed_data", compress_page(F.col(data)))
    return packed.withColumn(f"original_data_sha{bits}", digest(F.col(data), bits)).withColumn(
        f"compressed_data_sha{bits}", digest(F.col("compressed_data"), bits)
    )


def size_summary(
    sizes: DataFrame, group: str, original: Column, compressed: Column
) -> DataFrame:
    """Sizes before and after per group, and the line that reports them."""
    summed = sizes.groupBy(group).agg(
        F.count("*").alias("n"),
        F.sum(original).alias("original_bytes"),
        F.sum(compressed).alias("compressed_bytes"),
    )
    before, after = F.col("original_bytes"), F.col("compressed_bytes")
    return summed.withColumn("ratio", F.try_divide(after, before)).withColumn(
        "summary", F.concat(human_size(before), F.lit(" -> "), human_size(after))
    )


def duplicate_content(content: DataFrame, sha: str, key: str) -> DataFrame:
    """Hashes stored more than once: ``sha, n_copies, first_key``."""
    return (
        content.filter(F.col(sha).isNotNull())
        .groupBy(sha)
        .agg(F.count("*").alias("n_copies"), F.min(key).alias(f"first_{key}"))
        .filter(F.col("n_copies") > 1)
    )


def page_changes(
    visits: DataFrame,
    page: str = "submission_id",
    sha: str = "original_data_sha512",
    visited: str = "date_visited",
    key: str = "submission_webpage_id",
    slot_seconds: int = 30 * 86_400,
) -> DataFrame:
    """Each visit with ``change``: ``first``, ``changed`` or ``unchanged``.

    A page's visits are put in order within slots of ``slot_seconds``, each in
    one task; visits of one page at one and the same moment stay together.
    """
    start = slot_of(F.col(visited), slot_seconds)
    rows = visits.select(page, visited, key, sha, start.alias(SLOT))
    walked = previous_row(rows, [page], [visited, key], [sha], "_prev")
    change = (
        F.when(F.col("_prev").isNull(), "first")
        .when(F.col(f"_prev.{sha}") == F.col(sha), "unchanged")
        .otherwise("changed")
    )
    return walked.select(page, visited, key, sha, change.alias("change"))


def codec_dictionary(
    samples: DataFrame,
    group: str,
    key: str,
    data: str,
    dict_bytes: int = 1024**2,
    k: int = 100_000,
    d: int = 8,
    level: int = 9,
    shard_bytes: int = 64 * 1024**2,
) -> DataFrame:
    """Zstandard dictionaries trained on all samples: ``group, shard, n, dictionary``.

    A group is cut by a hash of the unique ``key`` into shards of about
    ``shard_bytes``, each trained in its own task, so a large group gets
    several dictionaries and no task holds it whole.  ``dictionary`` is null
    where a shard has too little data to train on.
    """

    def train_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        trained = train_dictionary([bytes(x) for x in pdf["_data"]], dict_bytes, k, d, level)
        return pd.DataFrame(
            {
                group: [pdf[group].iloc[0]],
                "shard": [pdf["shard"].iloc[0]],
                "n": [len(pdf)],
                "dictionary": [trained],
            }
        )

    sharded = with_shards(samples, group, key, data, shard_bytes)
    kind = samples.schema[group].dataType.simpleString()
    return (
        sharded.select(group, "shard", F.col(data).alias("_data"))
        .groupBy(group, "shard")
        .applyInPandas(train_shard, f"`{group}` {kind}, shard long, n long, dictionary binary")
    )


def with_shards(
    samples: DataFrame, group: str, key: str, data: str, shard_bytes: int = 64 * 1024**2
) -> DataFrame:
    """Add ``shard`` so that every (group, shard) holds about ``shard_bytes``.

    Only groups above ``shard_bytes`` are cut.  There are at most
    (all bytes / ``shard_bytes``) of them, which is what makes their table
    safe to broadcast.
    """
    large = (
        samples.groupBy(group)
        .agg(F.sum(F.octet_length(data)).alias("_bytes"))
        .filter(F.col("_bytes") > shard_bytes)
        .select(group, F.ceil(F.col("_bytes") / F.lit(shard_bytes)).alias("_shards"))
    )
    shard = F.pmod(F.xxhash64(key), F.coalesce("_shards", F.lit(1)))
    return (
        samples.join(F.broadcast(large), group, "left")
        .withColumn("shard", shard.cast("long"))
        .drop("_shards")
    )


def codec_sizes(data: Column, level: int = 9) -> Column:
    """``struct<none,zlib,lzma,zstd>`` of the stored size per codec."""

    @F.pandas_udf("none long, zlib long, lzma long, zstd long")
    def measure(blobs: pd.Series) -> pd.DataFrame:
        zstandard = load_zstandard()
        zstd = zstandard and zstandard.ZstdCompressor(level=level)
        rows = [
            [None] * 4 if blob is None else stored_sizes(bytes(blob), level, zstd)
            for blob in blobs
        ]
        return pd.DataFrame(rows, columns=["none", "zlib", "lzma", "zstd"]).astype("Int64")

    return measure(data)


def compression_profile(content: DataFrame, group: str, data: str) -> DataFrame:
    """``group, codec, n, stored_bytes, avg_ratio`` over all blobs, one row per codec."""
    measured = content.select(group, codec_sizes(F.col(data)).alias("_s"))
    stored = F.array(
        *[
            F.struct(F.lit(name).alias("codec"), F.col(f"_s.{name}").alias("bytes"))
            for name in ("none", "zlib", "lzma", "zstd")
        ]
    )
    each = measured.select(group, F.col("_s.none").alias("raw"), F.explode(stored).alias("c"))
    return (
        each.filter(F.col("c.bytes").isNotNull())
        .groupBy(group, F.col("c.codec").alias("codec"))
        .agg(
            F.count("*").alias("n"),
            F.sum("c.bytes").alias("stored_bytes"),
            F.avg(F.try_divide("c.bytes", "raw")).alias("avg_ratio"),
        )
    )


def dictionary_profile(
    content: DataFrame,
    dictionaries: DataFrame,
    group: str,
    key: str,
    data: str,
    level: int = 9,
    shard_bytes: int = 64 * 1024**2,
) -> DataFrame:
    """The ``zstd_dict`` rows of :func:`compression_profile`.

    Every blob is stored with the dictionary of its own shard, which meets
    the shard's blobs once, not once per blob.  Blobs of a shard that was too
    small to train on are stored without one, and count all the same.
    """

    def measure(key_values: tuple, blobs: pd.DataFrame, trained: pd.DataFrame) -> pd.DataFrame:
        zstandard = load_zstandard()
        columns = [group, "n", "stored_bytes", "ratios"]
        if zstandard is None or blobs.empty:
            return pd.DataFrame(columns=columns)
        trained = trained[trained["dictionary"].notna()]["dictionary"]
        known = None if trained.empty else zstandard.ZstdCompressionDict(bytes(trained.iloc[0]))
        codec = zstandard.ZstdCompressor(level=level, dict_data=known)
        raw = blobs["_data"].map(len)
        stored = blobs["_data"].map(lambda blob: len(codec.compress(bytes(blob))))
        ratios = float((stored / raw.where(raw > 0)).sum())
        return pd.DataFrame([[key_values[0], len(blobs), int(stored.sum()), ratios]], columns=columns)

    kind = content.schema[group].dataType.simpleString()
    blobs = with_shards(content, group, key, data, shard_bytes).select(
        group, "shard", F.col(data).alias("_data")
    )
    per_shard = (
        blobs.filter(F.col("_data").isNotNull())
        .groupBy(group, "shard")
        .cogroup(dictionaries.select(group, "shard", "dictionary").groupBy(group, "shard"))
        .applyInPandas(measure, f"`{group}` {kind}, n long, stored_bytes long, ratios double")
    )
    return (
        per_shard.groupBy(group)
        .agg(
            F.sum("n").alias("n"),
            F.sum("stored_bytes").alias("stored_bytes"),
            F.sum("ratios").alias("_ratios"),
        )
        .select(
            group,
            F.lit("zstd_dict").alias("codec"),
            "n",
            "stored_bytes",
            (F.col("_ratios") / F.col("n")).alias("avg_ratio"),
        )
    )
