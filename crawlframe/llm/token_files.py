"""Token-id files: ids of all documents in a row, boundaries in Elias-Fano code.

The files are Parquet, one row per segment.  A segment holds neighbours in
``doc_id`` order: ``ids`` (all ids, two bytes each where the vocabulary allows
it, else four, little-endian), ``bounds`` (Elias-Fano code of the ends of the
documents, counted in ids from the segment's begin) and ``doc_ids``.
``(shard, segment)`` gives the order of segments; the offset of a segment is
summed from the ids of those before it.

Null and empty texts give a document that consists of the end id alone.  Rows
that share a ``doc_id`` stay separate documents, in no fixed order; a null
``doc_id`` sorts first.  An empty table gives files without segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlframe.llm.batches import mapped, only, partitions, small
from crawlframe.llm.elias_fano import EliasFano, pack
from crawlframe.llm.token_words import word_encoder

SEGMENT_IDS = 1 << 20
SEGMENT = "shard int, segment int, n_ids long, width int, doc_ids array<long>, bounds binary, ids binary"
DOCUMENT = "doc_id long, shard int, segment int, local_start long, n_tokens long, ids binary"


def write_token_files(docs: DataFrame, path: str, *, vocabulary: str, end_id: int) -> None:
    """Encode ``docs`` (doc_id, text) and write them to ``path`` in ascending doc_id order."""
    spark = docs.sparkSession
    rows = only(docs, doc_id="bigint", text="string")
    ordered = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = word_encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        shard = TaskContext.get().partitionId()
        wide = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) > 1 << 16
        keys: list[int | None] = []
        parts: list[bytes] = []
        total = made = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            bounds = np.cumsum([len(part) // 4 for part in parts])
            return pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "segment": pa.array([made], pa.int32()),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "width": pa.array([4 if wide else 2], pa.int32()),
                    "doc_ids": pa.array([keys], pa.list_(pa.int64())),
                    "bounds": pa.array([pack(bounds)], pa.binary()),
                    "ids": pa.array([(ids if wide else ids.astype("<u2")).tobytes()], pa.binary()),
                }
            )

        for batch in small(batches, "text", 8_000_000):
            for key, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                keys.append(key)
                parts.append(ids + end)
                total += len(ids) // 4 + 1
                if total >= SEGMENT_IDS:
                    yield flush()
                    keys, parts, total, made = [], [], 0, made + 1
        if keys:
            yield flush()

    mapped(ordered, segments, SEGMENT).write.mode("overwrite").option("compression", "zstd").parquet(path)


def segment_starts(files: DataFrame) -> DataFrame:
    """Ids before each segment: first within its shard, then the totals of earlier shards."""
    sizes = files.select("shard", "segment", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("in_shard"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard only
    shards = shards.select("shard", F.coalesce(F.sum("in_shard").over(earlier), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return inner.join(shards, "shard").select("shard", "segment", (F.col("shard_start") + F.col("before")).alias("segment_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A row per stored document with its ids (four bytes each) and its place in its segment."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4").tobytes()
                ends = EliasFano(row["bounds"]).all()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                n = len(ends)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "shard": pa.array([row["shard"]] * n, pa.int32()),
                        "segment": pa.array([row["segment"]] * n, pa.int32()),
                        "local_start": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(ends - starts, pa.int64()),
                        "ids": pa.array([ids[4 * a : 4 * b] for a, b in zip(starts, ends)], pa.binary()),
                    }
                )

    return mapped(spark.read.schema(SEGMENT).parquet(path), documents, DOCUMENT)


def find_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of :func:`read_documents` for some ids alone: their boundaries are selected, no other one is decoded.

    ``doc_ids`` is a short list; other segments are passed over by their ids.
    """
    wanted = sorted(set(doc_ids))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bounds, rows = EliasFano(row["bounds"]), []
                for k, key in enumerate(row["doc_ids"]):
                    if key in chosen:
                        start, end = bounds.select(k - 1) if k else 0, bounds.select(k)
                        data = np.frombuffer(row["ids"], f"<u{row['width']}", end - start, start * row["width"])
                        rows.append((key, row["shard"], row["segment"], start, end - start, data.astype("<u4").tobytes()))
                if rows:
                    names, kinds = ("doc_id", "shard", "segment", "local_start", "n_tokens", "ids"), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_pydict({name: pa.array(column, kind) for name, kind, column in zip(names, kinds, zip(*rows))})

    chosen = set(wanted)
    files = spark.read.schema(SEGMENT).parquet(path)
    return mapped(files.filter(F.arrays_overlap("doc_ids", F.array(*map(F.lit, wanted)).cast("array<bigint>"))), pick, DOCUMENT)


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the checksum of its ids."""
    starts = segment_starts(spark.read.schema(SEGMENT).parquet(path))
    found = read_documents(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return found.join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("segment_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
