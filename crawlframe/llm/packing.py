"""Packing of documents into sequences of a fixed length: shortest pack first, over the length histogram.

Documents are encoded, ended by one id and cut every ``length`` ids.  The
lengths of the pieces give a histogram of at most ``length`` rows.  On it,
lengths are placed longest first into the pack with the least content that
still takes them, many equal packs at a time; what counts is how often a
pattern of lengths occurs, not which documents fill it.  Last, pieces of each
length are ranked and the rank gives the pattern's copy and the place in it.

Null and empty texts are one piece, the end id.  Rows that share a ``doc_id``
are packed each for itself.  An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.llm.batches import mapped, only, partitions, shard_of, small
from crawlframe.llm.token_words import word_encoder
from crawlframe.session import scratch_path

PIECE = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def cut_pieces(docs: DataFrame, *, vocabulary: str, end_id: int, length: int, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids, with the ids themselves (four bytes each) where asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, step = word_encoder(vocabulary), np.array([end_id], "<u4").tobytes(), 4 * length
        for batch in small(batches, "text", 8_000_000):
            rows = []
            for key, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                ids += end
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    rows.append((key, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part))
            columns = list(zip(*rows)) or [()] * 6
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            made = {name: pa.array(values, kind) for name, kind, values in zip(names, kinds, columns)}
            if with_ids:
                made["ids"] = pa.array(columns[5], pa.binary())
            yield pa.RecordBatch.from_pydict(made)

    rows = only(docs, doc_id="bigint", text="string")
    return mapped(rows, cut, PIECE + (", ids binary" if with_ids else ""))


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in the order of placing) with the number of packs that follow each."""
    heap: list[tuple[int, int]] = []
    patterns: dict[int, tuple[list[int], int]] = {}
    made = 0

    def push(lengths: list[int], packs: int) -> None:
        nonlocal made
        patterns[made] = (lengths, packs)
        heapq.heappush(heap, (sum(lengths), made))
        made += 1

    for size in sorted((k for k, n in histogram.items() if n), reverse=True):
        left, changed = histogram[size], []
        while left and heap and heap[0][0] + size <= length:
            _, key = heapq.heappop(heap)
            lengths, packs = patterns.pop(key)
            room = (length - sum(lengths)) // size
            each = min(room, max(1, left // packs))
            taken = min(packs, left // each)
            changed.append((lengths + [size] * each, taken))
            if packs > taken:
                push(lengths, packs - taken)
            left -= taken * each
        each = max(1, length // size)
        if left >= each:
            changed.append(([size] * each, left // each))
            left %= each
        if left:
            changed.append(([size] * left, 1))
        for lengths, packs in changed:
            push(lengths, packs)
    return [patterns[key] for key in sorted(patterns)]


def slot_table(patterns: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: begins of the ranges of ranks, with the sequence of the first and the offset in it."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, packs in patterns:
        offset = 0
        for size in lengths:
            begin = used.get(size, 0)
            found.setdefault(size, []).append((begin, sequence, offset))
            used[size] = begin + packs
            offset += size
        sequence += packs
    return {size: tuple(np.array(column, np.int64) for column in zip(*rows)) for size, rows in found.items()}


def ranked(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0: within a shard, plus those of earlier shards."""
    shards = partitions(pieces.sparkSession)
    placed = pieces.withColumn("shard", shard_of("doc_id", shards))
    counts = placed.groupBy("shard", "length").count()
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "length").orderBy("doc_id", "start", "ids_crc32")
    own = placed.withColumn("own", F.row_number().over(inside) - 1)
    return own.join(base, ["shard", "length"]).withColumn("rank", F.col("base") + F.col("own")).drop("shard", "own", "base")


def place(pieces: DataFrame, *, length: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces."""
    counted = pieces.groupBy("length").count().collect()  # at most one row per length
    slots = slot_table(shortest_pack_first({row["length"]: row["count"] for row in counted}, length))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                mine = sizes == size
                begins, firsts, offsets = slots[int(size)]
                row = np.searchsorted(begins, ranks[mine], side="right") - 1
                sequence[mine] = firsts[row] + ranks[mine] - begins[row]
                offset[mine] = offsets[row]
            kept = batch.drop_columns(["rank"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return mapped(ranked(pieces).select(*order, "rank"), look_up, f"{PIECE}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, *, vocabulary: str, end_id: int = 1, length: int = 2048) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    cut_pieces(docs, vocabulary=vocabulary, end_id=end_id, length=length).write.parquet(path)
    return place(spark.read.schema(PIECE).parquet(path), length=length).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
