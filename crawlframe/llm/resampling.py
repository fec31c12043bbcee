"""Target-distribution importance resampling, ranked by a parallel sort with regular sampling.

A feature is a run of up to ``grams`` neighbouring words; it falls into one of
``buckets`` by its CRC-32.  A bucket's gain is the floored thousandfold log
ratio of its smoothed shares of the target and of the source.  A document's
weight is the floored mean of the gains of its features, read from the array of
gains; with Gumbel noise from a hash of ``doc_id`` added, the highest scores
are a draw without replacement in proportion to the importance weights.

Ranks are exact.  Documents with enough words are written in locally sorted
runs of bounded length.  Every run gives rows at regular distances; these are
merged in groups, each group again giving rows at regular distances, until one
group yields the splitters.  Rows between two splitters are a segment; their
counts, summed in order, give the rank at which each segment begins.  Segments
that begin within the draw are exchanged, each run's sorted part merged there.

Order: score down, then doc_id up (none last), then place in the runs, so that
rows that share an id have ranks of their own and no segment outgrows its
bound.  Null and empty texts have no features and weight 0; no target or no
source text makes all shares smoothed ones.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.batches import mapped, only, partitions
from crawlframe.llm.components import stored

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CACHED = 200_000  # words whose buckets a task remembers
RUN_ROWS, SEGMENT_ROWS = 1 << 20, 1 << 20
GROUP_ROWS, FAN_IN = 1 << 20, 64


class Buckets(dict):
    """Bucket of each feature seen, forgotten when they are too many."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def feature_buckets(text: str | None, known: Buckets, grams: int) -> tuple[int, list[int]]:
    """The number of words, and the buckets of all features, repeats included."""
    words = WORD.findall((text or "").encode().lower())
    of = known.__getitem__
    found = list(map(of, words))
    for width in range(2, grams + 1):
        found += [of(b" ".join(words[k : k + width])) for k in range(len(words) - width + 1)]
    return len(words), found


def bucketed(docs: DataFrame, buckets: int, grams: int) -> DataFrame:
    """doc_id, n_words and the buckets of the features, two or four bytes each."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(buckets)
        for batch in batches:
            found = [feature_buckets(text, known, grams) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "words": pa.array([n for n, _ in found], pa.int64()),
                    "found": pa.array([np.array(some, kind).tobytes() for _, some in found], pa.binary()),
                }
            )

    return mapped(only(docs, doc_id="bigint", text="string"), read, "doc_id long, words long, found binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket; a task sends each bucket once."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column("found").to_pylist():
                total += np.bincount(np.frombuffer(data, kind), minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(full, pa.int32()), "n": pa.array(total[full], pa.int64())})

    rows = mapped(found.select("found"), count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for row in rows.collect():  # a row a bucket, ``buckets`` being a parameter
        total[row["bucket"]] = row["n"]
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of target share over source share), both smoothed by one a bucket."""
    all_source, all_target, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array(
        [
            math.floor(1000 * math.log(((t + 1) * float(all_source + buckets)) / ((s + 1) * float(all_target + buckets))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandfold Gumbel noise, the same for equal ids on every run."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


SCORED = "doc_id long, n_features long, weight long, score long, run long, place long"


def sorted_runs(found: DataFrame, gains: np.ndarray, *, min_words: int, seed: int) -> DataFrame:
    """Scores of all rows; those of ``min_words`` words have a run and their place in it, in order."""
    kind = "<u2" if len(gains) <= 1 << 16 else "<u4"
    held = found.sparkSession.sparkContext.broadcast(gains)  # a number a bucket

    def batch_of(columns: list[np.ndarray], run: int | None) -> pa.RecordBatch:
        n = len(columns[0])
        names = ["doc_id", "n_features", "weight", "score"]
        made = {name: pa.array(column, pa.int64()) for name, column in zip(names, columns)}
        made["doc_id"] = pa.array(columns[0], pa.int64(), mask=columns[4])
        made["run"] = pa.array([run] * n, pa.int64())
        made["place"] = pa.array(np.arange(n), pa.int64()) if run is not None else pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_pydict(made)

    def close(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(some) for some in zip(*parts)]
        order = np.lexsort([columns[0], columns[4], -columns[3]])
        whole = batch_of([column[order] for column in columns], uuid.uuid4().int >> 65)
        for at in range(0, whole.num_rows, 1 << 16):
            yield whole.slice(at, 1 << 16)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = held.value
        parts, size = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = [np.frombuffer(data, kind) for data in batch.column("found").to_pylist()]
            n = np.array([len(some) for some in found], np.int64)
            weight = np.array([int(gain[some].sum()) // max(1, len(some)) for some in found], np.int64)
            drawn = weight + np.array([noise(number, seed) for number in ids], np.int64)
            none = np.array([number is None for number in ids], bool)
            columns = [np.array([number or 0 for number in ids], np.int64), n, weight, drawn, none]
            enough = batch.column("words").to_numpy() >= min_words
            yield batch_of([column[~enough] for column in columns], None)
            parts.append([column[enough] for column in columns])
            size += int(enough.sum())
            if size >= RUN_ROWS:
                yield from close(parts)
                parts, size = [], 0
        if size:
            yield from close(parts)

    return mapped(found, score, SCORED)


KEY = "score long, no_id boolean, id long, run long, place long"


def sort_keys(rows: DataFrame) -> DataFrame:
    """The columns of the order; score negated, so that all go up."""
    return rows.select((-F.col("score")).alias("score"), F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "run", "place")


def key_bytes(part: pa.Table) -> np.ndarray:
    """The sort keys as strings of 33 bytes that compare like them."""
    out = np.empty((part.num_rows, 33), np.uint8)
    out[:, 8] = part.column("no_id").to_numpy()
    for name, at in (("score", 0), ("id", 9), ("run", 17), ("place", 25)):
        numbers = part.column(name).to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        out[:, at : at + 8] = numbers.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S33").ravel()


def keys_of(part: pa.Table) -> np.ndarray:
    """The keys of scored rows."""
    ids = part.column("doc_id")
    score = pa.array(-part.column("score").to_numpy())
    return key_bytes(pa.table({"score": score, "no_id": ids.is_null(), "id": ids.fill_null(0), "run": part.column("run"), "place": part.column("place")}))


def splitters(rows: DataFrame, total: int, segments: int) -> np.ndarray:
    """Keys between segments: rows at regular distances in all runs, merged in groups and thinned until one group holds them."""
    runs = rows.agg(F.count_distinct("run")).first()[0]
    step = max(1, total // (segments * runs))
    samples = stored(sort_keys(rows.filter(F.col("place") % step == step // 2)), "regular-samples")

    def thin(part: pa.Table) -> pa.Table:
        return part.take(pa.array(np.argsort(key_bytes(part), kind="stable")[FAN_IN // 2 :: FAN_IN]))

    left = samples.count()
    while left > GROUP_ROWS:
        group = F.pmod(F.xxhash64("run"), F.lit(left // GROUP_ROWS + 1))
        samples = stored(samples.groupBy(group.alias("group")).applyInArrow(thin, KEY), "regular-samples")
        left = samples.count()

    def cut(part: pa.Table) -> pa.Table:
        keys = np.sort(key_bytes(part), kind="stable")
        at = np.unique(np.arange(1, segments) * len(keys) // segments)
        return pa.table({"key": pa.array([bytes(key).ljust(33, b"\0") for key in keys[at[at > 0]]], pa.binary())})

    found = samples.groupBy(F.lit(0).alias("group")).applyInArrow(cut, "key binary").collect()  # fewer than ``segments``
    return np.array([bytes(row["key"]) for row in found], "S33")


def ranked(scored: DataFrame, draw: int, total: int, segments: int) -> DataFrame:
    """The rows of runs with their ``rank``, null beyond the draw."""
    spark = scored.sparkSession
    rows = scored.filter("run IS NOT NULL")
    held = spark.sparkContext.broadcast(splitters(rows, total, segments))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = held.value
        for batch in batches:
            segment = np.searchsorted(cuts, keys_of(pa.Table.from_batches([batch])), side="right")
            yield batch.append_column("segment", pa.array(segment, pa.int32()))

    dealt = stored(mapped(rows, assign, SCORED + ", segment int"), "segments")
    counts = {row["segment"]: row["count"] for row in dealt.groupBy("segment").count().collect()}
    begins, seen = {}, 0
    for segment in sorted(counts):
        begins[segment], seen = seen, seen + counts[segment]
    last = max((segment for segment, begin in begins.items() if begin < draw), default=-1)
    prefix = spark.sparkContext.broadcast(begins)

    def merge(part: pa.Table) -> pa.Table:
        order = np.argsort(keys_of(part), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = prefix.value[part.column("segment")[0].as_py()] + 1 + np.arange(len(order))
        return part.select(OUT[:-1]).append_column("rank", pa.array(rank, pa.int64(), mask=rank > draw))

    exchanged = dealt.filter(F.col("segment") <= last).groupBy("segment").applyInArrow(merge, RANKED)
    rest = dealt.filter(F.col("segment") > last)
    return exchanged.unionByName(rest.select(*OUT[:-1], F.lit(None).cast("long").alias("rank")))


OUT = ["doc_id", "n_features", "weight", "score", "rank"]
RANKED = ", ".join(f"{name} long" for name in OUT)


def resample(
    docs: DataFrame, target: DataFrame, *, percent: int = 10, buckets: int = 10_000, grams: int = 1, min_words: int = 20, seed: int = 2024
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (1 is best; null if not drawn) for every row of ``docs``.

    ``target`` has a column ``text``.  Of the N rows with ``min_words`` words
    floor(percent N / 100) are drawn.
    """
    found = stored(bucketed(docs, buckets, grams), "feature-buckets")
    goal = bucketed(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, grams)
    gains = bucket_gains(bucket_counts(found, buckets), bucket_counts(goal, buckets))
    scored = stored(sorted_runs(found, gains, min_words=min_words, seed=seed), "sorted-runs")
    total = scored.filter("run IS NOT NULL").count()
    draw = percent * total // 100
    segments = max(partitions(docs.sparkSession), total // SEGMENT_ROWS + 1)
    few = scored.filter("run IS NULL").select(*OUT[:-1], F.lit(None).cast("long").alias("rank"))
    return few.unionByName(ranked(scored, draw, total, segments)) if total else few
