"""Sets of integer ids as bitmaps, one per bucket of :data:`WIDTH` ids.

A set is a table ``bucket, bitmap``; bit ``k`` of a bucket's bitmap stands for
the id ``bucket * WIDTH + k``.  Bitmaps are built and joined by map-side
aggregation, so a shuffle carries at most one of them per bucket and task,
whatever the number of rows, and a sparse one shrinks to its few set bytes.
Sets kept as tables are merged, compared and complemented without the rows
they came from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids in a bucket: the size of Spark's bitmaps.
SHIFT = 15
WIDTH = 1 << SHIFT
SET = "bucket long, bitmap binary"
# Buckets in one Arrow batch of ids.
_BUCKETS = 8


def id_set(ids: DataFrame, column: str = "id") -> DataFrame:
    """The ids of a table as a set; null is no id, an id that comes often is one bit."""
    number = F.col(column).cast("long")
    place = F.pmod(number, F.lit(WIDTH))
    known = ids.filter(number.isNotNull())
    return known.groupBy(F.shiftright(number, SHIFT).alias("bucket")).agg(
        F.bitmap_construct_agg(place).alias("bitmap")
    )


def merge_sets(*sets: DataFrame) -> DataFrame:
    """The union of sets."""
    rows = reduce(DataFrame.unionByName, sets)
    return rows.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_ids(members: DataFrame) -> DataFrame:
    """One row ``n_ids``."""
    return members.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("n_ids"))


def _bits(bitmap: bytes | None) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bitmap or bytes(WIDTH // 8), np.uint8), bitorder="little").astype(bool)


def _listed(pairs: DataFrame, choose: Callable[[np.ndarray, np.ndarray], np.ndarray], lo: int | None, hi: int | None) -> DataFrame:
    """``id`` of the bits that ``choose`` takes from the bitmaps ``left, right`` of each bucket."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BUCKETS):
                found = []
                for bucket, left, right in zip(*(column.to_pylist() for column in batch.slice(at, _BUCKETS).columns)):
                    numbers = bucket * WIDTH + np.flatnonzero(choose(_bits(left), _bits(right)))
                    if lo is not None:
                        numbers = numbers[numbers >= lo]
                    found.append(numbers if hi is None else numbers[numbers <= hi])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int64())], names=["id"])

    return pairs.select("bucket", "left", "right").mapInArrow(ids, "id long")


def list_ids(members: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """The ids of a set, or those of a range."""
    one = members.select("bucket", F.col("bitmap").alias("left"), F.lit(None).cast("binary").alias("right"))
    return _listed(one, lambda left, right: left, lo, hi)


def _both(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    return left.select("bucket", F.col("bitmap").alias("left")).join(
        right.select("bucket", F.col("bitmap").alias("right")), "bucket", how
    )


def ids_without(members: DataFrame, others: DataFrame) -> DataFrame:
    """``id`` of those in the first set and not in the second; bitmaps meet, not ids."""
    return _listed(_both(members, others, "left"), lambda left, right: left & ~right, None, None)


def ids_in_both(members: DataFrame, others: DataFrame) -> DataFrame:
    """``id`` of those in both sets."""
    return _listed(_both(members, others, "inner"), lambda left, right: left & right, None, None)


def missing_ids(members: DataFrame, lo: int, hi: int) -> DataFrame:
    """``id`` of those from ``lo`` to ``hi`` that are not in the set.

    The complement: the range is expected as its buckets, not as its ids.
    """
    expected = members.sparkSession.range(lo // WIDTH, hi // WIDTH + 1).select(F.col("id").alias("bucket"))
    pairs = expected.join(members.select("bucket", F.col("bitmap").alias("left")), "bucket", "left")
    return _listed(pairs.withColumn("right", F.lit(None).cast("binary")), lambda left, right: ~left, lo, hi)


def bucket_coverage(members: DataFrame, lo: int, hi: int) -> DataFrame:
    """``bucket, first_id, last_id, n_expected, n_present`` of each bucket of a range: where the holes are, without listing them.

    Ids of the set that lie outside the range in its first and last bucket are counted out by masks.
    """
    spark, first, last = members.sparkSession, F.col("bucket") * WIDTH, F.col("bucket") * WIDTH + (WIDTH - 1)
    expected = spark.range(lo // WIDTH, hi // WIDTH + 1).select(F.col("id").alias("bucket"))
    begin, end = F.greatest(first, F.lit(lo)), F.least(last, F.lit(hi))
    whole = (F.col("bucket") * WIDTH >= lo) & (last <= hi)
    edges = list_ids(members.filter(F.col("bucket").isin(lo // WIDTH, hi // WIDTH)), lo, hi)
    inside = edges.groupBy(F.shiftright("id", SHIFT).alias("bucket")).agg(F.count("*").alias("n_edge"))  # two rows
    counted = members.select("bucket", F.bitmap_count("bitmap").alias("n_all"))
    rows = expected.join(counted, "bucket", "left").join(F.broadcast(inside), "bucket", "left")
    present = F.coalesce(F.when(whole, F.col("n_all")).otherwise(F.col("n_edge")), F.lit(0))
    return rows.select(
        "bucket", begin.alias("first_id"), end.alias("last_id"), (end - begin + 1).alias("n_expected"), present.alias("n_present")
    )

