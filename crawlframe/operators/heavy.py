"""The most frequent values, exactly, in two passes and without shuffling every value.

The first pass keeps, per task, a summary of ``capacity`` counters: when they
are full, the middle count is taken off all of them and those at zero go.  The
sum of what was taken off bounds how much any count can be short, at most
``2 n / capacity`` of ``n`` rows.  Summaries are added up; the values whose
upper bound reaches the ``k``-th lower bound of their group are candidates.
The second pass counts only those, in the scan.  The result is certain if the
``k``-th exact count is above the bound for values that no summary holds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.session import scratch_path

SUMMARY = "grp string, val string, low long, off long"


def frequent_summaries(rows: DataFrame, group: str, value: str, capacity: int) -> DataFrame:
    """``grp, val, low`` of each task's counters, and one row per task with ``off``, its largest shortfall."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        off = 0
        for batch in batches:
            counts.update(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            if len(counts) > capacity:
                cut = sorted(counts.values(), reverse=True)[capacity // 2]
                off += cut
                counts = Counter({key: n - cut for key, n in counts.items() if n > cut})
        keys = list(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "grp": pa.array([key[0] for key in keys] + [None], pa.string()),
                "val": pa.array([key[1] for key in keys] + [None], pa.string()),
                "low": pa.array([*counts.values(), 0], pa.int64()),
                "off": pa.array([0] * len(keys) + [off], pa.int64()),
            }
        )

    known = rows.select(F.col(group).cast("string"), F.col(value).cast("string")).filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    return known.mapInArrow(summarise, SUMMARY)


def top_values(rows: DataFrame, group: str, value: str, k: int, n: str = "n_rows") -> DataFrame:
    """``group, value, n, rank`` by counting all values: per group the ``k`` most frequent, values in order on equal counts."""
    known = rows.select(F.col(group).cast("string").alias(group), F.col(value).cast("string").alias(value))
    counted = known.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group, value).agg(F.count("*").alias(n))
    return _ranked(counted, group, value, k, n)


def _ranked(counted: DataFrame, group: str, value: str, k: int, n: str) -> DataFrame:
    order = Window.partitionBy(group).orderBy(F.col(n).desc(), value)
    ranked = counted.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))


def heavy_hitters(
    rows: DataFrame, group: str, value: str, k: int, capacity: int = 20_000, n: str = "n_rows", most: int = 100_000
) -> DataFrame:
    """The rows of :func:`top_values`, through summaries.

    ``rows`` is read twice.  At most ``most`` candidates (counted) are
    broadcast; with more of them, or where counts are so flat that the
    summaries cannot be certain, all values are counted instead.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "summaries")
    frequent_summaries(rows, group, value, capacity).write.parquet(path)
    stored = spark.read.schema(SUMMARY).parquet(path)
    off = stored.agg(F.sum("off")).first()[0] or 0
    merged = stored.filter("val IS NOT NULL").groupBy("grp", "val").agg(F.sum("low").alias("low"))
    best = _ranked(merged.select("grp", "val", "low"), "grp", "val", k, "low")
    least = best.groupBy("grp").agg(F.when(F.count("*") == k, F.min("low")).otherwise(0).alias("least"))
    candidates = merged.join(least, "grp").filter(F.col("low") + off >= F.col("least")).select("grp", "val")
    candidates.write.parquet(f"{path}-candidates")
    chosen = spark.read.schema("grp string, val string").parquet(f"{path}-candidates")
    if chosen.count() > most:
        return top_values(rows, group, value, k, n)
    known = rows.select(F.col(group).cast("string").alias(group), F.col(value).cast("string").alias(value))
    counted = known.join(F.broadcast(chosen.toDF(group, value)), [group, value], "left_semi").groupBy(group, value).agg(F.count("*").alias(n))
    if off:
        _ranked(counted, group, value, k, n).write.parquet(f"{path}-top")
        top = spark.read.schema(f"`{group}` string, `{value}` string, `{n}` long, rank long").parquet(f"{path}-top")
        flat = top.groupBy(group).agg(F.min(n).alias("least"), F.count("*").alias("found")).filter(
            (F.col("least") <= off) | (F.col("found") < k)
        )
        unseen = known.select(group).filter(F.col(group).isNotNull() & known[value].isNotNull()).distinct().join(top.select(group).distinct(), group, "left_anti")
        return top if flat.isEmpty() and unseen.isEmpty() else top_values(rows, group, value, k, n)
    return _ranked(counted, group, value, k, n)
