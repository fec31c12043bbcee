"""The frontier of integer ids: ranges, the newest id, gaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlframe.operators import id_sets
from crawlframe.schemas import SITE_ID


def id_range(
    spark: SparkSession, start: int, end: int, step: int = -1, partitions: int | None = None
) -> DataFrame:
    """Ids from ``start`` to ``end``, both included, forwards or backwards."""
    if step == 0:
        raise ValueError("step must not be 0")
    stop = end + (1 if step > 0 else -1)
    return spark.range(start, stop, step, partitions)


def latest_id(attempts: DataFrame, column: str = SITE_ID) -> DataFrame:
    """One row ``latest_id``: the largest id of any status, null without rows."""
    return attempts.agg(F.max(column).alias("latest_id"))


def catch_up_ids(
    latest: DataFrame, on_site: DataFrame, ids_per_task: int = 1_000_000
) -> DataFrame:
    """Ids after the newest stored one up to the newest on the site.

    Both inputs have one row (``latest_id``, ``site_id``).  Nothing comes back
    when the table is up to date or either id is unknown.  The range is cut
    into slices that are spread over tasks before they are filled.
    """
    unknown = F.lit(None).cast("long")
    both = latest.select(F.col("latest_id").alias("lo"), unknown.alias("hi")).unionByName(
        on_site.select(unknown.alias("lo"), F.col("site_id").alias("hi"))
    )
    bounds = both.agg((F.max("lo") + 1).alias("lo"), F.max("hi").alias("hi"))
    return fill_ranges(bounds.filter("lo <= hi"), ids_per_task).select("id")


def fill_ranges(ranges: DataFrame, ids_per_slice: int = 1_000_000) -> DataFrame:
    """Every id of the inclusive ``lo, hi`` ranges, with its range's bounds."""
    slices = ranges.withColumn(
        "_at", F.explode(F.sequence("lo", "hi", F.lit(ids_per_slice).cast("long")))
    )
    # a stated number of partitions: adaptive execution would merge the few slices into one task
    tasks = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = slices.repartition(tasks, "_at")
    slice_end = F.least(F.col("_at") + F.lit(ids_per_slice - 1), F.col("hi"))
    return spread.select(F.explode(F.sequence("_at", slice_end)).alias("id"), "lo", "hi")


def missing_ids(ids: DataFrame, lo: int, hi: int, column: str = "id") -> DataFrame:
    """Ids of ``lo..hi`` without a row.

    Through a set of bitmaps: one per bucket of ids is shuffled, and of the
    expected range its bucket numbers alone.
    """
    number = F.col(column).cast("long")
    return id_sets.missing_ids(id_sets.id_set(ids.filter(number.between(lo, hi)), column), lo, hi)


def id_bounds(ids: DataFrame, column: str = "id") -> tuple[int, int] | None:
    """Smallest and largest id: two numbers, the only thing brought to the driver."""
    row = ids.agg(F.min(column), F.max(column)).first()
    return None if row[0] is None else (row[0], row[1])


def missing_ranges(
    ids: DataFrame,
    lo: int | None = None,
    hi: int | None = None,
    column: str = "id",
    bucket_width: int = 65_536,
) -> DataFrame:
    """Gaps between the ids as inclusive ``lo, hi, n``.

    With ``lo`` and ``hi`` the gaps before the first and after the last id of
    that range count too.  Each bucket of ``bucket_width`` ids is ordered on
    its own and hands its first and last id on; so do buckets of buckets, up to
    one that holds all.  With the default width at most 65,536 rows meet in a
    task after the first level, however sparse the ids are.
    """
    present = ids.select(F.col(column).cast("long").alias("id")).filter(F.col("id").isNotNull())
    if lo is not None:
        present = present.filter(F.col("id") >= lo)
    if hi is not None:
        present = present.filter(F.col("id") <= hi)
    # Guards just outside the range make the outer gaps ordinary ones.
    guards = [] if lo is None else [lo - 1]
    guards += [] if hi is None else [hi + 1]
    if guards:
        edge = ids.sparkSession.createDataFrame([(guard,) for guard in guards], "id long")
        present = present.unionByName(edge)
    level = present.select(F.col("id").alias("first"), F.col("id").alias("last"))
    gaps = []
    for width in [bucket_width, *(size for size in (1 << 32, 1 << 48) if size > bucket_width), None]:
        bucket = F.lit(0) if width is None else F.expr(f"first div {width}")
        level = level.withColumn("_part", bucket.cast("long"))
        walk = Window.partitionBy("_part").orderBy("first")
        before = level.withColumn("_before", F.lag("last").over(walk))
        gaps.append(
            before.select((F.col("_before") + 1).alias("lo"), (F.col("first") - 1).alias("hi"))
        )
        level = level.groupBy("_part").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    gap = reduce(DataFrame.unionByName, gaps)
    return gap.filter("lo <= hi").withColumn("n", F.col("hi") - F.col("lo") + 1)
