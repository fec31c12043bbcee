"""Connected components by alternating stars, each round written to the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again, which cuts their lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like :func:`stored`, with the path, for rows that are to be discarded later."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove rows written by :func:`kept_at` that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def state(edges: DataFrame) -> tuple:
    """Two numbers that stay the same only if the edges do."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node with an edge.

    ``edges`` has long columns ``a`` and ``b``.  A round joins each node's
    larger neighbours to its least one, then its smaller neighbours; the number
    of rounds grows with the logarithm of the longest path.  The least
    neighbours are written before they are joined, so that a node with very
    many neighbours is split over tasks.  Loops and repeated edges do no harm;
    no edges give no rows.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    edges = stored(edges.filter("a != b").select(hi, lo).distinct(), "edges")
    seen = state(edges)
    while seen[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stored(large, "large")
        least = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        joined = large.join(least, "hi")
        small = joined.filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = stored(small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
