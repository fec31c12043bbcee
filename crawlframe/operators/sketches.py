"""Distinct counts that are stored, merged and compared: theta sketches per group.

A sketch of ``2 ** lg_k`` entries is exact up to that many distinct values;
beyond, a union's estimate has a relative standard error of
``1 / sqrt(2 ** lg_k)`` (0.0055 at the default), and an intersection or a
difference one that is larger by the square root of union over result.
Sketches are built by map-side aggregation: a shuffle carries one per group
and task, of 8 bytes an entry at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 15


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of one sketch or a union of sketches."""
    return 1 / math.sqrt(1 << lg_k)


def distinct_sketches(rows: DataFrame, by: list[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """``by, sketch``: the distinct values of each group, to be kept as a table."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.theta_sketch_agg(value, lg_k).alias("sketch"))


def merged_counts(sketches: DataFrame, by: list[str], lg_k: int = LG_K) -> DataFrame:
    """``by, n_distinct`` of the unions of all sketches of a coarser group."""
    merged = sketches.groupBy(*by).agg(F.theta_union_agg("sketch", lg_k).alias("sketch"))
    return merged.select(*by, _count(F.col("sketch")).alias("n_distinct"))


def compared_counts(left: DataFrame, right: DataFrame, by: list[str], lg_k: int = LG_K) -> DataFrame:
    """``by, n_left, n_right, n_both, n_either, n_left_only`` of two tables with one sketch per group.

    Groups that one side lacks are empty there.
    """
    both = left.select(*by, F.col("sketch").alias("_a")).join(right.select(*by, F.col("sketch").alias("_b")), by, "full")
    a, b = F.col("_a"), F.col("_b")
    met = a.isNotNull() & b.isNotNull()
    n_a, n_b = (F.coalesce(_count(one), F.lit(0).cast("long")) for one in (a, b))
    shared = F.when(met, _count(F.theta_intersection(a, b))).otherwise(F.lit(0).cast("long"))
    either = F.when(met, _count(F.theta_union(a, b, F.lit(lg_k)))).otherwise(n_a + n_b)
    rest = F.when(met, _count(F.theta_difference(a, b))).otherwise(n_a)
    return both.select(
        *by, n_a.alias("n_left"), n_b.alias("n_right"), shared.alias("n_both"), either.alias("n_either"), rest.alias("n_left_only")
    )


def merged_sketches(sketches: DataFrame, by: list[str], lg_k: int = LG_K) -> DataFrame:
    """``by, sketch``: sketches of a coarser group."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("sketch", lg_k).alias("sketch"))


def _count(sketch: Column) -> Column:
    return F.theta_sketch_estimate(sketch).cast("long")
