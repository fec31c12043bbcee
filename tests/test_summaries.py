"""Sketches and summaries against exact counts."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crawlframe.operators import heavy, sketches
from tests.conftest import explained


def pairs(spark, rows):
    return spark.createDataFrame(rows, "role string, name string").repartition(4)


def by_hand(rows, k):
    out = []
    for role in sorted({r for r, n in rows if r is not None}):
        counts = Counter(n for r, n in rows if r == role and n is not None)
        best = sorted(counts.items(), key=lambda one: (-one[1], one[0]))[:k]
        out += [(role, name, count, rank) for rank, (name, count) in enumerate(best, 1)]
    return sorted(out)


def skewed(n, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), f"n{int(rng.paretovariate(0.7))}") for _ in range(n)]
    return rows + [(None, "x"), ("a", None), ("c", "only"), ("c", "two")]


@pytest.mark.parametrize("capacity, most", [(20_000, 100_000), (400, 100_000), (20, 100_000), (400, 3)])
def test_heavy_hitters(spark, monkeypatch, capacity, most):
    rows = [row for row in skewed(30_000) if capacity > 400 or row[0] != "c"]
    whole = []
    plain = heavy.top_values
    monkeypatch.setattr(heavy, "top_values", lambda *a, **b: whole.append(1) or plain(*a, **b))
    found = heavy.heavy_hitters(pairs(spark, rows), "role", "name", 5, capacity, most=most)
    assert found.columns == ["role", "name", "n_rows", "rank"]
    assert sorted(map(tuple, found.collect())) == by_hand(rows, 5)
    if capacity >= 400:
        assert bool(whole) == (most == 3)


@pytest.mark.parametrize("rows", [[], [("a", "x")] * 3, [("a", f"n{k}") for k in range(5000)]])
def test_few_and_flat_counts(spark, rows):
    for capacity in (100, 10_000):
        found = heavy.heavy_hitters(pairs(spark, rows), "role", "name", 3, capacity)
        assert sorted(map(tuple, found.collect())) == by_hand(rows, 3)


def test_summaries_are_short_by_no_more_than_they_say(spark):
    rows = [row for row in skewed(20_000, 3) if None not in row]
    got = heavy.frequent_summaries(pairs(spark, rows), "role", "name", 200).collect()
    off = sum(row.off for row in got)
    low = Counter()
    for row in got:
        if row.val is not None:
            low[row.grp, row.val] += row.low
    true = Counter(rows)
    assert 0 < off <= 2 * len(rows) / 200 * 1.01 and len(got) <= 4 * 201
    assert all(low[key] <= n <= low[key] + off for key, n in true.items())


def test_fewer_rows_are_shuffled(spark):
    rows = spark.range(0, 400_000, 1, 4).select(
        F.lit("a").alias("role"), F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(F.col("id")).cast("string").alias("name")
    )
    found = heavy.heavy_hitters(rows, "role", "name", 5, 2000)
    assert sorted(found.collect()) == sorted(heavy.top_values(rows, "role", "name", 5).collect())
    summary = heavy.frequent_summaries(rows, "role", "name", 2000).count()
    assert summary <= 4 * 2001 < 250_000 < rows.distinct().count()
    plan = explained(heavy.heavy_hitters(rows, "role", "name", 5, 500_000, most=10**6))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_sketches_within_their_bound(spark):
    rows = spark.range(0, 300_000).select((F.col("id") % 3).alias("day"), F.lit("r").alias("role"), (F.col("id") % 100_000).alias("user"))
    rows = rows.unionByName(spark.createDataFrame([(0, "r", None), (0, "s", 1)], "day long, role string, user long"))
    made = sketches.distinct_sketches(rows, ["role", "day"], "user", lg_k=12).cache()
    total = {row.role: row.n_distinct for row in sketches.merged_counts(made, ["role"], lg_k=12).collect()}
    bound = 4 * sketches.standard_error(12)
    assert abs(total["r"] / 100_000 - 1) <= bound and total["s"] == 1
    left, right = (sketches.merged_sketches(made.filter(F.col("day") == k), ["role"], 12) for k in (0, 1))
    row = sketches.compared_counts(left, right, ["role"], 12).filter("role = 'r'").first()
    per_day = rows.filter("role = 'r'").groupBy("day").agg(F.count_distinct("user").alias("n")).collect()
    exact = {one.day: one.n for one in per_day}
    both = rows.filter("day = 0").select("user").intersect(rows.filter("day = 1").select("user")).filter("user IS NOT NULL").count()
    either = exact[0] + exact[1] - both
    assert abs(row.n_left / exact[0] - 1) <= bound and abs(row.n_right / exact[1] - 1) <= bound
    assert abs(row.n_either / either - 1) <= bound
    assert abs(row.n_both - both) <= bound * math.sqrt(either * max(both, 1)) and abs(row.n_left_only - (exact[0] - both)) <= bound * math.sqrt(either * max(exact[0] - both, 1))
    lone = sketches.compared_counts(left, right.limit(0), ["role"], 12).filter("role = 's'").first()
    assert tuple(lone) == ("s", 1, 0, 0, 1, 1)
    assert made.filter(F.octet_length("sketch") > 8 * 4096 + 64).isEmpty()
    made.unpersist()
