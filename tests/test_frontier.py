from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from crawlframe.operators import frontier as R
from crawlframe.plans.catch_up import catch_up_messages, newest_on_site


def listed(df):
    return [row[0] for row in df.collect()]


@pytest.mark.parametrize(
    "start, end, step, ids",
    [(10, 7, -1, [10, 9, 8, 7]), (1, 10, 3, [1, 4, 7, 10]), (10, 4, -2, [10, 8, 6, 4]),
     (5, 5, 1, [5]), (5, 4, 1, []), (1, 9, 3, [1, 4, 7])],
)
def test_id_range(spark, start, end, step, ids):
    assert sorted(listed(R.id_range(spark, start, end, step)), reverse=step < 0) == ids


def test_step_zero_is_refused(spark):
    with pytest.raises(ValueError):
        R.id_range(spark, 1, 2, 0)


def id_table(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


@pytest.mark.parametrize(
    "stored, site, ids",
    [([5, 9, 2], 12, [10, 11, 12]), ([5, 9], 9, []), ([9], 3, []), ([], 3, []), ([4], None, [])],
)
def test_catch_up(spark, stored, site, ids):
    latest = R.latest_id(id_table(spark, stored), "id")
    on_site = spark.createDataFrame([(site,)], "site_id long")
    assert sorted(listed(R.catch_up_ids(latest, on_site, 2))) == ids


def test_catch_up_messages_from_a_front_page(spark):
    html = '<p id="gallery-frontpage-submissions"><figure><a href="/view/7/"></a></figure></p>'
    page = spark.createDataFrame([(1, html)], "page_id long, html string")
    messages = catch_up_messages(id_table(spark, [4]), newest_on_site(page), "id")
    assert sorted(bytes(r.value) for r in messages.collect()) == [b"5", b"6", b"7"]


def brute_gaps(ids, lo, hi):
    inside = {i for i in ids if i is not None and (lo is None or i >= lo) and (hi is None or i <= hi)}
    if lo is not None:
        inside.add(lo - 1)
    if hi is not None:
        inside.add(hi + 1)
    ordered = sorted(inside)
    return sorted((a + 1, b - 1, b - a - 1) for a, b in zip(ordered, ordered[1:]) if b - a > 1)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("lo, hi", [(None, None), (0, 120), (-20, 300), (0, None)])
def test_missing_ranges_against_brute_force(spark, seed, lo, hi):
    rng = random.Random(seed)
    # One id repeated often, a cluster, a far outlier, a null.
    ids = [rng.randrange(-10, 100) for _ in range(40)] + [7] * 50 + [5000, None]
    found = R.missing_ranges(id_table(spark, ids), lo, hi, bucket_width=8)
    assert sorted(tuple(r) for r in found.select("lo", "hi", "n").collect()) == brute_gaps(ids, lo, hi)


def test_missing_ranges_without_ids(spark):
    assert R.missing_ranges(id_table(spark, [])).count() == 0
    assert [tuple(r) for r in R.missing_ranges(id_table(spark, []), 3, 9).collect()] == [(3, 9, 7)]


def test_missing_ids_and_filled_ranges_agree(spark):
    ids = id_table(spark, [3, 3, 4, 9, 20, 41])
    direct = sorted(listed(R.missing_ids(ids, 0, 50)))
    gaps = R.missing_ranges(ids, 0, 50, bucket_width=4)
    assert direct == sorted(listed(R.fill_ranges(gaps, 3).select("id")))
    assert direct == [i for i in range(51) if i not in (3, 4, 9, 20, 41)]


def test_id_bounds(spark):
    assert R.id_bounds(id_table(spark, [4, None, 9])) == (4, 9)
    assert R.id_bounds(id_table(spark, [])) is None


def test_latest_id_of_nothing_is_null(spark):
    assert R.latest_id(id_table(spark, []).withColumnRenamed("id", "site_submission_id")).first()[0] is None


def test_catch_up_ids_lie_in_many_tasks(spark):
    latest = spark.createDataFrame([(0,)], "latest_id long")
    on_site = spark.createDataFrame([(4_000_000,)], "site_id long")
    ids = R.catch_up_ids(latest, on_site, 100_000)
    tasks = ids.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(row["count"] for row in tasks) == 4_000_000 and len(tasks) > 2


def test_gaps_of_sparse_ids(spark):
    ids = spark.range(20_000).select((F.col("id") * 1_000_003 - 7_000_000_000).alias("id"))
    gaps = R.missing_ranges(ids)
    assert gaps.count() == 19_999
    assert gaps.agg(F.sum("n")).first()[0] == 19_999 * 1_000_002
