"""Bitmaps of ids against Python sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from crawlframe.operators import frontier, id_sets
from tests.conftest import explained

WIDTH = id_sets.WIDTH


def id_table(spark, ids):
    return spark.createDataFrame([(k,) for k in ids], "id long").repartition(3)


def listed(rows):
    return sorted(row[0] for row in rows.collect())


def some_ids(kind):
    rng = random.Random(kind)
    if kind == "dense":
        return [k for k in range(-5, 3 * WIDTH) if rng.random() < 0.97] * 2
    if kind == "sparse":
        return [rng.randrange(-(1 << 62), 1 << 62) for _ in range(300)] + [0, -1, WIDTH, WIDTH - 1, (1 << 63) - 1, -(1 << 63)]
    return []


@pytest.mark.parametrize("kind", ["dense", "sparse", "none"])
def test_sets_hold_their_ids(spark, kind):
    ids = some_ids(kind)
    members = id_sets.id_set(id_table(spark, ids + [None]))
    assert listed(id_sets.list_ids(members)) == sorted(set(ids))
    assert id_sets.count_ids(members).first().n_ids == len(set(ids))
    assert members.select("bucket").distinct().count() == members.count()
    assert members.filter(F.octet_length("bitmap") > WIDTH // 8).isEmpty()


def test_operations(spark):
    rng = random.Random(1)
    a, b, c = ({rng.randrange(-2 * WIDTH, 5 * WIDTH) for _ in range(20_000)} | {rng.randrange(1 << 50)} for _ in range(3))
    sets = [id_sets.id_set(id_table(spark, some)) for some in (a, b, c)]
    assert listed(id_sets.list_ids(id_sets.merge_sets(*sets))) == sorted(a | b | c)
    assert listed(id_sets.ids_without(sets[0], sets[1])) == sorted(a - b)
    assert listed(id_sets.ids_in_both(sets[0], sets[1])) == sorted(a & b)
    assert listed(id_sets.list_ids(sets[2], 7, 2 * WIDTH)) == sorted(k for k in c if 7 <= k <= 2 * WIDTH)


@pytest.mark.parametrize("lo, hi", [(0, 10), (-WIDTH, WIDTH - 1), (5, 4 * WIDTH + 3), (WIDTH, WIDTH), (9, 8), (7 * WIDTH, 8 * WIDTH)])
def test_missing_ids(spark, lo, hi):
    ids = set(some_ids("dense"))
    rows = frontier.missing_ids(id_table(spark, ids), lo, hi)
    assert rows.columns == ["id"] and listed(rows) == sorted(set(range(lo, hi + 1)) - ids)
    cover = id_sets.bucket_coverage(id_sets.id_set(id_table(spark, ids)), lo, hi).collect() if lo <= hi else []
    for row in cover:
        inside = set(range(row.first_id, row.last_id + 1))
        assert (row.n_expected, row.n_present) == (len(inside), len(inside & ids))
    assert sum(row.n_expected for row in cover) == max(0, hi - lo + 1)


def test_no_range_of_ids_is_shuffled(spark):
    rows = frontier.missing_ids(spark.range(0, 1 << 22, 3, 4), 0, 1 << 22)
    plan = explained(rows)
    assert "Range (0, 129" in plan and "Range (0, 4194305" not in plan
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "hashpartitioning(" in line]
    assert exchanged and all("bucket" in line or "shiftright" in line or "_groupingexpression" in line for line in exchanged)
    assert "partial_bitmap_construct_agg" in plan
