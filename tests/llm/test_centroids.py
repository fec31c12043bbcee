"""Exact k-means against brute force, and the bounds it rests on."""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlframe.llm import centroids
from crawlframe.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def brute_force(rows, k=40, rounds=5, dim=64):
    kept = []
    for key, values in rows:
        if values is not None and len(values) == dim and all(x is not None and math.isfinite(x) for x in values):
            kept.append((key, [math.floor(256 * Fraction(x)) for x in values]))
    name = lambda row: (hashlib.sha256(f"2:{'' if row[0] is None else row[0]}".encode()).hexdigest(), np.array(row[1], "<i4").tobytes())
    middle = [row[1] for row in sorted(kept, key=name)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), number) for number, c in enumerate(middle))

    for _ in range(rounds):
        groups = [[] for _ in middle]
        for _, x in kept:
            groups[nearest(x)[1]].append(x)
        middle = [[sum(column) // len(group) for column in zip(*group)] if group else c for group, c in zip(groups, middle)]
    found = [(key, *nearest(x)) for key, x in kept]
    total = [sum(d for _, d, c in found if c == number) for number in range(len(middle))]
    return sorted(
        ((key, c, d, total[c], sum(total), hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest()) for key, d, c in found), key=repr
    )


def vectors(n, groups, seed=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (groups, 64))
    rows = [(k, [float(x) for x in middle[k % groups] + rng.normal(0, 0.1, 64)]) for k in range(n)]
    return [(k, np.float32(x).astype(float).tolist()) for k, x in rows]


def frame(spark, rows, cluster=7):
    return spark.createDataFrame([(*row, cluster, "p") for row in rows], "vec_id long, embedding array<float>, cluster int, `a.b` string")


@pytest.mark.parametrize("groups", [3, 60])
def test_clusters_by_brute_force(spark, groups):
    rows = vectors(150, groups)
    rows += [rows[3]] * 5 + [(None, rows[7][1]), (3, rows[9][1])]
    odd = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [1.0] * 63), (905, [float("nan")] * 64), (906, [float("inf")] + [0.0] * 63)]
    odd += [(907, [-0.001] * 64), (908, [0.0] * 64), (909, [1e5] * 64), (910, [-1e5] + [3e4] * 63)]
    found = centroids.cluster_vectors(frame(spark, rows + odd))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows + odd)


def test_few_vectors(spark):
    for rows in ([], vectors(1, 1), vectors(5, 5), [(1, [0.5] * 64)] * 50):
        assert sorted(map(tuple, centroids.cluster_vectors(frame(spark, rows)).collect()), key=repr) == brute_force(rows)
    assert centroids.cluster_vectors(frame(spark, [(1, [1e30] * 64)])).collect() == []


def test_clusters_of_a_table(spark):
    rows = [(row.vec_id, row.embedding) for row in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op11_centroids"](spark, SF).collect()), key=repr) == brute_force(rows)
    assert "op11_centroids" in ORACLES


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_bounds_hold_and_give_way_less_than_the_drift(seed):
    rng = np.random.default_rng(seed)
    k, dim, size = 6, 5, int(rng.integers(1, 200))
    old = rng.integers(-300, 300, (k, dim))
    new = old + rng.integers(-size, size + 1, (k, dim)) * (rng.random((k, 1)) < 0.8)
    cluster = rng.integers(0, k, 400)
    rows = old[cluster] + rng.integers(-60, 61, (400, dim))
    far = np.sqrt(centroids.squared(rows, old).astype(float))
    radius = np.array([far[cluster == c, c].max(initial=0) for c in range(k)])
    loosen = centroids.loosening(old, new, radius)
    drift = np.sqrt(((new - old) ** 2).sum(axis=1))
    assert (loosen <= drift.max() + 1e-4).all()
    after = np.sqrt(centroids.squared(rows, new).astype(float))
    others = np.arange(k)[None, :] != cluster[:, None]
    before = np.where(others, far, np.inf).min(axis=1)
    assert (np.where(others, after, np.inf).min(axis=1) >= before - loosen[cluster] - 1e-6).all()


def test_most_vectors_are_not_scanned():
    rows = np.floor(256 * np.array([values for _, values in vectors(4000, 20)])).astype(np.int64)
    rng = np.random.default_rng(1)
    now = centroids.Round(rows[rng.choice(4000, 40, replace=False)], np.zeros(40))
    cluster, lower = np.full(4000, -1), np.zeros(4000)
    scanned = []
    for _ in range(6):
        cluster, lower, own, n = centroids.assign(rows, cluster, lower, now)
        scanned.append(n)
        assert (cluster == centroids.squared(rows, now.centroids).argmin(axis=1)).all()
        means = np.array([rows[cluster == c].sum(axis=0) // max(1, (cluster == c).sum()) if (cluster == c).any() else now.centroids[c] for c in range(40)])
        radius = np.array([np.sqrt(own[cluster == c].max(initial=0)) for c in range(40)])
        now = centroids.Round(means, centroids.loosening(now.centroids, means, radius))
    assert scanned[0] == 4000 and scanned[-1] < 2000


def test_large_components_are_exact():
    rows = np.array([[1 << 26, -(1 << 26)], [(1 << 26) - 1, 5]], np.int64)
    wanted = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)) for c in rows] for x in rows]
    assert centroids.squared(rows, rows).tolist() == wanted
