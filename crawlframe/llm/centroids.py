"""k-means on integer vectors, exact in every round, with bounds loosened by planar geometry.

Components become integers; sums, floored means and squared distances are
exact.  A vector keeps its cluster and a lower bound on its distance to any
other centroid.  When the centroids move, the bound must give way, but by less
than the largest drift: a cluster's vectors lie in a sphere around its centroid,
and what a moving centroid can gain on any point of the sphere is settled in
the plane through the sphere's centre and the centroid's old and new place.
From the old place the sphere is seen under the angle ``phi`` to the way the
centroid takes, with half-width ``alpha``; as the angle to a point only grows on
that way, the gain is at most drift * cos(max(0, phi - alpha)), and the whole
drift only for a sphere that lies ahead or holds the old place.  It is negative
for spheres left behind, whose bounds rise.

A vector whose exact distance to its own centroid is below the bound stays; the
others are ambiguous and scanned exactly against all centroids.  Per round the
driver gets sums of moved vectors and radii, a row per cluster and component.

Vectors are kept if they have ``dim`` components, none null, NaN, infinite or
of ``LIMIT`` or more (squared distances would not fit a long).  Equal distances
go to the smaller centroid number.  Repeated rows each count; a null ``vec_id``
hashes as if it were empty.  With fewer vectors than ``k`` there are as many centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.batches import mapped, run_starts
from crawlframe.llm.components import discard, kept_at

LIMIT = 1 << 18
STATE = "vec_id long, vector binary, cluster int, before int, lower double, distance long"


@dataclass
class Round:
    """Centroids, and by how much each cluster's lower bounds give way."""

    centroids: np.ndarray
    loosen: np.ndarray


def integer_vectors(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """vec_id and floor(scale * x) of the kept vectors, four bytes a component."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float(LIMIT))))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("embedding").flatten(), float).reshape(-1, dim)
            made = np.floor(scale * x).astype("<i4")
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "vector": pa.array([row.tobytes() for row in made], pa.binary())})

    return mapped(rows.filter((F.size("embedding") == dim) & fine), floor, "vec_id long, vector binary")


def squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    top = max(np.abs(rows).max(initial=0), np.abs(centroids).max(initial=0))
    if rows.shape[1] * int(top) ** 2 >= 1 << 50:  # beyond that doubles would round
        return np.stack([((rows - centroid) ** 2).sum(axis=1) for centroid in centroids], axis=1)
    x, c = rows.astype(float), centroids.astype(float)
    return ((x**2).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c**2).sum(axis=1)).astype(np.int64)


def assign(rows: np.ndarray, cluster: np.ndarray, lower: np.ndarray, now: Round) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """New clusters, lower bounds and squared distances, and how many rows were scanned."""
    known = cluster >= 0
    own = np.zeros(len(rows), np.int64)
    own[known] = ((rows[known] - now.centroids[cluster[known]]) ** 2).sum(axis=1)
    lower = np.where(known, lower - now.loosen[cluster], 0.0)
    safe = known & (np.sqrt(own.astype(float)) < lower - 1e-6 - 1e-9 * np.abs(lower))
    scan = np.flatnonzero(~safe)
    cluster = cluster.copy()
    for at in range(0, len(scan), 1 << 14):
        some = scan[at : at + (1 << 14)]
        far = squared(rows[some], now.centroids)
        best = far.argmin(axis=1)
        cluster[some], own[some] = best, far[np.arange(len(some)), best]
        far[np.arange(len(some)), best] = np.iinfo(np.int64).max
        lower[some] = np.sqrt(far.min(axis=1).astype(float)) if far.shape[1] > 1 else np.inf
    return cluster, lower, own, len(scan)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster the most that any other centroid has gained on a point of its sphere."""
    k = len(old)
    way = (new - old).astype(float)
    drift = np.sqrt((way**2).sum(axis=1))
    found = np.full(k, -np.inf)
    for i in range(k):
        to = (old[i] - old).astype(float)
        far = np.sqrt((to**2).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            phi = np.arccos(np.clip((to * way).sum(axis=1) / (far * drift), -1, 1))
            alpha = np.arcsin(np.clip(radius[i] / far, 0, 1))
            gain = drift * np.cos(np.maximum(0, phi - alpha))
        gain = np.where(far <= radius[i], drift, np.where(drift == 0, 0.0, gain))
        gain[i] = -np.inf
        found[i] = gain.max() + 1e-7 * (1 + drift.max()) if k > 1 else 0.0
    return found


def next_state(state: DataFrame, now: Round, dim: int, name: str) -> tuple[DataFrame, str]:
    """The state after one assignment, written, and where."""
    held = state.sparkSession.sparkContext.broadcast(now)  # k * dim numbers

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)
            before = batch.column("cluster").to_numpy().astype(np.int64)
            cluster, lower, distance, _ = assign(rows, before, batch.column("lower").to_numpy(), held.value)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"),
                    "vector": batch.column("vector"),
                    "cluster": pa.array(cluster, pa.int32()),
                    "before": batch.column("cluster"),
                    "lower": pa.array(lower, pa.float64()),
                    "distance": pa.array(distance, pa.int64()),
                }
            )

    return kept_at(mapped(state.select("vec_id", "vector", "cluster", "lower"), step, STATE), name)


def moved_sums(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that changed cluster add to sums and counts, less what they take away."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)
            rows = np.column_stack([rows, np.ones(len(rows), np.int64)])
            for name, sign in (("cluster", 1), ("before", -1)):
                of = batch.column(name).to_numpy()
                order = np.argsort(of, kind="stable")
                begins = run_starts(of[order])
                if len(begins):
                    sums = np.add.reduceat(rows[order], begins)
                    clusters = of[order][begins]
                    total[clusters[clusters >= 0]] += sign * sums[clusters >= 0]
        cluster, place = np.nonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(cluster, pa.int32()), "place": pa.array(place, pa.int32()), "n": pa.array(total[cluster, place], pa.int64())}
        )

    moved = state.filter("cluster <> before").select("vector", "cluster", "before")
    found = mapped(moved, add, "cluster int, place int, n long").groupBy("cluster", "place").agg(F.sum("n").alias("n"))
    total = np.zeros((k, dim + 1), np.int64)
    for row in found.collect():  # k * (dim + 1) rows at most
        total[row["cluster"], row["place"]] = row["n"]
    return total[:, :dim], total[:, dim]


def radii(state: DataFrame, k: int) -> np.ndarray:
    """The largest distance of a cluster's vectors from their centroid."""
    found = np.zeros(k)
    for row in state.groupBy("cluster").agg(F.max("distance").alias("far")).collect():
        found[row["cluster"]] = np.sqrt(float(row["far"])) * (1 + 1e-12)
    return found


def cluster_vectors(vectors: DataFrame, *, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every kept row of ``vectors`` (vec_id, embedding).

    The first centroids are the ``k`` vectors whose SHA-256 of ``seed:vec_id``
    is smallest; rows that share a ``vec_id`` follow in the order of their bytes.
    """
    spark = vectors.sparkSession
    kept, path = kept_at(integer_vectors(vectors, dim, scale), "integer-vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(name, "vector").limit(k).collect()
    centroids = np.array([np.frombuffer(row["vector"], "<i4") for row in first], np.int64).reshape(-1, dim)
    n = len(centroids)
    state = kept.select("vec_id", "vector", F.lit(-1).alias("cluster"), F.lit(0.0).alias("lower"))
    now, sums, counts = Round(centroids, np.zeros(max(n, 1))), np.zeros((n, dim), np.int64), np.zeros(n, np.int64)
    for turn in range(rounds + 1):
        state, written = next_state(state, now, dim, f"clusters-{turn}")
        discard(spark, path)
        path = written
        if turn == rounds or not n:
            break
        more, others = moved_sums(state, n, dim)
        sums, counts = sums + more, counts + others
        means = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], now.centroids)
        now = Round(means, loosening(now.centroids, means, radii(state, n)))

    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in now.centroids.tolist()]
    found = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    of = {row["cluster"]: int(row["sum"]) for row in found}
    rows = [(c, of.get(c, 0), sum(of.values()), digest) for c, digest in enumerate(digests)]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(known), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
