"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations.

A vector is turned by three rounds of random signs and a Hadamard transform;
its hash is the axis, with its sign, to which it then lies closest.  A table
joins some such hashes into a bucket; besides its own bucket a vector is also
listed in those where one hash is its second-best axis.  Vectors that share a
bucket of any of the tables are candidates, and the cosine in double precision
decides.  Equal vectors are one class and are not paired.

The number of hashes grows with the logarithm of the number of classes, so that
there are ``SPARE`` times as many buckets as classes, and unlike vectors are as
seldom candidates of one vector at any size.  Beyond four hashes tables are
added.  Pairs at cosine 0.95 share a bucket in 0.998 of all cases or more, at
64 and at 384 dimensions, with two to five hashes.

A bucket of more than ``CROWD`` classes is cut into blocks; a task compares
two blocks and gives out only pairs that link, so no bucket is too large and
none is cut short.

Null, empty and zero vectors and those with a null or non-finite component
link with nothing.  Vectors of different lengths do not link.  Rows that share
a ``vec_id`` are compared each for itself; a null ``vec_id`` takes part, but
names no component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.batches import mapped
from crawlframe.llm.components import connected_components, stored

TABLES, SPARE, CROWD = 14, 8, 128


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, by halving."""
    n, size = rows.shape
    step = 1
    while step < size:
        parts = rows.reshape(n, size // (2 * step), 2, step)
        rows = np.stack([parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return rows / np.sqrt(size)


def hash_counts(dim: int, classes: int) -> tuple[int, int]:
    """Tables, and hashes in each, for so many vectors of a length."""
    codes = 2 * padded_size(dim)
    hashes = 2
    while codes**hashes < SPARE * classes:
        hashes += 1
    return TABLES + 6 * max(0, hashes - 4), hashes


def padded_size(dim: int) -> int:
    return 1 << max(1, (dim - 1).bit_length())


@lru_cache(maxsize=8)
def signs(size: int, tables: int, hashes: int) -> np.ndarray:
    """Random signs of every table, hash and round."""
    return np.random.default_rng([11, size]).choice([-1.0, 1.0], (tables, hashes, 3, size))


def buckets(unit: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """Buckets of each row: its own and a probe for each hash, of every table."""
    n, dim = unit.shape
    size = padded_size(dim)
    padded = np.zeros((n, size))
    padded[:, :dim] = unit
    found = np.empty((n, tables, hashes + 1), np.int64)
    for table in range(tables):
        axes = []
        for number in range(hashes):
            turned = padded
            for flip in signs(size, tables, hashes)[table, number]:
                turned = hadamard(turned * flip)
            best = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :2]
            negative = np.take_along_axis(turned, best, axis=1) < 0
            axes.append((best + size * negative).astype(np.uint64))
        for probe in range(hashes + 1):
            code = np.full(n, dim, np.uint64)
            for number in range(hashes):  # wraps beyond 64 bits: a few more candidates
                code = code * np.uint64(2 * size) + axes[number][:, int(probe == number + 1)]
            found[:, table, probe] = code.astype(np.int64)
    return found


def unit_rows(lists: list) -> tuple[list[bytes | None], list[bytes | None]]:
    """Key and normalised vector (doubles) of each list; none for those that link with nothing."""
    keys: list[bytes | None] = []
    units: list[bytes | None] = []
    for values in lists:
        good = bool(values) and None not in values
        vector = np.array(values, float) if good else np.zeros(1)
        norm = float(np.sqrt(vector @ vector)) if np.isfinite(vector).all() else 0.0
        if norm == 0.0 or not np.isfinite(norm):
            top = np.abs(vector).max() if good and np.isfinite(vector).all() else 0.0
            vector = vector / top if top else vector  # too large or small to square
            norm = float(np.sqrt(vector @ vector)) if top else 0.0
        keys.append(hashlib.blake2b((vector + 0.0).tobytes(), digest_size=16).digest() if norm else None)
        units.append((vector / norm).tobytes() if norm else None)
    return keys, units


def link_classes(classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b), a < b, of class numbers whose cosine reaches the threshold."""
    rows_in_all = classes.count()

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, units = batch.column("class").to_numpy(), batch.column("unit").to_pylist()
            lengths = np.array([len(unit) for unit in units])
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                tables, hashes = hash_counts(int(length) // 8, rows_in_all)
                for at in range(0, len(mine), 512):
                    rows = mine[at : at + 512]
                    found = buckets(np.frombuffer(b"".join(units[k] for k in rows), float).reshape(len(rows), -1), tables, hashes)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "table": pa.array(np.tile(np.repeat(np.arange(tables), hashes + 1), len(rows)), pa.int32()),
                            "bucket": pa.array(found.ravel(), pa.int64()),
                            "class": pa.array(np.repeat(numbers[rows], tables * (hashes + 1)), pa.int64()),
                        }
                    )

    keys = stored(mapped(classes.select("class", "unit"), hash_rows, "table int, bucket long, class long"), "buckets")
    shared = stored(keys.groupBy("table", "bucket").count().filter("count > 1"), "shared-buckets")
    met = stored(keys.join(shared, ["table", "bucket"]), "met")

    few = met.filter(F.col("count") <= CROWD).drop("count")
    pairs = (
        few.withColumnRenamed("class", "a")
        .join(few.withColumnRenamed("class", "b"), ["table", "bucket"])
        .filter("a < b")
        .select("a", "b")
        .distinct()
    )
    units = classes.select("class", "unit")
    sides = pairs.join(units.toDF("a", "left"), "a").join(units.toDF("b", "right"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            near = [len(x) == len(y) and float(np.frombuffer(x) @ np.frombuffer(y)) >= threshold for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    near = mapped(sides, verify, "a long, b long")

    blocks = F.ceil(F.col("count") / CROWD).cast("int")
    many = met.filter(F.col("count") > CROWD).withColumn("blocks", blocks)
    many = many.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = many.select("table", "bucket", "class", "own", other)
    dealt = dealt.select("table", "bucket", "class", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(part: pa.Table) -> pa.Table:
        numbers, own = part.column("class").to_numpy(), part.column("own").to_numpy()
        rows = np.frombuffer(b"".join(part.column("unit").to_pylist()), float).reshape(len(numbers), -1)
        cross = part.column("i")[0].as_py() != part.column("j")[0].as_py()
        x, y = np.nonzero(rows @ rows.T >= threshold)
        wanted = (numbers[x] < numbers[y]) & ((own[x] != own[y]) if cross else True)
        return pa.table({"a": pa.array(numbers[x[wanted]], pa.int64()), "b": pa.array(numbers[y[wanted]], pa.int64())})

    crowds = dealt.join(units, "class").groupBy("table", "bucket", "i", "j").applyInArrow(compare, "a long, b long")
    return near.unionByName(crowds).distinct()


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding)."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, units = unit_rows(batch.column("embedding").to_pylist())
            yield pa.RecordBatch.from_pydict(
                {"vec_id": batch.column("vec_id"), "key": pa.array(keys, pa.binary()), "unit": pa.array(units, pa.binary())}
            )

    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(mapped(rows, prepare, "vec_id long, key binary, unit binary"), "units")
    grouped = rows.filter("key IS NOT NULL").groupBy("key")
    classes = grouped.agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("unit").alias("unit"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    found = stored(link_classes(classes, threshold), "vector-links")

    ends = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("class").alias("b"), "copies")
    linked = ends.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "class")
    labels = connected_components(found).withColumnRenamed("node", "class")
    nodes = classes.drop("unit").join(linked, "class", "left").join(labels, "class", "left")
    nodes = stored(nodes.withColumn("label", F.coalesce("component", "class")), "vector-nodes")
    least = stored(nodes.groupBy("label").agg(F.min("first").alias("component_id")), "vector-components")
    counted = (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    known = stored(nodes.join(least, "label").select("key", counted, "component_id"), "vector-known")
    whole = rows.drop("unit").join(known, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return whole.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
