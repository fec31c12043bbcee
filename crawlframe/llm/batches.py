"""Small helpers that the operators share: reading columns, slicing texts, partition counts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def on_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, if it is not installed there."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))
    return spark


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package; a worker gives Arrow's memory back after each task."""
    on_workers(df.sparkSession)

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the user sizes to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shard_of(key: str, shards: int) -> Column:
    """A shard number from 0, equal for equal keys on every run."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(shards)).cast("int")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns cast to the given types; extra columns go."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def held_out(key: str, buckets: int, bucket: int) -> Column:
    """True where crc32 of the key as text falls into one of the buckets."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(buckets)) == bucket, F.lit(False))


def text_mark() -> Column:
    """SHA-256 of the column ``text`` as it is; null is empty."""
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores added until none is among ``columns``."""
    taken, found = {name.lower() for name in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (doc_id and the mark of the text), repeated rows once."""
    names = fresh(docs.columns, "id", "no_id", "mark")
    key = F.col("doc_id").cast("bigint")
    keys = [F.coalesce(key, F.lit(0)), key.isNull()]
    wanted = kept.select(*[made.alias(name) for made, name in zip([*keys, F.col("mark")], names)])
    keyed = docs.withColumns(dict(zip(names, [*keys, text_mark()])))
    return keyed.join(wanted, names, "left_semi").dropDuplicates(names).drop(*names)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to ``most`` or less, one item at least."""
    begin = total = 0
    for k, size in enumerate(sizes):
        if k > begin and total + size > most:
            yield begin, k
            begin, total = k, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def small(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a column of text or bytes takes ``most`` bytes in each, or is one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for a, b in slices(sizes, most):
            yield batch.slice(a, b - a)


def utf8(texts) -> list[bytes]:
    """The texts of an Arrow string column as bytes; null is empty."""
    return [b"" if text is None else text.encode() for text in texts.to_pylist()]


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Positions at which sorted rows differ from the row before."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)
