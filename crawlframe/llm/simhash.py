"""SimHash near-duplicates, with candidates pruned by pigeonring chains.

A text's fingerprint has a bit set where more than half of its word shingles'
XXH64 values have it.  Fingerprints at ``MOST`` or fewer differing bits link.

The 64 bits form a ring of five segments.  If two fingerprints differ in at
most two bits, some segment starts a chain whose cumulative differences never
exceed its proportional budget: 0, 0, 1, 1, 2 bits after 1 to 5 segments.  So
the first two segments are equal, and either the third is equal too, or it
differs in one bit and the fourth is equal.  Those ten cases are the keys on
which candidates meet (39 bits or so), the rest of the chain prunes them, and
the full Hamming distance decides.

A key shared by more than ``CROWD`` fingerprints is not paired out: each of
them is listed under itself and under every fingerprint one bit away outside
the key.  Two that differ in two bits or fewer meet under one of these, and
all that meet there link, so one edge each to the least of them suffices.

Null and empty texts have fingerprint zero.  Equal fingerprints are one node,
whatever their number; rows that share a ``doc_id`` are linked by their texts.
A null ``doc_id`` takes part, but names no component unless it is alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.llm.batches import mapped, only, rows_of, text_mark, utf8
from crawlframe.llm.components import connected_components, stored

MOST, CROWD, SEED = 2, 64, 42
SIZES = (13, 13, 13, 13, 12)


def segments() -> list[int]:
    masks, at = [], 0
    for size in SIZES:
        masks.append(((1 << size) - 1) << at)
        at += size
    return masks


def chain_keys() -> list[tuple[int, int, int]]:
    """(bits of the key, the segment to watch, its least difference) of the ten cases."""
    ring = segments()
    found = []
    for i in range(5):
        one, two, three, four = (ring[(i + k) % 5] for k in range(4))
        found.append((one | two | three, four, 0))
        found.append((one | two | four, three, 1))
    return found


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join
    runs = zip(*(islice(words, k, None) for k in range(width)))
    return np.array([digest(joined(run), SEED) for run in runs], np.uint64)


def fingerprint(text: bytes, width: int) -> int:
    hashes = shingle_hashes(text, width)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = np.unpackbits(hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += part.sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame, *keys: str, width: int = 3) -> DataFrame:
    """``keys`` (columns of ``docs``) with ``print``, the fingerprint as a signed long."""
    kinds = dict(docs.dtypes)

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text, width) for text in utf8(batch.column("__text"))], np.uint64).astype(np.int64)
            yield batch.drop_columns(["__text"]).append_column("print", pa.array(found, pa.int64()))

    schema = ", ".join(f"`{key}` {kinds[key]}" for key in keys)
    rows = docs.select(*keys, F.col("text").cast("string").alias("__text"))
    return mapped(rows, hash_texts, f"{schema}, print long")


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join all that link."""
    chains = chain_keys()
    kinds = [
        F.struct(F.lit(k).alias("kind"), F.col("print").bitwiseAND(F.lit(signed(key))).alias("part"))
        for k, (key, _, _) in enumerate(chains)
    ]
    keys = prints.select("print", F.inline(F.array(*kinds)))
    shared = stored(keys.groupBy("kind", "part").count().filter("count > 1"), "shared-keys")
    met = stored(keys.join(shared, ["kind", "part"]), "met")

    few = met.filter(F.col("count") <= CROWD).drop("count")
    differ = F.col("a").bitwiseXOR(F.col("b"))

    def of_kind(values):
        return F.element_at(F.array(*map(F.lit, values)), F.col("kind") + 1)

    watched = F.bit_count(differ.bitwiseAND(of_kind([signed(watch) for _, watch, _ in chains])))
    pairs = few.withColumnRenamed("print", "a").join(few.withColumnRenamed("print", "b"), ["kind", "part"]).filter("a < b")
    chained = watched.between(of_kind([least for _, _, least in chains]), F.lit(1))
    near = pairs.filter(chained & (F.bit_count(differ) <= MOST)).select("a", "b")

    many = met.filter(F.col("count") > CROWD)
    bits = F.array(*[F.lit(signed(1 << bit)) for bit in range(64)])
    free = F.filter(bits, lambda bit: bit.bitwiseAND(of_kind([signed(key) for key, _, _ in chains])) == 0)
    around = F.concat(F.array("print"), F.transform(free, lambda bit: F.col("print").bitwiseXOR(bit)))
    listed = many.select("kind", "print", F.explode(around).alias("middle"))
    together = Window.partitionBy("kind", "middle")  # at most 65 fingerprints are one bit away
    stars = listed.withColumn("a", F.min("print").over(together)).filter("a != print")
    return near.unionByName(stars.select("a", F.col("print").alias("b")))


def labelled(rows: DataFrame, *keys: str, width: int) -> DataFrame:
    """``keys`` (doc_id among them), print, label (the same for all that link) and component_id for every row."""
    prints = stored(fingerprints(rows, *keys, width=width), "prints")
    distinct = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    labels = connected_components(links(distinct.select("print")))
    nodes = distinct.join(labels.withColumnRenamed("node", "print"), "print", "left")
    nodes = stored(nodes.select("print", "first", F.coalesce("component", "print").alias("label")), "nodes")
    least = stored(nodes.groupBy("label").agg(F.min("first").alias("component_id")), "components")
    classes = stored(nodes.join(least, "label").select("print", "label", "component_id"), "classes")
    return prints.join(classes, "print").select(*keys, "print", "label", "component_id")


def near_duplicates(docs: DataFrame, *, width: int = 3) -> DataFrame:
    """doc_id, print and component_id (smallest doc_id reachable) for every row."""
    return labelled(only(docs, doc_id="bigint", text="string"), "doc_id", width=width).drop("label")


def keep_one(docs: DataFrame, *, width: int = 3) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id, with the columns of ``docs``.

    Of several texts in a group under that doc_id the one of the smallest
    SHA-256 stays.  Repeated rows are one.  Rows without an id stay if none of
    their group has an id.
    """
    rows = only(docs, doc_id="bigint", text="string").withColumn("mark", text_mark())
    first = labelled(rows, "doc_id", "mark", width=width).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = stored(first.groupBy("label").agg(F.min("doc_id").alias("doc_id"), F.min("mark").alias("mark")), "kept")
    return rows_of(docs, kept)
