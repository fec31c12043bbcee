"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Rows are dealt to shards by their key.  A shard sorts its distinct 64-bit
fingerprints and sends each owner, who has a range of fingerprints, one
Golomb-coded block.  The owner answers with a bitmap: which of them another
shard sent too.  Rows whose fingerprint came twice, in one shard or in two,
are suspects; only their texts are shuffled, and each is compared byte by byte
with the text of the row that stays.

Texts are equal when the same after lower-casing A-Z; null is empty.  Of equal
texts the largest ``doc_id`` stays (null is less than any).  Rows that share
``doc_id`` and text count each for itself and are all kept or all dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm import golomb
from crawlframe.llm.batches import mapped, only, partitions, rows_of, run_starts, shard_of, utf8
from crawlframe.llm.components import stored

PRINT = "doc_id long, mark string, print long, text_sha256 string"


def fingerprints(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, SHA-256 of the text as it is, print (XXH64 of the normalised text), its SHA-256 and, where asked for, that text in UTF-8."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = utf8(batch.column("text"))
            texts = [text.lower() for text in given]
            digests = [hashlib.sha256(text).hexdigest() for text in texts]
            marks = [digest if text == norm else hashlib.sha256(text).hexdigest() for text, norm, digest in zip(given, texts, digests)]
            made = {
                "doc_id": batch.column("doc_id"),
                "mark": pa.array(marks, pa.string()),
                "print": pa.array(np.array([xxhash.xxh64_intdigest(text) for text in texts], np.uint64).astype(np.int64)),
                "text_sha256": pa.array(digests, pa.string()),
            }
            if with_text:
                made["norm"] = pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_pydict(made)

    rows = only(docs, doc_id="bigint", text="string")
    return mapped(rows, digest, PRINT + (", norm binary" if with_text else ""))


def owner_bounds(owners: int) -> np.ndarray:
    """First fingerprint of each owner but the first."""
    return np.array([(k << 64) // owners for k in range(1, owners)], np.uint64)


def distinct_prints(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints of a shard, how often each occurs, and the place of every row's."""
    prints = part.column("print").to_numpy().astype(np.uint64)
    return np.unique(prints, return_inverse=True, return_counts=True)


def exchange(prints: DataFrame) -> DataFrame:
    """Bitmaps (shard, owner, bits) of the fingerprints that several shards hold."""
    owners = partitions(prints.sparkSession)

    def send(part: pa.Table) -> pa.Table:
        found, _, _ = distinct_prints(part)
        cuts = np.searchsorted(found, owner_bounds(owners))
        blocks = {owner: block for owner, block in enumerate(np.split(found, cuts)) if len(block)}
        shard = part.column("shard")[0].as_py()
        return pa.table(
            {
                "shard": pa.array([shard] * len(blocks), pa.int32()),
                "owner": pa.array(blocks.keys(), pa.int32()),
                "block": pa.array([golomb.encode(block) for block in blocks.values()], pa.binary()),
            }
        )

    def answer(part: pa.Table) -> pa.Table:
        blocks = [golomb.decode(block) for block in part.column("block").to_pylist()]
        found = np.concatenate(blocks)
        order = np.argsort(found, kind="stable")
        begins = run_starts(found[order])
        counts = np.diff(np.append(begins, len(found)))
        shared = np.zeros(len(found), np.uint8)
        shared[order] = np.repeat(counts > 1, counts)
        ends = np.cumsum([len(block) for block in blocks])[:-1]
        bits = [np.packbits(some).tobytes() for some in np.split(shared, ends)]
        return pa.table({"shard": part.column("shard"), "owner": part.column("owner"), "bits": pa.array(bits, pa.binary())})

    sent = prints.groupBy("shard").applyInArrow(send, "shard int, owner int, block binary")
    return sent.groupBy("owner").applyInArrow(answer, "shard int, owner int, bits binary")


def suspects(prints: DataFrame) -> DataFrame:
    """Every row of ``prints`` (with its shard) and whether its fingerprint occurs more than once."""
    owners = partitions(prints.sparkSession)

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left.append_column("suspect", pa.array([], pa.bool_()))
        found, place, counts = distinct_prints(left)
        cuts = np.searchsorted(found, owner_bounds(owners))
        sizes = np.diff(np.concatenate([[0], cuts, [len(found)]]))
        bitmaps = dict(zip(right.column("owner").to_pylist(), right.column("bits").to_pylist()))
        shared = [np.unpackbits(np.frombuffer(bitmaps[k], np.uint8))[: sizes[k]] for k in range(owners) if sizes[k]]
        suspect = (np.concatenate(shared) > 0) | (counts > 1)
        return left.append_column("suspect", pa.array(suspect[place], pa.bool_()))

    answers = exchange(prints)
    marked = prints.groupBy("shard").cogroup(answers.groupBy("shard"))
    return marked.applyInArrow(mark, f"{PRINT}, shard int, suspect boolean").drop("shard")


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, mark, keep_id, group_size, kept and text_sha256 of every row."""
    prints = fingerprints(docs).withColumn("shard", shard_of("doc_id", partitions(docs.sparkSession)))
    marked = stored(suspects(stored(prints, "fingerprints")), "suspects")
    alone = marked.filter("NOT suspect").select(
        "doc_id", "mark", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )

    wanted = marked.filter("suspect").select(F.col("doc_id").alias("id"), F.col("print").alias("p")).distinct()
    texts = fingerprints(docs, with_text=True)
    texts = stored(texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("print") == F.col("p")), "left_semi"), "suspect-texts")
    same = ["print", "text_sha256"]
    stays = texts.groupBy(*same).agg(F.max("doc_id").alias("leader"))
    led = stored(stays, "leaders")
    leaders = texts.join(led, same).filter(F.col("doc_id").eqNullSafe(F.col("leader")))
    leaders = stored(leaders.select(*same, F.col("norm").alias("leader_text")).dropDuplicates(same), "leader-texts")
    checked = texts.join(leaders, same).select("doc_id", "mark", *same, (F.col("norm") == F.col("leader_text")).alias("equal"))
    checked = stored(checked, "verified")
    groups = checked.filter("equal").groupBy(*same).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    grouped = checked.filter("equal").join(stored(groups, "groups"), same)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    grouped = grouped.select("doc_id", "mark", "keep_id", "group_size", kept, "text_sha256")
    # same digests, other bytes: such a row is a text of its own
    unlike = checked.filter("NOT equal").select(
        "doc_id", "mark", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    return alone.unionByName(grouped).unionByName(unlike)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    return judged(docs).drop("mark")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns of ``docs``.

    Of equal texts under the kept doc_id the spelling of the smallest SHA-256
    stays; repeated rows are one.
    """
    kept = judged(docs).filter("kept").groupBy("doc_id", "text_sha256").agg(F.min("mark").alias("mark"))
    return rows_of(docs, kept)
