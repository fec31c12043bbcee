"""Lines that several documents have, found with two Bloom filters: seen once and seen twice.

A line's key is the line without ASCII white space at its ends, A-Z in lower
case.  Keys of ``MIN_CHARS`` code points or more that two documents hold lose
all their lines but those in the document of the smallest ``doc_id``.

The documents of a task are digested in chunks of bounded size.  Both filters
are cut into segments by hash; a chunk sets the bits of its keys in a filter of
its own and sends each segment's owner the places of the bits, Golomb-coded,
and which of them it has set twice.  The owner joins the filters of all chunks:
a bit is seen twice if a chunk says so or two chunks have set it.  It answers
each chunk with the twice-seen filter at the places sent.  A key none of whose
bits is missing there is suspected; no key of two documents can be missed.

Only suspected keys are then shuffled, one row for each document and key, as
SHA-256 digests.  Smallest and largest ``doc_id`` of a digest are aggregated
before the shuffle, so that a line of all documents costs a row per task; they
tell true repeats from the filter's errors, and name the first document.

Null and empty texts are one empty line.  Rows that share a ``doc_id`` are one
document; rows without one are together one document after all others.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm import golomb
from crawlframe.llm.batches import fresh, mapped, on_workers, only, partitions, text_mark
from crawlframe.llm.components import stored

MIN_CHARS = 10
BITS, HASHES = 12, 3  # bits a key in either filter, and places a key has
CHUNK_KEYS, SEGMENT_BITS = 1 << 20, 1 << 27
BLANK = " \t\n\v\f\r"
LAST = np.iinfo(np.int64).max
CHUNK = "chunk long, keys long, docs binary, marks binary, sizes binary, digests binary"


def line_key(line: str, least: int) -> bytes | None:
    """The key's SHA-256, or nothing for keys of fewer than ``least`` code points."""
    key = line.strip(BLANK)
    return hashlib.sha256(key.encode().lower()).digest() if len(key) >= least else None


def digest_lines(docs: DataFrame, least: int) -> DataFrame:
    """Rows of documents and of the digests of their distinct keys, ``CHUNK_KEYS`` or little more in one."""

    def chunk(ids: list[int], marks: list[bytes], sizes: list[int], digests: list[bytes]) -> pa.RecordBatch:
        made = (np.array(ids, "<i8").tobytes(), b"".join(marks), np.array(sizes, "<i4").tobytes(), b"".join(digests))
        head = {"chunk": pa.array([uuid.uuid4().int >> 65], pa.int64()), "keys": pa.array([len(digests)], pa.int64())}
        return pa.RecordBatch.from_pydict(head | {name: pa.array([data], pa.binary()) for name, data in zip(("docs", "marks", "sizes", "digests"), made)})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, marks, sizes, digests = [], [], [], []
        for batch in batches:
            for number, mark, text in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "mark", "text"))):
                found = {line_key(line, least) for line in (text or "").split("\n")} - {None}
                if not found:
                    continue
                ids.append(LAST if number is None else number)
                marks.append(bytes.fromhex(mark))
                sizes.append(len(found))
                digests.extend(found)
                if len(digests) >= CHUNK_KEYS:
                    yield chunk(ids, marks, sizes, digests)
                    ids, marks, sizes, digests = [], [], [], []
        if digests:
            yield chunk(ids, marks, sizes, digests)

    return mapped(docs, gather, CHUNK)


class Places:
    """The filter bits of a chunk's keys: sorted distinct ``codes`` (segment, place) and where each key finds its own."""

    def __init__(self, digests: bytes, segments: int, bits: int):
        words = np.frombuffer(digests, "<u8").reshape(-1, 4)
        with np.errstate(over="ignore"):
            segment = ((words[:, 0] >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
            steps = words[:, 1, None] + np.arange(HASHES, dtype=np.uint64) * (words[:, 2, None] | np.uint64(1))
        codes = segment[:, None] * np.uint64(bits) + steps % np.uint64(bits)
        self.codes, place = np.unique(codes.ravel(), return_inverse=True)
        self.of_key = place.reshape(-1, HASHES)
        self.keys = words[:, 0]
        owners = (self.codes // np.uint64(bits)).astype(np.int64)
        self.owners, self.begins = np.unique(owners, return_index=True)
        self.bits = bits

    def blocks(self) -> list[tuple[int, bytes, bytes]]:
        """Owner, Golomb-coded places and flags of those set by a key that came twice."""
        _, which, counts = np.unique(self.keys, return_inverse=True, return_counts=True)
        twice = np.zeros(len(self.codes), np.uint8)
        twice[self.of_key[counts[which] > 1]] = 1
        parts = zip(self.owners.tolist(), np.split(self.codes, self.begins[1:]), np.split(twice, self.begins[1:]))
        return [(owner, golomb.encode(codes - np.uint64(owner * self.bits)), np.packbits(flags).tobytes()) for owner, codes, flags in parts]

    def suspects(self, answers: dict[int, bytes]) -> np.ndarray:
        """Which keys have all their bits in the twice-seen filter."""
        sizes = np.diff(np.append(self.begins, len(self.codes)))
        found = [np.unpackbits(np.frombuffer(answers[owner], np.uint8))[:size] for owner, size in zip(self.owners.tolist(), sizes)]
        return np.concatenate(found)[self.of_key].all(axis=1)


def merge_filters(places: list[np.ndarray], flags: list[bytes], bits: int) -> list[bytes]:
    """A segment's two filters of all chunks; the twice-seen one at each chunk's places."""
    once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
    for at, said in zip(places, flags):
        twice[at[once[at]]] = True
        twice[at[np.unpackbits(np.frombuffer(said, np.uint8))[: len(at)] > 0]] = True
        once[at] = True
    return [np.packbits(twice[at]).tobytes() for at in places]


def suspected(chunks: DataFrame) -> DataFrame:
    """doc, mark and digest of every key that may be in two documents."""
    spark = chunks.sparkSession
    keys = chunks.agg(F.sum("keys")).first()[0] or 0
    segments = max(partitions(spark), keys * BITS // SEGMENT_BITS + 1)
    bits = max(64, -(-keys * BITS // segments))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, digests in zip(batch.column("chunk").to_pylist(), batch.column("digests").to_pylist()):
                owners, places, flags = zip(*Places(digests, segments, bits).blocks())
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": pa.array(owners, pa.int32()),
                        "chunk": pa.array([number] * len(owners), pa.int64()),
                        "places": pa.array(places, pa.binary()),
                        "flags": pa.array(flags, pa.binary()),
                    }
                )

    def merge(part: pa.Table) -> pa.Table:
        places = [golomb.decode(block).astype(np.int64) for block in part.column("places").to_pylist()]
        answers = merge_filters(places, part.column("flags").to_pylist(), bits)
        return part.select(["segment", "chunk"]).append_column("twice", pa.array(answers, pa.binary()))

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = dict(zip(right.column("segment").to_pylist(), right.column("twice").to_pylist()))
        docs, marks, digests = [], [], []
        for given, keyed, sizes, data in zip(*(left.column(name).to_pylist() for name in ("docs", "marks", "sizes", "digests"))):
            suspect = np.flatnonzero(Places(data, segments, bits).suspects(answers))
            row = np.searchsorted(np.cumsum(np.frombuffer(sizes, "<i4")), suspect, side="right")
            docs.append(np.frombuffer(given, "<i8")[row])
            marks += [keyed[32 * k : 32 * k + 32] for k in row.tolist()]
            digests += [data[32 * k : 32 * k + 32] for k in suspect.tolist()]
        return pa.table(
            {
                "doc": pa.array(np.concatenate(docs) if docs else [], pa.int64()),
                "mark": pa.array(marks, pa.binary()),
                "digest": pa.array(digests, pa.binary()),
            }
        )

    sent = mapped(chunks.select("chunk", "digests"), send, "segment int, chunk long, places binary, flags binary")
    answers = stored(sent.groupBy("segment").applyInArrow(merge, "segment int, chunk long, twice binary"), "twice-seen")
    both = chunks.drop("keys").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(mark, "doc long, mark binary, digest binary")


def repeated_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc (the id, or the largest long for none), mark (SHA-256 of the text) and the digests of the keys that its text loses."""
    rows = only(docs, doc_id="bigint", text="string").withColumn("mark", text_mark())
    chunks = stored(digest_lines(rows, min_chars), "line-digests")
    found = stored(suspected(chunks), "suspected-lines")
    spans = found.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    repeats = stored(spans.filter("first < last").select("digest", "first"), "repeated-lines")
    # no distinct between join and shuffle: it would bind all rows of a common line to one task
    late = found.join(repeats, "digest").filter("doc > first").select("doc", "mark", "digest")
    return late.groupBy("doc", "mark").agg(F.collect_set("digest").alias("lost"))


def drop_lines(text: str | None, lost, least: int) -> tuple[int, list[str]]:
    """The number of lines, and those that stay."""
    lines = (text or "").split("\n")
    gone = set() if lost is None else set(lost)
    return len(lines), [line for line in lines if line_key(line, least) not in gone] if gone else lines


def with_lost(docs: DataFrame, min_chars: int) -> tuple[DataFrame, str]:
    """``docs`` with a column, whose name is returned, of the digests each row loses."""
    lost, doc, mark = fresh(docs.columns, "lost", "doc", "mark")
    keyed = docs.withColumns({doc: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)), mark: text_mark()})
    found = repeated_lines(docs, min_chars=min_chars).toDF(doc, mark, lost)
    found = found.withColumn(mark, F.lower(F.hex(mark)))
    return keyed.join(stored(found, "lost-lines"), [doc, mark], "left").drop(doc, mark), lost


def line_report(docs: DataFrame, *, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 (of the lines that stay, joined by newlines) for every row."""
    rows, _ = with_lost(only(docs, doc_id="bigint", text="string"), min_chars)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [drop_lines(text, lost, min_chars) for text, lost in zip(batch.column("text").to_pylist(), batch.column("lost").to_pylist())]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_lines": pa.array([n for n, _ in found], pa.int64()),
                    "n_dropped": pa.array([n - len(left) for n, left in found], pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256("\n".join(left).encode()).hexdigest() for _, left in found], pa.string()),
                }
            )

    return mapped(rows, report, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def without_repeated_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` with the lines that stay as ``text``; a text that loses none is as it was."""
    rows, name = with_lost(docs, min_chars)

    on_workers(docs.sparkSession)

    @F.pandas_udf("string")
    def left(texts: pd.Series, lost: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(drop_lines(text, some, min_chars)[1]) for text, some in zip(texts, lost)], dtype=object)

    found = F.when(F.col(name).isNotNull(), left(F.col("text").cast("string"), F.col(name))).otherwise(F.col("text"))
    return rows.withColumn("text", found).drop(name)
