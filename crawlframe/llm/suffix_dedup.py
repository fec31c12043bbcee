"""Repeated passages by longest previous factors, over a sampled suffix order.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document of smaller ``doc_id``.  In suffix order, with documents breaking ties,
the longest previous factor of a suffix is shared with its previous or next
smaller value; cut at ``LENGTH`` bytes, it is the previous smaller document
among the neighbours whose common prefix reaches that length.

The order of all suffixes of a corpus would be many times its size, so it is
built where it decides something.  Every window of ``LENGTH`` bytes has an
anchor, the least hashed ``GRAM``-byte string in it; equal windows have equal
anchors.  Neighbouring windows of one anchor are a span.  In three exchanges,
shards of documents send sorted blocks to owners of ranges and get answers:

1. anchors: which occur in two documents at all.  The others are settled.
2. spans (anchor, hash of all bytes): an earlier document with the same span
   covers it whole; an anchor with several spans leaves the first document of
   each contested.
3. windows of contested spans: sorted as suffixes in the shard, where longest
   previous factors leave one entry per window; owners then compare shards.

A shard sends an entry once, with its smallest doc_id, and ``CROWD`` spans of
an anchor at most: more are contested anyway, and windows settle them.

Null texts are empty; a null ``doc_id`` is larger than any other.  Rows that
share a ``doc_id`` are the same document to each other and stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.batches import fresh, on_workers, partitions, run_starts, shard_of, utf8
from crawlframe.llm.components import stored
from crawlframe.llm.elias_fano import EliasFano, pack
from crawlframe.session import scratch_path

LENGTH, GRAM, CROWD = 50, 20, 64
SHARD_BYTES = 4 << 20
STEPS = (1, 2, 4, 8)
CACHED = 1 << 14
#: Odd multipliers for mixing.
ONE, TWO, THREE, BASE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0x5851F42D4C957F2D))
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LARGEST = np.iinfo(np.int64).max


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * THREE
    return x ^ (x >> np.uint64(29))


class Powers:
    """Powers of an odd number: those below ``CACHED``, and of them by steps of that size."""

    def __init__(self, base: np.uint64, n: int):
        low = np.full(CACHED + 1, base, np.uint64)
        low[0] = 1
        low = np.cumprod(low, dtype=np.uint64)
        high = np.full(n // CACHED + 1, low[-1], np.uint64)
        high[0] = 1
        self.low, self.high = low[:-1], np.cumprod(high, dtype=np.uint64)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.low[at % CACHED] * self.high[at // CACHED]


def previous_factors(keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, ties by document: the order, the begins of runs with equal keys, and each run's first document.

    A suffix has a previous factor as long as its keys just if its document is
    larger than the first of its run.
    """
    order = np.lexsort([docs, *keys[::-1]])
    begins = run_starts(*[key[order] for key in keys])
    return order, begins, docs[order][begins]


def spread(begins: np.ndarray, n: int) -> np.ndarray:
    """Number of the run of each of ``n`` sorted rows."""
    runs = np.zeros(n, np.int64)
    runs[begins[1:]] = 1
    return np.cumsum(runs)


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, ends included, and the range each is of."""
    sizes = last - first + 1
    which = np.repeat(np.arange(len(first)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[which], which


@dataclass
class Spans:
    """The spans of a shard: windows ``first`` to ``last`` of the joined texts, all with one anchor."""

    data: np.ndarray
    loads: np.ndarray
    prefix: np.ndarray
    inverse: Powers
    first: np.ndarray
    last: np.ndarray
    row: np.ndarray
    anchor: np.ndarray
    whole: np.ndarray


def window_hashes(prefix: np.ndarray, inverse: Powers, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``begin`` to ``end`` (not included), eight at least."""
    return mixed((prefix[end - 7] - prefix[begin]) * inverse[begin])


def find_spans(texts: list[bytes]) -> Spans:
    lengths = np.array([len(text) for text in texts], np.int64)
    data = np.frombuffer(b"".join(texts) + bytes(LENGTH + 8), np.uint8)
    n = len(data) - 8
    loads = np.ndarray((n,), "<u8", data, strides=(1,))
    power, inverse = Powers(BASE, n), Powers(BASE_INVERSE, n)
    prefix, grams = np.zeros(n + 1, np.uint64), np.zeros(n, np.uint64)
    places, new = np.zeros(n, np.int32), np.zeros(n, bool)
    wide, before = LENGTH - GRAM + 1 - 16, -1
    for a in range(0, n, CACHED):  # pieces that stay in the cache
        here = np.ascontiguousarray(loads[a : a + CACHED + LENGTH])
        second = mixed(here * TWO)
        size = min(CACHED, n - a)
        sums = np.cumsum(second[:size] * power.low[:size])
        prefix[a + 1 : a + size + 1] = sums * power.high[a // CACHED] + prefix[a]
        m = len(here) - GRAM + 8
        if m <= 8 + 31:
            break  # no window begins here
        hashes = mixed((here[: m - 8] * ONE) ^ second[8:m] ^ (here[GRAM - 8 :][: m - 8] * BASE))
        low = (hashes >> np.uint64(32)).astype(np.uint32) & ~np.uint32(31)  # the low bits count how far the least one is
        for step in STEPS:
            low = np.minimum(low[:-step], low[step:] + np.uint32(step))
        low = np.minimum(low[:-wide], low[wide:] + np.uint32(wide))[:size]
        grams[a : a + len(hashes[:size])] = hashes[:size]
        at = (low & np.uint32(31)).astype(np.int32) + np.arange(a, a + len(low), dtype=np.int32)
        places[a : a + len(at)] = at
        new[a + 1 : a + len(at)] = at[1:] != at[:-1]
        new[a] = at[0] != before
        before = at[-1]
    ends = np.cumsum(lengths)
    long = lengths >= LENGTH
    new[(ends - lengths)[long]] = True
    first = np.flatnonzero(new[: ends[-1]]) if len(ends) else np.zeros(0, np.int64)
    row = np.searchsorted(ends, first, side="right")
    windows = first <= ends[row] - LENGTH if len(first) else np.zeros(0, bool)
    first, row = first[windows], row[windows]
    last = ends[row] - LENGTH
    last[:-1] = np.where(row[1:] == row[:-1], first[1:] - 1, last[:-1])
    anchor = mixed(grams[places[first]] * ONE)
    whole = window_hashes(prefix, inverse, first, last + LENGTH)
    shape = (places[first] - first) * 64 + (last - first)
    return Spans(data, loads, prefix, inverse, first, last, row, anchor, whole ^ mixed(shape.astype(np.uint64) * ONE))


def bounds(owners: int) -> np.ndarray:
    return np.array([(k << 64) // owners for k in range(owners)], np.uint64)


def planes(values: np.ndarray) -> bytes:
    """Eight bytes each, all first bytes, then all second ones: high zeros press well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def split(keys: np.ndarray, owners: int) -> list[tuple[int, slice]]:
    """The owners of sorted keys and the part of each."""
    cuts = np.append(np.searchsorted(keys, bounds(owners)), len(keys))
    return [(k, slice(cuts[k], cuts[k + 1])) for k in range(owners) if cuts[k] < cuts[k + 1]]


def gather(replies: dict[int, bytes], keys: np.ndarray, owners: int) -> np.ndarray:
    """The answers to sorted keys, in their order."""
    parts = [np.frombuffer(replies[owner], np.uint8) for owner, _ in split(keys, owners)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


@dataclass
class Shard:
    """One shard's side of the exchanges; each step needs the answers to the steps before."""

    texts: list[bytes]
    docs: np.ndarray
    owners: int
    drop_bits: int
    replies: dict[int, dict[int, bytes]]

    def __post_init__(self):
        self.spans = find_spans(self.texts)
        self.doc = self.docs[self.spans.row]
        self.keys, self.key = np.unique(self.spans.anchor, return_inverse=True)

    def blocks(self, step: int) -> list[tuple[int, list[bytes]]]:
        return [self.anchors, self.shared, self.contested][step - 1]()

    def anchors(self) -> list[tuple[int, list[bytes]]]:
        low, high = np.full(len(self.keys), LARGEST), np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.key, self.doc)
        np.maximum.at(high, self.key, self.doc)
        several = (low < high).astype(np.uint8)
        return [
            (owner, [self.brief(owner, self.keys[part]), np.packbits(several[part]).tobytes()])
            for owner, part in split(self.keys, self.owners)
        ]

    def brief(self, owner: int, keys: np.ndarray) -> bytes:
        """Keys from the owner's first one on, without their low bits."""
        return pack((keys - bounds(self.owners)[owner]) >> np.uint64(self.drop_bits))

    def sort_shared(self) -> None:
        """Runs of equal (anchor, span) among anchors that two documents have."""
        shared = gather(self.replies[1], self.keys, self.owners) > 0
        self.chosen = np.flatnonzero(shared[self.key])
        keys = [self.spans.anchor[self.chosen], self.spans.whole[self.chosen]]
        self.order, self.begins, self.run_doc = previous_factors(keys, self.doc[self.chosen])
        self.sorted = self.chosen[self.order]
        self.run = spread(self.begins, len(self.order))
        self.run_key = self.spans.anchor[self.sorted[self.begins]]
        self.run_whole = self.spans.whole[self.sorted[self.begins]]
        of_key = run_starts(self.run_key)
        sizes = np.diff(np.append(of_key, len(self.run_key)))
        self.sent = np.arange(len(self.run_key)) - np.repeat(of_key, sizes) < CROWD

    def shared(self) -> list[tuple[int, list[bytes]]]:
        self.sort_shared()
        keys, whole, docs = self.run_key[self.sent], self.run_whole[self.sent], self.run_doc[self.sent]
        return [
            (owner, [self.brief(owner, keys[part]), whole[part].astype("<u8").tobytes(), planes(docs[part].view(np.uint64))])
            for owner, part in split(keys, self.owners)
        ]

    def sort_contested(self) -> None:
        """Windows of contested spans, as suffixes in order."""
        self.sort_shared()
        code = np.full(len(self.run_key), 2, np.uint8)
        code[self.sent] = gather(self.replies[2], self.run_key[self.sent], self.owners)
        first = self.doc[self.sorted] == self.run_doc[self.run]
        self.covered = self.sorted[~first | (code[self.run] == 1)]
        open_spans = self.sorted[first & (code[self.run] == 2)]
        spans = self.spans
        self.window, which = ranges(spans.first[open_spans], spans.last[open_spans])
        self.window_doc = self.doc[open_spans][which]
        loads = [spans.loads[self.window + at].byteswap() for at in (0, 8, 16, 24, 32, 40, LENGTH - 8)]
        order, begins, self.first_doc = previous_factors(loads, self.window_doc)
        self.window_run = np.empty(len(order), np.int64)
        self.window_run[order] = spread(begins, len(order))
        one = self.window[order[begins]]
        hashes = window_hashes(spans.prefix, spans.inverse, one, one + LENGTH)
        check = (spans.anchor[open_spans][which[order[begins]]] & np.uint64(0xFFFFFFFF)).astype("<u4")
        self.by_hash = np.argsort(hashes, kind="stable")
        self.hashes, self.check = hashes[self.by_hash], check[self.by_hash]

    def contested(self) -> list[tuple[int, list[bytes]]]:
        self.sort_contested()
        docs = self.first_doc[self.by_hash].view(np.uint64)
        return [
            (owner, [self.hashes[part].astype("<u8").tobytes(), self.check[part].tobytes(), planes(docs[part])])
            for owner, part in split(self.hashes, self.owners)
        ]

    def removed(self) -> np.ndarray:
        """A flag for every byte of the joined texts."""
        self.sort_contested()
        earlier = np.zeros(len(self.hashes), bool)
        earlier[self.by_hash] = gather(self.replies[3], self.hashes, self.owners) > 0
        gone = earlier[self.window_run] | (self.window_doc > self.first_doc[self.window_run])
        begins = np.concatenate([self.spans.first[self.covered], self.window[gone]])
        ends = np.concatenate([self.spans.last[self.covered], self.window[gone]]) + LENGTH
        n = sum(map(len, self.texts))
        steps = np.bincount(begins, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
        return np.cumsum(steps[:n]) > 0


def answer(step: int, parts: list[list[bytes]]) -> list[bytes]:
    """An owner's answers to the blocks of a step, a byte for each entry."""
    if step == 1:
        keys = [EliasFano(part[0]).all() for part in parts]
        several = [np.unpackbits(np.frombuffer(part[1], np.uint8))[: len(key)] for part, key in zip(parts, keys)]
        sizes, joined = [len(key) for key in keys], np.concatenate(keys)
        shard = np.repeat(np.arange(len(parts)), sizes)
        order = np.lexsort([shard, joined])
        begins = run_starts(joined[order])
        met = shard[order][begins] != shard[order][np.append(begins[1:], len(order)) - 1]
        met |= np.add.reduceat(np.concatenate(several)[order], begins) > 0
        code = np.empty(len(joined), np.uint8)
        code[order] = met[spread(begins, len(order))]
    elif step == 2:
        keys = [EliasFano(part[0]).all() for part in parts]
        sizes = [len(key) for key in keys]
        key, whole = np.concatenate(keys), np.concatenate([np.frombuffer(part[1], "<u8") for part in parts])
        docs = np.concatenate([unplanes(part[2]) for part in parts]).view(np.int64)
        order, begins, first = previous_factors([key, whole], docs)
        run = spread(begins, len(order))
        of_key = run_starts(key[order][begins])
        several = np.diff(np.append(of_key, len(begins))) > 1
        code = np.empty(len(key), np.uint8)
        late = docs[order] > first[run]
        code[order] = np.where(late, 1, np.where(several[spread(of_key, len(begins))][run], 2, 0))
    else:
        hashes, check = (np.concatenate([np.frombuffer(part[k], kind) for part in parts]) for k, kind in ((0, "<u8"), (1, "<u4")))
        sizes = [len(part[1]) // 4 for part in parts]
        docs = np.concatenate([unplanes(part[2]) for part in parts]).view(np.int64)
        order, begins, first = previous_factors([hashes, check], docs)
        code = np.empty(len(docs), np.uint8)
        code[order] = docs[order] > first[spread(begins, len(order))]
    return [some.tobytes() for some in np.split(code, np.cumsum(sizes)[:-1])]


BLOCK, REPLY = "shard int, owner int, parts array<binary>", "shard int, owner int, step int, code binary"


def read_shard(part: pa.Table, replies: pa.Table, owners: int, drop_bits: int) -> Shard:
    found: dict[int, dict[int, bytes]] = {1: {}, 2: {}, 3: {}}
    for owner, step, code in zip(*(replies.column(name).to_pylist() for name in ("owner", "step", "code"))):
        found[step][owner] = code
    docs = part.column("doc_id").cast(pa.int64()).fill_null(LARGEST).to_numpy()
    return Shard(utf8(part.column("text")), docs, owners, drop_bits, found)


def bucketed(docs: DataFrame, shard: str, shards: int) -> DataFrame:
    """The documents in a table bucketed by the new column ``shard``, so that later steps need not shuffle texts again.

    The catalog forgets the table's name at once; its files stay in the shared folder.
    """
    spark, buckets = docs.sparkSession, partitions(docs.sparkSession)
    path = scratch_path(spark, "shards")
    name = "shards_" + path.rsplit("-", 1)[1]
    sharded = docs.withColumn(shard, shard_of("doc_id", shards)).repartition(buckets, shard)
    writer = sharded.write.bucketBy(buckets, shard).option("path", path).option("compression", "zstd")
    writer.saveAsTable(name)
    table = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def exchange_sides(step: int, owners: int, drop_bits: int) -> tuple[Callable, Callable]:
    """What a shard sends in a step, and what an owner replies."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = read_shard(left, right, owners, drop_bits).blocks(step) if left.num_rows else []
        shard = [left.column("shard")[0].as_py()] * len(blocks) if blocks else []
        return pa.table(
            {
                "shard": pa.array(shard, pa.int32()),
                "owner": pa.array([owner for owner, _ in blocks], pa.int32()),
                "parts": pa.array([parts for _, parts in blocks], pa.list_(pa.binary())),
            }
        )

    def reply(part: pa.Table) -> pa.Table:
        codes = answer(step, part.column("parts").to_pylist())
        return pa.table(
            {
                "shard": part.column("shard"),
                "owner": part.column("owner"),
                "step": pa.array([step] * len(codes), pa.int32()),
                "code": pa.array(codes, pa.binary()),
            }
        )

    return send, reply


def with_removals(docs: DataFrame, schema: str, finish: Callable) -> DataFrame:
    """``finish(part, texts, removed)`` for each shard of ``docs`` (doc_id, text and any others)."""
    spark = on_workers(docs.sparkSession)
    owners = partitions(spark)
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards = max(owners, size // SHARD_BYTES + 1)
    drop_bits = max(0, 64 - (int(size).bit_length() + 10))
    (shard_name,) = fresh(docs.columns, "shard")
    table = bucketed(docs, shard_name, shards)
    texts = table.select(F.col(shard_name).alias("shard"), "doc_id", "text")
    replies = spark.createDataFrame([], REPLY)

    for step in (1, 2, 3):
        send, reply = exchange_sides(step, owners, drop_bits)
        blocks = texts.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(send, BLOCK)
        replies = replies.unionByName(stored(blocks.groupBy("owner").applyInArrow(reply, REPLY), f"replies-{step}"))

    def end(left: pa.Table, right: pa.Table) -> pa.Table:
        shard = read_shard(left, right, owners, drop_bits)
        return finish(left, shard.texts, shard.removed())

    return table.groupBy(shard_name).cogroup(replies.groupBy("shard")).applyInArrow(end, schema)


def kept_parts(texts: list[bytes], removed: np.ndarray) -> list[bytes]:
    """What is left of each text."""
    ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
    gone = np.concatenate([[0], np.cumsum(removed)])
    left = np.frombuffer(b"".join(texts), np.uint8)[~removed].tobytes()
    stops = ends - gone[ends]
    return [left[a:b] for a, b in zip([0, *stops[:-1]], stops)]


def removal_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes left."""

    def report(part: pa.Table, texts: list[bytes], removed: np.ndarray) -> pa.Table:
        lengths = np.array([len(text) for text in texts], np.int64)
        ends = np.cumsum(lengths)
        gone = np.concatenate([[0], np.cumsum(removed)])
        begins = removed.copy()
        begins[1:] &= ~removed[:-1]
        first = (ends - lengths)[lengths > 0]
        begins[first] = removed[first]
        runs = np.concatenate([[0], np.cumsum(begins)])
        return pa.table(
            {
                "doc_id": part.column("doc_id").cast(pa.int64()),
                "n_bytes": pa.array(lengths, pa.int64()),
                "n_removed": pa.array(gone[ends] - gone[ends - lengths], pa.int64()),
                "n_spans": pa.array(runs[ends] - runs[ends - lengths], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(left).hexdigest() for left in kept_parts(texts, removed)], pa.string()),
            }
        )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_removals(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", report)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with what is left of ``text``; characters cut in two are dropped, documents left empty too."""
    columns = [name if name in ("doc_id", "text") else f"column_{k}" for k, name in enumerate(docs.columns)]
    schema = ", ".join(f"{name} {kind}" for name, (_, kind) in zip(columns, docs.dtypes))

    def rewrite(part: pa.Table, texts: list[bytes], removed: np.ndarray) -> pa.Table:
        left = [text.decode(errors="ignore") for text in kept_parts(texts, removed)]
        whole = part.select(columns).set_column(columns.index("text"), "text", pa.array(left, pa.string()))
        return whole.filter(pa.array([bool(new) or not old for new, old in zip(left, texts)], pa.bool_()))

    return with_removals(docs.toDF(*columns), schema, rewrite).toDF(*docs.columns)
