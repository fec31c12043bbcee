"""Claims as keyed state with timers: an id that is not finished in time comes out again.

Per id the state store holds where it is: claimed until a deadline, expired, or
finished.  Ids are kept in ranges of ``1 << RANGE_BITS``: a call to the store, a
timer and a batch of output cost far more than the claim they are for, and are
paid once per range.  A micro-batch touches the ranges it has events for and the
timers that the watermark has passed, never what earlier batches wrote; a range
has a fixed length, so that is a fixed cost per event at any number of ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby
from operator import itemgetter

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from crawlframe.schemas import SITE_ID
from crawlframe.session import ROCKSDB
from crawlframe.sources.queue import split_messages
from crawlframe.sources.shipping import ship
from crawlframe.streaming.batches import write_batch

CLAIMED, EXPIRED, FINISHED = "claimed", "expired", "finished"
RANGE_BITS = 8
#: The claims of a range, as packed rows: in the store they are one value.
STATE = "claims binary"
PACKED = np.dtype([("id", "<i8"), ("status", "S8"), ("deadline", "<i8"), ("n_claims", "<i4"), ("step", "<i4")])
CHANGES = "ids array<long>, actions array<string>, at_ms array<long>, n_claims array<int>, steps array<int>"
CLAIM_LOG = "id long, action string, at timestamp, n_claims int, step int"
EVENT = "id long, kind string, ts timestamp"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def pack(claims: dict[int, tuple]) -> bytes:
    return np.array([(key, *claim) for key, claim in claims.items()], PACKED).tobytes()


def unpack(packed: bytes) -> dict[int, tuple]:
    """``status, deadline, n_claims, step`` by id."""
    rows = np.frombuffer(packed, PACKED).tolist()
    return {key: (status.decode(), *rest) for key, status, *rest in rows}


def next_ring(claims: dict[int, tuple]) -> int | None:
    """The earliest deadline of a claimed id."""
    return min((deadline for status, deadline, _, _ in claims.values() if status == CLAIMED), default=None)


class ClaimMachine(StatefulProcessor):
    """``new`` or ``reuse`` for a message that is to be worked on, ``expired`` and ``finished`` as they come.

    Events of an id count in time order within a micro-batch, a ``finished``
    before a message of the same moment.  A message for a claimed id claims it
    again and moves the deadline; one for a finished id gives nothing.  An
    event at or after the deadline finds the claim expired, whether or not the
    timer has rung, so the outcome does not hang on how micro-batches are cut.

    The key is a range of ids; its timer rings at the earliest deadline in it.
    """

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("claims", STATE)

    def _get(self) -> dict[int, tuple]:
        held = self.state.get()  # one call to the store
        return unpack(held[0]) if held else {}

    def _put(self, claims: dict[int, tuple], rang: int | None) -> None:
        """Store the claims of a range whose timer was set to ``rang``."""
        self.state.update((pack(claims),))
        ring = next_ring(claims)
        if ring != rang:
            if rang is not None:
                self.handle.deleteTimer(rang)
            if ring is not None:
                self.handle.registerTimer(ring)

    @staticmethod
    def _rows(changes: list[tuple]) -> Iterator[Row]:
        """The changes as one row of columns."""
        if changes:
            ids, actions, at_ms, n_claims, steps = map(list, zip(*changes))
            yield Row(ids=ids, actions=actions, at_ms=at_ms, n_claims=n_claims, steps=steps)

    def _walk(self, key: int, claim: tuple, events: Iterator[tuple], changes: list[tuple]) -> tuple:
        """The claim of an id after its events, whose changes are added to ``changes``."""
        status, deadline, n_claims, step = claim
        for _, at, kind in events:
            if status == CLAIMED and at >= deadline:
                status, step = EXPIRED, step + 1
                changes.append((key, EXPIRED, deadline, n_claims, step))
            if status == FINISHED:
                continue
            if kind == FINISHED:
                status, action = FINISHED, FINISHED
            else:
                action = "reuse" if status else "new"
                status, deadline, n_claims = CLAIMED, at + self.timeout_ms, n_claims + 1
            step += 1
            changes.append((key, action, at, n_claims, step))
        return status, deadline, n_claims, step

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        claims = self._get()
        rang, changes = next_ring(claims), []
        events = sorted((row.id, row.at_ms, row.kind) for row in rows)
        for one, mine in groupby(events, itemgetter(0)):
            claims[one] = self._walk(one, claims.get(one, ("", 0, 0, 0)), mine, changes)
        if changes:
            self._put(claims, rang)
        yield from self._rows(changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()  # timers up to it have rung
        claims, changes = self._get(), []
        for one, (status, deadline, n_claims, step) in claims.items():
            if status == CLAIMED and deadline <= now:
                claims[one] = (EXPIRED, deadline, n_claims, step + 1)
                changes.append((one, EXPIRED, deadline, n_claims, step + 1))
        if changes:
            self._put(claims, None)  # Spark takes away the timer that has rung
        yield from self._rows(changes)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        done, todo = (FINISHED, 0, 0, 0), (EXPIRED, 0, 0, 0)
        ids = zip(initialState.ids, initialState.finished)
        self._put({one: done if finished else todo for one, finished in ids}, None)

    def close(self) -> None:
        pass


def range_of(key: str) -> Column:
    return F.shiftright(key, RANGE_BITS).alias("range")


def message_events(messages: DataFrame) -> DataFrame:
    """Messages of a queue that hold an id, as events."""
    good, _ = split_messages(messages)
    return good.select(F.col("submission_id").alias("id"), F.lit("message").alias("kind"), F.col("ts").cast("timestamp").alias("ts"))


def finish_events(visited: DataFrame, moment: Column) -> DataFrame:
    """Finished ids (``site_submission_id``) as events."""
    return visited.select(F.col(SITE_ID).cast("long").alias("id"), F.lit(FINISHED).alias("kind"), moment.cast("timestamp").alias("ts"))


def claim_changes(
    events: DataFrame, timeout_seconds: int, delay: str = "10 minutes", submissions: DataFrame | None = None
) -> DataFrame:
    """Stream of ``id, action, at, n_claims, step`` for a stream of :data:`EVENT` rows.

    Rows without id or moment are dropped.  ``submissions`` is a snapshot to
    begin with: finished ids stay finished, others are claimed as ``reuse``;
    of several rows of an id one that is finished counts.
    """
    known = events.filter("id IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", delay)
    keyed = known.withColumn("at_ms", F.unix_millis("ts")).withColumn("range", range_of("id")).groupBy("range")
    initial = None
    if submissions is not None:
        rows = submissions.select(F.col(SITE_ID).cast("long").alias("id"), "processed_status").filter("id IS NOT NULL")
        done = F.coalesce(F.bool_or(F.col("processed_status") == FINISHED), F.lit(False))
        ids = rows.groupBy("id").agg(done.alias("finished")).groupBy(range_of("id"))
        pairs = ids.agg(F.collect_list(F.struct("id", "finished")).alias("pairs"))
        initial = pairs.select("range", F.col("pairs.id").alias("ids"), "pairs.finished").groupBy("range")
    changes = keyed.transformWithState(ClaimMachine(1000 * timeout_seconds), CHANGES, "Update", "EventTime", initial)
    each = changes.select(F.inline(F.arrays_zip("ids", "actions", "at_ms", "n_claims", "steps")))
    return each.select(
        F.col("ids").alias("id"), F.col("actions").alias("action"), F.timestamp_millis("at_ms").alias("at"), "n_claims",
        F.col("steps").alias("step"),
    )


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's own setting comes back after.

    A query takes the settings over when it starts, so others are not touched.
    """
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def stream_claims(
    events: DataFrame,
    claims_path: str,
    checkpoint: str,
    timeout_seconds: int,
    delay: str = "10 minutes",
    submissions: DataFrame | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Log of claims below ``claims_path``; ``new`` and ``reuse`` rows are the work to do, ``expired`` ids are free again.

    A repeated micro-batch overwrites what it wrote.  State is kept in RocksDB,
    as Spark demands for timers, whatever the session's own provider is.
    """
    changes = claim_changes(events, timeout_seconds, delay, submissions)
    writer = (
        changes.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, claims_path, batch_id))
        .option("checkpointLocation", checkpoint)
    )
    with rocksdb_state(events.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_claims(log: DataFrame) -> DataFrame:
    """``id, action, at, n_claims`` of each id's last change."""
    last = F.max_by(F.struct("action", "at", "n_claims"), "step")
    return log.groupBy("id").agg(last.alias("_last")).select("id", "_last.*")


ship(__name__)
