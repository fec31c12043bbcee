"""Claims with deadlines, against the same rules by hand."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest

from crawlframe.streaming import claims as C
from crawlframe.streaming.batches import read_batches

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
LIMIT = 3600


def moment(minutes):
    return START + timedelta(minutes=minutes)


def add_batch(spark, path, rows):
    """One file of events (id, kind, minutes)."""
    frame = spark.createDataFrame([(key, kind, None if at is None else moment(at)) for key, kind, at in rows], C.EVENT)
    frame.coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, submissions=None):
    events = spark.readStream.schema(C.EVENT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/events")
    C.stream_claims(events, f"{tmp_path}/claim", f"{tmp_path}/check", LIMIT, "0 seconds", submissions).awaitTermination()
    return read_batches(spark, f"{tmp_path}/claim", C.CLAIM_LOG)


def told(log):
    rows = log.orderBy("id", "step").collect()
    return [(r.id, r.action, (r.at.replace(tzinfo=timezone.utc) - START).total_seconds() / 60, r.n_claims) for r in rows]


def by_hand(events, until):
    """The log of all events in time order, and of deadlines up to ``until``."""
    log, state = [], {}
    for key in sorted({key for key, _, _ in events}):
        status, deadline, n = None, 0, 0
        mine = sorted((at, kind) for k, kind, at in events if k == key)
        for at, kind in [*mine, (until, "end")]:
            if status == "claimed" and (at >= deadline if kind != "end" else deadline < until):
                log.append((key, "expired", deadline, n))
                status = "expired"
            if status == "finished" or kind == "end":
                continue
            if kind == "finished":
                status = "finished"
                log.append((key, "finished", at, n))
            else:
                n += 1
                log.append((key, "new" if status is None else "reuse", at, n))
                status, deadline = "claimed", at + LIMIT / 60
        state[key] = status
    return log, state


def test_a_worker_that_dies(spark, tmp_path):
    path = f"{tmp_path}/events"
    add_batch(spark, path, [(1, "message", 0), (2, "message", 0), (None, "message", 1), (5, "message", None)])
    assert told(run(spark, tmp_path)) == [(1, "new", 0, 1), (2, "new", 0, 1)]
    add_batch(spark, path, [(2, "finished", 30)])  # worker 1 is dead, worker 2 is done
    add_batch(spark, path, [(3, "message", 100)])  # time goes on: the timer of 1 rings
    log = told(run(spark, tmp_path))
    assert (1, "expired", 60, 1) in log and (2, "finished", 30, 1) in log and not any(row[:2] == (2, "expired") for row in log)
    add_batch(spark, path, [(1, "message", 110), (2, "message", 111)])  # 1 is work again, 2 is not
    add_batch(spark, path, [(1, "finished", 120)])
    log = told(run(spark, tmp_path))
    assert [row for row in log if row[0] == 1] == [(1, "new", 0, 1), (1, "expired", 60, 1), (1, "reuse", 110, 2), (1, "finished", 120, 2)]
    now = {row.id: row.action for row in C.current_claims(read_batches(spark, f"{tmp_path}/claim", C.CLAIM_LOG)).collect()}
    assert now == {1: "finished", 2: "finished", 3: "new"}


@pytest.mark.parametrize("batches", [1, 3])
def test_cuts_of_batches_do_not_matter(spark, tmp_path, batches):
    rng = random.Random(5)
    events = [(rng.randrange(12), rng.choice(["message", "message", "finished"]), rng.randrange(600)) for _ in range(60)]
    events.append((99, "message", 1000))
    ordered = sorted(events, key=lambda one: one[2])
    for k in range(batches):
        add_batch(spark, f"{tmp_path}/events", ordered[k * 61 // batches : (k + 1) * 61 // batches])
    log, _ = by_hand(events, 1000)
    assert sorted(told(run(spark, tmp_path))) == sorted(log)


def test_snapshot_to_begin_with(spark, tmp_path):
    known = spark.createDataFrame([(1, "finished"), (2, "todo"), (3, "todo"), (3, "finished")], "site_submission_id long, processed_status string")
    add_batch(spark, f"{tmp_path}/events", [(k, "message", 5) for k in (1, 2, 3, 4)])
    assert told(run(spark, tmp_path, known)) == [(2, "reuse", 5, 1), (4, "new", 5, 1)]


def test_session_with_another_state_store(spark, tmp_path):
    """A session that keeps state on the heap runs it too, and has its own setting back."""
    session = spark.newSession()
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    session.conf.set(C.PROVIDER, other)
    add_batch(session, f"{tmp_path}/events", [(1, "message", 0), (2, "message", 90), (2, "message", 200)])
    log = run(session, tmp_path)
    assert told(log) == [(1, "new", 0, 1), (1, "expired", 60, 1), (2, "new", 90, 1), (2, "expired", 150, 1), (2, "reuse", 200, 2)]
    assert session.conf.get(C.PROVIDER) == other


def test_ids_of_a_range_share_their_state(spark, tmp_path):
    """The store is called and a timer set per range of ids, not per id."""
    ids = range(-600, 600)
    add_batch(spark, f"{tmp_path}/events", [(k, "message", k % 7) for k in ids])
    events = spark.readStream.schema(C.EVENT).parquet(f"{tmp_path}/events")
    query = C.stream_claims(events, f"{tmp_path}/claim", f"{tmp_path}/check", LIMIT, "0 seconds")
    query.awaitTermination()
    updated = [one["numRowsUpdated"] for batch in query.recentProgress for one in batch["stateOperators"]]
    assert 0 < sum(updated) < 60
    log = told(read_batches(spark, f"{tmp_path}/claim", C.CLAIM_LOG))
    assert sorted(log) == sorted((k, "new", k % 7, 1) for k in ids)


def test_ranges_with_many_deadlines(spark, tmp_path):
    """The timer of a range goes from deadline to deadline, over negative ids and moments of any year too."""
    rng = random.Random(8)
    events = [(rng.randrange(-300, 300), rng.choice(["message", "message", "finished"]), rng.randrange(900)) for _ in range(900)]
    events += [(1000, "message", 1200), (1000, "message", 1_000_000_000)]
    ordered = sorted(events, key=lambda one: one[2])
    for k in range(3):
        add_batch(spark, f"{tmp_path}/events", ordered[k * 902 // 3 : (k + 1) * 902 // 3])
    log, _ = by_hand(events, 1_000_000_000)
    assert sorted(told(run(spark, tmp_path))) == sorted(log)


def test_packed_claims():
    claims = {-7: (C.CLAIMED, -1, 2, 3), 2**62: (C.FINISHED, 2**53, 1, 2), 0: (C.EXPIRED, 0, 0, 0)}
    assert C.unpack(C.pack(claims)) == claims
    assert C.next_ring(claims) == -1 and C.next_ring({}) is None and C.unpack(b"") == {}
