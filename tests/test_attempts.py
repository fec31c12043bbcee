from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crawlframe import schemas
from crawlframe.operators import attempts as A
from crawlframe.operators import names as N
from crawlframe.sources import tables
from tests.conftest import explained

START = datetime(2024, 1, 1)
COLUMNS = (
    "scrape_attempt_id long, site_submission_id long, date_visited timestamp,"
    " processed_status string, claimed_by string, error_string string"
)


def attempt_table(spark, seed, n=400):
    """A log in which one id and one worker hold a third of all rows."""
    rng = random.Random(seed)
    rows = []
    for key in range(n):
        hot = rng.random() < 0.34
        rows.append(
            (
                key,
                1 if hot else rng.randrange(30),
                START + timedelta(seconds=rng.randrange(40_000)),
                rng.choice(["todo", "finished", "error"]),
                "w0" if hot else f"w{rng.randrange(1, 9)}",
                None,
            )
        )
    return rows, spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("seed", range(3))
def test_latest_attempt(spark, seed):
    rows, log = attempt_table(spark, seed)
    newest = {}
    for row in rows:
        if row[1] not in newest or (row[2], row[0]) > (newest[row[1]][2], newest[row[1]][0]):
            newest[row[1]] = row
    assert sorted(tuple(r) for r in A.latest_attempt(log).collect()) == sorted(newest.values())
    status = {r[0]: r[1] for r in A.latest_status(log).collect()}
    assert status == {key: row[3] for key, row in newest.items()}


def brute_sessions(rows, idle):
    found, by_worker = [], defaultdict(list)
    for row in rows:
        by_worker[row[4]].append((row[2], row[0]))
    for worker, times in by_worker.items():
        run = []
        for moment, _ in sorted(times):
            if run and moment - run[-1] > timedelta(seconds=idle):
                found.append((worker, run[0], run[-1], len(run)))
                run = []
            run.append(moment)
        found.append((worker, run[0], run[-1], len(run)))
    return sorted(found)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(
    "idle, slot_seconds", [(300, 100), (60, 700), (5000, 86_400), (1, 20), (2000, 1)]
)
def test_sessions_against_brute_force(spark, seed, idle, slot_seconds):
    rows, log = attempt_table(spark, seed)
    found = A.worker_sessions(log, idle, slot_seconds)
    assert sorted(tuple(r) for r in found.collect()) == brute_sessions(rows, idle)


def test_status_counts(spark):
    rows, log = attempt_table(spark, 5)
    for r in A.attempts_by_status(log).collect():
        mine = [row[3] for row in rows if row[1] == r.site_submission_id]
        assert r.n_attempts == len(mine)
        assert (r.n_todo, r.n_finished, r.n_error) == tuple(
            mine.count(s) for s in ("todo", "finished", "error")
        )
    never = {row[1] for row in rows} - {row[1] for row in rows if row[3] == "finished"}
    assert {r[0] for r in A.retry_candidates(log).collect()} == never


SUBMISSION = (
    "submission_id long, site_submission_id long, date_visited timestamp,"
    " submission_status string, processed_status string, claimed_by string"
)


def submission_table(spark):
    return spark.createDataFrame(
        [
            (1, 10, START, "exists", "finished", "a"),
            (2, 20, START, "unknown", "todo", "a"),
            (3, 30, START, "unknown", "error", "a"),
            (4, 40, START, "exists", "finished", "a"),
            (5, 40, START, "unknown", "todo", "a"),
        ],
        SUBMISSION,
    )


def test_claims(spark):
    incoming = spark.createDataFrame([(i,) for i in [10, 20, 20, 30, 40, 50, 50, None]], "id long")
    claims = A.claim_submissions(incoming, submission_table(spark))
    assert {r.id: r.action for r in claims.collect()} == {
        10: "skip", 20: "reuse", 30: "reuse", 40: "conflict", 50: "new"
    }
    assert claims.count() == 5
    later = F.lit("2025-01-01").cast("timestamp")
    after = A.apply_claims(submission_table(spark), claims, later, F.lit("me")).collect()
    assert len(after) == 6
    moved = {r.site_submission_id: r for r in after if r.claimed_by == "me"}
    assert set(moved) == {20, 30, 50}
    assert moved[30].processed_status == "error" and moved[30].date_visited.year == 2025
    assert (moved[50].submission_status, moved[50].processed_status) == ("unknown", "todo")


def test_lookup_unique(spark):
    ids = spark.createDataFrame([(i,) for i in [10, 10, 40, 99, None]], "site_submission_id long")
    found, several = N.lookup_unique(ids, submission_table(spark), "site_submission_id")
    assert {r.site_submission_id: r.submission_id for r in found.collect()} == {10: 1, 99: None}
    assert [tuple(r) for r in several.collect()] == [(40, 2)]


def test_rollup_levels(spark):
    rows = {(r[0], r[1]): (r.n, r.level) for r in A.status_rollup(submission_table(spark)).collect()}
    assert rows[("exists", "finished")] == (2, 0)
    assert rows[("unknown", None)] == (3, 1)
    assert rows[(None, None)] == (5, 3)


def test_orphans(spark):
    log = spark.createDataFrame(
        [(1, "finished"), (2, "finished"), (3, "todo")],
        "scrape_attempt_id long, processed_status string",
    )
    content = spark.createDataFrame([(7, 1), (8, 9), (9, 9), (10, 1)], "content_id long, attempt_id long")
    assert sorted(tuple(r) for r in A.orphan_rows(content, log).collect()) == [
        ("content_without_attempt", 8), ("content_without_attempt", 9),
        ("finished_without_content", 2),
    ]


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "user_name string")


def test_names_are_case_sensitive_and_never_null(spark):
    found, users = names(spark, "a", "A", "a", None, "b"), names(spark, "a", "c", None)
    assert {r[0] for r in N.known_users(found, users).collect()} == {"a"}
    assert {r[0] for r in N.new_users(found, users).collect()} == {"A", "b"}
    assert {r[0] for r in N.set_union(found, users).collect()} == {"a", "A", "b", "c"}
    now = F.lit("2025-01-01").cast("timestamp")
    assert N.insert_ignore_users(names(spark), users, now).count() == 0
    added = N.insert_ignore_users(found, users, now)
    again = N.insert_ignore_users(found, users, now)
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, again.collect()))
    dimension = added.select("user_name").union(users)
    assert N.new_users(found, dimension).count() == 0


def test_top_mentioned(spark):
    rows = [(p, "icon", n) for n, pages in {"x": 3, "y": 3, "z": 1}.items() for p in range(pages)]
    rows += [(0, "icon", "z")] * 9 + [(1, "link", "q"), (1, "link", None)]
    mentions = spark.createDataFrame(rows, "page_id long, role string, user_name string")
    assert sorted(tuple(r) for r in N.top_mentioned(mentions, 2).collect()) == [
        ("icon", "x", 3, 1), ("icon", "y", 3, 2), ("link", "q", 1, 1)
    ]


def test_surrogate_keys(spark):
    rows = spark.range(1000).repartition(7)
    keyed = tables.with_surrogate_key(rows, "key", after=500)
    keys = [r.key for r in keyed.collect()]
    assert len(set(keys)) == 1000 and min(keys) > 500
    first = tables.with_surrogate_key(rows, "key", natural_key=["id"]).orderBy("id").collect()
    second = tables.with_surrogate_key(rows.repartition(3), "key", natural_key=["id"])
    assert first == second.orderBy("id").collect()


def test_domains(spark):
    good = submission_table(spark)
    assert schemas.domain_violations(good, "submission").count() == 0
    assert schemas.assert_domain(good, "submission_status", ["exists"]).count() == 3
    bad = good.withColumn("submission_status", F.when(F.col("submission_id") > 1, "gone"))
    assert schemas.domain_violations(bad, "submission").count() == 5
    assert schemas.assert_domain(bad, "submission_status", schemas.SUBMISSION_STATUS).count() == 5


def test_stored_column_name_is_accepted(spark, tmp_path):
    stored = submission_table(spark).withColumnRenamed("site_submission_id", "gallery_submission_id")
    stored.write.parquet(str(tmp_path / "t"))
    rows = tables.read_crawl_table(spark, str(tmp_path / "t"), "submission")
    assert rows.columns == schemas.TABLES["submission"].names
    assert {r.site_submission_id for r in rows.collect()} == {10, 20, 30, 40}


def test_claims_are_dealt_by_the_number_of_rows(spark):
    """As many tasks as the rows ask for, whatever their keys; rows without an id stay as they are."""
    assert A.tasks_for(9_000_000, spark) == 18 and A.tasks_for(3, spark) == spark.sparkContext.defaultParallelism
    incoming = spark.createDataFrame([(i,) for i in [10, 20, 20, 30, 40, 50, 50, None]], "id long")
    nobody = spark.createDataFrame([(6, None, START, "unknown", "todo", "a")] * 2, SUBMISSION)
    table = submission_table(spark).union(nobody)
    claims = A.claim_submissions(incoming, table, rows_per_task=1)
    assert claims.rdd.getNumPartitions() == 14
    left_to_spark = A.claim_submissions(incoming, table, rows_per_task=None)
    assert sorted(map(tuple, claims.collect())) == sorted(map(tuple, left_to_spark.collect()))
    after = A.apply_claims(table, claims, F.lit("2025-01-01").cast("timestamp"), F.lit("me"))
    assert after.filter("site_submission_id IS NULL AND claimed_by = 'a'").count() == 2 and after.count() == 8
    assert "REPARTITION_BY_NUM" in explained(after)
