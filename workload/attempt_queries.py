"""The attempt log and the submission table."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlframe.functions.content import file_safe_timestamp
from crawlframe.operators import attempts as A
from crawlframe.schemas import domain_violations
from crawlframe.session import scratch_path
from crawlframe.sources import queue
from crawlframe.sources.tables import append_rows, read_crawl_table, with_surrogate_key
from workload import frames
from workload.frames import PROFILE, with_tables
from workload.registry import query, sql_time, time_text

VISITED = sql_time("date_visited")


@query(
    "read_crawl_table",
    with_tables(
        f"""
        SELECT scrape_attempt_id, site_submission_id, {VISITED} AS date_visited,
               processed_status, claimed_by, error_string
        FROM attempt""",
        "attempt",
    ),
)
def read_table(spark, d):
    """A table as the crawler stored it, read back under the common names."""
    path = scratch_path(spark, "attempt")
    stored = frames.attempts(spark, d).withColumnRenamed(
        "site_submission_id", PROFILE.stored_submission_id
    )
    stored.write.parquet(path)
    rows = read_crawl_table(spark, path, "scrape_attempt")
    return rows.withColumn("date_visited", time_text(F.col("date_visited")))


@query(
    "append_rows",
    with_tables(
        f"""
        SELECT site_submission_id, {VISITED} AS date_visited, processed_status, claimed_by
        FROM attempt""",
        "attempt",
    ),
)
def append(spark, d):
    """Two appends with generated keys, read back without them."""
    path = scratch_path(spark, "append")
    rows = frames.attempts(spark, d).drop("scrape_attempt_id")
    failed = F.col("processed_status") == "error"
    first = with_surrogate_key(rows.filter(failed), "scrape_attempt_id")
    rest = with_surrogate_key(
        rows.filter(~failed), "scrape_attempt_id", natural_key=["site_submission_id", "date_visited"]
    )
    append_rows(first, path, "scrape_attempt")
    append_rows(rest, path, "scrape_attempt")
    return read_crawl_table(spark, path, "scrape_attempt").select(
        "site_submission_id",
        time_text(F.col("date_visited")).alias("date_visited"),
        "processed_status",
        "claimed_by",
    )


@query(
    "assert_domain",
    with_tables(
        """
        SELECT submission_id, claimed FROM (SELECT *, 'retired' AS claimed FROM submission)
        WHERE processed_status NOT IN ('todo', 'finished')""",
        "every_submission",
    ),
)
def domains(spark, d):
    """Rows with a status outside the domain, here made by renaming one status."""
    status = F.col("processed_status")
    rows = frames.all_submissions(spark, d).withColumn(
        "processed_status", F.when(status == "error", "retired").otherwise(status)
    )
    return domain_violations(rows, "submission").select(
        "submission_id", F.col("processed_status").alias("claimed")
    )


@query(
    "pending_items",
    with_tables(
        "SELECT submission_id, submission_status FROM submission WHERE processed_status = 'todo'",
        "every_submission",
    ),
)
def pending(spark, d):
    return A.pending_items(frames.all_submissions(spark, d)).select(
        "submission_id", "submission_status"
    )


@query(
    "parse_message_id",
    with_tables(
        """
        SELECT delivery_tag, body,
               CASE WHEN regexp_matches(body, '^[+-]?[0-9]+$') THEN TRY_CAST(body AS BIGINT) END
                 AS submission_id
        FROM message""",
        "message",
    ),
)
def parse_messages(spark, d):
    return queue.parse_message_id(frames.messages(spark, d)).select(
        "delivery_tag", F.col("value").cast("string").alias("body"), "submission_id"
    )


@query(
    "content_with_attempt",
    with_tables(
        f"""
        SELECT content_id, attempt_id, content_sha512, site_submission_id,
               {VISITED} AS date_visited, processed_status
        FROM content JOIN attempt ON attempt_id = scrape_attempt_id""",
        "attempt", "content",
    ),
)
def joined(spark, d):
    rows = A.content_with_attempt(frames.contents(spark, d), frames.attempts(spark, d))
    return rows.select(
        "content_id",
        "attempt_id",
        "content_sha512",
        "site_submission_id",
        time_text(F.col("date_visited")).alias("date_visited"),
        "processed_status",
    )


CLAIMS = """
    SELECT id, CASE WHEN submission_id IS NULL THEN 'new'
                    WHEN processed_status = 'finished' THEN 'skip' ELSE 'reuse' END AS action
    FROM (SELECT DISTINCT CAST(body AS BIGINT) AS id FROM message
          WHERE regexp_matches(body, '^[0-9]+$'))
    LEFT JOIN submission ON submission_id = id"""


@query("claim_submissions", with_tables(CLAIMS, "message", "submission"))
def claim(spark, d):
    good, _ = queue.split_messages(frames.messages(spark, d))
    return A.claim_submissions(good, frames.submissions(spark, d), "submission_id")


@query(
    "apply_claims",
    with_tables(
        f"""
        , claim AS ({CLAIMS})
        SELECT site_submission_id, processed_status, submission_status,
               CASE WHEN action = 'reuse' THEN '2025-01-01 00:00:00.000000' ELSE {VISITED} END
                 AS date_visited,
               CASE WHEN action = 'reuse' THEN 'me' ELSE 'worker' END AS claimed_by
        FROM submission LEFT JOIN claim ON id = site_submission_id
        UNION ALL
        SELECT id, 'todo', 'unknown', '2025-01-01 00:00:00.000000', 'me'
        FROM claim WHERE action = 'new'""",
        "message", "submission",
    ),
)
def apply(spark, d):
    """The submission table after all messages are claimed."""
    good, _ = queue.split_messages(frames.messages(spark, d))
    rows = frames.submissions(spark, d)
    claims = A.claim_submissions(good, rows, "submission_id")
    now = F.lit("2025-01-01").cast("timestamp_ntz")
    after = A.apply_claims(rows, claims, now, F.lit("me"))
    return after.select(
        "site_submission_id",
        "processed_status",
        "submission_status",
        time_text(F.col("date_visited")).alias("date_visited"),
        "claimed_by",
    )


OBSERVED = """CASE WHEN o_orderkey % 5 = 0 THEN NULL
                   WHEN o_totalprice > 150000 THEN 'exists' ELSE 'deleted' END"""


@query(
    "finish_submissions",
    with_tables(
        f"""
        SELECT site_submission_id,
               CASE WHEN open AND state IS NOT NULL THEN state ELSE submission_status END
                 AS submission_status,
               CASE WHEN open AND state IS NOT NULL THEN 'finished' ELSE processed_status END
                 AS processed_status
        FROM (SELECT submission.*, processed_status <> 'finished' AS open, {OBSERVED} AS state
              FROM submission LEFT JOIN orders ON o_orderkey = site_submission_id)""",
        "every_submission",
    ),
)
def finish(spark, d):
    """The submission table after visits to its ids, some without a result."""
    seen = frames.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("site_submission_id"), F.expr(OBSERVED).alias("submission_status")
    )
    after = A.finish_submissions(frames.all_submissions(spark, d), seen)
    return after.select("site_submission_id", "submission_status", "processed_status")


@query(
    "file_safe_timestamp",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H_%M_%S.%f') || '+0000' AS stamp FROM events",
)
def stamp(spark, d):
    return frames.table(spark, d, "events").select(
        "event_id", file_safe_timestamp(F.col("ts")).alias("stamp")
    )


@query(
    "attempts_by_status",
    with_tables(
        """
        SELECT site_submission_id, count(*) AS n_attempts,
               count(*) FILTER (processed_status = 'todo') AS n_todo,
               count(*) FILTER (processed_status = 'finished') AS n_finished,
               count(*) FILTER (processed_status = 'error') AS n_error
        FROM attempt GROUP BY 1""",
        "attempt",
    ),
)
def by_status(spark, d):
    return A.attempts_by_status(frames.attempts(spark, d))


@query(
    "latest_attempt",
    with_tables(
        f"""
        SELECT scrape_attempt_id, site_submission_id, {VISITED} AS date_visited,
               processed_status, claimed_by, error_string
        FROM attempt
        QUALIFY row_number() OVER (PARTITION BY site_submission_id
                                   ORDER BY date_visited DESC, scrape_attempt_id DESC) = 1""",
        "attempt",
    ),
)
def latest(spark, d):
    return A.latest_attempt(frames.attempts(spark, d)).withColumn(
        "date_visited", time_text(F.col("date_visited"))
    )


LATEST_STATUS = with_tables(
    """
    SELECT site_submission_id, processed_status FROM attempt
    QUALIFY row_number() OVER (PARTITION BY site_submission_id
                               ORDER BY date_visited DESC, scrape_attempt_id DESC) = 1""",
    "attempt",
)


@query("latest_status", LATEST_STATUS)
def latest_status(spark, d):
    return A.latest_status(frames.attempts(spark, d))


@query(
    "retry_candidates",
    """
    SELECT user_id * 100 + day(ts) AS site_submission_id, count(*) AS n_attempts
    FROM events GROUP BY 1 HAVING NOT bool_or(event_type = 'purchase')""",
)
def retry(spark, d):
    return A.retry_candidates(frames.day_attempts(spark, d))


@query(
    "status_rollup",
    with_tables(
        """
        SELECT submission_status, processed_status, count(*) AS n,
               grouping(submission_status, processed_status) AS level
        FROM submission GROUP BY ROLLUP (submission_status, processed_status)""",
        "every_submission",
    ),
)
def rollup(spark, d):
    return A.status_rollup(frames.all_submissions(spark, d))


@query(
    "worker_throughput",
    with_tables(
        f"""
        SELECT {sql_time("date_trunc('hour', date_visited)")} AS window_start, claimed_by,
               count(*) AS n_attempts
        FROM attempt GROUP BY 1, 2""",
        "attempt",
    ),
)
def throughput(spark, d):
    return A.worker_throughput(frames.attempts(spark, d)).withColumn(
        "window_start", time_text(F.col("window_start"))
    )


@query(
    "worker_sessions",
    with_tables(
        f"""
        , marked AS (
          SELECT *, CASE WHEN date_diff('microsecond', lag(date_visited) OVER w, date_visited)
                              <= 5400000000 THEN 0 ELSE 1 END AS starts
          FROM attempt
          WINDOW w AS (PARTITION BY claimed_by ORDER BY date_visited, scrape_attempt_id)),
        numbered AS (
          SELECT *, sum(starts) OVER (PARTITION BY claimed_by
                                      ORDER BY date_visited, scrape_attempt_id) AS no
          FROM marked)
        SELECT claimed_by, {sql_time("min(date_visited)")} AS session_start,
               {sql_time("max(date_visited)")} AS session_end, count(*) AS n_attempts
        FROM numbered GROUP BY claimed_by, no""",
        "attempt",
    ),
)
def sessions(spark, d):
    found = A.worker_sessions(frames.attempts(spark, d), idle_seconds=5400)
    return found.select(
        "claimed_by",
        time_text(F.col("session_start")).alias("session_start"),
        time_text(F.col("session_end")).alias("session_end"),
        "n_attempts",
    )


@query(
    "orphan_rows",
    with_tables(
        """
        SELECT 'content_without_attempt' AS kind, content_id AS id FROM content
        WHERE attempt_id NOT IN (SELECT scrape_attempt_id FROM attempt)
        UNION ALL
        SELECT 'finished_without_content', scrape_attempt_id FROM attempt
        WHERE processed_status = 'finished'
          AND scrape_attempt_id NOT IN (SELECT attempt_id FROM content)""",
        "attempt", "content",
    ),
)
def orphans(spark, d):
    return A.orphan_rows(frames.contents(spark, d), frames.attempts(spark, d))
