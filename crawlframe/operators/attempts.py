"""The attempt log: states, claims, sessions, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlframe.operators.ordered import SLOT, slot_of
from crawlframe.schemas import SITE_ID


def pending_items(items: DataFrame, status: str = "processed_status") -> DataFrame:
    """All items still to do."""
    return items.filter(F.col(status) == "todo")


def content_with_attempt(content: DataFrame, attempts: DataFrame) -> DataFrame:
    """Each content row with its attempt; a skewed key is split by adaptive execution."""
    joined = content["attempt_id"] == attempts["scrape_attempt_id"]
    return content.join(attempts, joined, "inner")


def attempts_by_status(attempts: DataFrame) -> DataFrame:
    """Attempts per id: all, and one count per status."""
    status = F.col("processed_status")
    return attempts.groupBy(SITE_ID).agg(
        F.count("*").alias("n_attempts"),
        F.count_if(status == "todo").alias("n_todo"),
        F.count_if(status == "finished").alias("n_finished"),
        F.count_if(status == "error").alias("n_error"),
    )


def latest_attempt(attempts: DataFrame) -> DataFrame:
    """The newest attempt of each id, the larger attempt id on equal dates.

    An aggregate, not a window: each task keeps one row per id before the
    shuffle, however many attempts an id has.
    """
    others = [name for name in attempts.columns if name != SITE_ID]
    newest = F.max_by(F.struct(*others), F.struct("date_visited", "scrape_attempt_id"))
    return (
        attempts.groupBy(SITE_ID)
        .agg(newest.alias("_newest"))
        .select(SITE_ID, "_newest.*")
        .select(*attempts.columns)
    )


def latest_status(attempts: DataFrame) -> DataFrame:
    """Batch form of the status stream: the status last written per id."""
    order = F.struct("date_visited", "scrape_attempt_id")
    return attempts.groupBy(SITE_ID).agg(
        F.max_by("processed_status", order).alias("processed_status")
    )


def retry_candidates(attempts: DataFrame) -> DataFrame:
    """Ids that no attempt ever finished, with their number of attempts."""
    finished = F.bool_or(F.col("processed_status") == "finished")
    return (
        attempts.groupBy(SITE_ID)
        .agg(F.count("*").alias("n_attempts"), finished.alias("_finished"))
        .filter(~F.col("_finished"))
        .drop("_finished")
    )


def status_rollup(submissions: DataFrame) -> DataFrame:
    """Counts by submission and processed status with subtotals.

    The table is counted once by both columns; the subtotals roll up those few
    counts instead of three copies of every row.  ``level`` is 0 for a detail
    row, 1 for a subtotal, 3 for the total.
    """
    counted = submissions.groupBy("submission_status", "processed_status").agg(
        F.count("*").alias("_n")
    )
    return counted.rollup("submission_status", "processed_status").agg(
        F.sum("_n").alias("n"), F.grouping_id().cast("long").alias("level")
    )


def worker_throughput(attempts: DataFrame, width: str = "1 hour") -> DataFrame:
    """Attempts per worker and time window."""
    return (
        attempts.groupBy(F.window("date_visited", width).alias("_w"), "claimed_by")
        .agg(F.count("*").alias("n_attempts"))
        .select(F.col("_w.start").alias("window_start"), "claimed_by", "n_attempts")
    )


def worker_sessions(
    attempts: DataFrame, idle_seconds: int = 1800, slot_seconds: int = 86_400
) -> DataFrame:
    """Runs of attempts of a worker with no pause longer than ``idle_seconds``.

    ``claimed_by, session_start, session_end, n_attempts``.  Attempts at the
    same moment are counted into one row before the shuffle, so a bulk import
    with one timestamp is one row per task.  A worker's moments are put
    together within slots of ``slot_seconds``; of the pieces of a slot only the
    first and the last can go on in another slot, and only these, at most two
    per slot, meet in one window per worker.
    """
    worker, second = "claimed_by", 1_000_000
    start = slot_of(F.col("date_visited"), slot_seconds)
    moments = attempts.groupBy(worker, start.alias(SLOT), "date_visited").agg(F.count("*").alias("_n"))

    def micros(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp"))

    def starts(before: str, at: str) -> Column:
        pause = micros(at) - micros(before)
        return F.when(F.col(before).isNull() | (pause > idle_seconds * second), 1).otherwise(0)

    slot = Window.partitionBy(worker, SLOT)
    walk = slot.orderBy("date_visited")
    pieces = (
        moments.withColumn("_before", F.lag("date_visited").over(walk))
        .withColumn("_no", F.sum(starts("_before", "date_visited")).over(walk))
        .groupBy(worker, SLOT, "_no")
        .agg(
            F.min("date_visited").alias("session_start"),
            F.max("date_visited").alias("session_end"),
            F.sum("_n").alias("n_attempts"),
        )
        .withColumn("_last_no", F.max("_no").over(slot))
    )
    # A piece between two others of its slot is whole and gets a lane to itself;
    # the others of a worker share lane 0.
    whole = (F.col("_no") > 1) & (F.col("_no") < F.col("_last_no"))
    lane = F.when(whole, F.struct(SLOT, "_no")).otherwise(F.lit(None))
    along = Window.partitionBy(worker, "_lane").orderBy(SLOT, "_no")
    return (
        pieces.withColumn("_lane", lane)
        .withColumn("_before", F.lag("session_end").over(along))
        .withColumn("_session", F.sum(starts("_before", "session_start")).over(along))
        .groupBy(worker, "_lane", "_session")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("n_attempts").alias("n_attempts"),
        )
        .select(worker, "session_start", "session_end", "n_attempts")
    )


def orphan_rows(content: DataFrame, attempts: DataFrame) -> DataFrame:
    """``kind, id``: content without attempt, finished attempts without content."""
    attempt_ids = attempts.select(F.col("scrape_attempt_id").alias("id"))
    content_ids = content.select(F.col("attempt_id").alias("id")).distinct()
    stray = content.select(F.col("attempt_id").alias("id"), "content_id").join(
        attempt_ids, "id", "left_anti"
    )
    finished = attempts.filter(F.col("processed_status") == "finished").select(
        F.col("scrape_attempt_id").alias("id")
    )
    bare = finished.join(content_ids, "id", "left_anti")
    return stray.select(
        F.lit("content_without_attempt").alias("kind"), F.col("content_id").alias("id")
    ).unionByName(
        bare.select(F.lit("finished_without_content").alias("kind"), F.col("id"))
    )


#: Rows that meet in one task of a claim; sorted on both sides they take some 100 MB.
ROWS_PER_TASK = 500_000


def tasks_for(rows: int, spark: SparkSession, rows_per_task: int = ROWS_PER_TASK) -> int:
    """A task per core, and more where tables are large, so that a task's memory does not grow with them."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_task))


def claim_submissions(
    incoming: DataFrame, submissions: DataFrame, id_column: str = "id", rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """What to do with each distinct incoming id: ``id, action``.

    ``skip`` if its row is finished, ``reuse`` if its row is not, ``new``
    without a row, ``conflict`` if it has several rows.  Both sides are counted
    and dealt out in tasks of about ``rows_per_task``; None leaves that to
    adaptive execution, for small inputs.
    """
    wanted = incoming.select(F.col(id_column).cast("long").alias("id")).filter(
        F.col("id").isNotNull()
    )
    ids, rows = wanted.distinct(), submissions
    if rows_per_task:
        n = tasks_for(wanted.count() + rows.count(), rows.sparkSession, rows_per_task)
        ids, rows = ids.repartition(n, "id"), rows.filter(F.col(SITE_ID).isNotNull()).repartition(n, SITE_ID)
    theirs = rows.join(ids.select(F.col("id").alias(SITE_ID)), SITE_ID, "left_semi")
    known = theirs.groupBy(F.col(SITE_ID).alias("id")).agg(
        F.count("*").alias("_rows"), F.max("processed_status").alias("_status")
    )
    action = (
        F.when(F.col("_rows").isNull(), "new")
        .when(F.col("_rows") > 1, "conflict")
        .when(F.col("_status") == "finished", "skip")
        .otherwise("reuse")
    )
    return ids.join(known, "id", "left").select("id", action.alias("action"))


def apply_claims(
    submissions: DataFrame, claims: DataFrame, visited_at: Column, worker: Column
) -> DataFrame:
    """Snapshot after the claims: reused rows re-dated, new rows added as ``todo``.

    A new row's key is its id, the same whenever the job is run again.  Rows
    are counted and dealt out in tasks of about :data:`ROWS_PER_TASK`; those
    without an id meet no claim and are not moved.
    """
    n = tasks_for(submissions.count(), submissions.sparkSession)
    reused = claims.filter(F.col("action") == "reuse").select(
        F.col("id").alias(SITE_ID), F.lit(True).alias("_reuse")
    )
    columns = submissions.columns
    has_id = F.col(SITE_ID).isNotNull()
    kept = (
        submissions.filter(has_id)
        .repartition(n, SITE_ID)
        .join(reused.repartition(n, SITE_ID), SITE_ID, "left")
        .withColumn("date_visited", F.when(F.col("_reuse"), visited_at).otherwise(F.col("date_visited")))
        .withColumn("claimed_by", F.when(F.col("_reuse"), worker).otherwise(F.col("claimed_by")))
        .select(*columns)
    )
    added = claims.filter(F.col("action") == "new").select(
        F.col("id").alias("submission_id"),
        F.col("id").alias(SITE_ID),
        visited_at.alias("date_visited"),
        F.lit("unknown").alias("submission_status"),
        F.lit("todo").alias("processed_status"),
        worker.alias("claimed_by"),
    )
    return kept.unionByName(submissions.filter(~has_id)).unionByName(added.select(*columns))


def finish_submissions(
    submissions: DataFrame, observed: DataFrame, moment: str | None = None
) -> DataFrame:
    """Snapshot after the visits: rows of visited ids get their state and are ``finished``.

    ``observed`` has ``site_submission_id`` and ``submission_status`` (the state
    that the page was classified as).  A visit without a state (null) leaves
    its row as it is, so the id is claimed again.  Of several visits of an id
    the newest by the column ``moment`` counts, without it (or at the same
    moment) the state that sorts last.  Rows that are finished stay as they
    are, and ``date_visited`` remains that of the claim.
    """
    seen = observed.filter(F.col("submission_status").isNotNull())
    order = [F.col(moment)] if moment else []
    newest = F.max_by("submission_status", F.struct(*order, F.col("submission_status")))
    states = seen.groupBy(SITE_ID).agg(newest.alias("_state"))
    open_row = ~F.col("processed_status").eqNullSafe("finished") & F.col("_state").isNotNull()

    def finished(value: Column, column: str) -> Column:
        return F.when(open_row, value).otherwise(F.col(column)).alias(column)

    new = {"submission_status": F.col("_state"), "processed_status": F.lit("finished")}
    return submissions.join(states, SITE_ID, "left").select(
        *[finished(new[name], name) if name in new else F.col(name) for name in submissions.columns]
    )
