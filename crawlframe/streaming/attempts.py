"""Messages to attempts: record, skip what is done, follow the status, set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlframe.operators.attempts import claim_submissions
from crawlframe.operators.names import only_keys
from crawlframe.schemas import SITE_ID
from crawlframe.sources.queue import parse_message_id, split_messages
from crawlframe.streaming.batches import held, read_batches, run_batches, write_batch

ATTEMPT_COLUMNS = (
    f"scrape_attempt_id long, {SITE_ID} long, date_visited timestamp,"
    " processed_status string, claimed_by string, error_string string"
)
CONTENT_COLUMNS = "content_id long, attempt_id long, content_length long, content_sha512 string"
DEAD_COLUMNS = "delivery_tag long, value binary, ts timestamp"


def attempt_rows(messages: DataFrame, worker: Column) -> DataFrame:
    """One ``todo`` attempt per delivered message; its key is the delivery tag.

    A message delivered again has a new tag and so makes a new attempt.
    """
    return messages.select(
        F.col("delivery_tag").alias("scrape_attempt_id"),
        F.col("submission_id").alias(SITE_ID),
        F.col("ts").alias("date_visited"),
        F.lit("todo").alias("processed_status"),
        worker.alias("claimed_by"),
        F.lit(None).cast("string").alias("error_string"),
    )


def stream_attempts(
    messages: DataFrame,
    contents: DataFrame,
    attempts_path: str,
    content_path: str,
    checkpoint: str,
    worker: Column,
    available_now: bool = True,
) -> StreamingQuery:
    """Log an attempt per message; finish it where its content is in storage.

    ``contents`` has ``site_submission_id, content_length, content_sha512`` of what was
    fetched, and when in ``date_fetched``; of several rows of an id the newest
    counts (without that column, or at one moment, the largest digest).
    Attempts and content of a micro-batch are written before its input counts
    as read, so a crash repeats the batch, and the repeat overwrites it: no
    message is lost, no row doubled.
    """
    order = [name for name in ("date_fetched", "content_sha512") if name in contents.columns]

    done = F.col("content_sha512").isNotNull()

    def each(batch: DataFrame, batch_id: int) -> None:
        good, _ = split_messages(batch)
        with held(attempt_rows(good, worker)) as (attempts, n_attempts):
            stored = only_keys(contents, attempts, SITE_ID, n_attempts)
            newest = F.max_by(F.struct("content_sha512", "content_length"), F.struct(*order)).alias("_c")
            stored = stored.groupBy(SITE_ID).agg(newest).select(SITE_ID, "_c.*")
            worked = attempts.join(stored, SITE_ID, "left")
            content = worked.filter(done).select(
                F.xxhash64("scrape_attempt_id", "content_sha512").alias("content_id"),
                F.col("scrape_attempt_id").alias("attempt_id"),
                "content_length",
                "content_sha512",
            )
            write_batch(content, content_path, batch_id)
            status = F.when(done, "finished").otherwise("todo")
            log = worked.withColumn("processed_status", status).select(*attempts.columns)
            write_batch(log, attempts_path, batch_id)

    return run_batches(messages, each, checkpoint, available_now)


def first_deliveries(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Parsed messages without repeats of an id that come within ``delay``.

    For queues in time order: a message that is more than ``delay`` behind the
    newest one is late and dropped.  :func:`stream_skip_finished` needs no such
    promise.
    """
    parsed = parse_message_id(messages).filter(F.col("submission_id").isNotNull())
    return parsed.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["submission_id"])


def stream_skip_finished(
    messages: DataFrame,
    submissions: DataFrame,
    claims_path: str,
    checkpoint: str,
    finished_path: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Claim each micro-batch's ids: ``id, action`` without ``skip`` rows is the work to do.

    Only an id that is finished is skipped: in ``submissions``, or by a row
    (``id``) that the finish step wrote below ``finished_path``.  An id that an
    earlier micro-batch claimed and nothing finished is claimed again as
    ``reuse``, so work that failed is not lost.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = read_batches(spark, claims_path, "id long, action string", batch_id)
        finished = read_batches(spark, finished_path or f"{claims_path}-none", "id long")
        good, _ = split_messages(batch)
        with held(good.select(F.col("submission_id").alias(SITE_ID)).distinct()) as (ids, n_ids):
            known = only_keys(submissions, ids, SITE_ID, n_ids).select(SITE_ID, "processed_status")
            claimed = only_keys(earlier.withColumnRenamed("id", SITE_ID), ids, SITE_ID, n_ids)
            done = only_keys(finished.withColumnRenamed("id", SITE_ID), ids, SITE_ID, n_ids)
            done = done.select(SITE_ID, F.lit(True).alias("_done")).distinct()
            added = claimed.select(SITE_ID).union(done.select(SITE_ID)).distinct()
            added = added.join(known, SITE_ID, "left_anti")
            known = known.unionByName(added.withColumn("processed_status", F.lit("todo")))
            status = F.when(F.col("_done"), "finished").otherwise(F.col("processed_status"))
            known = known.join(done, SITE_ID, "left").select(SITE_ID, status.alias("processed_status"))
            claims = claim_submissions(ids, known, SITE_ID, None)
            write_batch(claims.filter(F.col("action") != "skip"), claims_path, batch_id)

    return run_batches(messages, each, checkpoint, available_now)


def stream_status(
    attempts: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Newest status per id, written as one change row per id and micro-batch.

    State holds one row per id.  ``path`` is a change log; :func:`current_status`
    reads it.
    """
    newest = attempts.groupBy(SITE_ID).agg(
        F.max_by(
            F.struct("processed_status", "date_visited"),
            F.struct("date_visited", "scrape_attempt_id"),
        ).alias("_s")
    )
    changes = newest.select(SITE_ID, "_s.*")
    writer = (
        changes.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_status(changes: DataFrame) -> DataFrame:
    """``site_submission_id, processed_status`` as of the last micro-batch that touched an id."""
    return changes.groupBy(SITE_ID).agg(
        F.max_by("processed_status", "batch_id").alias("processed_status")
    )


def stream_dead_letter(
    messages: DataFrame, ids_path: str, dead_path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Split messages into ids and dead letters, each with its own output."""

    def each(batch: DataFrame, batch_id: int) -> None:
        good, dead = split_messages(batch)
        write_batch(good.select("delivery_tag", "submission_id"), ids_path, batch_id)
        write_batch(dead.select("delivery_tag", "value", "ts"), dead_path, batch_id)

    return run_batches(messages, each, checkpoint, available_now)
