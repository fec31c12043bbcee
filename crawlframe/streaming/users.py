"""Found names to the insert-only user dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlframe.operators.names import NAME, insert_ignore_users, only_keys
from crawlframe.sources.buckets import BucketTable, by_hash, insert_ignore
from crawlframe.streaming.batches import held, read_batches, run_batches, write_batch

USER_COLUMNS = "user_id long, date_added timestamp, user_name string"


def stream_insert_users(
    found: DataFrame,
    users: DataFrame,
    added_path: str,
    checkpoint: str,
    date_added: Column,
    available_now: bool = True,
) -> StreamingQuery:
    """Add the names of a stream that neither ``users`` nor an earlier batch has.

    One writer takes the place of the race between workers; a repeated batch
    overwrites its own rows.  A batch's names are counted, and if they are few
    the known names are filtered by them where they are read.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        earlier = read_batches(batch.sparkSession, added_path, USER_COLUMNS, batch_id)
        with held(batch.select(NAME).distinct()) as (names, n_names):
            known = users.select(NAME).union(earlier.select(NAME))
            known = only_keys(known, names, NAME, n_names)
            rows = insert_ignore_users(names, known, date_added.cast("timestamp"))
            write_batch(rows, added_path, batch_id)

    return run_batches(found, each, checkpoint, available_now)


def user_table(spark: SparkSession, root: str, buckets: int) -> BucketTable:
    """The dimension of users in buckets of names."""
    return BucketTable(spark, root, spark.createDataFrame([], USER_COLUMNS).schema, by_hash(NAME, buckets))


def stream_users_into(
    found: DataFrame, table: BucketTable, checkpoint: str, date_added: Column, available_now: bool = True
) -> StreamingQuery:
    """Add the names of a stream that a table of users lacks, one commit per micro-batch.

    Of the table only the buckets of a batch's names are read and written,
    however long the stream has run.  The commit holds the number of the
    batch: one that is run again finds it and does nothing.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        _, done = table.manifest()
        if batch_id <= done:
            return
        with held(batch.select(NAME).filter(F.col(NAME).isNotNull()).distinct()) as (names, _):
            rows = names.select(
                F.xxhash64(NAME).alias("user_id"), date_added.cast("timestamp").alias("date_added"), NAME
            )
            table.merge(rows, insert_ignore(NAME), folded=batch_id)

    return run_batches(found, each, checkpoint, available_now)
