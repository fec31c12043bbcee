"""Output that a replayed micro-batch overwrites with itself."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch_id"


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    """Replace what batch ``batch_id`` wrote below ``root``."""
    df.write.mode("overwrite").parquet(f"{root}/{BATCH}={batch_id}")


def read_batches(
    spark: SparkSession, root: str, schema: str, before: int | None = None
) -> DataFrame:
    """Everything written below ``root``, or what batches before ``before`` wrote.

    A batch that is run again sees what it saw the first time.  ``root`` may
    not exist yet.
    """
    full = f"{schema}, {BATCH} long"
    try:
        rows = spark.read.schema(full).parquet(root)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    return rows if before is None else rows.filter(F.col(BATCH) < before)


@contextmanager
def held(rows: DataFrame) -> Iterator[tuple[DataFrame, int]]:
    """Rows of a micro-batch kept for several uses, and their number."""
    kept = rows.persist()
    try:
        yield kept, kept.count()
    finally:
        kept.unpersist()


def run_batches(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start ``each`` over the micro-batches; input counts as done after ``each`` returns."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
