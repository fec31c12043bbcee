"""Archive folder to verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.operators.attempts import pending_items
from crawlframe.operators.records import hole_verdict, indexed_verdict
from crawlframe.profile import SiteProfile
from crawlframe.session import scratch_path
from crawlframe.sources.archives import LOCAL_SCHEME
from crawlframe.sources.warc_source import archive_index


def audit_archives(
    files: DataFrame,
    run_id: int,
    profile: SiteProfile = SiteProfile(),
    cloudflare: str | None = None,
    maintenance: str | None = None,
) -> DataFrame:
    """``hole_status`` rows of a run, ``finished`` with the archive's digest and verdict.

    Each file is read once, by the task that digests and parses it; nothing
    is shuffled.
    """
    return _hole_rows(hole_verdict(files, profile, cloudflare, maintenance), run_id)


def _hole_rows(verdicts: DataFrame, run_id: int) -> DataFrame:
    file_path = F.regexp_replace("path", LOCAL_SCHEME, "")
    return verdicts.select(
        F.xxhash64(F.lit(run_id), file_path).alias("item_id"),
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit("finished").alias("processed_status"),
        file_path.alias("file_path"),
        F.col("sha512").alias("warc_sha512"),
        "submission_status",
    )


def audit_pending(
    manifest: DataFrame,
    run_id: int,
    tasks: int,
    profile: SiteProfile = SiteProfile(),
    cloudflare: str | None = None,
    maintenance: str | None = None,
) -> DataFrame:
    """Rows of :func:`audit_archives` for the files that a run's manifest still lists as ``todo``.

    A run that stopped half-way goes on where it was: files that are finished
    are not opened.  Only paths are shuffled; ``tasks`` tasks stream the files,
    whatever their size, for digests and an index, written to the scratch
    folder, and verdicts read the main page's byte range.
    """
    todo = pending_items(manifest.filter(F.col("run_id") == run_id))
    listing = todo.select(F.col("file_path").alias("path")).distinct()
    spark, path = manifest.sparkSession, scratch_path(manifest.sparkSession, "archive-index")
    made = archive_index(listing, tasks)
    made.write.parquet(path)
    index = spark.read.schema(made.schema).parquet(path)
    return _hole_rows(indexed_verdict(index, profile, cloudflare, maintenance), run_id)
