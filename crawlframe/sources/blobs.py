"""Blobs out of a table and into one file each."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.urls import blob_path


def export_plan(content: DataFrame) -> DataFrame:
    """``content_id, file, content_binary`` of the blobs that have bytes to write."""
    blob = F.col("content_binary")
    return content.filter(blob.isNotNull() & (F.octet_length(blob) > 0)).select(
        "content_id",
        blob_path(F.col("content_sha512"), F.col("content_id"), F.col("attempt_id")).alias("file"),
        "content_binary",
    )


def export_blobs(content: DataFrame, root: str) -> DataFrame:
    """Write each blob to ``<root>/<sha[0:3]>/<name>`` and return receipts.

    Tasks write straight to the file system of ``root`` (any URI that Arrow
    opens, such as ``hdfs://`` or ``s3://``), each file under a name of its own
    that is moved to the final one when the file is whole.  Files are written
    when the receipts ``content_id, file, n_bytes`` are; a task that runs again
    writes the same bytes to the same names.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(root)
        made = set()
        for batch in batches:
            sizes = []
            for name, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                target = posixpath.join(base, name)
                folder = posixpath.dirname(target)
                if folder not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{folder}/.{uuid.uuid4().hex}.part"
                with files.open_output_stream(part, compression=None) as out:
                    out.write(blob.as_buffer())
                files.move(part, target)  # whole or not there
                sizes.append(len(blob.as_buffer()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64())],
                names=["content_id", "file", "n_bytes"],
            )

    return export_plan(content).mapInArrow(write, "content_id long, file string, n_bytes long")


def write_blob_table(content: DataFrame, path: str) -> None:
    """The same blobs as a table in 256 hash folders.

    Rows are brought together by folder first, so that folders hold few files;
    a folder with far more rows than the others is split over several tasks.
    """
    (
        export_plan(content)
        .withColumn("sha_folder", F.substring("file", 1, 2))
        .hint("rebalance", "sha_folder")
        .write.partitionBy("sha_folder")
        .mode("overwrite")
        .parquet(path)
    )


def null_out_payload(content: DataFrame, exported: DataFrame | None = None) -> DataFrame:
    """Snapshot of the table after an export: blobs gone, rows kept.

    With receipts in ``exported`` only the blobs that were written, and those
    of zero bytes, become null.
    """
    blob = F.col("content_binary")
    if exported is None:
        return content.withColumn("content_binary", F.lit(None).cast("binary"))
    written = exported.select("content_id").distinct().withColumn("_written", F.lit(True))
    gone = F.col("_written").isNotNull() | (F.octet_length(blob) == 0)
    return (
        content.join(written, "content_id", "left")
        .withColumn("content_binary", F.when(~gone, blob))
        .drop("_written")
        .select(*content.columns)
    )
