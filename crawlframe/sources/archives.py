"""Archive folders and the WARC files in them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.functions.pieces import PIECE_BYTES, pieces
from crawlframe.session import scratch_path
from crawlframe.sources.warc_format import DAMAGE, iter_records, payload_or_none, plain_bytes

# Local paths lose their scheme, as the crawler stored them; others keep it.
LOCAL_SCHEME = "^file:(//)?(?=/)"
RECORD_FIELDS = (
    "position long, warc_record_id string, warc_type string,"
    " content_type string, warc_target_uri string"
)
_RECORD_TYPE = pa.struct(
    [
        ("position", pa.int64()),
        ("warc_record_id", pa.string()),
        ("warc_type", pa.string()),
        ("content_type", pa.string()),
        ("warc_target_uri", pa.string()),
        ("block", pa.binary()),
    ]
)
_PARSED = pa.schema(
    [
        ("path", pa.string()),
        ("records", pa.list_(_RECORD_TYPE)),
        ("error", pa.string()),
        ("sha512", pa.string()),
    ]
)
# Files in one Arrow batch of a listing.
_LISTED_ROWS = 10_000


def walk_tree(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """``path, length, modified`` of every file below ``root``, whatever the layout and the names.

    In rounds: tasks list the direct children of the folders that the round
    before found, so deep and broad trees are shared out, and each round is
    written to the scratch folder.  The driver sees only whether folders are left.
    """
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, base = fs.FileSystem.from_uri(folder)
                prefix = folder[: len(folder) - len(base)] if folder.endswith(base) else ""
                found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
                for at in range(0, len(found), _LISTED_ROWS):
                    some = found[at : at + _LISTED_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([prefix + info.path for info in some], pa.string()),
                            pa.array([info.size for info in some], pa.int64()),
                            pa.array([info.mtime for info in some], pa.timestamp("us", tz="UTC")),
                            pa.array([info.is_file for info in some], pa.bool_()),
                        ],
                        names=["path", "length", "modified", "is_file"],
                    )

    schema = "path string, length long, modified timestamp, is_file boolean"
    place, depth = scratch_path(spark, "tree"), 0
    folders = spark.createDataFrame([(root.rstrip("/") or "/",)], "root string")
    while True:
        found = folders.repartition(tasks, "root").mapInArrow(children, schema)
        found.write.parquet(f"{place}/depth={depth}")
        below = spark.read.schema(schema).parquet(f"{place}/depth={depth}").filter("NOT is_file")
        if below.isEmpty():
            break
        folders, depth = below.select(F.col("path").alias("root")), depth + 1
    rows = spark.read.schema(f"{schema}, depth int").parquet(place)
    return rows.filter("is_file").select("path", "length", "modified")


def list_files(folders: DataFrame, root: str = "root") -> DataFrame:
    """``path, length, modified`` of all files below the folders, listed by the tasks.

    Every file counts, empty ones and names with a leading ``_`` or ``.`` too.
    Folders are paths or URIs of any file system that Arrow opens; one that
    does not exist holds nothing.  The driver never sees the listing.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, base = fs.FileSystem.from_uri(folder)
                prefix = folder[: len(folder) - len(base)] if folder.endswith(base) else ""
                below = fs.FileSelector(base, recursive=True, allow_not_found=True)
                found = [info for info in system.get_file_info(below) if info.is_file]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([prefix + info.path for info in found], pa.string()),
                        pa.array([info.size for info in found], pa.int64()),
                        pa.array(
                            [info.mtime for info in found], pa.timestamp("us", tz="UTC")
                        ),
                    ],
                    names=["path", "length", "modified"],
                )

    return folders.select(root).mapInArrow(walk, "path string, length long, modified timestamp")


def read_listed_files(listing: DataFrame, tasks: int) -> DataFrame:
    """``path, content`` of listed files, read by ``tasks`` tasks, a file at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_stream(name, compression=None) as source:
                    content = source.readall()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path], pa.string()), pa.array([content], pa.binary())],
                    names=["path", "content"],
                )

    return listing.select("path").repartition(tasks, "path").mapInArrow(
        read, "path string, content binary"
    )


def dir_manifest(files: DataFrame, run_id: int) -> DataFrame:
    """One ``todo`` audit row per file, from metadata alone."""
    return files.select(
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit("todo").alias("processed_status"),
        F.regexp_replace("path", LOCAL_SCHEME, "").alias("file_path"),
        F.lit(None).cast("string").alias("warc_sha512"),
        F.lit("unknown").alias("submission_status"),
    )


def with_records(
    files: DataFrame,
    block_types: tuple[str, ...] = (),
    block_uri: str | None = None,
    http_payload: bool = False,
    path: str = "path",
    content: str = "content",
) -> DataFrame:
    """``path, records array<struct>, error, sha512``: one row per file, no shuffle.

    Records come in file order; ``position`` is the byte offset in the
    unpacked archive.  A record's bytes are kept in ``block`` only if its type
    is in ``block_types`` and, for a response, its URI starts with a match of
    ``block_uri``.  With ``http_payload`` a response's ``block`` is the page
    itself, without HTTP headers, chunks and compression, or null if it cannot
    be unpacked.  A damaged file keeps the records before the damage and
    says why in ``error``.  ``sha512`` is that of the file as stored.  A file
    must fit in one binary value (2 GB).
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = re.compile(block_uri) if block_uri else None

        def block_of(headers: dict, body: memoryview) -> bytes | None:
            kind = headers.get("warc-type")
            if kind not in block_types:
                return None
            if kind == "response" and wanted and not wanted.match(
                headers.get("warc-target-uri", "")
            ):
                return None
            block = bytes(body)
            return payload_or_none(block) if http_payload and kind == "response" else block

        def parsed(name: str, stored: bytes) -> dict:
            records, error = [], None
            try:
                data = plain_bytes(stored)
                view = memoryview(data)
                for at, headers, start, length in iter_records(data):
                    records.append(
                        {
                            "position": at,
                            "warc_record_id": headers.get("warc-record-id"),
                            "warc_type": headers.get("warc-type"),
                            "content_type": headers.get("content-type"),
                            "warc_target_uri": headers.get("warc-target-uri"),
                            "block": block_of(headers, view[start : start + length]),
                        }
                    )
            except DAMAGE as problem:
                error = str(problem)
            digest = hashlib.sha512(stored).hexdigest()
            return {"path": name, "records": records, "error": error, "sha512": digest}

        for batch in pieces(batches, 1):
            rows, kept = [], 0
            for name, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.append(parsed(name, blob.as_py() or b""))
                kept += sum(len(record["block"] or b"") for record in rows[-1]["records"])
                if kept > PIECE_BYTES:  # packed archives
                    yield pa.RecordBatch.from_pylist(rows, schema=_PARSED)
                    rows, kept = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_PARSED)

    return files.select(path, content).mapInArrow(
        parse,
        f"path string, records array<struct<{_as_struct(RECORD_FIELDS)}, block: binary>>,"
        " error string, sha512 string",
    )


def _as_struct(fields: str) -> str:
    return ", ".join(": ".join(field.split()) for field in fields.split(","))


def warc_records(parsed: DataFrame) -> DataFrame:
    """One row per record of :func:`with_records`."""
    return parsed.select("path", F.inline("records"))


def record_index_jsonl(lines: DataFrame, value: str = "value") -> DataFrame:
    """Columns of record-index lines ``[position, id, type, content type, uri]``."""
    cells = F.from_json(F.col(value), "array<string>")
    row = lines.withColumn("_cells", cells)

    def cell(number: int) -> Column:
        return F.try_element_at("_cells", F.lit(number))

    return row.select(
        *[name for name in lines.columns if name != value],
        cell(1).try_cast("long").alias("position"),
        cell(2).alias("warc_record_id"),
        cell(3).alias("warc_type"),
        cell(4).alias("content_type"),
        cell(5).alias("warc_target_uri"),
    )


def record_chunks(lines: DataFrame, value: str = "value") -> DataFrame:
    """Decoded chunks of tagged block lines; other lines are dropped."""
    tagged = F.from_json(F.col(value), "BlockChunk struct<data:string>")
    return (
        lines.withColumn("chunk", F.unbase64(tagged["BlockChunk"]["data"]))
        .filter(F.col("chunk").isNotNull())
        .drop(value)
    )


def record_block(
    lines: DataFrame,
    key: str,
    line_no: str,
    value: str = "value",
    lines_per_segment: int = 16_384,
) -> DataFrame:
    """``key, block``: the decoded chunks joined in line order, one row per record.

    Runs of ``lines_per_segment`` lines are joined first, then the runs in
    order, so no task gathers the single chunks of a long record.  A block must
    fit a binary value (2 GB); :func:`record_chunks` has no such limit.
    """
    chunks = record_chunks(lines, value).withColumn(
        "_segment", F.floor(F.col(line_no) / lines_per_segment).cast("long")
    )
    joined = F.expr(f"listagg(chunk) WITHIN GROUP (ORDER BY `{line_no}`)")
    runs = chunks.groupBy(key, "_segment").agg(joined.alias("_run"))
    return runs.groupBy(key).agg(
        F.expr("listagg(_run) WITHIN GROUP (ORDER BY _segment)").alias("block")
    )


def http_body(block: Column) -> Column:
    """Payload bytes of an HTTP response block; null where it cannot be unpacked."""

    @F.pandas_udf("binary")
    def unpack(blocks: pd.Series) -> pd.Series:
        return blocks.map(lambda block: None if block is None else payload_or_none(bytes(block)))

    return unpack(block)
