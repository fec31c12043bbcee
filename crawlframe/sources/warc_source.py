"""WARC archives as a Spark data source, their index, and records by byte range."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith
from pyspark.sql.types import StructType

from crawlframe.sources.shipping import ship
from crawlframe.sources.warc_format import DAMAGE
from crawlframe.sources.warc_stream import StoredArchive, record_at

SOURCE = "warc"
RECORD_COLUMNS = (
    "path string, position long, length long, offset long, skip long, stored_length long,"
    " warc_record_id string, warc_type string, content_type string, warc_target_uri string,"
    " chunk int, block binary, error string"
)
_ARROW = {
    "string": pa.string(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "binary": pa.binary(),
}
HEADERS = {
    "warc_record_id": "warc-record-id",
    "warc_type": "warc-type",
    "content_type": "content-type",
    "warc_target_uri": "warc-target-uri",
}
_PLACES = ("position", "length", "offset", "skip", "stored_length")
_BATCH_ROWS, _BATCH_BYTES = 10_000, 16 << 20


def children(folder: str) -> Iterator[tuple[str, int | None]]:
    """Path and size of what a folder holds directly; folders have no size."""
    system, base = fs.FileSystem.from_uri(folder)
    prefix = folder[: len(folder) - len(base)] if folder.endswith(base) else ""
    info = system.get_file_info(base)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(base, allow_not_found=True))
    for one in found:
        yield prefix + one.path, one.size if one.is_file else None


def files_below(root: str) -> Iterator[str]:
    """All files of a tree, a folder at a time."""
    open_folders = [root]
    while open_folders:
        for path, size in children(open_folders.pop()):
            if size is None:
                open_folders.append(path)
            else:
                yield path


def archive_rows(path: str, wanted: list[str], accepts, chunk_bytes: int) -> Iterator[dict]:
    """The wanted columns of an archive's records; its last row says what is wrong with a damaged one."""
    system, name = fs.FileSystem.from_uri(path)
    with_block = "block" in wanted or "chunk" in wanted
    with system.open_input_stream(name, compression=None) as source:
        archive = StoredArchive(source.read)
        try:
            for place, headers in archive.records():
                row = {column: headers.get(header) for column, header in HEADERS.items()}
                if not accepts(row):
                    continue
                chunks = archive.body(chunk_bytes)
                number, block = 0, next(chunks, b"")
                if not with_block:
                    for _ in chunks:
                        pass
                while True:
                    after = next(chunks, None)  # a place is whole once the body has ended
                    yield row | {"path": path, "chunk": number, "block": block} | {k: getattr(place, k) for k in _PLACES}
                    if after is None:
                        break
                    number, block = number + 1, after
        except DAMAGE as problem:
            yield {"path": path, "error": str(problem)}


@dataclass
class ArchivePartition(InputPartition):
    """Files, and folders that the task walks itself."""

    files: list[str] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)


class ArchiveReader(DataSourceReader):
    """Plans partitions by bytes, takes over filters on types and addresses, reads the asked columns."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.columns = [(one.name, one.dataType.simpleString()) for one in schema.fields]
        self.root = options["path"]
        self.depth = int(options.get("depth", -1))
        self.bytes = int(options.get("partitionBytes", 128 << 20))
        self.chunk = int(options.get("chunkBytes", 16 << 20))
        self.equal: list[tuple[str, frozenset]] = []
        self.begin: list[tuple[str, str]] = []
        self.given: set[str] = set()

    def pushFilters(self, filters):
        for one in filters:
            name = one.attribute[0] if len(one.attribute) == 1 else None
            if name not in HEADERS:
                yield one
            elif isinstance(one, EqualTo):
                self.equal.append((name, frozenset([one.value])))
            elif isinstance(one, In):
                self.equal.append((name, frozenset(one.value)))
            elif isinstance(one, StringStartsWith):
                self.begin.append((name, one.value))
            elif isinstance(one, IsNotNull):
                self.given.add(name)
            else:
                yield one

    def accepts(self, row: dict) -> bool:
        return (
            all(row[name] in values for name, values in self.equal)
            and all((row[name] or "").startswith(value) and row[name] is not None for name, value in self.begin)
            and all(row[name] is not None for name in self.given)
        )

    def partitions(self) -> list[ArchivePartition]:
        """Files packed by size.  Below ``depth`` levels folders are left to the tasks, one partition each."""
        found, level, depth = [], [self.root], 0
        files: list[tuple[str, int]] = []
        while level and (self.depth < 0 or depth < self.depth):
            below = []
            for folder in level:
                for path, size in children(folder):
                    below.append(path) if size is None else files.append((path, size))
            level, depth = below, depth + 1
        found = [ArchivePartition(folders=[folder]) for folder in level]
        part, held = ArchivePartition(), 0
        for path, size in sorted(files):
            if part.files and held + size > self.bytes:
                found.append(part)
                part, held = ArchivePartition(), 0
            part.files.append(path)
            held += size
        return found + [part] if part.files else found

    def read(self, partition: ArchivePartition) -> Iterator[pa.RecordBatch]:
        names = [name for name, _ in self.columns]
        schema = pa.schema([(name, _ARROW[kind]) for name, kind in self.columns])
        filtered = bool(self.equal or self.begin or self.given)
        rows, held = [], 0

        def paths() -> Iterator[str]:
            yield from partition.files
            for folder in partition.folders:
                yield from files_below(folder)

        for path in paths():
            for row in archive_rows(path, names, self.accepts, self.chunk):
                if filtered and "error" in row:
                    continue  # it has no type: no filter on one lets it through
                rows.append({name: row.get(name) for name in names})
                held += len(rows[-1].get("block") or b"")
                if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class ArchiveSource(DataSource):
    """``spark.read.format("warc").load(folder)``, after :func:`register_source`.

    One row per record, or per ``chunkBytes`` of a longer one's block, so that
    neither an archive nor a record has to fit a value.  ``.schema(...)`` with
    some of the columns is the way to prune: a reader without ``block`` passes
    over the bodies.  Filters on the header columns are pushed into the reader.
    """

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return RECORD_COLUMNS

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArchiveReader(schema, self.options)


def register_source(spark: SparkSession) -> None:
    """Make the format known to a session and let filters reach it."""
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archives(spark: SparkSession, root: str, columns: str = RECORD_COLUMNS, **options: str) -> DataFrame:
    """Records of all archives below ``root``; only the columns named are read."""
    register_source(spark)
    return spark.read.format(SOURCE).schema(columns).options(**options).load(root)


_ENTRY = pa.struct([(name, pa.int64()) for name in _PLACES] + [(name, pa.string()) for name in HEADERS])
ENTRY = ", ".join([f"{name}: bigint" for name in _PLACES] + [f"{name}: string" for name in HEADERS])


def archive_index(listing: DataFrame, tasks: int) -> DataFrame:
    """``path, records, error, sha512, n_bytes``: where each record of each listed archive is, one row per file.

    Files are streamed once, by ``tasks`` tasks; ``sha512`` is that of the
    file as stored.  ``records`` holds places and headers, no bodies.
    """
    kinds = pa.schema([("path", pa.string()), ("records", pa.list_(_ENTRY)), ("error", pa.string()), ("sha512", pa.string()), ("n_bytes", pa.int64())])

    def index(path: str) -> dict:
        system, name = fs.FileSystem.from_uri(path)
        digest, size, records, error = hashlib.sha512(), 0, [], None
        with system.open_input_stream(name, compression=None) as source:

            def read(n: int) -> bytes:
                nonlocal size
                piece = source.read(n)
                size += len(piece)
                return piece

            archive = StoredArchive(read, digest)
            try:
                for place, headers in archive.records():
                    for _ in archive.body():
                        pass
                    records.append({k: getattr(place, k) for k in _PLACES} | {k: headers.get(v) for k, v in HEADERS.items()})
            except DAMAGE as problem:
                error = str(problem)
            while piece := read(1 << 20):  # the digest is of the whole file
                digest.update(piece)
        return {"path": path, "records": records, "error": error, "sha512": digest.hexdigest(), "n_bytes": size}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([index(path)], schema=kinds)

    return listing.select("path").repartition(tasks, "path").mapInArrow(
        indexed, f"path string, records array<struct<{ENTRY}>>, error string, sha512 string, n_bytes long"
    )


def read_ranges(path: str, ranges: list[dict | None]) -> tuple[list[bytes | None], int]:
    """Bodies of some records of one file, and the bytes read for them.

    Null for a null range and for one that holds no record.
    """
    wanted = [one for one in ranges if one is not None]
    if not wanted:
        return [None] * len(ranges), 0
    system, name = fs.FileSystem.from_uri(path)
    found: list[bytes | None] = []
    with system.open_input_file(name) as source:
        for one in ranges:
            try:
                found.append(None if one is None else record_at(source, one["offset"], one["skip"], one["stored_length"]))
            except DAMAGE:
                found.append(None)
    return found, sum(one["stored_length"] for one in wanted)


def record_bodies(chosen: DataFrame, record: str = "record") -> DataFrame:
    """The rows of ``chosen`` (``path`` and an entry of an index) with ``block`` and ``n_read`` for it.

    A file is opened once per row; nothing but the record's own range is read.
    """
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in chosen.dtypes)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                (block,), size = read_ranges(one.column("path")[0].as_py(), [one.column(record)[0].as_py()])
                one = one.append_column("block", pa.array([block], pa.binary()))
                yield one.append_column("n_read", pa.array([size], pa.int64()))

    return chosen.mapInArrow(fetch, f"{kinds}, block binary, n_read bigint")


ship(__name__)
