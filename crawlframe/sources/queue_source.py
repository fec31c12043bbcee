"""A folder queue as a streaming source: deliveries with numbers, a limit in flight, commits as acknowledgements.

Below ``root``, ``messages/`` holds Parquet files of messages.  A delivery is a
file ``deliveries/<number>.json`` that names the rows it hands out; its number
is the stream's offset.  When Spark has finished a batch it commits the offset:
``acked.json`` moves to that number, and message files that have been
handed out whole go.  So a stream that is started again, with its checkpoint or
without, gets just the deliveries that nobody acknowledged.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from crawlframe.sources.queue import MESSAGE_SCHEMA
from crawlframe.sources.shipping import ship

QUEUE = "crawl_queue"
_BATCH_ROWS = 10_000
_KINDS = {"delivery_tag": pa.int64(), "value": pa.binary(), "ts": pa.timestamp("us", tz="UTC")}


class QueueFolder:
    """The files of a queue; small ones apart from the messages."""

    def __init__(self, root: str):
        self.files, self.base = fs.FileSystem.from_uri(root)

    def names(self, folder: str, ending: str) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.base}/{folder}", allow_not_found=True))
        return sorted(one.base_name for one in found if one.is_file and one.base_name.endswith(ending) and one.base_name[0] not in "._")

    def put(self, name: str, value) -> None:
        """Write a small file; it appears whole."""
        target = f"{self.base}/{name}"
        self.files.create_dir(target.rpartition("/")[0], recursive=True)
        part = f"{target.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        with self.files.open_output_stream(part) as out:
            out.write(json.dumps(value).encode())
        self.files.move(part, target)

    def get(self, name: str, default=None):
        if not self.files.get_file_info(f"{self.base}/{name}").is_file:
            return default
        with self.files.open_input_stream(f"{self.base}/{name}") as source:
            return json.loads(source.readall())

    def acked(self) -> dict:
        """The last delivery acknowledged, and rows handed out of files that have more."""
        return self.get("acked.json", {"number": 0, "begun": {}})

    def numbers(self) -> list[int]:
        return sorted(int(name.removesuffix(".json")) for name in self.names("deliveries", ".json"))

    def delivery(self, number: int) -> list[list]:
        """``[file, first row, end row]`` of a delivery."""
        return self.get(f"deliveries/{number}.json", [])

    def rows_in(self, name: str) -> int:
        with self.files.open_input_file(f"{self.base}/messages/{name}") as source:
            return pq.ParquetFile(source).metadata.num_rows

    def open_deliveries(self) -> dict[int, list[list]]:
        done = self.acked()["number"]
        return {number: self.delivery(number) for number in self.numbers() if number > done}

    def deliver(self, limit: int, worked: int = 0) -> int:
        """Hand out up to ``limit`` messages less those in flight; the last delivery's number.

        In flight are open deliveries after number ``worked``.
        """
        acked, known = self.acked(), self.open_deliveries()
        last = max([acked["number"], *known])
        room = limit - sum(end - begin for number, parts in known.items() if number > worked for _, begin, end in parts)
        at = dict(acked["begun"])
        for parts in known.values():
            for name, _, end in parts:
                at[name] = max(at.get(name, 0), end)
        parts = []
        for name in self.names("messages", ".parquet"):
            if room <= 0:
                break
            begin, rows = at.get(name, 0), self.rows_in(name)
            end = min(rows, begin + room)
            if end > begin:
                parts.append([name, begin, end])
                room -= end - begin
        if not parts:
            return last
        self.put(f"deliveries/{last + 1}.json", parts)
        return last + 1

    def acknowledge(self, number: int) -> None:
        """Deliveries up to ``number`` are done: files that are used up go, then their records."""
        acked = self.acked()
        begun = dict(acked["begun"])
        done = [one for one in self.numbers() if one <= number]
        for one in done:
            for name, _, end in self.delivery(one):
                begun[name] = max(begun.get(name, 0), end)
        present = set(self.names("messages", ".parquet"))
        used = [name for name, end in begun.items() if name not in present or end >= self.rows_in(name)]
        if number > acked["number"]:
            # files that are used up keep their mark until they are gone
            self.put("acked.json", {"number": number, "begun": begun})
        for name in used:
            if name in present:
                self.files.delete_file(f"{self.base}/messages/{name}")
        if used:
            self.put("acked.json", {"number": max(number, acked["number"]), "begun": {name: end for name, end in begun.items() if name not in used}})
        for one in done:
            self.files.delete_file(f"{self.base}/deliveries/{one}.json")


@dataclass
class Piece(InputPartition):
    """Some rows of a message file."""

    name: str
    begin: int
    end: int


class QueueReader(DataSourceStreamReader):
    """Offsets are delivery numbers; :meth:`commit` is the acknowledgement."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.root = options["path"]
        self.limit = int(options.get("prefetch", 1000))
        self.columns = schema.fieldNames()
        self.given = 0

    def initialOffset(self) -> dict:
        return {"number": QueueFolder(self.root).acked()["number"]}

    def latestOffset(self) -> dict:
        # Spark asks again once it has worked off what it was given; it commits that only with its next batch
        self.given = QueueFolder(self.root).deliver(self.limit, self.given)
        return {"number": self.given}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        folder = QueueFolder(self.root)
        return [Piece(*part) for number in range(start["number"] + 1, end["number"] + 1) for part in folder.delivery(number)]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        folder, at = QueueFolder(self.root), 0
        with folder.files.open_input_file(f"{folder.base}/messages/{partition.name}") as source:
            messages = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
            for batch in messages.iter_batches(_BATCH_ROWS, columns=self.columns):
                begin, end = max(0, partition.begin - at), min(batch.num_rows, partition.end - at)
                if begin < end:
                    yield batch.slice(begin, end - begin).cast(pa.schema([(name, _KINDS[name]) for name in batch.schema.names]))
                at += batch.num_rows
                if at >= partition.end:
                    return

    def commit(self, end: dict) -> None:
        QueueFolder(self.root).acknowledge(end["number"])


class QueueSource(DataSource):
    """``spark.readStream.format("crawl_queue")`` over a folder; ``prefetch`` messages in flight at most."""

    @classmethod
    def name(cls) -> str:
        return QUEUE

    def schema(self) -> str:
        return MESSAGE_SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return QueueReader(schema, self.options)


def publish_messages(messages: DataFrame, root: str) -> None:
    """Add messages to the queue below ``root``."""
    messages.write.mode("append").parquet(f"{root}/messages")


def read_queue(spark: SparkSession, root: str, prefetch: int = 1000) -> DataFrame:
    """Stream of the messages of a queue, each until its delivery is acknowledged.

    One reader at a time; a delivery is one micro-batch or part of one.  A
    trigger that takes what is available takes one delivery.
    """
    spark.dataSource.register(QueueSource)
    return spark.readStream.format(QUEUE).option("prefetch", str(prefetch)).load(root)


ship(__name__)
