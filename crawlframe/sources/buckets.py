"""Tables in buckets of ids: a change rewrites the buckets it touches, under one commit.

Below ``root`` a commit ``n`` writes ``data/commit=n/bucket=b/`` for its buckets
and then, last, ``manifest/n``, which says for every bucket which commit holds
it.  Readers take the newest manifest that was finished, so a job that dies
leaves the snapshot before it as it was.  Manifests have a row per bucket.

A table has one writer at a time; a second one that commits the same number
fails instead of overwriting.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from crawlframe.operators.id_sets import SHIFT, WIDTH, id_set

BUCKET = "bucket"
MANIFEST = "bucket long, commit long, folded long"
#: Buckets whose bitmaps of 4 KB are broadcast together.
_AT_ONCE = 4096


def by_range(key: str) -> Column:
    """Buckets of neighbouring integer keys, as in an id set."""
    return F.shiftright(F.col(key).cast("long"), SHIFT)


def by_hash(key: str, buckets: int) -> Column:
    """Buckets of any key, all of a size."""
    return F.pmod(F.xxhash64(key), F.lit(buckets))


@dataclass
class BucketTable:
    """A table below ``root`` with the columns of ``schema``, in buckets given by ``bucket``."""

    spark: SparkSession
    root: str
    schema: StructType
    bucket: Column

    def _folders(self, name: str) -> list[str]:
        """Names of what a folder below ``root`` holds; none if it does not exist."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [status.getPath().getName() for status in files.listStatus(path)] if files.exists(path) else []

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def commits(self) -> list[int]:
        """Numbers of the finished commits, in order."""
        found = sorted(int(name) for name in self._folders("manifest") if name.isdigit())
        return [number for number in found if self._exists(f"manifest/{number}/_SUCCESS")]

    def manifest(self, commit: int | None = None) -> tuple[dict[int, int], int]:
        """The commit that holds each bucket, and up to which batch streams are folded in (-1: none)."""
        known = self.commits()
        number = known[-1] if known and commit is None else commit
        if number is None:
            return {}, -1
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/{number}").collect()  # a row per bucket
        return {row.bucket: row.commit for row in rows if row.bucket is not None}, max(row.folded for row in rows)

    def read(self, only: list[int] | None = None, commit: int | None = None) -> DataFrame:
        """The newest snapshot, or that of a commit; with ``only`` no file of other buckets is opened."""
        held, _ = self.manifest(commit)
        wanted = held.items() if only is None else [(b, held[b]) for b in only if b in held]
        paths = [f"{self.root}/data/commit={number}/bucket={one}" for one, number in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets of some rows: at most as many as the table has, the only thing brought to the driver."""
        return sorted(row[0] for row in changes.select(self.bucket.alias(BUCKET)).distinct().collect())

    def _write(self, rows: DataFrame, number: int, spread: bool = True) -> None:
        named = rows.select(*self.schema.fieldNames()).withColumn(BUCKET, self.bucket)
        if spread:  # few files per bucket; a large bucket is shared out
            named = named.hint("rebalance", BUCKET)
        named.write.partitionBy(BUCKET).mode("append").parquet(f"{self.root}/data/commit={number}")

    def _commit(self, number: int, replaced: list[int], held: dict[int, int], folded: int) -> int:
        names = self._folders(f"data/commit={number}")
        written = [int(name.split("=")[1]) for name in names if name.startswith(f"{BUCKET}=") and name.split("=")[1].lstrip("-").isdigit()]
        now = {one: commit for one, commit in held.items() if one not in set(replaced)}
        now |= {one: number for one in written}
        rows = [(one, commit, folded) for one, commit in now.items()] or [(None, number, folded)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(f"{self.root}/manifest/{number}")
        return number

    def _next(self) -> int:
        """A number that no commit has used, finished or not."""
        used = [int(name) for name in self._folders("manifest") if name.isdigit()]
        used += [int(name.split("=")[1]) for name in self._folders("data") if name.startswith("commit=")]
        return max(used, default=0) + 1

    def replace(self, rows: DataFrame) -> int:
        """Make ``rows`` the whole table."""
        number = self._next()
        held, folded = self.manifest()
        self._write(rows, number)
        return self._commit(number, list(held), held, folded)

    def merge(self, changes: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], folded: int | None = None) -> int:
        """Put ``combine(old rows, changes)`` in the place of the buckets that ``changes`` touch.

        ``changes`` needs the columns of the bucket expression and is read
        twice; only old rows of touched buckets are read, shuffled and written.
        """
        number = self._next()
        held, before = self.manifest()
        buckets = self.touched(changes)
        if buckets:
            self._write(combine(self.read(only=buckets), changes), number)
        return self._commit(number, buckets, held, before if folded is None else folded)

    def clear(self, members: DataFrame, key: str, column: str) -> int:
        """Null ``column`` in the rows whose integer ``key`` is in an id set (see ``id_sets``); for tables in :func:`by_range` buckets.

        Rows are not shuffled: the bitmaps of at most ``_AT_ONCE`` buckets at a
        time, 4 KB each, go to the tasks that read these buckets and write
        them again without the values.  Untouched buckets stay as they are.
        """
        number = self._next()
        held, folded = self.manifest()
        buckets = sorted(row[0] for row in members.select(BUCKET).distinct().collect())
        buckets = [one for one in buckets if one in held]
        for at in range(0, len(buckets), _AT_ONCE):
            some = buckets[at : at + _AT_ONCE]
            bitmaps = members.filter(F.col(BUCKET).isin(some)).select(F.col(BUCKET).alias("_of"), F.col("bitmap").alias("_bits"))
            byte = f"CAST(conv(hex(substring(_bits, shiftright(CAST(pmod(`{key}`, {WIDTH}) AS INT), 3) + 1, 1)), 16, 10) AS INT)"
            bit = F.expr(f"({byte} & shiftleft(1, CAST(pmod(`{key}`, 8) AS INT))) <> 0")
            rows = self.read(only=some).withColumn("_of", self.bucket).join(F.broadcast(bitmaps), "_of", "left")
            kept = F.when(F.coalesce(bit, F.lit(False)), F.lit(None)).otherwise(F.col(column))
            self._write(rows.withColumn(column, kept), number, spread=False)
        return self._commit(number, buckets, held, folded)

    def vacuum(self, keep: int = 2) -> int:
        """Remove manifests before the last ``keep`` and the data folders no kept one names; the number of folders gone."""
        known = self.commits()
        kept = known[-keep:]
        used: dict[int, set[int]] = defaultdict(set)
        for number in kept:
            for one, commit in self.manifest(number)[0].items():
                used[commit].add(one)
        gone = [f"manifest/{number}" for number in known if number not in kept]
        for name in self._folders("data"):
            commit = int(name.split("=")[1])
            if known and commit > known[-1]:
                continue  # a commit that is being written
            folders = [one for one in self._folders(f"data/{name}") if one.startswith(f"{BUCKET}=")]
            old = [one for one in folders if int(one.split("=")[1]) not in used[commit]]
            gone += [f"data/{name}"] if len(old) == len(folders) else [f"data/{name}/{one}" for one in old]
        for name in gone:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return len(gone)


def upsert(key: str, order: Column) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Of all rows of a key, old and new, the one of the largest ``order``; a new one of the same order wins."""

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        columns = old.columns
        both = old.withColumn("_new", F.lit(0)).unionByName(new.select(*columns).withColumn("_new", F.lit(1)))
        whole = F.max_by(F.struct(*columns), F.struct(order, F.col("_new"))).alias("_row")
        return both.groupBy(key).agg(whole).select("_row.*")

    return combine


def insert_ignore(key: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Old rows as they are, and one new row per key that has none."""

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        columns = old.columns
        fresh = new.select(*columns).join(old.select(key), key, "left_anti").dropDuplicates([key])
        return old.unionByName(fresh.select(*columns))

    return combine


def exported_ids(receipts: DataFrame, key: str = "content_id") -> DataFrame:
    """The ids of an export's receipts as a set, for :meth:`BucketTable.clear`."""
    return id_set(receipts, key)


def fold_batches(
    table: BucketTable, batches: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], batch: str = "batch_id"
) -> int | None:
    """Merge the batches of a stream's output that are not in the table yet; the commit, or nothing to do.

    The manifest keeps the last batch folded in, so a fold that dies is simply
    run again, and folded batch folders may be removed.
    """
    _, done = table.manifest()
    rows = batches.filter(F.col(batch) > done)
    last = rows.agg(F.max(F.col(batch).cast(LongType()))).first()[0]
    if last is None:
        return None
    return table.merge(rows.filter(F.col(batch) <= last), combine, folded=last)
