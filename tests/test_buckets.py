"""Tables in buckets: what a change rewrites, what a dead job leaves, what is shuffled."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from crawlframe.operators.id_sets import WIDTH, id_set
from crawlframe.sources import buckets as B
from crawlframe.streaming.batches import write_batch
from crawlframe.streaming.users import stream_users_into, user_table

SCHEMA = "id long, state string, moment long, blob binary"


def rows_of(spark, ids, state="old", moment=1):
    return spark.createDataFrame([(k, state, moment, f"blob {k}".encode()) for k in ids], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    made = B.BucketTable(spark, str(tmp_path / "table"), rows_of(spark, []).schema, B.by_range("id"))
    made.replace(rows_of(spark, range(0, 100 * WIDTH, WIDTH // 4)))
    return made


def files(root):
    return {os.path.join(folder, name) for folder, _, names in os.walk(root) for name in names if name.endswith(".parquet") and "/data/" in folder}


def content(rows):
    return sorted((r.id, r.state, r.moment, r.blob and bytes(r.blob)) for r in rows.collect())


def test_a_small_change_rewrites_little(spark, table):
    before, old = files(table.root), content(table.read())
    changed = rows_of(spark, [5 * WIDTH, 5 * WIDTH + 1], "new", 2)
    number = table.merge(changed, B.upsert("id", F.col("moment")))
    new = files(table.root) - before
    assert before <= files(table.root) and 0 < len(new) <= len(before) * 0.02
    assert all(f"commit={number}/bucket=5/" in name for name in new)
    wanted = [row for row in old if row[0] != 5 * WIDTH] + content(changed)
    assert content(table.read()) == sorted(wanted)
    assert content(table.read(commit=1)) == old
    opened = table.read(only=[5]).inputFiles()
    assert opened and all(f"commit={number}/bucket=5/" in name for name in opened)


def test_a_job_that_dies_leaves_the_snapshot(spark, table, monkeypatch):
    old = content(table.read())
    monkeypatch.setattr(table, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        table.merge(rows_of(spark, [0, 7 * WIDTH], "new", 2), B.upsert("id", F.col("moment")))
    monkeypatch.undo()
    assert content(table.read()) == old
    table.merge(rows_of(spark, [0], "new", 2), B.upsert("id", F.col("moment")))
    now = content(table.read())
    assert (0, "new", 2, b"blob 0") in now and (7 * WIDTH, "old", 1, f"blob {7 * WIDTH}".encode()) in now and len(now) == len(old)
    os.makedirs(f"{table.root}/manifest/99")  # begun, not finished
    assert content(table.read()) == now


def test_two_writers_of_one_number(spark, table, monkeypatch):
    monkeypatch.setattr(table, "_next", lambda: 1)
    with pytest.raises(Exception, match="(?i)exist"):
        table.merge(rows_of(spark, [1], "new", 2), B.upsert("id", F.col("moment")))


def test_rules(spark, table):
    table.merge(rows_of(spark, [0, 0, 1], "late", 0), B.upsert("id", F.col("moment")))
    found = {r.id: r.state for r in table.read(only=[0]).collect()}
    assert found[0] == "old" and found[1] == "late"
    table.merge(rows_of(spark, [0, 2, 2], "seen", 9), B.insert_ignore("id"))
    found = [(r.id, r.state) for r in table.read(only=[0]).filter("id < 3").collect()]
    assert sorted(found) == [(0, "old"), (1, "late"), (2, "seen")]
    table.merge(rows_of(spark, [0]), lambda old, new: old.filter("id <> 0"))  # rows may go
    assert table.read(only=[0]).filter("id = 0").isEmpty()
    table.merge(rows_of(spark, [50 * WIDTH]), lambda old, new: old.limit(0))  # a bucket too
    assert table.read(only=[50]).isEmpty() and not table.read(only=[51]).isEmpty()
    assert table.merge(rows_of(spark, []), B.insert_ignore("id")) > 1


def test_clear_moves_no_blob(spark, table, monkeypatch):
    plans = []
    write = B.BucketTable._write

    def noted(self, rows, number, spread=True):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, number, spread)

    monkeypatch.setattr(B.BucketTable, "_write", noted)
    monkeypatch.setattr(B, "_AT_ONCE", 2)
    old, before = content(table.read()), files(table.root)
    gone = {0, WIDTH // 4, 3 * WIDTH, 8 * WIDTH + WIDTH // 2, 9 * WIDTH, 10**9, -4}
    table.clear(id_set(spark.createDataFrame([(k,) for k in gone], "id long")), "id", "blob")
    assert content(table.read()) == [row[:3] + (None if row[0] in gone else row[3],) for row in old]
    assert {name.split("bucket=")[1].split("/")[0] for name in files(table.root) - before} == {"0", "3", "8", "9"}
    assert len(plans) == 2 and all("BroadcastHashJoin" in plan for plan in plans)
    for plan in plans:  # the one shuffle is that of the bitmaps
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(shuffles) == 1 and "_groupingexpression" in shuffles[0] and "SortMergeJoin" not in plan


def test_negative_and_hashed_buckets(spark, tmp_path):
    made = B.BucketTable(spark, str(tmp_path / "neg"), rows_of(spark, []).schema, B.by_range("id"))
    assert made.read().isEmpty()
    made.merge(rows_of(spark, [-1, -WIDTH - 1, 3]), B.insert_ignore("id"))
    assert sorted(r.id for r in made.read().collect()) == [-WIDTH - 1, -1, 3]
    made.clear(id_set(spark.createDataFrame([(-1,)], "id long")), "id", "blob")
    assert {r.id: r.blob is None for r in made.read().collect()} == {-1: True, -WIDTH - 1: False, 3: False}
    names = B.BucketTable(spark, str(tmp_path / "names"), spark.createDataFrame([], "user_name string").schema, B.by_hash("user_name", 8))
    for some in (["a", "b"], ["b", "c", None]):
        names.merge(spark.createDataFrame([(n,) for n in some], "user_name string").filter("user_name IS NOT NULL"), B.insert_ignore("user_name"))
    assert sorted(r.user_name for r in names.read().collect()) == ["a", "b", "c"]
    assert all(0 <= one < 8 for one in names.manifest()[0])


def test_batches_are_folded_once(spark, table, tmp_path):
    root = str(tmp_path / "stream")
    for number in range(3):
        write_batch(rows_of(spark, [0, number + 1], f"batch {number}", 10 + number), root, number)
    read = lambda: spark.read.schema(f"{SCHEMA}, batch_id long").parquet(root)
    rule = B.upsert("id", F.col("moment"))
    assert B.fold_batches(table, read(), rule) == 2 and table.manifest()[1] == 2
    assert B.fold_batches(table, read(), rule) is None
    write_batch(rows_of(spark, [0], "batch 3", 20), root, 3)
    assert B.fold_batches(table, read(), rule) == 3
    found = {r.id: r.state for r in table.read(only=[0]).collect()}
    assert (found[0], found[1], found[2], found[3]) == ("batch 3", "batch 0", "batch 1", "batch 2")
    assert table.merge(rows_of(spark, [9]), rule) == 4 and table.manifest()[1] == 3


def test_vacuum(spark, table):
    rule = B.upsert("id", F.col("moment"))
    for moment in range(2, 6):
        table.merge(rows_of(spark, [0], "new", moment), rule)
    old = content(table.read())
    assert table.vacuum(keep=2) > 0 and table.commits() == [4, 5]
    assert content(table.read()) == old and content(table.read(commit=4)) != old
    assert len([name for name in files(table.root) if "bucket=0/" in name]) == 2
    assert table.vacuum(keep=2) == 0


def test_a_stream_into_buckets(spark, tmp_path):
    path = str(tmp_path / "found")
    for names in (["a", "b", "a"], ["b", "c", "B"], ["a", None]):
        spark.createDataFrame([(n,) for n in names], "user_name string").coalesce(1).write.mode("append").parquet(path)
    table = user_table(spark, str(tmp_path / "user"), 8)
    table.replace(spark.createDataFrame([("1", "c")], "a string, user_name string").selectExpr("xxhash64(user_name) AS user_id", "timestamp'2020-01-01' AS date_added", "user_name"))
    for run in range(2):  # the second one from a lost checkpoint: its batches are in the table already
        found = spark.readStream.schema("user_name string").option("maxFilesPerTrigger", 1).parquet(path)
        stream_users_into(found, table, f"{tmp_path}/check{run}", F.lit("2025-01-01")).awaitTermination()
        rows = table.read().collect()
        assert sorted(r.user_name for r in rows) == ["B", "a", "b", "c"] and len({r.user_id for r in rows}) == 4
    assert [r.date_added.year for r in rows if r.user_name == "c"] == [2020]
    assert table.manifest()[1] == 2 and table.commits()[-1] == 4
