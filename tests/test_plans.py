"""Plans that must hold at any size: what is read, shuffled, broadcast, gathered."""

from __future__ import annotations

import re

import pytest
from conftest import explained

import __spark_entry__ as entry_points
from crawlframe.operators import attempts as A
from crawlframe.operators import content as C
from crawlframe.operators import frontier, names, pages, records
from crawlframe.sources import archives, blobs
from crawlframe.sources.tables import save_bucketed
from workload import frames
from workload.frames import PROFILE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def content(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("content") / "t")
    frames.contents(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def attempts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("attempt") / "t")
    frames.attempts(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Sizes at which Spark would not broadcast of its own accord."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


LAZY = [key for key in entry_points.queries() if not key.startswith(("stream_", "queue_"))
        and key not in ("read_crawl_table", "append_rows", "dir_manifest", "export_blobs",
                        "record_index_jsonl", "id_range", "missing_ids")]


@pytest.mark.parametrize("key", LAZY)
def test_no_query_multiplies_rows_or_gathers_a_table(spark, key):
    plan = explained(entry_points.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "collect_list" not in plan and "collect_set" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_status_filter_is_pushed_and_columns_are_pruned(attempts):
    plan = explained(A.pending_items(attempts).select("scrape_attempt_id"))
    assert "EqualTo(processed_status,todo)" in plan
    assert "ReadSchema: struct<scrape_attempt_id:bigint,processed_status:string>" in plan


def test_counting_blobs_reads_one_column(content):
    assert "ReadSchema: struct<content_binary:binary>" in explained(C.payload_count(content))
    plan = explained(C.payload_batch(content).select("content_id"))
    assert "IsNotNull(content_binary)" in plan


def test_a_manifest_reads_no_bytes(spark, tmp_path):
    (tmp_path / "x").write_text("x")
    plan = explained(archives.dir_manifest(archives.walk_tree(spark, str(tmp_path)), 1))
    assert re.search(r"ReadSchema: struct<path:string,is_file:boolean>", plan)


def test_newest_rows_are_found_before_the_shuffle(attempts):
    for found in (A.latest_attempt(attempts), A.latest_status(attempts)):
        plan = explained(found)
        assert "Window" not in plan and plan.count("Exchange") == 2  # tree and detail
        assert "partial_max_by" in plan


def test_pages_and_archives_are_read_without_a_shuffle(spark):
    raw = spark.createDataFrame([(1, "<p>")], "page_id long, html string")
    assert "Exchange" not in explained(pages.extract_mentions(raw))
    assert "Exchange" not in explained(pages.page_status(raw))
    files = spark.createDataFrame([("p", bytearray(b""))], "path string, content binary")
    assert "Exchange" not in explained(records.hole_verdict(files, PROFILE))
    assert "Exchange" not in explained(records.parse_archives(files, PROFILE))


def test_a_page_is_parsed_once(spark):
    raw = spark.createDataFrame([(1, "<p>")], "page_id long, html string")
    tree = explained(pages.extract_mentions(raw)).split("(1)")[0]
    assert tree.count("MapInArrow") == 1


def test_top_names_are_cut_before_the_last_shuffle(spark, no_broadcast):
    mentions = spark.createDataFrame([(1, "a", "x")], "page_id long, role string, user_name string")
    assert explained(names.top_mentioned(mentions, 5)).count("WindowGroupLimit") >= 2


def test_new_names_are_distinct_before_they_meet_the_users(spark, no_broadcast):
    found = spark.createDataFrame([("a",)], "user_name string")
    tree = explained(names.new_users(found, found)).split("\n\n")[0]
    assert "SortMergeJoin LeftAnti" in tree
    # One shuffle a side, already reduced; the join adds none.
    assert tree.count("Exchange") == 2


def test_gaps_gather_one_row_per_bucket_only(spark, no_broadcast):
    plan = explained(frontier.missing_ranges(spark.range(100), 0, 200))
    assert plan.count("Arguments: SinglePartition") == 1
    assert "partial_max" in plan


def test_sessions_scan_once_and_combine_before_the_shuffle(spark, no_broadcast):
    plan = explained(A.worker_sessions(frames.attempts(spark, SF)))
    tree = plan.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and "Join" not in tree
    assert "partial_count" in plan


def test_page_versions_share_one_shuffle_of_the_visits(spark, no_broadcast):
    rows = C.page_changes(frames.visits(spark, SF))
    rows.collect()
    final = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final
    assert "Broadcast" not in final


def test_rollup_expands_counts_not_rows(spark):
    rows = frames.submissions(spark, SF)
    tree = explained(A.status_rollup(rows)).split("\n\n")[0]
    lines = [line for line in tree.splitlines() if "Expand" in line or "Scan" in line or "Exchange" in line]
    assert [re.sub(r"[^A-Za-z]", "", line.split("(")[0]) for line in lines][1] == "Expand"


def test_blob_table_splits_crowded_folders(spark, content):
    plan = explained(blobs.export_plan(content).hint("rebalance", "file"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_sketches_have_fixed_size(spark):
    mentions = spark.createDataFrame([("a", "x")], "role string, user_name string")
    assert "approx_count_distinct" in explained(names.approx_users(mentions))


def test_bucketed_tables_join_without_a_shuffle(spark, attempts, content, no_broadcast):
    save_bucketed(attempts, "bucketed_attempt", "scrape_attempt_id", 8)
    save_bucketed(content, "bucketed_content", "attempt_id", 8)
    joined = A.content_with_attempt(spark.table("bucketed_content"), spark.table("bucketed_attempt"))
    plan = explained(joined)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert joined.count() == A.content_with_attempt(content, attempts).count()


def test_few_keys_filter_a_snapshot_where_it_is_read(spark, attempts, no_broadcast):
    keys = spark.createDataFrame([(1,)], "site_submission_id long")
    few = names.only_keys(attempts, keys, "site_submission_id", 1)
    plan = explained(few)
    assert "BroadcastHashJoin LeftSemi" in plan and "hashpartitioning" not in plan
    assert names.only_keys(attempts, keys, "site_submission_id", 2, most=1) is attempts
