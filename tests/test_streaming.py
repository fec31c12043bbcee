from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from crawlframe.operators.attempts import latest_status
from crawlframe.sources.queue import (
    MESSAGE_SCHEMA,
    publish_ids,
    read_message_stream,
    split_messages,
    write_messages,
)
from crawlframe.streaming import attempts as S
from crawlframe.streaming.batches import read_batches
from crawlframe.streaming.throughput import stream_sessions, stream_throughput
from crawlframe.streaming.users import USER_COLUMNS, stream_insert_users

START = datetime(2024, 1, 1)


def put(spark, path, *files):
    """Write one message file per argument, oldest first."""
    for rows in files:
        frame = spark.createDataFrame(
            [(tag, body, START + timedelta(minutes=tag)) for tag, body in rows], MESSAGE_SCHEMA
        )
        write_messages(frame.coalesce(1), path)


FILES = ([(1, b"10"), (2, b"20"), (3, b"x")], [(4, b"10"), (5, b"30")], [(6, b"20"), (7, b"30")])


def test_messages_round_trip(spark, tmp_path):
    path = str(tmp_path / "q")
    publish_ids(spark.range(5, 12)).write.parquet(path)
    stream = read_message_stream(spark, path, 10, "value binary")
    run = stream.writeStream.format("memory").queryName("round_trip").trigger(availableNow=True)
    run.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    good, dead = split_messages(spark.table("round_trip"))
    assert sorted(r.submission_id for r in good.collect()) == list(range(5, 12))
    assert dead.count() == 0


def attempts_of(spark, root):
    rows = read_batches(spark, f"{root}/attempt", S.ATTEMPT_COLUMNS).collect()
    return sorted((r.scrape_attempt_id, r.site_submission_id, r.processed_status) for r in rows)


def test_attempts_are_at_least_once_and_replays_change_nothing(spark, tmp_path):
    put(spark, str(tmp_path / "q"), *FILES)
    fetched = spark.createDataFrame(
        [(10, 3, "aa"), (30, 4, "bb")],
        "site_submission_id long, content_length long, content_sha512 string",
    )
    expected = [(1, 10, "finished"), (2, 20, "todo"), (4, 10, "finished"), (5, 30, "finished"),
                (6, 20, "todo"), (7, 30, "finished")]
    for run in range(2):
        # A new checkpoint delivers every batch a second time.
        S.stream_attempts(
            read_message_stream(spark, str(tmp_path / "q")), fetched, f"{tmp_path}/attempt",
            f"{tmp_path}/content", f"{tmp_path}/check{run}", F.lit("w"),
        ).awaitTermination()
        assert attempts_of(spark, tmp_path) == expected
        content = read_batches(spark, f"{tmp_path}/content", S.CONTENT_COLUMNS)
        assert sorted(r.attempt_id for r in content.collect()) == [1, 4, 5, 7]
    batches = read_batches(spark, f"{tmp_path}/attempt", S.ATTEMPT_COLUMNS)
    assert batches.select("batch_id").distinct().count() == 3


def test_only_finished_ids_are_skipped(spark, tmp_path):
    put(spark, str(tmp_path / "q"), *FILES)
    known = spark.createDataFrame(
        [(1, 20, "finished"), (2, 30, "todo")],
        "submission_id long, site_submission_id long, processed_status string",
    )
    spark.createDataFrame([(40,)], "id long").write.parquet(f"{tmp_path}/done/batch_id=0")
    extra = spark.createDataFrame([(90 + k, str(key).encode(), START) for k, key in enumerate((30, 50, 40))],
                                  "delivery_tag long, value binary, ts timestamp")
    extra.coalesce(1).write.mode("append").parquet(f"{tmp_path}/q2")
    extra.filter("value <> X'3430'").coalesce(1).write.mode("append").parquet(f"{tmp_path}/q2")
    for run in range(2):
        S.stream_skip_finished(
            read_message_stream(spark, str(tmp_path / "q2"), max_files=1), known,
            f"{tmp_path}/claim", f"{tmp_path}/check{run}", f"{tmp_path}/done",
        ).awaitTermination()
        claims = read_batches(spark, f"{tmp_path}/claim", "id long, action string")
        # 30 and 50 are delivered twice and not finished: claimed again, the second time as known rows
        assert sorted((r.id, r.action, r.batch_id) for r in claims.collect()) == [
            (30, "reuse", 0), (30, "reuse", 1), (50, "new", 0), (50, "reuse", 1)
        ]


def test_two_contents_of_an_id_make_one_attempt_each(spark, tmp_path):
    rows = [(k, b"7", START) for k in (1, 2)]
    frame = spark.createDataFrame(rows, "delivery_tag long, value binary, ts timestamp")
    frame.coalesce(1).write.parquet(f"{tmp_path}/q")
    fetched = spark.createDataFrame(
        [(7, 3, "aa"), (7, 4, "bb")], "site_submission_id long, content_length long, content_sha512 string"
    )
    S.stream_attempts(
        read_message_stream(spark, f"{tmp_path}/q"), fetched, f"{tmp_path}/a", f"{tmp_path}/c",
        f"{tmp_path}/check", F.lit("w"),
    ).awaitTermination()
    assert read_batches(spark, f"{tmp_path}/a", S.ATTEMPT_COLUMNS).count() == 2
    content = read_batches(spark, f"{tmp_path}/c", S.CONTENT_COLUMNS).collect()
    assert sorted((r.attempt_id, r.content_sha512) for r in content) == [(1, "bb"), (2, "bb")]


def test_repeats_within_the_delay_are_dropped(spark, tmp_path):
    put(spark, str(tmp_path / "q"), *FILES)
    firsts = S.first_deliveries(read_message_stream(spark, str(tmp_path / "q")), "1 hour")
    run = firsts.writeStream.format("memory").queryName("firsts").trigger(availableNow=True)
    run.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    assert sorted(r.submission_id for r in spark.table("firsts").collect()) == [10, 20, 30]


def test_dead_letters(spark, tmp_path):
    put(spark, str(tmp_path / "q"), *FILES)
    S.stream_dead_letter(
        read_message_stream(spark, str(tmp_path / "q")), f"{tmp_path}/id", f"{tmp_path}/dead",
        f"{tmp_path}/check",
    ).awaitTermination()
    dead = read_batches(spark, f"{tmp_path}/dead", S.DEAD_COLUMNS).collect()
    assert [(r.delivery_tag, bytes(r.value)) for r in dead] == [(3, b"x")]
    ids = read_batches(spark, f"{tmp_path}/id", "delivery_tag long, submission_id long")
    assert ids.count() == 6


def log_files(spark, path, *files):
    for rows in files:
        frame = spark.createDataFrame(
            [(key, site, START + timedelta(minutes=m), status, "w") for key, site, m, status in rows],
            "scrape_attempt_id long, site_submission_id long, date_visited timestamp,"
            " processed_status string, claimed_by string",
        )
        frame.coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


LOG = (
    [(1, 7, 0, "todo"), (2, 8, 5, "todo")],
    [(3, 7, 20, "finished"), (4, 9, 21, "todo")],
    [(5, 7, 10, "todo"), (6, 8, 200, "finished"), (7, 8, 199, "error")],
)


def test_status_follows_event_time(spark, tmp_path):
    stream = log_files(spark, str(tmp_path / "log"), *LOG)
    S.stream_status(stream, f"{tmp_path}/change", f"{tmp_path}/check").awaitTermination()
    schema = "site_submission_id long, processed_status string, date_visited timestamp"
    now = S.current_status(read_batches(spark, f"{tmp_path}/change", schema))
    batch = latest_status(spark.read.parquet(str(tmp_path / "log")))
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, batch.collect()))
    assert {r[0]: r[1] for r in now.collect()} == {7: "finished", 8: "finished", 9: "todo"}


def test_users_are_inserted_once(spark, tmp_path):
    path = str(tmp_path / "found")
    for names in (["a", "b", "a"], ["b", "c", "B"], ["a", None]):
        frame = spark.createDataFrame([(n,) for n in names], "user_name string")
        frame.coalesce(1).write.mode("append").parquet(path)
    users = spark.createDataFrame([("c",)], "user_name string")
    for run in range(2):
        found = spark.readStream.schema("user_name string").option("maxFilesPerTrigger", 1).parquet(path)
        stream_insert_users(
            found, users, f"{tmp_path}/user", f"{tmp_path}/check{run}", F.lit("2025-01-01")
        ).awaitTermination()
        rows = read_batches(spark, f"{tmp_path}/user", USER_COLUMNS).collect()
        assert sorted(r.user_name for r in rows) == ["B", "a", "b"]


def append_output(spark, counts, tmp_path):
    writer = counts.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out").collect()


def test_late_rows_are_dropped(spark, tmp_path):
    stream = log_files(
        spark, str(tmp_path / "log"),
        [(1, 1, 0, "todo"), (2, 1, 59, "todo")],
        [(3, 1, 300, "todo")],
        [(4, 1, 310, "todo")],
        [(5, 1, 1, "todo"), (6, 1, 299, "todo")],  # the first is late, the second is not
        [(7, 1, 400, "todo")],
    )
    rows = append_output(spark, stream_throughput(stream), tmp_path)
    hours = {(r.window_start - START).seconds // 3600: r.n_attempts for r in rows}
    assert hours == {0: 2, 4: 1, 5: 2}


def test_sliding_windows(spark, tmp_path):
    stream = log_files(spark, str(tmp_path / "log"), [(1, 1, 45, "todo"), (2, 1, 600, "todo")])
    rows = append_output(spark, stream_throughput(stream, "1 hour", "30 minutes"), tmp_path)
    starts = sorted(r.window_start for r in rows if r.window_start < START + timedelta(hours=8))
    assert starts == [START, START + timedelta(minutes=30)]


def test_sessions(spark, tmp_path):
    stream = log_files(
        spark, str(tmp_path / "log"),
        [(1, 1, 0, "todo"), (2, 1, 20, "todo"), (3, 1, 100, "todo"), (4, 1, 900, "todo")],
    )
    rows = append_output(spark, stream_sessions(stream), tmp_path)
    assert sorted((r.session_start, r.n_attempts) for r in rows) == [
        (START, 2), (START + timedelta(minutes=100), 1)
    ]
