"""The folder queue: what is delivered, acknowledged and delivered again."""

from __future__ import annotations

import random
from datetime import datetime, timezone

import pytest

from crawlframe.sources import queue_source as Q

MOMENT = datetime(2024, 1, 1, tzinfo=timezone.utc)


def publish(spark, root, ids, files=1):
    rows = [(k, str(k).encode(), MOMENT) for k in ids]
    Q.publish_messages(spark.createDataFrame(rows, Q.MESSAGE_SCHEMA).repartition(files), root)


def start(spark, root, prefetch, each, checkpoint):
    writer = Q.read_queue(spark, root, prefetch).writeStream.foreachBatch(each)
    return writer.option("checkpointLocation", checkpoint).start()


def drain(spark, root, prefetch, seen, checkpoint):
    def each(batch, number):
        seen.append((number, sorted(row.delivery_tag for row in batch.collect())))

    run = start(spark, root, prefetch, each, checkpoint)
    try:
        run.processAllAvailable()
    finally:
        run.stop()


def test_folder_by_itself(spark, tmp_path):
    root = str(tmp_path / "q")
    publish(spark, root, range(10), files=3)
    folder = Q.QueueFolder(root)
    assert folder.deliver(4) == 1 and folder.deliver(4) == 1  # all four are in flight
    assert sum(end - begin for _, begin, end in folder.delivery(1)) == 4
    assert folder.deliver(6) == 2 and sum(end - begin for _, begin, end in folder.delivery(2)) == 2
    folder.acknowledge(1)
    assert folder.acked()["number"] == 1 and list(folder.open_deliveries()) == [2]
    assert folder.deliver(6) == 3
    folder.acknowledge(3)
    folder.acknowledge(3)  # twice does no harm
    assert folder.deliver(100) == 3 or folder.deliver(100) == 4
    folder.acknowledge(folder.deliver(100))
    assert not folder.names("messages", ".parquet") and folder.acked()["begun"] == {} and not folder.numbers()


@pytest.mark.parametrize("seed", range(4))
def test_no_message_is_lost_or_doubled(spark, tmp_path, seed):
    rng, root, published, got = random.Random(seed), str(tmp_path / "q"), 0, []
    folder = Q.QueueFolder(root)

    def rows_of(number):
        found = []
        for name, begin, end in folder.delivery(number):
            with folder.files.open_input_file(f"{folder.base}/messages/{name}") as source:
                found += Q.pq.read_table(source).column("delivery_tag").to_pylist()[begin:end]
        return found

    publish(spark, root, range(30), files=3)
    published = 30
    while True:
        if rng.random() < 0.3 and published < 60:
            publish(spark, root, range(published, published + 15), files=2)
            published += 15
        last = folder.deliver(rng.choice([3, 7, 20]))
        waiting = sorted(folder.open_deliveries())
        if not waiting:
            break
        upto = rng.choice(waiting)
        for number in [n for n in waiting if n <= upto]:
            got += rows_of(number)
        folder.acknowledge(upto)
        assert last >= upto
    assert sorted(got) == list(range(published))


def test_stream_takes_the_limit(spark, tmp_path):
    root, seen = str(tmp_path / "q"), []
    publish(spark, root, range(25), files=2)
    drain(spark, root, 10, seen, str(tmp_path / "check"))
    sizes = [len(tags) for _, tags in seen if tags]
    assert sorted(tag for _, tags in seen for tag in tags) == list(range(25)) and max(sizes) <= 10
    publish(spark, root, range(25, 30))
    later = []
    drain(spark, root, 10, later, str(tmp_path / "check"))
    new = [tag for _, tags in later for tag in tags]
    assert set(new) >= set(range(25, 30)) and set(new) - set(range(25, 30)) <= set(seen[-1][1])


def test_a_failed_batch_is_delivered_again(spark, tmp_path):
    root, seen = str(tmp_path / "q"), []
    publish(spark, root, range(12), files=2)

    def fails(batch, number):
        seen.append(sorted(row.delivery_tag for row in batch.collect()))
        if number == 1:
            raise RuntimeError("the worker dies")

    run = start(spark, root, 5, fails, str(tmp_path / "check"))
    with pytest.raises(Exception, match="dies"):
        run.processAllAvailable()
    run.stop()
    first, second = seen[:2]
    again = []
    drain(spark, root, 5, again, str(tmp_path / "other"))  # without the checkpoint, too
    tags = [tag for _, some in again for tag in some]
    assert set(second) <= set(tags) and len(tags) == len(set(tags))
    assert set(tags) | set(first) == set(range(12))
    assert not set(tags) & set(first) or set(first) <= set(tags)  # acknowledged or not, as a whole
