"""Importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from crawlframe.llm import resampling
from crawlframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, grams):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [zlib.crc32(" ".join(words[k : k + n]).encode()) % 10_000 for n in range(1, grams + 1) for k in range(len(words) - n + 1)]


def brute_force(rows, goal, grams=1, percent=10):
    found = [(doc, *features(text, grams)) for doc, text in rows]
    source, target = Counter(b for _, _, some in found for b in some), Counter(b for text in goal for b in features(text, grams)[1])
    s, t = sum(source.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s + 10_000) / ((source[b] + 1) * (t + 10_000)))) for b in range(10_000)]
    out = []
    for doc, words, some in found:
        weight = sum(gain[b] for b in some) // max(1, len(some))
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(some), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    enough = [row for row in out if row[5] >= 20]
    enough.sort(key=lambda row: (-row[3], row[0] is None, row[0]))
    for rank, row in enumerate(enough[: percent * len(enough) // 100], 1):
        row[4] = rank
    return sorted((tuple(row[:5]) for row in out), key=repr)


def odd_rows():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.choice([1, 3, 6]))) for _ in range(300)]
    rows = [(k, " ".join(rng.choices(words, k=rng.choice([1, 19, 20, 21, 60])))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, "-- !! \x00"), (203, "A1b2-ÀÉ_x.y " * 4000), (-7, "ABC abc " * 30)]
    return rows, [" ".join(rng.choices(words[:90], k=40)) for _ in range(30)] + [None, ""]


@pytest.mark.parametrize("grams, run_rows, group_rows, fan_in", [(1, 1 << 20, 1 << 20, 64), (2, 5, 12, 3), (1, 9, 10, 2)])
def test_ranks_by_brute_force(spark, monkeypatch, grams, run_rows, group_rows, fan_in):
    monkeypatch.setattr(resampling, "RUN_ROWS", run_rows)
    monkeypatch.setattr(resampling, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(resampling, "FAN_IN", fan_in)
    rows, goal = odd_rows()
    docs = spark.createDataFrame([(*row, 3, "s", 1) for row in rows], "doc_id long, text string, rank int, `a.b` string, segment int").repartition(5)
    target = spark.createDataFrame([(text,) for text in goal], "text string")
    found = resampling.resample(docs, target, grams=grams, percent=30)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows, goal, grams, 30)


def test_repeated_rows_have_ranks_of_their_own(spark):
    text = " ".join(f"w{k}" for k in range(25))
    rows = [(1, text)] * 50 + [(None, text + " x")] * 3 + [(2, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    target = spark.createDataFrame([("w1 w2",)], "text string")
    found = resampling.resample(docs, target, percent=100).collect()
    assert sorted(row.rank for row in found) == list(range(1, 55))
    for percent, drawn in ((0, 0), (50, 27)):
        assert sum(row.rank is not None for row in resampling.resample(docs, target, percent=percent).collect()) == drawn


def test_ranks_of_a_table(spark):
    rows = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    goal = [row.text for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_resampling"](spark, SF).collect()), key=repr) == brute_force(rows, goal)


def test_nothing_to_draw(spark):
    docs, target = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "text string")
    assert resampling.resample(docs, target).collect() == []
    docs = spark.createDataFrame([(1, "few words"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, resampling.resample(docs, target).collect())) == brute_force([(1, "few words"), (2, None)], [])
