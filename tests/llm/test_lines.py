"""Repeated lines against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from crawlframe.llm import line_dedup
from crawlframe.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\v\f\r"
COMMON = "All rights reserved, see the notice below"


def key_of(line):
    return line.strip(BLANK).encode().lower()


def brute_force(rows):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(line.strip(BLANK)) >= 10:
                holders[key_of(line)].add(line_dedup.LAST if doc is None else doc)
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        mine = line_dedup.LAST if doc is None else doc
        left = [line for line in lines if min(holders.get(key_of(line), {mine})) == mine]
        found.append((doc, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(found, key=repr)


def odd_rows():
    rng = random.Random(3)
    lines = ["".join(rng.choice("abcdeé fghij") for _ in range(rng.choice([3, 9, 10, 11, 40]))) for _ in range(60)]
    rows = [(k, "\n".join(rng.choice(["", " \t", "\v "]) + rng.choice([line, line.upper()]) + rng.choice(["", "\r", "\x85"]) for line in rng.choices(lines, k=rng.choice([1, 4, 30]))) + f"\n {COMMON}\n") for k in range(40)]
    rows += rows[3:5] + [(7, "another text under this id\n" + COMMON), (100, None), (101, ""), (102, "\n\n"), (None, COMMON + "\nno id, no id"), (None, "no id, no id")]
    rows += [(200, "\n".join(f"line number {k} of a long text" for k in range(20_000))), (201, "LINE number 77 of a long text \nx\x00y" * 3), (-5, "line number 9 of a long text")]
    return rows


@pytest.mark.parametrize("chunk_keys", [1 << 20, 7])
def test_lines_by_brute_force(spark, monkeypatch, chunk_keys):
    monkeypatch.setattr(line_dedup, "CHUNK_KEYS", chunk_keys)
    rows = odd_rows()
    docs = spark.createDataFrame([(*row, 1, "x", "m") for row in rows], "doc_id long, text string, lost int, `a.b` string, mark string").repartition(3)
    found = line_dedup.line_report(docs)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows)
    left = line_dedup.without_repeated_lines(docs)
    assert left.columns == docs.columns
    kept = sorted((row.doc_id, hashlib.sha256((row.text or "").encode()).hexdigest()) for row in left.collect() if row.doc_id is not None)
    assert kept == sorted((row[0], row[3]) for row in brute_force(rows) if row[0] is not None)


def test_lines_of_a_table(spark):
    rows = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_line_dedup"](spark, SF).collect()), key=repr) == brute_force(rows)
    assert "op12_line_dedup" in ORACLES


def test_no_lines(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.line_report(docs).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "short")], "doc_id long, text string")
    assert {row.n_dropped for row in line_dedup.line_report(docs).collect()} == {0}


def test_filters_miss_no_repeat():
    rng = np.random.default_rng(5)
    digests = [rng.bytes(32) for _ in range(3000)]
    chunks = [digests[:1200], digests[1000:2000], digests[1990:] + digests[2500:2510]]
    places = [line_dedup.Places(b"".join(chunk), 5, 9000) for chunk in chunks]
    answers = [{} for _ in chunks]
    for owner in range(5):
        sent = [(k, block) for k, some in enumerate(places) for block in some.blocks() if block[0] == owner]
        at = [line_dedup.golomb.decode(block[1]).astype(np.int64) for _, block in sent]
        for (k, _), said in zip(sent, line_dedup.merge_filters(at, [block[2] for _, block in sent], 9000)):
            answers[k][owner] = said
    counts = defaultdict(int)
    for chunk in chunks:
        for digest in chunk:
            counts[digest] += 1
    wrong = 0
    for some, chunk, said in zip(places, chunks, answers):
        for digest, suspect in zip(chunk, some.suspects(said)):
            assert suspect or counts[digest] == 1
            wrong += bool(suspect) and counts[digest] == 1
    assert wrong < 15
