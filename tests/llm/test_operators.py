"""Operators for training text against brute force, round trips and held-out labels."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlframe.llm import (
    exact_dedup,
    golomb,
    html_text,
    language_id,
    packing,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    token_files,
    token_words,
    toxicity,
    vector_dedup,
)
from crawlframe.llm.components import connected_components
from crawlframe.llm.elias_fano import EliasFano, pack
from crawlframe.llm.queries import PIECES, QUERIES, VOCABULARY, tokenizer_path
from crawlframe.llm.token_words import word_encoder

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, print string, kept int, shard int, score string"
PASSAGE = "The harbour master counted forty grey barrels before the tide turned and the lamps went out. "


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh ijklmnop") for _ in range(7)).strip() or "x" for _ in range(words))


TEXTS = {
    1: prose(1, 120) + PASSAGE + prose(2, 80),
    2: prose(3, 60) + PASSAGE * 2 + prose(4, 60),
    3: prose(1, 120) + PASSAGE + prose(2, 80),
    4: None,
    5: "",
    6: "Ärger im Straßencafé, naïve Œuvre! " * 30,
    7: prose(5, 6000),
    8: (prose(1, 120) + PASSAGE + prose(2, 80)).upper(),
    9: "a b",
    10: "Du " * 90,
    11: "\n\t \x0b",
    12: PASSAGE + "é" * 200,
    None: "no id at all, but some words to look at",
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(key, text, "clash", 1, 2, "3") for key, text in TEXTS.items()]
    return spark.createDataFrame(rows + rows[5:6], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@given(st.lists(st.integers(0, 2**64 - 1)))
def test_golomb_round_trip(values):
    values = np.array(sorted(values), np.uint64)
    assert (golomb.decode(golomb.encode(values)) == values).all()


@given(st.lists(st.integers(0, 2**40)))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    read = EliasFano(pack(np.array(values, np.int64)))
    assert read.all().tolist() == values == [read.select(k) for k in range(len(read))]


def test_elias_fano_is_small():
    ends = np.cumsum(np.full(100_000, 700))
    assert len(pack(ends)) < 100_000 * 13 / 8


# exact duplicates


def test_exact_duplicates(spark, docs):
    groups = defaultdict(list)
    rows = [*TEXTS.items(), list(TEXTS.items())[5]]
    for key, text in rows:
        groups[(text or "").encode().lower()].append(-1 if key is None else key)
    wanted = []
    for key, text in rows:
        norm = (text or "").encode().lower()
        keep = max(groups[norm])
        wanted.append((key, None if keep < 0 else keep, len(groups[norm]), keep == (-1 if key is None else key), hashlib.sha256(norm).hexdigest()))
    found = exact_dedup.exact_duplicates(docs)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)


def test_exact_keep_one(docs):
    left = [row.doc_id for row in exact_dedup.keep_one(docs).collect()]
    assert sorted(key or 0 for key in left) == [0, 2, 5, 6, 7, 8, 9, 10, 11, 12]
    assert exact_dedup.keep_one(docs).columns == docs.columns


ODD_COLUMNS = "doc_id long, text string, `a.b` string, __kept int, __shard int, mark string, id int"


def test_rows_that_share_an_id(spark):
    rows = [(1, "x y"), (1, "other text"), (2, "X y"), (3, "lone"), (3, "lone"), (None, None), (4, "")]
    docs = spark.createDataFrame([(*row, "p", 1, 2, "m", 3) for row in rows], ODD_COLUMNS)
    for keep_one, wanted in (
        (exact_dedup.keep_one, [(1, "other text"), (2, "X y"), (3, "lone"), (4, "")]),
        (simhash.keep_one, [(1, "other text"), (1, "x y"), (3, "lone"), (4, "")]),
    ):
        left = keep_one(docs)
        assert left.columns == docs.columns
        assert sorted((row.doc_id, row.text) for row in left.collect()) == wanted


def test_passages_of_odd_columns(spark):
    rows = [(1, PASSAGE), (2, "x" + PASSAGE), (3, None), (4, "")]
    docs = spark.createDataFrame([(*row, "p", 1, 2, "m", 3) for row in rows], ODD_COLUMNS)
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect())) == [(1, PASSAGE, "p", 1, 2, "m", 3), (2, "x", "p", 1, 2, "m", 3), (3, "", "p", 1, 2, "m", 3), (4, "", "p", 1, 2, "m", 3)]
    assert not [table.name for table in spark.catalog.listTables() if table.name.startswith("shards_")]


# repeated passages


def repeats(rows):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) by definition."""
    first = {}
    order = sorted(((2**63 if key is None else key), (text or "").encode()) for key, text in rows)
    for key, data in order:
        for at in range(len(data) - 49):
            first.setdefault(data[at : at + 50], key)
    out = []
    for key, text in rows:
        data, own = (text or "").encode(), 2**63 if key is None else key
        gone = bytearray(len(data))
        for at in range(len(data) - 49):
            if first[data[at : at + 50]] < own:
                gone[at : at + 50] = b"\1" * 50
        spans = sum(1 for at, flag in enumerate(gone) if flag and not (at and gone[at - 1]))
        rest = bytes(byte for byte, flag in zip(data, gone) if not flag)
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def test_repeats_by_brute_force(docs):
    rows = [*TEXTS.items(), list(TEXTS.items())[5]]
    found = suffix_dedup.removal_report(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == repeats(rows)


def test_repeats_of_the_smallest_tables(spark):
    rows = [(row.doc_id, row.text) for row in documents(spark).collect()]
    found = QUERIES["op4_suffix_dedup"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, found.collect()), key=repr) == repeats(rows)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.lists(st.sampled_from([PASSAGE, PASSAGE[:49], PASSAGE[:50], "ab" * 40, "xyz", "é" * 30]), max_size=5))))
def test_shards_settle_repeats(parts):
    rows = [(key, "".join(pieces)) for key, pieces in parts]
    shards = [[row for row in rows if row[0] % 3 == k] for k in range(3)]
    shards = [part for part in shards if part]
    replies = [{1: {}, 2: {}, 3: {}} for _ in shards]

    def shard(k):
        texts = [text.encode() for _, text in shards[k]]
        return suffix_dedup.Shard(texts, np.array([key for key, _ in shards[k]]), 2, 20, replies[k])

    for step in (1, 2, 3):
        sent = [(owner, k, block) for k in range(len(shards)) for owner, block in shard(k).blocks(step)]
        for owner in range(2):
            mine = [(k, block) for to, k, block in sent if to == owner]
            if mine:
                for (k, _), code in zip(mine, suffix_dedup.answer(step, [block for _, block in mine])):
                    replies[k][step][owner] = code
    found = []
    for k, part in enumerate(shards):
        texts = [text.encode() for _, text in part]
        removed = shard(k).removed()
        for (key, _), rest in zip(part, suffix_dedup.kept_parts(texts, removed)):
            found.append((key, hashlib.sha256(rest).hexdigest()))
    assert sorted(found) == sorted((row[0], row[4]) for row in repeats(rows))


def test_many_spans_of_one_anchor(spark):
    """More contested spans of an anchor than a shard sends."""
    middle = "q" * 10 + "The lamps of the old quay burned low that night." + "w" * 10
    rows = [(k, prose(1000 + k, 6) + middle + prose(2000 + k, 6)) for k in range(400)]
    found = suffix_dedup.removal_report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == repeats(rows)


def test_without_repeats_keeps_columns(docs):
    found = suffix_dedup.without_repeats(docs)
    assert found.schema.names == docs.schema.names
    left = {row.doc_id: row.text for row in found.collect()}
    assert 3 not in left and left[1] == TEXTS[1] and PASSAGE.strip() not in left[2]


# SimHash


def own_print(text, width=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[k : k + width]) for k in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def linked(prints):
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_simhash_by_brute_force(spark, docs):
    prints = {key: own_print(text) for key, text in TEXTS.items()}
    root, least = linked(set(prints.values())), {}
    for key, value in prints.items():
        if key is not None:
            least[root[value]] = min(key, least.get(root[value], key))
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(TEXTS) + 1
    for row in found:
        assert row.print % 2**64 == prints[row.doc_id] and row.component_id == least.get(root[prints[row.doc_id]])


@pytest.mark.parametrize("crowd", [64, 3])
def test_links_join_all_within_two_bits(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for one in base:
        for _ in range(20):
            flips = rng.sample(range(64), rng.choice([1, 2, 2, 3, 4]))
            prints.add(one ^ sum(1 << bit for bit in flips))
    frame = spark.createDataFrame([(simhash.signed(p),) for p in prints], "print long")
    edges = [(row.a % 2**64, row.b % 2**64) for row in simhash.links(frame).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in edges)
    mine = {row.node % 2**64: row.component for row in connected_components(simhash.links(frame)).collect()}
    wanted = linked(prints)
    groups, found = defaultdict(set), defaultdict(set)
    for p in prints:
        groups[wanted[p]].add(p)
        found[mine.get(p, ("alone", p))].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_simhash_keep_one(docs):
    left = sorted(row.doc_id or 0 for row in simhash.keep_one(docs).collect())
    assert 3 not in left and 8 not in left and {1, 2, 6, 7, 0} <= set(left)


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(60)] + [(1000 + rng.randrange(200), 1000 + rng.randrange(200)) for _ in range(150)]
    edges += [(5000, 5000 + k) for k in range(100)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted([find(a), find(b)])
        parent[high] = low
    alone = {a for a, b in edges if a == b}
    wanted = {x: find(x) for x in parent if not (x in alone and find(x) == x and not any(x in e and e[0] != e[1] for e in edges))}
    assert {row.node: row.component for row in connected_components(frame).collect()} == wanted


# vectors


def test_vectors_by_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 48))
    rows = [(k, vector.tolist()) for k, vector in enumerate(base)]
    for k in range(240):
        near = base[k % 60] + rng.normal(size=48) * rng.choice([0.05, 0.15, 0.25, 0.4])
        rows.append((100 + k, near.tolist()))
    rows += [(900 + k, base[3].tolist()) for k in range(300)]
    crowd = base[7] + rng.normal(size=(200, 48)) * 0.02
    rows += [(2000 + k, vector.tolist()) for k, vector in enumerate(crowd)]
    odd = [None, [], [0.0] * 48, [None] + [1.0] * 47, [float("nan")] * 48, [float("inf")] + [1.0] * 47, [1.0, 2.0]]
    rows += [(5000 + k, vector) for k, vector in enumerate(odd)] + [(6000, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {k: np.array(v) / np.linalg.norm(v) for k, v in rows if v and len(v) == 48 and None not in v and np.isfinite(v).all() and any(v)}
    keys = list(good)
    unit = np.stack([good[k] for k in keys])
    near = unit @ unit.T >= 0.95
    count = {k: int(n) - 1 for k, n in zip(keys, near.sum(axis=1))}
    found = {row.vec_id: row for row in vector_dedup.near_duplicates(frame).collect()}
    assert len(found) == len(rows)
    assert sum(found[k].n_links for k in keys) >= 0.99 * sum(count.values())
    assert all(found[k].n_links <= count[k] for k in keys)
    for k in range(len(odd) - 1):
        assert (found[5000 + k].n_links, found[5000 + k].component_id, found[5000 + k].kept) == (0, 5000 + k, True)
    assert found[6000].n_links == found[5006].n_links == 1 and found[6000].component_id == 5006
    assert found[1100].component_id == 3 and not found[1100].kept


# tokens


def test_word_ids_equal_the_library(spark):
    encoder = word_encoder(tokenizer_path(VOCABULARY))
    texts = [text or "" for text in TEXTS.values()] + [row.text for row in documents(spark).collect()]
    texts += ["İstanbul, ΟΔΥΣΣΕΥΣ. don't I'LL x's 12a_b(c) <|endoftext|>z   wide line é 한!", "'s", "..'s.", "ab'", "\x1c"]
    wanted = [one.ids for one in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == wanted


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("aZ'.s, \n\té")), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_any_word_ids_equal_the_library(text):
    encoder = word_encoder(tokenizer_path(VOCABULARY))
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_encoder_looks_up_kept_words_as_they_stand(monkeypatch):
    """Words kept from before need no second look, also where the same call makes room for others."""
    encoder = token_words.WordEncoder(tokenizer_path(VOCABULARY))
    monkeypatch.setattr(token_words, "KEPT_WORDS", 8)
    texts = ["the sea is wide", "The sea, the sea! is it wide? 12 b4 Straße ΣΟΦΟΣ", "the sea of one two three four five six seven eight", "sea is"]
    for text in texts + texts[::-1]:
        (ids,) = encoder.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_encoder_takes_arrow_columns(monkeypatch):
    """Slices of a column, with nulls, white space of all kinds and words that no table keeps."""
    encoder = token_words.WordEncoder(tokenizer_path(VOCABULARY))
    monkeypatch.setattr(token_words, "KEPT_MARKS", 3)
    texts = ["cut off", None, "", " \t\n", "a\vb\fc\r\nd\xa0e\u2003f", "İ İx i̇ ΣΑΣ K Å", "x" * 60 + ".", "end" + "!" * 60, "a. b, c; d: e? f!", "a+ b- c* don't 'x' <|endoftext|>", "a.", "cut off"]
    got = encoder.encode(pa.array(texts, pa.string())[1:-1])
    wanted = [encoder.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts[1:-1]]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == wanted
    assert encoder.encode(pa.array([], pa.string())) == []


def test_word_encoder_asks_the_library_once_for_words_at_hand(monkeypatch):
    """Where the table is full, the known words of the call stay, and a repeated word is asked for once."""
    monkeypatch.setattr(token_words, "KEPT_WORDS", 8)
    asked = []
    of_letters = token_words.WordEncoder.of_letters
    monkeypatch.setattr(token_words.WordEncoder, "of_letters", lambda self, words: asked.append(sorted(words)) or of_letters(self, words))
    encoder = token_words.WordEncoder(tokenizer_path(VOCABULARY))
    texts = ["one two three four five six", "One two, two three four seven (eight nine. nine!", "One seven, eight nine.", "five"]
    for text in texts:
        (ids,) = encoder.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert list(filter(None, asked)) == [["five", "four", "one", "six", "three", "two"], ["nine", "seven"], ["eight"], ["five"]]



def ids_of(texts, end):
    tokenizer = word_encoder(tokenizer_path(VOCABULARY)).tokenizer
    encoded = tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)
    return [np.array([*one.ids, end], "<u4") for one in encoded]


def test_token_files(spark):
    rows = documents(spark).orderBy("doc_id").collect()
    found = {row.doc_id: row for row in QUERIES["op8_token_files"](spark, SF).collect()}
    at = 0
    for row, ids in zip(rows, ids_of([row.text for row in rows], 2)):
        got = found[row.doc_id]
        assert (got.start, got.n_tokens, got.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_documents_are_found_by_select(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 3000)
    path = str(tmp_path / "files")
    token_files.write_token_files(documents(spark), path, vocabulary=tokenizer_path(VOCABULARY), end_id=2)
    rows = {row.doc_id: row for row in token_files.read_documents(spark, path).collect()}
    wanted = [*sorted(rows)[:3], *sorted(rows)[50:150:7], max(rows), -5]
    assert {row.doc_id: row for row in token_files.find_documents(spark, path, wanted).collect()} == {key: rows[key] for key in wanted if key in rows}


def test_token_files_of_odd_rows(spark, docs, empty, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    for name, frame, rows in (("odd", docs, len(TEXTS) + 1), ("empty", empty, 0)):
        path = str(tmp_path / name)
        token_files.write_token_files(frame, path, vocabulary=tokenizer_path(VOCABULARY), end_id=2)
        found = sorted(token_files.document_index(spark, path).collect(), key=lambda row: row.start)
        assert len(found) == rows
        assert [row.start for row in found] == [sum(row.n_tokens for row in found[:k]) for k in range(rows)]
        keys = [row.doc_id if row.doc_id is not None else -1 for row in found]
        assert keys == sorted(keys)


def test_packing(spark, docs):
    path = tokenizer_path(VOCABULARY)
    for frame, length in ((documents(spark), 2048), (docs, 64)):
        rows = frame.collect()
        pieces = packing.pack_documents(frame, vocabulary=path, end_id=1, length=length).collect()
        wanted = defaultdict(int)
        for row, ids in zip(rows, ids_of([row.text for row in rows], 1)):
            for at in range(0, len(ids), length):
                part = ids[at : at + length]
                wanted[(row.doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
        got = defaultdict(int)
        sequences = defaultdict(list)
        for p in pieces:
            got[(p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens)] += 1
            sequences[p.sequence_id].append((p.offset, p.length))
        assert got == wanted
        for parts in sequences.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= length
        assert set(sequences) == set(range(len(sequences)))
        filled = sum(p.length for p in pieces) / length / len(sequences)
        assert filled > 0.95


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50)))
def test_patterns_use_every_length(histogram):
    patterns = packing.shortest_pack_first(histogram, 40)
    used = defaultdict(int)
    for lengths, packs in patterns:
        assert packs > 0 and sum(lengths) <= 40
        for size in lengths:
            used[size] += packs
    assert used == histogram


# SentencePiece


def test_pieces_equal_the_library(spark):
    import sentencepiece

    path = tokenizer_path(PIECES)
    texts = [text or "" for text in TEXTS.values()] + [row.text for row in documents(spark).collect()]
    texts += [" ", "  two  blanks ", "▁mark ▁▁ s", "日本語 🙂\r\n\n x", "a\nb", "\u0000z"]
    assert sentencepiece_codec.parity(texts, path) == []
    codec, processor = sentencepiece_codec.codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    ids = codec.encode(texts)
    assert codec.decode(ids) == processor.decode([np.frombuffer(one, "<u4").tolist() for one in ids])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("ab the\n▁")), st.characters(exclude_categories=["Cs"], exclude_characters="\0")), max_size=30))
def test_any_pieces_equal_the_library(text):
    assert sentencepiece_codec.parity([text], tokenizer_path(PIECES)) == []


def proto(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + np.float32(value).tobytes()
    return varint(number << 3) + varint(value)


def test_unigram_model_with_byte_fallback(tmp_path):
    import sentencepiece

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{k:02X}>", -9.0, 6) for k in range(256)]]
    pieces += [("▁", -3.0, 1), ("▁the", -1.5, 1), ("th", -2.5, 1), ("e", -3.0, 1), ("t", -4.0, 1), ("h", -4.0, 1), ("▁t", -2.9, 1), ("he", -2.2, 1)]
    data = b"".join(proto(1, proto(1, piece.encode()) + proto(2, score) + proto(3, kind)) for piece, score, kind in pieces)
    data += proto(2, proto(3, 1) + proto(35, 1)) + proto(3, proto(1, b"identity") + proto(3, 1) + proto(4, 1) + proto(5, 1))
    path = tmp_path / "unigram.model"
    path.write_bytes(data)
    texts = ["the the", " the  thé ", "hethe 🙂", "", "e"]
    processor = sentencepiece.SentencePieceProcessor(model_file=str(path))
    codec = sentencepiece_codec.PieceCodec(data)
    own = [np.frombuffer(ids, "<u4").tolist() for ids in codec.encode(texts)]
    assert own == processor.encode(texts)
    assert codec.decode(codec.encode(texts)) == processor.decode(own)


def test_sentencepiece_query_round_trip(spark):
    found = QUERIES["op5_sentencepiece"](spark, SF).collect()
    assert len(found) == documents(spark).count() and all(row.round_trip for row in found)


# language and toxicity


def test_language_held_out(spark):
    lang = {row.doc_id: row.lang for row in documents(spark).collect()}
    found = [row for row in QUERIES["op1_language_id"](spark, SF).collect() if row.held_out]
    assert found and all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in found)
    assert sum(row.lang_pred == lang[row.doc_id] for row in found) >= 0.95 * len(found)


def test_language_of_odd_rows(spark, docs, empty):
    model = language_id.train(documents(spark))
    found = {row.doc_id: row for row in language_id.predict(docs, model, "doc_id").collect()}
    for key in (4, 5, 11):
        assert (found[key].lang_pred, found[key].score) == ("und", 0.0)
    assert all(0 <= row.score <= 1 for row in found.values())
    left = language_id.accepted(docs, model)
    assert left.columns == docs.columns and {row.doc_id for row in left.collect()} & {4, 5, 11} == set()
    assert language_id.predict(empty, model, "doc_id").count() == 0
    nothing = language_id.train(empty.withColumn("lang", empty.text))
    assert {row.lang_pred for row in language_id.predict(docs, nothing, "doc_id").collect()} == {"und"}


def test_letters_of_long_words_and_numerals(spark):
    assert language_id.word_list("½ ² ① Ⅷ a½b ÄÖ") == ["a", "b", "äö"]
    rows = [(k, "z" * 60 + "qxqx" * 20, "q") for k in range(10)] + [(k + 10, "z" * 60 + "wvwv" * 20, "w") for k in range(10)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "qxqxq", None), (2, "wvwvw", None), (3, "½ ² ① Ⅷ", None)], "doc_id long, text string, lang string")
    assert [row.lang_pred for row in language_id.predict(asked, model, "doc_id").orderBy("doc_id").collect()] == ["q", "w", "und"]
    assert [row.doc_id for row in language_id.accepted(asked, model).orderBy("doc_id").collect()] == [1, 2]


def test_toxicity_of_labels_at_odds(spark):
    docs = spark.createDataFrame([(k, f"{'vile' if k % 2 else 'kind'} words here {k}") for k in range(60)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    found = {row.doc_id: row.score for row in toxicity.score(docs, model, "doc_id").collect()}
    assert all((score > 0.5) == bool(key % 2) for key, score in found.items())


def test_toxicity_pairs_beat_weights():
    """A term pair decides where neither term does."""
    rng = random.Random(2)
    rows, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append([k for k, on in ((1, a), (2, b)) if on] + [rng.randrange(3, 9)])
        labels.append(int(a != b))
    model = toxicity.fit(rows, labels, list(range(1, 9)), rounds=600)
    scores = [toxicity.sigmoid(model.logit([model.index[term] for term in row])) for row in rows]
    assert sum((score >= 0.5) == bool(label) for score, label in zip(scores, labels)) > 0.97 * len(rows)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {row.doc_id: row.toxic for row in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [row for row in QUERIES["op7_toxicity"](spark, sf).collect() if row.held_out and row.doc_id in toxic]
    right = sum(row.predicted == toxic[row.doc_id] for row in found)
    hits = sum(row.predicted for row in found if toxic[row.doc_id])
    assert right > 0.97 * len(found) and hits > 0.85 * sum(toxic[row.doc_id] for row in found)


def test_toxicity_without_labels(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    assert {row.score for row in toxicity.score(docs, model, "doc_id").collect()} == {0.5}
    assert toxicity.score(empty, model, "doc_id").count() == 0


# pages

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body><header>Site name</header><nav><ul><li><a href="/x">Home</a></li></ul></nav><!-- <p>hidden</p> -->
<div class="cookie-notice">We store things. Accept, please.</div>
<article><h1>A  title</h1><p>First <b>bold</b>&nbsp;text, it&#39;s &lt;fine&gt;.<br>Next line.<p>Second one.
<aside>Read this too.</aside><div class="comments"><p>Reader says hello, twice, and more.</p></div>
<form><p>Mail us</p></form><ul><li>Point one</li><li>Point two</ul></article><div id="sidebar">Popular</div><footer>&copy; us</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "A title\nFirst bold text, it's <fine>. Next line.\nSecond one.\nPoint one\nPoint two"


def test_main_text_of_a_page_laid_out_beside_a_sidebar():
    page = "<body><div class='content has-sidebar no_comments'><p>Some long text, of the page.</p></div><div class=sidebar><p>Aside, of it.</p></div></body>"
    assert html_text.main_text(page) == "Some long text, of the page."


@pytest.mark.parametrize(
    "part",
    [
        "<section id='side-effects'><p>{}</p></section>",
        "<h2 id='related-work'>{}</h2>",
        "<section id='search-results'><p>{}</p></section>",
        "<p><a title='The hidden cost' data-x='a role=search'>{}</a></p>",
        "<p data-hidden='false' hidden-by=none>{}</p>",
        "<p><svg viewBox='0 0 > 1' />{}</p>",
        "<p><math/>{}</p>",
    ],
)
def test_main_text_keeps_what_only_looks_like_a_role(part):
    text = "Words of the text, all of them."
    assert html_text.main_text(f"<article><p>First, a line.</p>{part.format(text)}<p>Last, a line.</p></article>") == f"First, a line.\n{text}\nLast, a line."


@pytest.mark.parametrize("marks", ["hidden", "hidden=''", "HIDDEN class=x", "title='a b'hidden", "aria-hidden=true", "role='search'", "class='share'", "id=comments"])
def test_main_text_drops_marked_elements(marks):
    page = f"<article><p>First, a line.</p><div {marks}><p>Not of the text, this.</p></div><svg><text>Drawn.</text></svg></article>"
    assert html_text.main_text(page) == "First, a line."


def test_main_text_without_article():
    body = "".join(f"<div class='body'><p>{'Some words, well chosen. ' * 12}{k}</p></div>" for k in range(3))
    menu = "".join(f"<div><a href='/{k}'>Link {k}</a></div>" for k in range(12))
    lines = html_text.main_text(f"<body><div id=menu>{menu}</div>{body}<div class=footer>Rights, all.</div></body>").split("\n")
    assert len(lines) == 3 and all("well chosen" in line for line in lines)


LONG = "<p>This is a real paragraph, with words in it, and more of them. It goes on.</p>"


@pytest.mark.parametrize(
    "page, kept, dropped",
    [
        (f"<article><h3>Teaser</h3></article><div>{LONG * 4}</div>", ["real paragraph"], []),
        (f"<form action=x>{LONG * 3}<input></form>", ["real paragraph"], []),
        (f"<article>{LONG}<form><p>Your name here</p></form></article>", ["real paragraph"], ["Your name"]),
        (f"<div>{LONG * 3}</div><form><p>Mail me</p></form>", ["real paragraph"], ["Mail me"]),
        ("<article><p>Before it.</p><select><option>odd<p>After, the rest.</p></article>", ["Before it", "After, the rest"], ["odd"]),
        ("<article><p>Before it.</p><object data=x><p>After, the rest.</p></article>", ["Before it", "After, the rest"], []),
        (f"<div><p>Before, the text.</p><iframe src=x></div><div>{LONG}</div>", ["Before", "real paragraph"], []),
        (f"<div>{LONG * 3}<ul><li>One</li><li>Two</li></ul><table><tr><td>cell</td></tr></table><blockquote>Short</blockquote></div>", ["One\nTwo", "cell", "Short"], []),
        (f"<body><h1>Title</h1>{LONG * 3}", ["Title"], []),
        (f"<article>{LONG}<table><tr><td>7</td></tr></table></article>", ["7"], []),
        ('<p>a <a href="x>y</a> b, c.</p><p>tail, of it.</p>', ["tail"], []),
        ("<p>if a < b and c > d then, x.</p>", ["if a < b and c > d then, x."], []),
        ("<p>Some text, yes.</p><a href=", ["Some text"], ["href"]),
    ],
)
def test_main_text_is_not_lost(page, kept, dropped):
    text = html_text.main_text(page)
    assert all(part in text for part in kept) and not any(part in text for part in dropped)


@pytest.mark.parametrize("part", ["<svg x", "<a ", "<b>x", '<a "', "<a '\">", "<select>", "<div></i>", "<!-- ", "<script ", "<svg>", "<p x='"])
def test_broken_markup_takes_linear_time(part):
    page = "<p>" + part * (1_000_000 // len(part))
    began = time.process_time()
    html_text.main_text(page)
    html_text.main_text(page + ">")
    assert time.process_time() - began < 12


def test_pages_of_all_kinds(spark):
    pages = [None, "", "plain", "<p>a<p>b", "<p>unclosed <b>x", "<script>never", "a < b > c", "<!-- open", "<article></article>"]
    rows = [(k, f"u{k}", page, "t") for k, page in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {row.page_id: row for row in html_text.extract_text(frame, "page_id", "url").collect()}
    assert found[0].text == found[1].text == found[5].text == found[7].text == found[8].text == ""
    assert all(row.n_chars == len(row.text) for row in found.values())


def test_nothing_in_nothing_out(empty):
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert suffix_dedup.removal_report(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert packing.pack_documents(empty, vocabulary=tokenizer_path(VOCABULARY)).count() == 0


@pytest.mark.parametrize("dim", [64, 384])
def test_planted_vectors(spark, dim):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(150, dim))
    rows = [*base, *base[:20], *(2 * base[20:40])]
    rows += list(base[:100] + rng.normal(size=(100, dim)) * 0.25 * np.linalg.norm(base[:100], axis=1)[:, None] / np.sqrt(dim))
    rows += list(base[0] + rng.normal(size=(150, dim)) * 0.15 * np.linalg.norm(base[0]) / np.sqrt(dim))  # a dense group
    given = [(k, row.tolist()) for k, row in enumerate(rows)] + [(3, base[7].tolist()), (None, base[8].tolist()), (9999, [0.0] * dim)]
    frame = spark.createDataFrame([(*row, 1, "p") for row in given], "vec_id long, embedding array<double>, class int, `a.b` string")
    unit = np.array([values for _, values in given[:-1]])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    ids = [key for key, _ in given]
    label = np.arange(len(near))
    while True:
        least = np.where(near, label[None, :], len(near)).min(axis=1, initial=len(near))
        new = np.minimum(label, least)
        if (new == label).all():
            break
        label = new
    first = {root: min((ids[k] for k in np.flatnonzero(label == root) if ids[k] is not None), default=None) for root in set(label.tolist())}
    wanted = [(ids[k], int(near[k].sum()), first[label[k]], first[label[k]] == ids[k]) for k in range(len(near))] + [(9999, 0, 9999, True)]
    found = sorted(map(tuple, vector_dedup.near_duplicates(frame, threshold=0.95).collect()), key=repr)
    links = sum(n for _, n, _, _ in wanted)
    assert links > 10_000 and sum(row[1] for row in found) >= 0.998 * links
    if sum(row[1] for row in found) == links:
        assert found == sorted(wanted, key=repr)


def test_candidates_stay_few():
    rng = np.random.default_rng(2)
    shares = []
    for n in (500, 4000):
        unit = rng.normal(size=(n, 64))
        found = vector_dedup.buckets(unit, *vector_dedup.hash_counts(64, n))
        _, counts = np.unique((found.astype(object) * 64 + np.arange(found.shape[1])[None, :, None]).astype(str).ravel(), return_counts=True)
        shares.append((counts * (counts - 1) / 2).sum() / n)
    assert max(shares) < 40 and [vector_dedup.hash_counts(64, n)[1] for n in (500, 50_000, 10**9)] == [2, 3, 5]


def test_no_vectors(spark):
    assert vector_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
