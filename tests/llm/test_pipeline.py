"""The pipeline against the same stages by brute force, and on odd rows."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from crawlframe.llm import language_id
from tests.llm.test_operators import SF, documents, linked, own_print


def removed_passages(rows):
    """Texts without the bytes of 50-byte strings that also start in an earlier document."""
    first = {}
    for key in sorted(rows):
        data = rows[key].encode()
        for at in range(len(data) - 49):
            first.setdefault(data[at : at + 50], key)
    out = {}
    for key, text in rows.items():
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 49):
            if first[data[at : at + 50]] < key:
                gone[at : at + 50] = b"\1" * 50
        rest = bytes(byte for byte, flag in zip(data, gone) if not flag).decode(errors="ignore")
        if rest or not text:
            out[key] = rest
    return out


def test_stages_by_brute_force(spark):
    docs = documents(spark)
    known = language_id.predict(docs, language_id.train(docs), "doc_id", "text").collect()
    texts = {row.doc_id: row.text for row in known if row.lang_pred != "und" and row.score >= 0.5}
    groups = defaultdict(list)
    for key, text in texts.items():
        groups[text.encode().lower()].append(key)
    texts = {max(keys): texts[max(keys)] for keys in groups.values()}
    prints = {key: own_print(text, 3) for key, text in texts.items()}
    root, least = linked(set(prints.values())), {}
    for key in sorted(texts):
        least.setdefault(root[prints[key]], key)
    texts = removed_passages({key: texts[key] for key in least.values()})

    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
    rows = kept.collect()
    assert {row.doc_id: row.text for row in rows} == texts
    assert all(row.n_chars == len(row.text) for row in rows)
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {piece.doc_id for piece in pieces} == set(texts)


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "words and the words of it", "en", "s", 25), (3, "12 34", None, "s", 5)]
    rows += [(4, "the words and the words of it all " * 20, None, None, None)] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        # no letters, no language; the repeated row is one
        assert {row.doc_id for row in docs.collect()} == ({None, 4} if some else set())
