"""Toxicity scores: a factorization machine over hashed terms.

Terms are the words of a text and the first four letters of longer ones,
hashed.  Training keeps the terms whose presence and the label depend on each
other most clearly, then fits bias, one weight a term and a short vector a
term; the dot product of two vectors is what that pair adds when both occur,
so an insult next to a group mention can weigh more than the two alone.

A text is the set of its terms.  Null and empty texts get the score of no
term.  Rows that share a key are scored each for itself.  Without labels of
both kinds every text scores the share of label 1 (0.5 with no label at all).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.batches import mapped, only, small
from crawlframe.llm.components import stored

WORD = re.compile(r"[^\W\d_]+")
BITS, STEM, CACHED = 22, 4, 300_000


def hashed(term: str) -> int:
    return zlib.crc32(term.encode()) & ((1 << BITS) - 1)


def word_terms(word: str) -> list[int]:
    """The word itself and, if it is longer, its first letters."""
    return [hashed(word)] + ([hashed("^" + word[:STEM])] if len(word) > STEM else [])


def text_terms(text: str | None) -> set[int]:
    found: set[int] = set()
    for word in set(WORD.findall((text or "").lower())):
        found.update(word_terms(word))
    return found


@dataclass
class FactorModel:
    """``index`` gives the row of a hashed term in ``weights`` and ``factors``."""

    bias: float
    index: dict[int, int]
    weights: np.ndarray
    factors: np.ndarray
    cache: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def rows(self, word: str) -> tuple[int, ...]:
        found = self.cache.get(word)
        if found is None:
            found = self.cache[word] = tuple(row for row in map(self.index.get, word_terms(word)) if row is not None)
        return found

    def score(self, text: str | None) -> float:
        if len(self.cache) > CACHED:
            self.cache = {}
        rows: set[int] = set()
        for word in set(WORD.findall((text or "").lower())):
            rows.update(self.rows(word))
        return float(sigmoid(self.logit(sorted(rows))))

    def logit(self, rows: list[int]) -> float:
        vectors = self.factors[rows]
        pairs = 0.5 * ((vectors.sum(axis=0) ** 2).sum() - (vectors**2).sum())
        return self.bias + self.weights[rows].sum() + pairs


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[list[int]], labels: list[int], terms: list[int], *, rank: int = 4, rounds: int = 150) -> FactorModel:
    """Fit by Adam on the whole (bounded) sample; ``rows`` hold hashed terms."""
    index = {term: k for k, term in enumerate(sorted(terms))}
    y = np.array(labels, float)
    share = float(y.mean()) if len(y) else 0.5
    factors = np.random.default_rng(7).normal(0, 0.02, (len(index), rank))
    if not index or share in (0.0, 1.0):
        bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return FactorModel(bias, index, np.zeros(len(index)), factors * 0)
    known = [[index[term] for term in row if term in index] for row in rows]
    doc = np.repeat(np.arange(len(y)), [len(row) for row in known])
    column = np.array([k for row in known for k in row], np.int64)
    balance = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    balance /= balance.sum()
    parameters = [np.array([np.log(share / (1 - share))]), np.zeros(len(index)), factors]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, rounds + 1):
        bias, weights, factors = parameters
        vectors = factors[column]
        sums = np.stack([np.bincount(doc, vectors[:, k], len(y)) for k in range(rank)], axis=1)
        squares = np.bincount(doc, (vectors**2).sum(axis=1), len(y))
        z = bias[0] + np.bincount(doc, weights[column], len(y)) + 0.5 * ((sums**2).sum(axis=1) - squares)
        slope = (sigmoid(z) - y) * balance
        for_factors = slope[doc][:, None] * (sums[doc] - vectors)
        slopes = [
            np.array([slope.sum()]),
            np.bincount(column, slope[doc], len(index)) + 1e-5 * weights,
            np.stack([np.bincount(column, for_factors[:, k], len(index)) for k in range(rank)], axis=1) + 1e-4 * factors,
        ]
        for k, (rate, gradient) in enumerate(zip((0.05, 0.1, 0.02), slopes)):
            first[k] = 0.9 * first[k] + 0.1 * gradient
            second[k] = 0.99 * second[k] + 0.01 * gradient**2
            mean, spread = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
            parameters[k] = parameters[k] - rate * mean / (np.sqrt(spread) + 1e-9)
    return FactorModel(float(parameters[0][0]), index, parameters[1], parameters[2])


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20_000, max_terms: int = 4096, min_docs: int = 3) -> FactorModel:
    """Learn from the rows of ``labels`` (doc_id, toxic) and their texts.

    The classifier is fitted on a sample of about ``max_rows`` labelled rows,
    taken by a hash of doc_id, and on the ``max_terms`` terms of ``min_docs``
    rows or more whose link with the label is clearest.  Of several labels of a
    doc_id the largest counts, of several texts the one of the smallest terms.
    """
    spark = docs.sparkSession
    marked = only(labels, doc_id="bigint", toxic="int").filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, max_rows / max(marked.count(), 1))
    cut = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    chosen = stored(marked.filter(cut), "sampled-labels")
    if chosen.count() > 2 * max_rows + 1000:
        raise ValueError("the hash of doc_id does not thin the labels")
    # the bound of max_rows holds just now: the texts are filtered where they are read
    chosen = only(docs, doc_id="bigint", text="string").filter(cut).join(F.broadcast(chosen), "doc_id")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "text"):
            found = [sorted(text_terms(text)) for text in batch.column("text").to_pylist()]
            yield batch.drop_columns(["text"]).append_column("terms", pa.array(found, pa.list_(pa.int32())))

    rows = mapped(chosen.select("doc_id", "toxic", "text"), terms, "doc_id long, toxic int, terms array<int>")
    rows = stored(rows.groupBy("doc_id", "toxic").agg(F.min("terms").alias("terms")), "sampled-terms")
    totals = rows.groupBy("toxic").count().collect()
    ones = sum(row["count"] for row in totals if row["toxic"] == 1)
    every = sum(row["count"] for row in totals)
    if not ones or ones == every:
        return fit([], [int(bool(ones))] * bool(every), [])
    seen = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("docs"), F.sum("toxic").alias("hits")
    )
    expected = F.col("docs") * F.lit(ones / every)
    clearness = F.abs(F.col("hits") - expected) / F.sqrt(expected * F.lit(1 - ones / every) + F.lit(0.1))
    best = (
        seen.filter(F.col("docs") >= min_docs)
        .withColumn("clearness", clearness)
        .filter("clearness >= 3")
        .orderBy(F.col("clearness").desc(), "term")
        .limit(max_terms)
    )
    picked = [row["term"] for row in best.collect()]
    known = F.broadcast(spark.createDataFrame([(term,) for term in picked], "known int"))  # max_terms rows
    pairs = rows.select("doc_id", "toxic", F.explode_outer("terms").alias("term")).join(known, F.col("term") == F.col("known"), "left")
    fitted = pairs.groupBy("doc_id", "toxic").agg(F.collect_list("known").alias("terms")).toPandas()
    fitted = fitted.sort_values("doc_id")  # the sums do not depend on the order of arrival
    return fit([sorted(row) for row in fitted["terms"]], fitted["toxic"].tolist(), picked)


def score(docs: DataFrame, model: FactorModel, *keys: str) -> DataFrame:
    """``keys`` (columns of ``docs``) with ``score``; only ``text`` decides."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kinds = dict(docs.dtypes)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = held.value
        for batch in small(batches, "__text"):
            found = [learned.score(text) for text in batch.column("__text").to_pylist()]
            yield batch.drop_columns(["__text"]).append_column("score", pa.array(found, pa.float64()))

    schema = ", ".join(f"`{key}` {kinds[key]}" for key in keys)
    rows = docs.select(*keys, F.col("text").cast("string").alias("__text"))
    return mapped(rows, apply, f"{schema}, score double")
