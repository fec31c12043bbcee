"""Language identification: known words first, backing off to ever shorter character n-grams.

A word that training saw often enough scores by its log frequency in each
language.  Any other word scores by the longest n-grams of it (with ``_`` at
its ends) that training knows: the mean over those of one length, 5 first,
then 4, down to 1.  Words without a known n-gram say nothing.

A text is its words' scores summed, plus the log share of each language; the
score is the winner's probability.  A text that is null or without a letter is
``und`` with score 0.  Ties go to the language that sorts first.  A null key
is kept as it is; rows that share a key are scored each for itself.  With no
labelled row to learn from, every text is ``und``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.batches import mapped, on_workers, only, small

WORD = re.compile(r"[^\W\d_]+")
#: Longest n-gram, and cached words per worker.
LONGEST, CACHED = 5, 300_000
UNKNOWN = "und"


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked; single letters without the marks."""
    if n == 1:
        return list(word)
    marked = f"_{word}_"
    return [marked[k : k + n] for k in range(len(marked) - n + 1)]


def word_list(text: str) -> list[str]:
    """Runs of letters in lower case; numerals such as ½ or Ⅷ are no letters."""
    found = WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [part for word in found for part in "".join(c if c.isalpha() else " " for c in word).split()]


class WordRows(dict):
    """Number of the row of a table that holds a word's scores; a new word fills the next row."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model = model
        self.table = np.zeros((CACHED, len(model.languages)))

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        known = self.model.words.get(word)
        self.table[row] = self.model.logs[known] if known is not None else self.model.back_off(word)
        return row


@dataclass
class LanguageModel:
    """Log frequencies per language; ``words`` and ``parts`` give row numbers of ``logs``."""

    languages: list[str]
    prior: list[float]
    words: dict[str, int]
    parts: list[dict[str, int]]
    logs: list[tuple[float, ...]]
    rows: WordRows | None = None

    def back_off(self, word: str) -> list[float]:
        """Scores of a word that is not in ``words``."""
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            known = [row for row in map(self.parts[n].get, grams(word, n)) if row is not None]
            if known:
                return [sum(column) / len(known) for column in zip(*map(self.logs.__getitem__, known))]
        return [0.0] * len(self.languages)

    def scores(self, text: str | None) -> tuple[str, float]:
        words = word_list(text) if text else []
        if not words or not self.languages:
            return UNKNOWN, 0.0
        total = np.array(self.prior)
        for at in range(0, len(words), CACHED // 2):
            some = words[at : at + CACHED // 2]
            if self.rows is None or len(self.rows) + len(some) > CACHED:
                self.rows = WordRows(self)
            numbers = list(map(self.rows.__getitem__, some))
            total += self.rows.table[numbers].sum(axis=0)
        chance = np.exp(total - total.max())
        best = int(total.argmax())
        return self.languages[best], float(chance[best] / chance.sum())


def labelled_sample(docs: DataFrame, max_rows: int) -> DataFrame:
    """Labelled rows, thinned by a hash of the key so that about ``max_rows`` are expected."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = labelled.count()
    share = min(1.0, max_rows / max(rows, 1))
    return labelled.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))


def train(
    docs: DataFrame, *, max_rows: int = 4000, min_count: int = 3, max_words: int = 30_000, max_grams: int = 60_000
) -> LanguageModel:
    """Learn from ``docs`` (doc_id, text, lang).

    The classifier is fitted on a sample of about ``max_rows`` labelled rows,
    taken by a hash of doc_id; of its words and n-grams the ``max_words`` and
    ``max_grams`` most frequent are kept, so the model has a fixed size.
    """
    sample = labelled_sample(only(docs, doc_id="bigint", text="string", lang="string"), max_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                counts.setdefault(lang, Counter()).update(word_list(text))
            for lang, words in counts.items():
                terms = Counter()
                for word, times in words.items():
                    terms[(0, word)] += times
                    for n in range(1, LONGEST + 1):
                        for gram in grams(word, n):
                            terms[(n, gram)] += times
                kinds, names = zip(*terms) if terms else ((), ())
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(terms), pa.string()),
                        "kind": pa.array(kinds, pa.int32()),
                        "term": pa.array(names, pa.string()),
                        "times": pa.array(terms.values(), pa.int64()),
                    }
                )

    counts = mapped(sample.select("text", "lang"), count, "lang string, kind int, term string, times long")
    summed = counts.groupBy("kind", "term", "lang").agg(F.sum("times").alias("times"))
    terms = summed.groupBy("kind", "term").agg(
        F.sum("times").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "times"))).alias("by_lang")
    )
    frequent = terms.filter(F.col("total") >= min_count)
    order = [F.col("total").desc(), "kind", "term"]
    words = frequent.filter("kind = 0").orderBy(*order).limit(max_words)
    parts = frequent.filter("kind > 0").orderBy(*order).limit(max_grams)
    shares = {row["lang"]: row["count"] for row in sample.groupBy("lang").count().collect()}
    return fit(words.unionByName(parts).collect(), shares)


def fit(terms: list, shares: dict[str, int]) -> LanguageModel:
    """The model of counted terms (kind, term, by_lang) and rows per language."""
    languages = sorted(shares)
    at = {lang: k for k, lang in enumerate(languages)}
    counts = np.zeros((len(terms), len(languages)))
    kinds = np.array([term["kind"] for term in terms], int)
    words: dict[str, int] = {}
    parts: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    for row, term in enumerate(terms):
        (parts[term["kind"]] if term["kind"] else words)[term["term"]] = row
        for lang, times in term["by_lang"].items():
            counts[row, at[lang]] = times
    logs = np.zeros_like(counts)
    for kind in set(kinds.tolist()):
        mine = counts[kinds == kind] + 0.1
        logs[kinds == kind] = np.log(mine / mine.sum(axis=0))
    prior = np.array([shares[lang] for lang in languages], float)
    shares_of = np.log(prior / max(prior.sum(), 1)).tolist()
    return LanguageModel(languages, shares_of, words, parts, list(map(tuple, logs.tolist())))


def predict(docs: DataFrame, model: LanguageModel, *keys: str) -> DataFrame:
    """``keys`` (columns of ``docs``) with ``lang_pred`` and ``score``; only ``text`` decides."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # of the fixed size train() states
    kinds = dict(docs.dtypes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = held.value
        for batch in small(batches, "__text"):
            found = [learned.scores(text) for text in batch.column("__text").to_pylist()]
            kept = batch.drop_columns(["__text"])
            kept = kept.append_column("lang_pred", pa.array([lang for lang, _ in found], pa.string()))
            yield kept.append_column("score", pa.array([number for _, number in found], pa.float64()))
        learned.rows = None  # the worker lives on

    schema = ", ".join(f"`{key}` {kinds[key]}" for key in keys)
    rows = docs.select(*keys, F.col("text").cast("string").alias("__text"))
    return mapped(rows, score, f"{schema}, lang_pred string, score double")


def accepted(docs: DataFrame, model: LanguageModel, *, min_score: float = 0.5) -> DataFrame:
    """Documents in a recognised language, with all their columns and no new one; only the text goes to Python."""
    held = on_workers(docs.sparkSession).sparkContext.broadcast(model)  # of the fixed size train() states

    @F.arrow_udf("boolean")
    def recognised(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        learned = held.value
        for texts in batches:
            found = (learned.scores(text.as_py()) for text in texts)
            yield pa.array([lang != UNKNOWN and score >= min_score for lang, score in found], pa.bool_())
        learned.rows = None  # the worker lives on
        pa.default_memory_pool().release_unused()

    return docs.filter(recognised(F.col("text").cast("string")))
