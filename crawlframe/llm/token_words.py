"""Encoding of whole texts with a tokenizers vocabulary, word by word.

Where a vocabulary never looks across a blank, every blank-separated word has
its own ids.  A word of letters with punctuation after it is split further,
as the vocabulary's own pre-tokenizer does.  Texts are split and their words
made distinct by Arrow, so that Python sees each word of a slice once.  Unseen
words reach the library many at a time, joined by blanks: the last token of
each is known by its end-of-word mark.  Ids of words are kept for the life of
a worker, in tables of a fixed size.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Encoding, Tokenizer

from crawlframe.llm.batches import slices

#: Words kept per worker, the longest word worth keeping, words in one text for the library, and texts in one call.
KEPT_WORDS, KEPT_CHARS, TOGETHER, AT_ONCE = 400_000, 48, 2000, 64
#: Runs of punctuation kept per worker.
KEPT_MARKS = 1000
MARKS = string.punctuation
END_OF_WORD = "</w>"

#: Ids of words, one word after another, and how many each word has.
Ids = tuple[np.ndarray, np.ndarray]


def ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions in each range, one range after another."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def begins_of(sizes: np.ndarray) -> np.ndarray:
    """Where each item begins if they follow one another."""
    return np.cumsum(sizes) - sizes


class KeptIds:
    """Ids of words; where the table would overflow, only the words asked for at that moment stay."""

    def __init__(self, encode: Callable[[list[str]], Ids]):
        self.encode = encode
        self.row: dict[str, int] = {}
        self.ids, self.sizes, self.begins = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def rows(self, words: list[str], most: int) -> np.ndarray:
        """The row of each of these distinct words; rows hold until the next call."""
        found = np.fromiter(map(self.row.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found < 0).tolist()
        if new:
            if len(self.row) + len(new) > most:
                old = np.flatnonzero(found >= 0)
                kept, found[old] = found[old], np.arange(len(old))
                self.row = {words[k]: row for row, k in enumerate(old.tolist())}
                self.ids = self.ids[ranges(self.begins[kept], self.sizes[kept])]
                self.sizes = self.sizes[kept]
            unseen = [words[k] for k in new]
            ids, sizes = self.encode(unseen)
            found[new] = np.arange(len(new)) + len(self.row)
            self.row.update(zip(unseen, found[new].tolist()))
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
            self.begins = begins_of(self.sizes)
        return found


class WordEncoder:
    """Texts to ids, equal to ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[key for token, key in vocabulary.items() if token.endswith(END_OF_WORD)]] = True
        self.letters, self.marks = KeptIds(self.of_letters), KeptIds(self.raw)

    def raw(self, words: list[str]) -> Ids:
        """Ids of each word by itself."""
        out: list[np.ndarray] = [np.zeros(0, "<u4")]
        for a, b in slices([len(word) + 50 for word in words], 1_000_000):
            out.extend(np.array(one.ids, "<u4") for one in self.tokenizer.encode_batch_fast(words[a:b], add_special_tokens=False))
        return np.concatenate(out), np.array([len(ids) for ids in out[1:]], np.int64)

    def joined(self, parts: list[list[str]]) -> Iterator[Encoding]:
        """The parts as encoded by the library, a few in one call: what it returns is many times the text."""
        for at in range(0, len(parts), AT_ONCE):
            yield from self.tokenizer.encode_batch_fast([" ".join(part) for part in parts[at : at + AT_ONCE]], add_special_tokens=False)

    def of_letters(self, words: list[str]) -> Ids:
        """Ids of words that consist of letters, encoded together."""
        out: list[Ids] = []
        parts = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        for part, one in zip(parts, self.joined(parts)):
            ids = np.array(one.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            # else a word became several in normalisation
            out.append((ids, np.diff(stops, prepend=0)) if len(stops) == len(part) else self.raw(part))
        return np.concatenate([ids for ids, _ in out]), np.concatenate([sizes for _, sizes in out])

    def learn(self, words: pa.StringArray) -> Ids:
        """Ids of distinct words: letters and the punctuation after them each from their table, other words whole."""
        cores = pc.utf8_rtrim(words, MARKS)
        tail = pc.subtract(pc.binary_length(words), pc.binary_length(cores)).to_numpy()
        plain = pc.and_(pc.utf8_is_alpha(cores), pc.less_equal(pc.utf8_length(cores), KEPT_CHARS))
        plain = pc.and_not(plain, pc.match_substring(cores, "İ"))  # two characters in lower case
        known = plain.to_numpy(zero_copy_only=False) & (tail <= KEPT_CHARS)

        lower = pc.utf8_lower(cores.filter(pa.array(known))).dictionary_encode()
        core = self.letters.rows(lower.dictionary.to_numpy(zero_copy_only=False).tolist(), KEPT_WORDS)[lower.indices.to_numpy()]
        ended = np.flatnonzero(known & (tail > 0))
        after = pa.array([word[-n:] for word, n in zip(words.take(pa.array(ended)).to_pylist(), tail[ended].tolist())], pa.string()).dictionary_encode()
        mark = self.marks.rows(after.dictionary.to_pylist(), KEPT_MARKS)[after.indices.to_numpy()]
        whole, whole_sizes = self.raw(words.filter(pa.array(~known)).to_pylist())

        # two ranges for each word: its letters, or all of it, and its punctuation
        begins, sizes = np.zeros((2, len(words), 2), np.int64)
        begins[known, 0], sizes[known, 0] = self.letters.begins[core], self.letters.sizes[core]
        begins[ended, 1], sizes[ended, 1] = self.marks.begins[mark] + len(self.letters.ids), self.marks.sizes[mark]
        begins[~known, 0], sizes[~known, 0] = begins_of(whole_sizes) + len(self.letters.ids) + len(self.marks.ids), whole_sizes
        store = np.concatenate([self.letters.ids, self.marks.ids, whole])
        return store[ranges(begins.ravel(), sizes.ravel())], sizes.sum(axis=1)

    def encode(self, texts: list[str | None] | pa.StringArray) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        out: list[bytes] = []
        for a, b in slices(pc.binary_length(column).to_pylist(), 8_000_000):
            words = pc.ascii_split_whitespace(column[a:b])
            ends = np.cumsum(pc.list_value_length(words).to_numpy())
            coded = words.flatten().dictionary_encode()
            ids, sizes = self.learn(coded.dictionary)
            which = coded.indices.to_numpy()
            each = sizes[which]
            data = ids[ranges(begins_of(sizes)[which], each)].tobytes()
            stops = (4 * np.cumsum(each)[ends - 1]).tolist()  # a text has one word at least, be it empty
            out.extend(data[begin:end] for begin, end in zip([0, *stops], stops))
        return out


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per vocabulary and worker process."""
    return WordEncoder(path)
