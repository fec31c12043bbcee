"""SentencePiece models run by the tokenizers library.

The model file is a protobuf message; the few fields that matter are read here:
pieces with scores and types, the kind of model, byte fallback and the
normaliser's settings.  From them a tokenizer is built: the normaliser (its
character map, white space, the marker put before the text), then a unigram
model with its scores or a BPE model whose merges follow from the scores, with
byte fallback.  Texts are encoded in batches on all threads of the process.

Where no piece but a run of markers has a marker after its first character,
each word with the markers before it is encoded on its own, and ids of words
seen before are kept; a line break that no longer piece holds stands alone.

Null and empty texts have no ids.  Decoding drops the marker put first, and
bytes that are not UTF-8 become U+FFFD.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Encoding, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from crawlframe.llm.batches import mapped, slices, small

MARK = "▁"
#: Fixed values of the model format: kinds of model and of piece.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
KEPT_WORDS, KEPT_CHARS, TOGETHER, AT_ONCE = 300_000, 48, 2000, 8


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    at = 0
    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(wire) if wire != 2 else varint()
        if size is None:
            raise ValueError(f"wire type {wire} in a model file")
        yield number, data[at : at + size]
        at += size


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    suffix: bool = False
    charsmap: bytes = b""


def parse_model(data: bytes) -> PieceModel:
    """The model message: pieces (1), trainer settings (2), normaliser settings (3)."""
    model = PieceModel()
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            model.pieces.append(piece.get(1, b"").decode())
            model.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            model.types.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.suffix = bool(trainer.get(24, 0))
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            settings = dict(fields(value))
            model.charsmap = settings.get(2, b"")
            model.dummy_prefix = bool(settings.get(3, 1))
            model.squeeze = bool(settings.get(4, 1))
            model.escape = bool(settings.get(5, 1))
    return model


def merges_of(model: PieceModel) -> list[tuple[str, str]]:
    """All ways to join two pieces into a third, best score of the result first."""
    usable = {piece: k for k, piece in enumerate(model.pieces) if model.types[k] in (NORMAL, USER, UNUSED)}
    found = []
    for piece, k in usable.items():
        for cut in range(1, len(piece)):
            left, right = usable.get(piece[:cut]), usable.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-model.scores[k], k, left, right))
    found.sort()
    return [(model.pieces[left], model.pieces[right]) for _, _, left, right in found]


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, data: bytes):
        self.model = model = parse_model(data)
        if model.suffix or not model.escape:
            raise ValueError("only models that mark the begin of words with an escaped blank are supported")
        unknown = model.types.index(UNKNOWN)
        if model.kind == UNIGRAM:
            core = models.Unigram(list(zip(model.pieces, model.scores)), unk_id=unknown, byte_fallback=model.byte_fallback)
        elif model.kind == BPE:
            vocabulary = {piece: k for k, piece in enumerate(model.pieces)}
            core = models.BPE(
                vocabulary, merges_of(model), unk_token=model.pieces[unknown], fuse_unk=True, byte_fallback=model.byte_fallback
            )
        else:
            raise ValueError(f"model kind {model.kind} is not supported")
        self.tokenizer = Tokenizer(core)
        self.normal = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.squeeze:
            self.normal += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        self.before = normalizers.Sequence(self.normal) if self.normal else None
        ordinary = [piece for piece, kind in zip(model.pieces, model.types) if kind in (NORMAL, USER)]
        self.by_word = all(MARK not in piece.lstrip(MARK) for piece in ordinary)
        lines = all("\n" not in piece or piece == "\n" for piece in ordinary)
        self.words = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if lines else f"{MARK}*[^{MARK}]+|{MARK}+")
        if self.by_word:
            self.tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        self.tokenizer.decoder = decoders.Sequence(steps + [decoders.Strip(" ", 1, 0)] * model.dummy_prefix)
        self.kept: dict[str, bytes] = {}
        self.begins = np.array([piece.startswith(MARK) for piece in model.pieces])
        spelled = zip(model.pieces, model.types)
        self.spelling = [bytes([int(piece[1:-1], 16)]) if kind == BYTE else piece.replace(MARK, " ").encode() for piece, kind in spelled]

    def normalise(self, text: str) -> str:
        """The text with its blanks as markers and the marker put before it."""
        if self.before is not None:
            text = self.before.normalize_str(text)
        text = text.replace(" ", MARK)
        return MARK + text if text and self.model.dummy_prefix else text

    def raw(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for a, b in slices(list(map(len, texts)), 100_000):
            found = self.tokenizer.encode_batch_fast(texts[a:b], add_special_tokens=False)
            out.extend(np.array(one.ids, "<u4").tobytes() for one in found)
        return out

    def together(self, parts: list[list[str]]) -> Iterator[Encoding]:
        """The parts as encoded by the library, a few in one call: what it returns is many times the text."""
        for at in range(0, len(parts), AT_ONCE):
            yield from self.tokenizer.encode_batch_fast(list(map("".join, parts[at : at + AT_ONCE])), add_special_tokens=False)

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of words, many encoded together: a piece that begins with the marker begins a word."""
        alone = [word for word in words if not (word[0] == MARK and word[1:2] not in ("", MARK))]
        found = dict(zip(alone, self.raw(alone)))
        marked = [word for word in words if word not in found]
        parts = [marked[at : at + TOGETHER] for at in range(0, len(marked), TOGETHER)]
        for part, one in zip(parts, self.together(parts)):
            ids = np.array(one.ids, "<u4")
            starts = (4 * np.flatnonzero(self.begins[ids])).tolist()
            if len(starts) == len(part):
                data = ids.tobytes()
                found.update((word, data[a:b]) for word, a, b in zip(part, starts, [*starts[1:], len(data)]))
            else:
                found.update(zip(part, self.raw(part)))
        return [found[word] for word in words]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, four bytes each."""
        out: list[bytes] = []
        for a, b in slices([len(text or "") for text in texts], 2_000_000):
            normal = [self.normalise(text or "") for text in texts[a:b]]
            if not self.by_word:
                out.extend(self.raw(normal))
                continue
            words = [self.words.findall(text) for text in normal]
            distinct = set(chain.from_iterable(words))
            missing = list(distinct.difference(self.kept))
            if len(self.kept) + len(missing) > KEPT_WORDS:
                self.kept, missing = {}, list(distinct)
            self.kept.update(zip(missing, self.of_words(missing)))
            out.extend(b"".join(map(self.kept.__getitem__, some)) for some in words)
            for word in distinct:
                if len(word) > KEPT_CHARS:
                    self.kept.pop(word, None)
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        """Texts of ids, four bytes each; ids that do not spell UTF-8 are left to the library."""
        out = []
        for one in ids:
            numbers = np.frombuffer(one, "<u4").tolist()
            try:
                text = b"".join(map(self.spelling.__getitem__, numbers)).decode()
                out.append(text.removeprefix(" ") if self.model.dummy_prefix else text)
            except UnicodeDecodeError:
                out.append(self.tokenizer.decode(numbers, skip_special_tokens=False))
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec per model file and worker process."""
    with open(path, "rb") as file:
        return PieceCodec(file.read())


def encode_documents(docs: DataFrame, *keys: str, model: str) -> DataFrame:
    """``keys`` (columns of ``docs``) with ``ids`` (four bytes each, little-endian) of ``text``."""
    kinds = dict(docs.dtypes)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "__text"):
            ids = codec(model).encode(batch.column("__text").to_pylist())
            yield batch.drop_columns(["__text"]).append_column("ids", pa.array(ids, pa.binary()))
        codec(model).kept = {}  # the worker lives on

    schema = ", ".join(f"`{key}` {kinds[key]}" for key in keys)
    rows = docs.select(*keys, F.col("text").cast("string").alias("__text"))
    return mapped(rows, encode, f"{schema}, ids binary")


def decode_documents(encoded: DataFrame, *keys: str, model: str) -> DataFrame:
    """``keys`` (columns of ``encoded``) with the ``text`` of ``ids``."""
    kinds = dict(encoded.dtypes)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "ids"):
            texts = codec(model).decode([ids or b"" for ids in batch.column("ids").to_pylist()])
            yield batch.drop_columns(["ids"]).append_column("text", pa.array(texts, pa.string()))

    schema = ", ".join(f"`{key}` {kinds[key]}" for key in keys)
    return mapped(encoded.select(*keys, "ids"), decode, f"{schema}, text string")


def round_trips(docs: DataFrame, *keys: str, model: str) -> DataFrame:
    """``keys`` (columns of ``docs``) with n_tokens, ids_crc32 and round_trip: whether the ids spell the text again (null: the empty one)."""
    kinds = dict(docs.dtypes)

    def there_and_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "__text"):
            texts = [text or "" for text in batch.column("__text").to_pylist()]
            ids = codec(model).encode(texts)
            made = batch.drop_columns(["__text"])
            made = made.append_column("n_tokens", pa.array([len(one) // 4 for one in ids], pa.int64()))
            made = made.append_column("ids_crc32", pa.array(map(zlib.crc32, ids), pa.int64()))
            yield made.append_column("round_trip", pa.array(map(str.__eq__, codec(model).decode(ids), texts), pa.bool_()))
        codec(model).kept = {}  # the worker lives on

    schema = ", ".join(f"`{key}` {kinds[key]}" for key in keys)
    rows = docs.select(*keys, F.col("text").cast("string").alias("__text"))
    return mapped(rows, there_and_back, f"{schema}, n_tokens long, ids_crc32 long, round_trip boolean")


def parity(texts: list[str], model: str) -> list[int]:
    """Positions of the texts whose ids differ from those of the sentencepiece library."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    own = [np.frombuffer(ids, "<u4").tolist() for ids in codec(model).encode(texts)]
    return [k for k, ids in enumerate(processor.encode(texts)) if ids != own[k]]
